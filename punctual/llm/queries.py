"""The queries of the text and statistics operators, over whole tables, and SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.leakage import find_leaks
from punctual.llm.lookalike import alike_classes, alike_pairs, fit_rewriter, normalize_texts
from punctual.llm.prefix_bpe import edited_alike, encode_corpus
from punctual.llm.rank_summary import combine_days, daily_summaries, group_percentiles, percentiles
from punctual.session import shared_path, table

PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
GROUP = ["route_id", "hour_local"]


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of the delay per route and hour, within 0.2 % of the group's ranks."""
    return group_percentiles(table(spark, d, "gold_timepoint_departures"), GROUP, "service_date", "delay_s", PERCENTILES)


def p1_daily_median(spark: SparkSession, d: str) -> DataFrame:
    """The median per route, hour and service date: the partial results that p1_percentiles combines."""
    rows = daily_summaries(table(spark, d, "gold_timepoint_departures"), GROUP, "service_date", "delay_s")
    return percentiles(rows, [*GROUP, "service_date"], [0.5])


def p1_stored_days(spark: SparkSession, d: str) -> DataFrame:
    """As p1_percentiles, from daily summaries that were written in two runs, each of its own service dates, and read back."""
    rows, folder = table(spark, d, "gold_timepoint_departures"), shared_path(spark, "daily-summaries")
    odd = F.coalesce(F.unix_date("service_date") % 2 == 1, F.lit(False))
    for part in (rows.where(~odd), rows.where(odd)):
        daily_summaries(part, GROUP, "service_date", "delay_s").write.mode("append").parquet(folder)
    return percentiles(combine_days(spark.read.parquet(folder), GROUP), GROUP, PERCENTILES)


def p1_direction_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per direction, large groups, and whether each lies within its stated bound of the exact ranks, counted."""
    rows, keys, at = table(spark, d, "gold_timepoint_departures"), ["direction_id"], PERCENTILES
    found = group_percentiles(rows, keys, "service_date", "delay_s", at)
    asked = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"p{100 * q:g}").alias("value")) for q in at])).alias("a")
    answers = found.select(F.col("direction_id").alias("g"), "n", "rank_error", asked).select("g", "n", "rank_error", "a.*")
    # The number of rows at each delay against seven answers for each direction.
    counts = rows.where("delay_s is not null").groupBy("direction_id", "delay_s").count()
    ranked = counts.join(answers, F.col("g").eqNullSafe(F.col("direction_id"))).groupBy("g", "n", "rank_error", "q").agg(
        F.sum(F.when(F.col("delay_s") < F.col("value"), F.col("count")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("delay_s") <= F.col("value"), F.col("count")).otherwise(0)).alias("through"),
    )
    rank = F.greatest(F.lit(1), F.ceil(F.round(F.col("q") * F.col("n"), 9)))
    off = F.greatest(F.col("below") + 1 - rank, rank - F.col("through"), F.lit(0))
    return ranked.select(
        F.col("g").alias("direction_id"), "q", "n", (off <= F.col("rank_error")).alias("within_stated"),
        (F.col("rank_error") <= 0.002 * F.col("n") + 1).alias("within_permitted"),
    )


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return encode_corpus(table(spark, d, "documents"))


def p7_edited(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose ids after an edit and an append, near which alone words are encoded again, are those of the whole text."""
    return edited_alike(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Every document that contains a passage of an evaluation item."""
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Per evaluation item, in how many documents it leaked and the most words tiled in one of them."""
    leaks = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return leaks.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("tiled_words").alias("most_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that look the same and are different strings."""
    return alike_pairs(table(spark, d, "documents"))


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the class of documents that look like it, and its written form."""
    return alike_classes(table(spark, d, "documents"))


def p9_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text in the one consistent form."""
    docs = table(spark, d, "documents")
    return normalize_texts(docs, fit_rewriter(docs))


def queries() -> dict:
    return {f.__name__: f for f in (p1_percentiles, p1_daily_median, p1_stored_days, p1_direction_bounds, p7_ids, p7_edited, p8_found, p8_items, p9_found, p9_classes, p9_normalized)}


def oracle_sql() -> dict[str, str]:
    cols = ", ".join(
        f"CAST(quantile_disc(delay_s, {q}) AS DOUBLE) AS p{100 * q:g}" for q in PERCENTILES
    )
    # Exact at the size of the SQL check: no group of a route and an hour reaches the 500 values (one in eps) from
    # which summaries may be compressed; the largest has 327. p1_direction_bounds has groups of thousands.
    whole = (
        f"SELECT route_id, hour_local, count(*) AS n, {cols}, CAST(0 AS BIGINT) AS rank_error "
        "FROM gold_timepoint_departures WHERE delay_s IS NOT NULL GROUP BY ALL"
    )
    return {
        "p1_percentiles": whole,
        "p1_stored_days": whole,
        "p1_direction_bounds": "SELECT direction_id, q, count(*) AS n, true AS within_stated, true AS within_permitted FROM gold_timepoint_departures, "
        f"(VALUES {', '.join(f'(CAST({q} AS DOUBLE))' for q in PERCENTILES)}) p(q) WHERE delay_s IS NOT NULL GROUP BY ALL",
        "p7_edited": "SELECT doc_id, true AS same FROM documents",
        "p1_daily_median": "SELECT route_id, hour_local, service_date, count(*) AS n, "
        "CAST(quantile_disc(delay_s, 0.5) AS DOUBLE) AS p50, CAST(0 AS BIGINT) AS rank_error "
        "FROM gold_timepoint_departures WHERE delay_s IS NOT NULL GROUP BY ALL",
    }
