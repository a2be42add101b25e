"""Applying one release at a time to a dimension with version periods."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import scalars as S
from punctual.operators.history import ROUTES, STOPS, Tracked, attr_hash

DIMENSIONS = {"routes": ROUTES, "stops": STOPS}
_VERSION = re.compile(r"[\w.-]+")


def release_rows(source: DataFrame, spec: Tracked, feed_version: str, valid_from: date) -> DataFrame:
    """One release in the dimension's shape: tracked columns it lacks are null, each key comes once (the least row)."""
    tracked = [F.col(c).cast("string") if c in source.columns else F.lit(None).cast("string") for c in spec.columns]
    one = source.groupBy(F.col(spec.key)).agg(F.min(F.struct(*[t.alias(c) for t, c in zip(tracked, spec.columns)])).alias("a"))
    return one.select(spec.key, "a.*").select(
        "*", attr_hash(spec.columns).alias("attr_hash"), F.lit(feed_version).alias("feed_version"), F.lit(valid_from).alias("valid_from")
    )


def next_state(current: DataFrame, release: DataFrame, spec: Tracked, valid_from: date) -> DataFrame:
    """The dimension after a release, each row with ``_change``: kept, closed or inserted.

    Open versions and the release meet in one full outer join on the key; everything follows from what each side has.
    """
    day = F.lit(valid_from)
    opened = current.where("is_current")
    shape = [*spec.columns, "attr_hash", "feed_version", "valid_from"]
    sides = opened.select(spec.key, F.struct(*[c for c in opened.columns if c != spec.key]).alias("old")).join(
        release.select(spec.key, F.struct(*shape).alias("new")), spec.key, "full_outer"
    )
    same = F.col("old.attr_hash") == F.col("new.attr_hash")
    rows = [c for c in current.columns if c not in (spec.key, "valid_to", "is_current")]
    left = sides.where("old is not null").select(
        spec.key, *[F.col(f"old.{c}").alias(c) for c in rows],
        F.when(~F.coalesce(same, F.lit(False)), day).alias("valid_to"), F.coalesce(same, F.lit(False)).alias("is_current"),
        F.when(F.coalesce(same, F.lit(False)), "kept").otherwise("closed").alias("_change"),
    )
    fresh = sides.where("new is not null and (old is null or old.attr_hash <> new.attr_hash)").select(
        spec.key, *[F.col(f"new.{c}").alias(c) for c in shape], F.xxhash64(spec.key, F.col("new.valid_from")).alias(spec.surrogate),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"), F.lit("inserted").alias("_change"),
    )
    past = current.where("not is_current").withColumn("_change", F.lit("kept"))
    return past.unionByName(left).unionByName(fresh).select(*current.columns, "_change")


def empty_dimension(spark, spec: Tracked) -> DataFrame:
    text = ", ".join(f"{c} string" for c in (spec.key, *spec.columns, "attr_hash", "feed_version"))
    return spark.createDataFrame([], f"{text}, valid_from date, {spec.surrogate} long, valid_to date, is_current boolean")


def apply_release(lake, table: str, release: DataFrame, spec: Tracked) -> dict[str, int]:
    """Applies a release in one commit; returns how many versions were inserted and closed.

    A release must begin after the versions in force; one of the same day is accepted only if it changes nothing, as
    a version that ends on the day it began would be empty.
    """
    first = release.select("valid_from").first()
    if first is None:
        raise ValueError(f"{table}: the release is empty")
    since = lake.version(table)
    current = lake.read(table) if since else empty_dimension(lake.spark, spec)
    latest = current.where("is_current").agg(F.max("valid_from")).first()[0]
    if latest is not None and first.valid_from < latest:
        raise ValueError(f"{table}: the release of {first.valid_from} is older than the versions of {latest}")
    after = next_state(current, release, spec, first.valid_from).persist()
    try:
        changes = {r["_change"]: r["count"] for r in after.groupBy("_change").count().collect()}
        done = {"inserted": changes.get("inserted", 0), "closed": changes.get("closed", 0)}
        if latest == first.valid_from and done["closed"]:
            raise ValueError(f"{table}: another release of {latest} was applied already")
        lake.overwrite(table, after.drop("_change"), done="scd2", since=since, **done)
        return done
    finally:
        after.unpersist()


def release_start(lake, feed_version: str) -> date:
    """The day a release begins; an error if it isn't known."""
    rows = lake.read("static_feed_info").where(F.col("feed_version") == feed_version)
    start = rows.agg(F.min(S.compact_date(F.col("feed_start_date")))).first()[0]
    if start is None:
        raise ValueError(f"no start date is known for the release {feed_version}")
    return start


def load_release(lake, feed_version: str) -> dict[str, dict[str, int]]:
    """Applies one static release to every dimension."""
    if not _VERSION.fullmatch(feed_version):
        raise ValueError(f"not a release name: {feed_version!r}")
    start = release_start(lake, feed_version)
    out = {}
    for name, spec in DIMENSIONS.items():
        rows = lake.read(f"static_{name}").where(F.col("feed_version") == feed_version)
        out[name] = apply_release(lake, f"dim_{name}", release_rows(rows, spec, feed_version, start), spec)
    return out
