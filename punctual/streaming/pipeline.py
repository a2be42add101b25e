"""The streaming part: landed JSON lines to raw tables, raw tables to typed tables and quarantine.

All queries take what is there and end. Raw tables are append-only Parquet folders, so streams over them see each
file once. Uniqueness doesn't rest on the stream's state: the typed table takes only keys it doesn't have.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators import feeds
from punctual.sources.lake import Lake, each_batch_inserts

WATERMARK = "30 minutes"


class TableLost(RuntimeError):
    """A typed table is missing while its stream believes its rows written."""


def rows_read(query) -> int:
    """Input rows of all of a finished query's batches."""
    return sum(int(p["numInputRows"] if isinstance(p, dict) else p.numInputRows) for p in query.recentProgress)


def rows_too_late(query) -> int:
    """Rows that came behind the watermark, from the state operators' own metric."""
    total = 0
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        total += sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
    return total


def checkpoint(lake: Lake, name: str) -> str:
    return f"{lake.root}/_checkpoints/{name}"


def _exists(lake: Lake, where: str) -> bool:
    path = lake._path(where)
    return path.getFileSystem(lake.spark._jsc.hadoopConfiguration()).exists(path)


def _delete(lake: Lake, where: str) -> None:
    lake._fs().delete(lake._path(where), True)
    if _exists(lake, where):
        raise RuntimeError(f"{where} could not be deleted")


# ---------------------------------------------------------------- schema registry


def all_text(schema: T.DataType) -> T.DataType:
    """The same shape with every leaf a string."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, all_text(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(all_text(schema.elementType))
    return T.StringType()


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` with the fields that only ``new`` has, at any depth; where shapes disagree the old one stays."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old.fields}
        theirs = {f.name: f.dataType for f in new.fields}
        kept = [T.StructField(n, widened(t, theirs[n]) if n in theirs else t) for n, t in known.items()]
        return T.StructType(kept + [T.StructField(n, t) for n, t in theirs.items() if n not in known])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType))
    return old


def landing_schema(lake: Lake, feed: str, landing: str) -> T.StructType:
    """The registered schema of a feed's landed lines, widened by fields that have come up since.

    Only files landed after the last look are read for it. Fields are never dropped or retyped. A line that doesn't
    fit the schema keeps its text in ``_rescued``.
    """
    where = f"{lake.root}/_schemas/{feed}.json"
    text = lake._read_text(where)
    known = json.loads(text) if text else None
    reader = lake.spark.read.option("primitivesAsString", True).option("pathGlobFilter", "*.jsonl")
    if known:
        reader = reader.option("modifiedAfter", known["until"])
    until = datetime.now(UTC) - timedelta(minutes=5)  # files may be landing just now
    try:
        found = all_text(reader.json(landing).drop("ingest_date").schema)
    except AnalysisException:  # no new file
        found = T.StructType([])
    schema = widened(T.StructType.fromJson(known["schema"]), found) if known else found
    lake._replace_text(where, json.dumps({"schema": json.loads(schema.json()), "until": until.strftime("%Y-%m-%dT%H:%M:%S")}))
    return schema


# ---------------------------------------------------------------- raw


def ingest(lake: Lake, feed: str, landing: str) -> int:
    """Appends new landed files of a feed to its raw table with their lineage; returns rows read."""
    schema = landing_schema(lake, feed, landing)
    read = T.StructType([*schema.fields, T.StructField("_rescued", T.StringType()), T.StructField("ingest_date", T.StringType())])
    lines = (
        lake.spark.readStream.schema(read).option("pathGlobFilter", "*.jsonl").option("columnNameOfCorruptRecord", "_rescued")
        .json(landing)
    )
    rows = lines.select(
        *schema.fieldNames(), "ingest_date", F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_modified_at"), F.current_timestamp().alias("_ingested_at"), "_rescued",
    )
    table = f"bronze_{feed}"
    lake.create_like(table, rows)
    if set(rows.columns) != set(lake.schema(table).fieldNames()) or rows.schema["entity"].dataType != lake.schema(table)["entity"].dataType:
        lake.widen(table, rows.schema)
    query = (
        rows.writeStream.format("parquet").option("path", lake.location(table)).option("checkpointLocation", checkpoint(lake, table))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rows_read(query)


def ingest_all(lake: Lake, landing: str, names: tuple[str, ...] = tuple(feeds.FEEDS)) -> dict[str, int]:
    return {name: ingest(lake, name, f"{landing.rstrip('/')}/{name}") for name in names}


# ---------------------------------------------------------------- typed


def refine(lake: Lake, name: str, watermark: str = WATERMARK) -> dict[str, int]:
    """New raw rows of a feed into its typed table and quarantine; returns what was read, added and dropped."""
    if name not in feeds.FEEDS:
        raise ValueError(f"no such feed: {name!r}; there are {', '.join(feeds.FEEDS)}")
    feed, table = feeds.FEEDS[name], f"silver_{name}"
    loaded = F.current_timestamp()
    shape = feeds.valid(feeds.typed(lake.read(f"bronze_{name}"), feed)).withColumn("_silver_loaded_at", loaded)
    if not lake.exists(table) and _exists(lake, checkpoint(lake, table)):
        raise TableLost(f"{table} is gone but {checkpoint(lake, table)} says its rows are written; reset() starts anew")
    lake.create_like(table, shape)
    source = feeds.typed(lake.stream(f"bronze_{name}"), feed)
    before = lake.read(table).count()
    good = feeds.valid(source).withColumn("_silver_loaded_at", loaded)
    stream = (
        good.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(list(feed.key))
        .writeStream.foreachBatch(each_batch_inserts(lake, table, feed.key, "event_ts"))
        .option("checkpointLocation", checkpoint(lake, table)).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    bad = feeds.quarantined(source, name)
    lake.create_like("silver_quarantine", bad)
    set_aside = lambda: lake.read("silver_quarantine").where(F.col("feed") == name).count()
    aside = set_aside()
    other = _append_stream(lake, bad, "silver_quarantine", f"quarantine_{name}")
    other.awaitTermination()
    return {
        "bronze_rows_read": rows_read(stream), "silver_rows_added": lake.read(table).count() - before,
        "quarantine_rows_added": set_aside() - aside, "dropped_late": rows_too_late(stream),
    }


def _append_stream(lake: Lake, rows: DataFrame, table: str, name: str):
    """Appends batches; a batch that is run again after a crash is recognised by its number and left out."""

    def add(batch: DataFrame, number: int) -> None:
        own = Lake(batch.sparkSession, lake.root)
        done = f"{checkpoint(own, name)}/done.json"
        text = own._read_text(done)
        if text is None or json.loads(text) < number:
            own.append(table, batch)
            own._replace_text(done, json.dumps(number))

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint(lake, name)).trigger(availableNow=True).start()


def refine_all(lake: Lake, watermark: str = WATERMARK) -> dict[str, dict[str, int]]:
    return {name: refine(lake, name, watermark) for name in feeds.FEEDS}


def reset(lake: Lake) -> None:
    """Deletes the typed tables and their checkpoints; every checkpoint must be gone before a table is dropped."""
    for name in feeds.FEEDS:
        _delete(lake, checkpoint(lake, f"silver_{name}"))
        _delete(lake, checkpoint(lake, f"quarantine_{name}"))
    for table in (*[f"silver_{n}" for n in feeds.FEEDS], "silver_quarantine"):
        lake.drop(table)


def reconcile(lake: Lake, name: str) -> dict:
    """Where every raw row of a feed went."""
    return feeds.reconcile(lake.read(f"bronze_{name}"), lake.read(f"silver_{name}"), feeds.FEEDS[name])


# ---------------------------------------------------------------- building blocks


def stream_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream over a Parquet folder, or over a single file by way of its folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        return reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return reader.parquet(path)


def distinct_in_stream(spark: SparkSession, source: str, schema: T.StructType, at: str, keys: list[str], watermark: str, out: str) -> DataFrame:
    """The first row of each key within the watermark, by a stream over a folder run to its end; read back from ``out``."""
    query = (
        stream_files(spark, source, schema).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, watermark)
        .dropDuplicatesWithinWatermark(keys).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)
