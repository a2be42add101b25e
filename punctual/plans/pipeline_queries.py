"""Queries that run the pipeline's own steps: messages, streams, releases, builds and reports, over whole tables.

What the steps read is made from the test tables by plain rules, alike in Spark and in SQL.
"""

from __future__ import annotations

import io
import json
import tempfile
import zipfile
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions import scalars as S
from punctual.operators import dimensions, feeds, marts, quality
from punctual.operators.history import ROUTES, STOPS, full_history
from punctual.plans import benchmarks, control, dashboard, datasets, metrics, views
from punctual.plans.problem_queries import _history_sql
from punctual.plans.queries import (
    _DAMAGED, _DEPARTURES, _LOG, _REASON, _rule_sql, DEP, GAPS, LOCAL, QUERIES, SQL, TU, VP, _lake, check_log, damaged, query, raw_positions, run_log, stop_times, table,
)
from punctual.session import shared_path, spread
from punctual.sources import feed_api, snapshot, static_release, weather_api, wire
from punctual.sources.lake import Lake, each_batch_inserts
from punctual.sources.store import HadoopStore
from punctual.streaming import pipeline
from punctual.streaming.pipeline import stream_files

_BEFORE = set(QUERIES)
T = table
_SECOND = "date_trunc('second', {})".format
_USABLE = f"usable AS (SELECT DISTINCT vehicle_id, {_SECOND('event_ts')} AS event_ts, route_id FROM damaged WHERE {_REASON} IS NULL)"

# ---------------------------------------------------------------- messages


@query(f"""WITH u AS (SELECT *, CASE WHEN CAST(floor(epoch(event_ts)) AS BIGINT) % 13 = 0 THEN {_SECOND('feed_header_ts')} ELSE {_SECOND('event_ts')} END AS e FROM {TU})
SELECT trip_id, e AS event_ts, coalesce(trip_start_date, CAST(e {LOCAL} AS DATE)) AS service_date, route_id, direction_id, trip_start_date, trip_start_time,
  schedule_relationship, vehicle_id, delay_s, n_stop_time_updates, {_SECOND('feed_header_ts')} AS feed_header_ts, {_SECOND('fetched_at')} AS fetched_at, _source_file, _ingested_at
FROM u WHERE trim(coalesce(trip_id, '')) <> '' AND e IS NOT NULL AND NOT coalesce(floor(epoch(fetched_at)) - floor(epoch(e)) < -300, false)""")
def parse_updates(spark, d):
    """Trip updates as raw JSON messages, parsed and typed again; where a message has no time its snapshot's counts."""
    text = lambda c: F.col(c).cast("string").alias(c)
    seconds = F.unix_seconds("event_ts")
    body = F.struct(
        F.struct(
            "trip_id", "route_id", text("direction_id"), F.date_format("trip_start_date", "yyyyMMdd").alias("start_date"), F.col("trip_start_time").alias("start_time"),
            "schedule_relationship",
        ).alias("trip"),
        F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"), F.col("delay_s").cast("string").alias("delay"),
        F.array_repeat(F.struct(F.lit("s").alias("stop_id")), F.col("n_stop_time_updates")).alias("stop_time_update"),
        F.when(seconds % 13 != 0, seconds.cast("string")).alias("timestamp"),
    )
    raw = spread(T(spark, d, TU)).select(
        F.lit("trip_updates").alias("feed"), F.unix_seconds("feed_header_ts").cast("string").alias("feed_header_ts"),
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"), F.to_json(F.struct(body.alias("trip_update"))).alias("entity"), "_source_file", "_ingested_at",
    )
    return feeds.valid(feeds.typed(raw, feeds.UPDATES))


def _snapshots(rows: DataFrame) -> DataFrame:
    """Raw JSON messages as binary snapshots, one for each batch of entities that came in one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            headers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bodies = [wire.encode({"header": {"timestamp": h}, "entity": [json.loads(x)]}) for h, x in zip(headers, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary()), batch.column(2)], ["content", "path"])

    return rows.select("feed_header_ts", "entity", "_source_file").mapInArrow(run, "content binary, path string").withColumn("modificationTime", F.current_timestamp())


@query(f"""SELECT vehicle_id, {_SECOND('event_ts')} AS event_ts, route_id, trip_id, stop_id, current_stop_sequence, direction_id, CAST(CAST(latitude AS FLOAT) AS VARCHAR) AS latitude
  FROM {VP}""")
def decode_positions(spark, d):
    """Positions as binary snapshots, decoded in the tasks that read them, and typed; coordinates have 32 bits there."""
    rows = wire.decoded(_snapshots(raw_positions(T(spark, d, VP))), "vehicle_positions").withColumn("_ingested_at", F.current_timestamp())
    typed = feeds.typed(rows, feeds.POSITIONS)
    return typed.select(
        "vehicle_id", "event_ts", "route_id", "trip_id", "stop_id", "current_stop_sequence", "direction_id",
        F.col("latitude").cast("float").cast("string").alias("latitude"),
    )


@query(f"""SELECT vehicle_id, {_SECOND('event_ts')} AS event_ts, CAST(NULL AS VARCHAR) AS trip_id, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS INTEGER) AS direction_id,
  CASE WHEN vehicle_id IS NULL OR trim(vehicle_id) = '' THEN 'missing_vehicle_id' WHEN event_ts IS NULL THEN 'missing_or_bad_timestamp' ELSE 'missing_position' END AS reason FROM {VP}""")
def parse_sparse(spark, d):
    """Messages of a shape without trips and positions: the fields that the data has never had are null."""
    raw = raw_positions(T(spark, d, VP)).select("feed_header_ts", "fetched_at", "_source_file", "_ingested_at", "entity")
    shape = "struct<id: string, vehicle: struct<vehicle: struct<id: string>, timestamp: string>>"
    rows = feeds.typed(raw.withColumn("entity", F.from_json("entity", shape)), feeds.POSITIONS)
    return rows.select("vehicle_id", "event_ts", "trip_id", "latitude", "direction_id", F.col("_dq_reason").alias("reason"))


class _Feeds:
    """A web session that answers with two snapshots, of which the second is the first again after a failure."""

    def __init__(self, body: bytes) -> None:
        self.answers = [SimpleNamespace(status_code=503), *[SimpleNamespace(status_code=200, content=body)] * 2]

    def get(self, url, **options):
        return self.answers.pop(0)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS vehicle_id, n_name AS label, CAST(n_regionkey AS VARCHAR) AS route_id FROM nation")
def polled_snapshot(spark, d):
    """A binary feed, polled twice with a retry, landed once, copied to the shared storage and read there."""
    rows = T(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").collect()  # 25 rows, one snapshot
    entities = [{"id": str(r[0]), "vehicle": {"vehicle": {"id": str(r[0]), "label": r[1]}, "trip": {"route_id": str(r[2])}}} for r in rows]
    body = wire.encode({"header": {"timestamp": "1790000000"}, "entity": entities})
    there = shared_path(spark, "landing")
    with tempfile.TemporaryDirectory() as here:
        settings = feed_api.Settings("k", {"vehicle_positions": "u"}, Path(here), 0.0)
        feed_api.poll(
            _Feeds(body), settings, wire.decode, 2, mirror=feed_api.Mirror(HadoopStore(spark), Path(here), there), sleep=lambda s: None
        )
    lines = spark.read.schema("entity string").json(f"{there}/vehicle_positions")
    at = lambda path, name: F.get_json_object("entity", f"$.vehicle.{path}").alias(name)
    return lines.select(at("vehicle.id", "vehicle_id"), at("vehicle.label", "label"), at("trip.route_id", "route_id"))


# ---------------------------------------------------------------- streams


def _landed(spark: SparkSession, d: str) -> tuple[Lake, dict[str, int], int]:
    """Damaged positions as landed lines, ingested and refined by streams: (lake, what refining returned, lines read)."""
    lake, landing = _lake(spark), shared_path(spark, "landing")
    raw = raw_positions(damaged(spark, d)).withColumn("entity", F.from_json("entity", feeds.POSITION_SHAPE))
    lines = raw.select(F.to_json(F.struct("feed", "feed_header_ts", "fetched_at", "entity")).alias("line"), F.to_date("fetched_at").cast("string").alias("ingest_date"))
    lines.hint("rebalance", "ingest_date").write.partitionBy("ingest_date").text(landing)
    fs, found = lake._fs(), lake._fs().listFiles(lake._path(landing), True)
    while found.hasNext():  # as a producer names them
        path = found.next().getPath()
        if path.getName().endswith(".txt"):
            fs.rename(path, lake._path(f"{path.getParent()}/{path.getName()[:-4]}.jsonl"))
    read = pipeline.ingest(lake, "vehicle_positions", landing)
    return lake, pipeline.refine(lake, "vehicle_positions"), read


@query(f"WITH {_DAMAGED}, {_USABLE} SELECT vehicle_id, event_ts, route_id FROM usable")
def stream_typed(spark, d):
    """Landed lines to the raw and then to the typed table, each key once, by two streams."""
    lake, _, _ = _landed(spark, d)
    return lake.read("silver_vehicle_positions").select("vehicle_id", "event_ts", "route_id")


@query(f"""WITH {_DAMAGED}, {_USABLE}, n AS (SELECT count(*) AS lines, count({_REASON}) AS bad FROM damaged), u AS (SELECT count(*) AS keys FROM usable)
SELECT 'reason' AS kind, {_REASON} AS name, count(*) AS n FROM damaged WHERE {_REASON} IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'ingest', 'lines_read', lines FROM n UNION ALL SELECT 'refine', 'bronze_rows_read', lines FROM n UNION ALL SELECT 'refine', 'silver_rows_added', keys FROM u
UNION ALL SELECT 'refine', 'quarantine_rows_added', bad FROM n UNION ALL SELECT 'refine', 'dropped_late', 0
UNION ALL SELECT 'again', 'silver_rows_added', 0 UNION ALL SELECT 'again', 'quarantine_rows_added', 0 UNION ALL SELECT 'reset', 'silver_rows_added', keys FROM u""")
def stream_counts(spark, d):
    """What the streams counted, the quarantine by reason, that a second run finds nothing new, and after a reset all."""
    lake, done, read = _landed(spark, d)
    again = pipeline.refine(lake, "vehicle_positions")
    pipeline.reset(lake)
    anew = pipeline.refine(lake, "vehicle_positions")
    rows = [("ingest", "lines_read", read), *[("refine", k, v) for k, v in done.items()], *[("again", k, again[k]) for k in ("silver_rows_added", "quarantine_rows_added")]]
    rows.append(("reset", "silver_rows_added", anew["silver_rows_added"]))
    by_reason = lake.read("silver_quarantine").groupBy(F.lit("reason").alias("kind"), F.col("reason").alias("name")).agg(F.count("*").alias("n"))
    return spark.createDataFrame(rows, "kind string, name string, n long").unionByName(by_reason)


@query(f"""WITH {_DAMAGED}, {_USABLE}, x AS (SELECT count(*) AS bronze_rows, count({_REASON}) AS quarantined FROM damaged),
k AS (SELECT count(*) AS keys, count(*) FILTER (WHERE vehicle_id <> (SELECT min(vehicle_id) FROM usable)) AS kept FROM usable)
SELECT bronze_rows, quarantined, bronze_rows - quarantined - keys AS duplicates, keys - kept AS dropped_late, kept AS silver_rows,
  round(100.0 * (bronze_rows - quarantined - keys) / bronze_rows, 2) AS pct_duplicates FROM x, k""")
def reconcile(spark, d):
    """Where every raw row went, when the typed table has lost one vehicle."""
    bronze = raw_positions(damaged(spark, d))
    keys = feeds.valid(feeds.typed(bronze, feeds.POSITIONS)).select(*feeds.POSITIONS.key).distinct()
    silver = keys.where(F.col("vehicle_id") != keys.agg(F.min("vehicle_id")).scalar())
    return spark.createDataFrame([feeds.reconcile(bronze, silver, feeds.POSITIONS)])


@query("SELECT DISTINCT user_id, event_type, ts FROM events")
def stream_insert_pruned(spark, d):
    """Inserts of new keys by a stream and its replay, each batch compared with the table from its earliest time on only."""
    lake, source, key = _lake(spark), f"{d}/events.parquet", ["user_id", "event_type", "ts"]
    rows = stream_files(spark, source, spark.read.parquet(source).schema).withColumn("ts", F.col("ts").cast("timestamp")).select(*key)
    lake.create_like("merged", T(spark, d, "events").select(*key))
    for attempt in ("first", "replay"):
        stream = rows.writeStream.foreachBatch(each_batch_inserts(lake, "merged", key, "ts")).option("checkpointLocation", f"{lake.root}/_checkpoints/{attempt}")
        stream.trigger(availableNow=True).start().awaitTermination()
    return lake.read("merged")


# ---------------------------------------------------------------- releases, weather


@query("""WITH v AS (SELECT max(feed_version) AS v FROM static_routes), r AS (SELECT DISTINCT route_id, CAST(length(route_id) AS INTEGER) AS n FROM static_routes WHERE feed_version = (SELECT v FROM v))
SELECT (SELECT v FROM v) AS feed_version, route_id AS trip_id, 'S' || route_id AS stop_id, n AS stop_sequence, CAST(n * 3600 + 309 AS INTEGER) AS arrival_secs,
  CAST((20 + n) * 3600 + 600 AS INTEGER) AS departure_secs, CAST(n % 2 AS INTEGER) AS timepoint, CAST(n / 2.0 AS DOUBLE) AS shape_dist_traveled FROM r""")
def static_load(spark, d):
    """A release's archive, downloaded and named by its version, loaded twice, and its stop times typed; one stop a route."""
    rows = T(spark, d, "static_routes")
    version = rows.agg(F.max("feed_version")).first()[0]
    ids = [r.route_id for r in rows.where(F.col("feed_version") == version).select("route_id").distinct().toLocalIterator()]  # some 200 routes
    lines = ["trip_id,stop_id,stop_sequence,arrival_time,departure_time,timepoint,shape_dist_traveled"]
    lines += [f"{i},S{i},{len(i)},{len(i)}:05:09,{20 + len(i)}:10:00,{len(i) % 2},{len(i) / 2}" for i in ids]
    lake = _lake(spark)
    with tempfile.TemporaryDirectory() as here:
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            z.writestr("feed/feed_info.txt", f"﻿feed_publisher_name,feed_version\nX,{version}\n")
            z.writestr("feed/stop_times.txt", "\n".join(lines) + "\n")
        archive = feed_api.download(_Feeds(body.getvalue()), "u", "k", Path(here, "got"), static_release.version_of)
        for _ in range(2):
            static_release.load(lake, archive, Path(here, "out"))
    static_release.build_stop_times(lake, version)
    return lake.read("silver_stop_times")


_HOURS = "2026-03-07 00:00:00"


@query(f"""WITH h AS (SELECT i, TIMESTAMP '{_HOURS}' + to_hours(CAST(i AS INTEGER)) AS hour_utc FROM range(96) t(i))
SELECT hour_utc, CAST(hour_utc {LOCAL} AS DATE) AS local_date, CAST(hour(hour_utc {LOCAL}) AS INTEGER) AS local_hour, i / 4.0 AS temperature_c, (i % 5) / 20.0 AS precipitation_mm,
  (i % 5) / 20.0 >= 0.1 AS is_wet, CAST(i % 3 AS INTEGER) AS weather_code FROM h WHERE i % 7 <> 0 AND i <= 60""")
def weather_parsed(spark, d):
    """Hours of a weather answer over a change of clocks, kept by hour; loaded twice, those ahead of now left out."""
    start = datetime.fromisoformat(_HOURS)
    hours = range(96)
    body = {
        "time": [(start + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in hours], "temperature_2m": [i / 4 for i in hours],
        "precipitation": [None if i % 7 == 0 else (i % 5) / 20 for i in hours], "weather_code": [i % 3 for i in hours],
    }
    web = SimpleNamespace(get=lambda url, **_: SimpleNamespace(raise_for_status=lambda: None, json=lambda: {"hourly": body}))
    lake = _lake(spark)
    for until in (40, 60):
        weather_api.load(lake, web, (start + timedelta(hours=until)).replace(tzinfo=UTC))
    return lake.read("silver_weather_hourly").select("hour_utc", "local_date", "local_hour", "temperature_c", "precipitation_mm", "is_wet", "weather_code")


# ---------------------------------------------------------------- builds


def _built(spark: SparkSession, d: str) -> tuple[Lake, dict]:
    """Marts built from the positions loaded in the first two days, then again when the rest has come: (lake, a third build)."""
    lake, rows = _lake(spark), T(spark, d, VP)
    mark = rows.agg(F.date_trunc("day", F.min("_silver_loaded_at") + F.expr("interval 2 days"))).first()[0]
    early = F.col("_silver_loaded_at") < F.lit(mark)
    lake.overwrite("silver_stop_times", stop_times(spark, d))
    lake.overwrite("static_feed_info", T(spark, d, "static_feed_info"))
    lake.overwrite(VP, rows.where(early))
    marts.build_marts(lake)
    lake.append(VP, rows.where(~early))
    marts.build_marts(lake)
    return lake, marts.build_marts(lake)


@query(f"WITH {_DEPARTURES} SELECT * FROM departures")
def build_incremental(spark, d):
    """Departures after two builds, the second of the dates that new rows touched."""
    lake, _ = _built(spark, d)
    return lake.read(DEP).drop("_gold_built_at")


@query(f"""WITH m AS (SELECT date_trunc('day', min(_silver_loaded_at) + INTERVAL 2 DAY) AS mark FROM {VP}),
p AS (SELECT service_date, _silver_loaded_at AS loaded, _silver_loaded_at < mark AS early FROM {VP}, m)
SELECT min(service_date) AS start_date, max(service_date) AS end_date, max(loaded) AS silver_loaded_through, true AS fresh, 0 AS third_build FROM p GROUP BY early""")
def build_log(spark, d):
    """The marks of both builds; a third build has nothing to do, and the newest departure's age is as it must be."""
    lake, third = _built(spark, d)
    newest = lake.read(DEP).agg(F.max("observed_ts")).scalar()
    age = F.unix_timestamp() - F.unix_seconds(newest)
    fresh = marts.freshness_s(lake)
    return lake.read("gold_build_log").select(
        "start_date", "end_date", "silver_loaded_through", (F.abs(age - F.lit(fresh)) < 3600).alias("fresh"), F.lit(third[DEP]).alias("third_build")
    )


_ENDS = """starts AS (SELECT feed_version, min(CAST(try_strptime(feed_start_date, '%Y%m%d') AS DATE)) AS start FROM static_feed_info
  WHERE feed_version IN (SELECT feed_version FROM static_routes) AND feed_version IN (SELECT feed_version FROM static_stops) GROUP BY 1),
ends AS (SELECT arg_min(feed_version, start) AS v1, min(start) AS s1, arg_max(feed_version, start) AS v2, max(start) AS s2 FROM starts)"""


def _two_releases(key: str, name: str, columns: tuple[str, ...]) -> str:
    """The dimension after the first and the last release: of one key's rows the least counts."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    packed = "concat_ws(chr(31), " + ", ".join(f"coalesce({c}, chr(0))" for c in columns) + ")"
    one = lambda v: f"(SELECT {key}, sha256({packed}) AS h FROM static_{name} WHERE feed_version = (SELECT {v} FROM ends) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"
    sides = f"(SELECT coalesce(a.{key}, b.{key}) AS id, a.h AS ha, b.h AS hb, ends.* FROM {one('v1')} a FULL JOIN {one('v2')} b USING ({key}), ends)"
    return f"""SELECT '{name}' AS entity, id, ha AS attr_hash, v1 AS feed_version, s1 AS valid_from, CASE WHEN ha IS DISTINCT FROM hb THEN s2 END AS valid_to,
      ha IS NOT DISTINCT FROM hb AS is_current FROM {sides} WHERE ha IS NOT NULL
      UNION ALL SELECT '{name}', id, hb, v2, s2, NULL, true FROM {sides} WHERE hb IS NOT NULL AND hb IS DISTINCT FROM ha"""


@query(f"WITH {_ENDS} " + " UNION ALL ".join(_two_releases(s.key, n, s.columns) for n, s in dimensions.DIMENSIONS.items()))
def dims_loaded(spark, d):
    """Both dimensions after two releases that were loaded by name, the first and the last of those with a start day."""
    lake, info = _lake(spark), T(spark, d, "static_feed_info")
    lake.overwrite("static_feed_info", info)
    given = None
    for name in dimensions.DIMENSIONS:
        rows = T(spark, d, f"static_{name}")
        lake.overwrite(f"static_{name}", rows)
        own = rows.select("feed_version").distinct()
        given = own if given is None else given.intersect(own)
    starts = info.join(given, "feed_version", "left_semi").groupBy("feed_version").agg(F.min(S.compact_date(F.col("feed_start_date"))).alias("start"))
    ends = starts.agg(F.min_by("feed_version", "start").alias("first"), F.max_by("feed_version", "start").alias("last")).first()
    for version in (ends.first, ends.last):
        dimensions.load_release(lake, version)
    shown = ["attr_hash", "feed_version", "valid_from", "valid_to", "is_current"]
    parts = [lake.read(f"dim_{n}").select(F.lit(n).alias("entity"), F.col(s.key).alias("id"), *shown) for n, s in dimensions.DIMENSIONS.items()]
    return parts[0].unionByName(parts[1])


_OF = {"route": (ROUTES, "routes"), "stop": (STOPS, "stops")}


@query(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, count(*) AS n_versions, true AS all_distinct, true AS kept, true AS stable FROM ({_history_sql(spec, name, '*')})" for e, (spec, name) in _OF.items()
))
def surrogate_keys(spark, d):
    """Every version has its own surrogate key, that of the old history where it was there, and the same when made again."""
    out = None
    for entity, (spec, name) in _OF.items():
        old = T(spark, d, f"dim_{name}")
        made = [full_history(old, T(spark, d, f"static_{name}"), T(spark, d, "static_feed_info"), spec).select(spec.key, "valid_from", spec.surrogate) for _ in range(2)]
        one, two = made[0].withColumnRenamed(spec.surrogate, "sk"), made[1].withColumnRenamed(spec.surrogate, "again")
        known = old.select(spec.key, "valid_from", F.col(spec.surrogate).alias("was"))
        rows = one.join(two, [spec.key, "valid_from"]).join(known, [spec.key, "valid_from"], "left").agg(
            F.count("*").alias("n_versions"), (F.count("*") == F.count_distinct("sk")).alias("all_distinct"),
            F.coalesce(F.bool_and(F.coalesce(F.col("sk") == F.col("was"), F.lit(True))), F.lit(True)).alias("kept"),
            F.coalesce(F.bool_and(F.col("sk") == F.col("again")), F.lit(True)).alias("stable"),
        ).select(F.lit(entity).alias("entity"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- reports


@query(f"""WITH {_LOG}, e AS (SELECT CAST(started_at {LOCAL} AS DATE) AS day, CAST(sum(3 * k) AS BIGINT) AS n FROM log WHERE step = 'bronze' AND status = 'succeeded' GROUP BY 1),
full_days AS (SELECT n FROM e WHERE (SELECT count(*) FROM e) < 3 OR day NOT IN ((SELECT min(day) FROM e), (SELECT max(day) FROM e)))
SELECT (SELECT count(*) FROM e) AS days_logged, CAST(round(avg(n)) AS BIGINT) AS avg_events_per_full_day, min(n) AS min_events_per_day, max(n) AS max_events_per_day,
  (SELECT CAST(sum(n) AS BIGINT) FROM e) AS total_events FROM full_days""")
def pipeline_kpis(spark, d):
    """The figures of the whole log; its first and last day, mostly partial, don't count towards events per day."""
    lake, names = _lake(spark), metrics.FEED_NAMES
    lake.overwrite("ops_run_log", run_log(spark, d))
    lake.overwrite("dq_results", check_log(spark, d))
    for name, source in zip(names, (VP, TU)):
        for stage in ("bronze", "silver"):
            lake.overwrite(f"{stage}_{name}", T(spark, d, source).select("_ingested_at"))
    lake.overwrite("silver_quarantine", spark.createDataFrame([], "feed string, _quarantined_at timestamp"))
    found = metrics.compute(lake)
    shown = ("days_logged", "avg_events_per_full_day", "min_events_per_day", "max_events_per_day", "total_events")
    return spark.createDataFrame([tuple(found[k] for k in shown)], ", ".join(f"{k} long" for k in shown))


@query(f"""SELECT * FROM (VALUES ('query', 'silver_route_day_lookup', 2, true), ('query', 'gold_route_day_lookup', 2, true), ('query', 'gold_full_aggregate', 2, true),
  ('table', '{VP}', NULL, true), ('table', '{DEP}', NULL, true), ('table', '{GAPS}', NULL, true)) v(kind, name, runs, measured)""")
def bench_measure(spark, d):
    """Timed reads and sizes of the tables, before and after they are laid out by date and route."""
    lake = _lake(spark)
    for name in (VP, DEP, GAPS):
        lake.overwrite(name, T(spark, d, name).repartition(8))
    benchmarks.measure(lake, "before", 2)
    benchmarks.cluster_all(lake)
    benchmarks.measure(lake, "after", 2)
    rows = benchmarks.compared(lake.read("ops_benchmarks"))
    ran = lake.read("ops_benchmarks").where("label = 'after'").select("kind", "name", "runs", "median_s", "num_files")
    fewer = F.coalesce(F.col("files_after") < F.col("files_before"), F.col("median_s") > 0)
    return rows.join(ran, ["kind", "name"]).select("kind", "name", "runs", fewer.alias("measured"))


@query(f"""WITH d AS (SELECT service_date, count(*) AS departures FROM {DEP} GROUP BY 1) SELECT service_date, departures, row_number() OVER (ORDER BY service_date) AS place FROM d""")
def daily_order(spark, d):
    """The daily dataset with the place that each row has in it."""
    rows = datasets.of("daily", T(spark, d, DEP), T(spark, d, GAPS))
    # Rows keep their order within a part, and parts are numbered in order.
    at = rows.select("service_date", "departures", F.monotonically_increasing_id().alias("at"))
    before = at.groupBy().agg(F.array_sort(F.collect_list("at")).alias("all"))  # one row a day
    return at.withColumn("all", before.scalar()).select("service_date", "departures", F.array_position("all", F.col("at")).alias("place"))


@query(SQL["daily_trend"])
def snapshot_read_back(spark, d):
    """The daily dataset exported with its manifest and read back with its types."""
    lake = _lake(spark)
    for name in (DEP, GAPS):
        lake.overwrite(name, T(spark, d, name))
    with tempfile.TemporaryDirectory() as folder:  # the driver's, as for any export
        datasets.export(lake, folder, "r")
        return snapshot.load(spark, folder)["daily"]


@query(SQL["pit_enriched"])
def views_published(spark, d):
    """Positions with their route's names by the published view."""
    lake = _lake(spark)
    for name in (VP, "dim_routes"):
        lake.overwrite(name, T(spark, d, name))
    views.publish(lake)
    return spark.table("silver_vehicle_positions_enriched").select("vehicle_id", "event_ts", "route_id", "route_sk", "route_short_name", "route_long_name", "route_match")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS number, format('{:,}', event_id * 1234567) AS grouped,
  CASE WHEN event_id % 3 = 0 THEN '–' ELSE printf('%.1f%%', CAST(event_id % 1000 AS DOUBLE) / 10) END AS percent FROM events""")
def number_text(spark, d):
    """Numbers out of text, and as text with groups of digits or as percentages."""
    n = F.col("event_id")
    text = F.when(n % 10 == 0, "NaN").when(n % 5 == 0, "12a").otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return T(spark, d, "events").select(
        "event_id", S.finite(text).alias("number"), S.grouped_digits(n * 1234567).alias("grouped"),
        S.percent_text(F.when(n % 3 != 0, (n % 1000) / 10)).alias("percent"),
    )


@query("""SELECT * FROM (VALUES ('weather', 'succeeded', 1), ('collect', 'failed', 2), ('bronze', 'succeeded', 1), ('silver', 'succeeded', 1), ('gold', 'failed', 1), ('gold', 'succeeded', 1),
  ('quality', 'failed', 1)) v(step, status, attempts)""")
def control_run(spark, d):
    """The log of a run: a failed collection stops nothing, a second attempt succeeds, failed checks stop the export."""
    lake, calls = _lake(spark), []

    def act(name: str):
        def go() -> dict:
            calls.append(name)
            if name in ("collect", "quality") or (name == "gold" and calls.count(name) == 1):
                raise RuntimeError(name)
            return {"rows": 1}

        return go

    control.run(lake, {s.name: act(s.name) for s in control.JOB}, "r")
    return lake.read("ops_run_log").groupBy("step", "status").agg(F.count("*").cast("int").alias("attempts"))


_LATEST = f"service_date BETWEEN (SELECT min(service_date) + 1 FROM {DEP}) AND (SELECT max(service_date) FROM {DEP})"


@query(" UNION ALL ".join(_rule_sql(r, _LATEST) for r in quality.RULES))
def quality_run(spark, d):
    """The verdicts that a run records for the service dates of the latest build, before it fails on a critical one."""
    lake, dep = _lake(spark), T(spark, d, DEP)
    for name in (VP, TU, GAPS):
        lake.overwrite(name, T(spark, d, name))
    lake.overwrite(DEP, dep)
    lake.overwrite("gold_route_hour_performance", marts.hourly_performance(dep))
    days = dep.agg(F.min("service_date").alias("a"), F.max("service_date").alias("b")).first()
    for low, at in ((days.a + timedelta(days=1), 2), (days.a, 1)):  # the later build is appended first
        lake.append("gold_build_log", spark.createDataFrame([(low, days.b, datetime(2026, 1, at))], "start_date date, end_date date, built_at timestamp"))
    try:
        quality.run_checks(lake, "r")
    except quality.QualityError:
        pass
    return lake.read("dq_results").select("check_name", "table_name", "severity", "failed", "total", "fail_pct", "passed")


@query(f"""WITH k AS (SELECT * FROM ({SQL['kpis_weighted']})), w AS (SELECT * FROM ({SQL['min_sample_routes']}) ORDER BY pct_on_time, departures DESC, route_id LIMIT 1)
SELECT 1 AS n, format('{{:g}}% of {{:,}} graded departures left on time.', pct_on_time, departures) AS sentence FROM k
UNION ALL SELECT 2, format('At weekday rush hour it is {{}}: {{:g}}% on time, {{:g}}% at other hours.', CASE WHEN rush_pct_on_time < rest_pct_on_time THEN 'worse' ELSE 'better' END,
  rush_pct_on_time, rest_pct_on_time) FROM k WHERE abs(rush_pct_on_time - rest_pct_on_time) >= 1
UNION ALL SELECT 3, format('{{:g}}% of headways were bunched, below a quarter of the scheduled one.', pct_bunched) FROM k
UNION ALL SELECT 4, format('Of routes with at least {{}} departures, {{}} is the least punctual: {{:g}}% on time.', least_departures, route, pct_on_time) FROM w""")
def headline_sentences(spark, d):
    """The findings in plain sentences."""
    route_hour = datasets.of("route_hour", T(spark, d, DEP), T(spark, d, GAPS)).where("day_type is not null").withColumn("hour_local", F.coalesce("hour_local", F.lit(-1)))
    summary = datasets.of("route_summary", T(spark, d, DEP), T(spark, d, GAPS), T(spark, d, "dim_routes"))
    kinds = (("% of", "departures left"), ("At weekday", ""), ("% of headways", ""), ("Of routes", ""))
    said = dashboard.headline(route_hour, summary)
    rows = [(next(n for n, (a, b) in reversed(list(enumerate(kinds, 1))) if a in s and b in s), s) for s in said]
    return spark.createDataFrame(rows, "n int, sentence string")


def queries() -> dict:
    return {k: v for k, v in QUERIES.items() if k not in _BEFORE}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k not in _BEFORE}
