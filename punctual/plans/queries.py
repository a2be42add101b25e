"""One query per operator of the engine, over the test tables, with equivalent SQL.

Positions, updates, departures, headways and dimensions are used as they are. Tables that the test data lacks are
made from others by plain rules, alike in Spark and in SQL: stop times from the departures' schedule, the log of runs
and the check results from ``events``, weather from the departures' hours.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions import scalars as S
from punctual.operators import feeds, marts, quality
from punctual.operators.dimensions import empty_dimension, next_state, release_rows
from punctual.operators.history import Tracked
from punctual.plans import benchmarks, dashboard, datasets, metrics
from punctual.session import LOCAL_ZONE, shared_path, spread, table
from punctual.sources.lake import Lake, each_batch_inserts
from punctual.sources.snapshot import overlap
from punctual.streaming.pipeline import distinct_in_stream, stream_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if SQL can tell."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, shared_path(spark, "lake"))


T = table
LOCAL = f"AT TIME ZONE 'UTC' AT TIME ZONE '{LOCAL_ZONE}'"
DEP, GAPS, VP, TU = "gold_timepoint_departures", "gold_headways", "silver_vehicle_positions", "silver_trip_updates"

# ---------------------------------------------------------------- scans and scalar functions


@query("SELECT event_id, user_id, event_type, true AS from_table, true AS modified, true AS has_size FROM events")
def scan_metadata(spark, d):
    """A scan with the file it came from, its size, and when that was written."""
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", F.col("_metadata").alias("m"))
    return rows.select(
        "event_id", "user_id", "event_type", F.regexp_replace("m.file_path", "^file:/+", "/").startswith(f"{d}/events.parquet").alias("from_table"),
        (F.col("m.file_modification_time") < F.current_timestamp()).alias("modified"), (F.col("m.file_size") > 0).alias("has_size"),
    )


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1")
def parse_json_props(spark, d):
    """Numbers out of JSON text."""
    return T(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("k_sum"))


@query("""WITH x AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '99999999999' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '-' || event_id
  WHEN 4 THEN '20261399' WHEN 5 THEN '20260131' ELSE CAST(value AS VARCHAR) END AS t FROM events)
SELECT event_id, CASE WHEN regexp_full_match(t, '-?[0-9]+') THEN TRY_CAST(t AS INTEGER) END AS as_int,
  CASE WHEN regexp_full_match(t, '-?[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?') THEN TRY_CAST(t AS DOUBLE) END AS as_double,
  CASE WHEN regexp_full_match(t, '[0-9]{8}') THEN CAST(try_strptime(t, '%Y%m%d') AS DATE) END AS as_date,
  CASE WHEN regexp_full_match(t, '[0-9]+') THEN to_timestamp(CAST(t AS BIGINT)) AT TIME ZONE 'UTC' END AS as_ts FROM x""")
def safe_casts(spark, d):
    """Lenient parsing: malformed, overflowing and impossible values are null."""
    e, n = T(spark, d, "events"), F.col("event_id") % 7
    text = F.when(n == 0, "99999999999").when(n == 1, "n/a").when(n == 2, "").when(n == 3, F.concat(F.lit("-"), F.col("event_id")))
    text = text.when(n == 4, "20261399").when(n == 5, "20260131").otherwise(F.col("value").cast("string"))
    t = F.col("t")
    return e.select("event_id", text.alias("t")).select(
        "event_id", S.whole_number(t).alias("as_int"), S.real_number(t).alias("as_double"), S.compact_date(t).alias("as_date"), S.epoch_instant(t).alias("as_ts")
    )


_REASON = """CASE WHEN vehicle_id IS NULL OR trim(vehicle_id) = '' THEN 'missing_vehicle_id' WHEN event_ts IS NULL THEN 'missing_or_bad_timestamp'
  WHEN latitude IS NULL OR longitude IS NULL THEN 'missing_position'
  WHEN abs(latitude) > 90 OR abs(longitude) > 180 OR (latitude = 0 AND longitude = 0) THEN 'invalid_position'
  WHEN floor(epoch(fetched_at)) - floor(epoch(event_ts)) < -300 THEN 'timestamp_in_future' END"""


_E = "CAST(floor(epoch(event_ts)) AS BIGINT)"
_DAMAGED = f"""damaged AS (SELECT CASE WHEN {_E} % 11 = 0 THEN ' ' ELSE vehicle_id END AS vehicle_id, event_ts, CASE WHEN {_E} % 13 = 0 THEN NULL WHEN {_E} % 17 = 0 THEN 95
  WHEN {_E} % 23 = 0 THEN 0 ELSE latitude END AS latitude, CASE WHEN {_E} % 23 = 0 THEN 0 ELSE longitude END AS longitude,
  CASE WHEN {_E} % 19 = 0 THEN event_ts - INTERVAL 400 SECOND ELSE fetched_at END AS fetched_at, route_id FROM {VP})"""


def damaged(spark: SparkSession, d: str) -> DataFrame:
    """Positions of which some break each rule."""
    hit = lambda n: F.unix_seconds("event_ts") % n == 0
    return T(spark, d, VP).withColumns({
        "vehicle_id": F.when(hit(11), " ").otherwise(F.col("vehicle_id")),
        "latitude": F.when(hit(13), None).when(hit(17), 95.0).when(hit(23), 0.0).otherwise(F.col("latitude")),
        "longitude": F.when(hit(23), 0.0).otherwise(F.col("longitude")),
        "fetched_at": F.when(hit(19), F.col("event_ts") - F.expr("interval 400 seconds")).otherwise(F.col("fetched_at")),
    })


@query(f"WITH {_DAMAGED} SELECT vehicle_id, event_ts, {_REASON} AS reason FROM damaged")
def dq_reason(spark, d):
    """The first rule that a position breaks."""
    return damaged(spark, d).select("vehicle_id", "event_ts", S.first_reason(feeds.position_rules()).alias("reason"))


@query(f"""WITH {_DAMAGED} SELECT coalesce({_REASON}, 'valid') AS reason, count(*) AS n, count({_REASON}) AS records FROM damaged GROUP BY 1""")
def quarantine_split(spark, d):
    """Usable rows and quarantined records by reason."""
    rows = damaged(spark, d).withColumn("_dq_reason", S.first_reason(feeds.position_rules()))
    good = feeds.valid(rows).groupBy(F.lit("valid").alias("reason")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("records"))
    bad = feeds.quarantined(rows, "vehicle_positions")
    return good.unionByName(bad.groupBy("reason").agg(F.count("*").alias("n"), F.count("record").alias("records")))


def raw_positions(rows: DataFrame) -> DataFrame:
    """Positions as raw rows, each message as JSON text; a table in few files is dealt out first, as landed files are many."""
    rows = spread(rows)
    text = lambda c, name=None: F.col(c).cast("string").alias(name or c)
    vehicle = F.struct(
        F.struct(
            "trip_id", "route_id", text("direction_id"), F.date_format("trip_start_date", "yyyyMMdd").alias("start_date"), F.col("trip_start_time").alias("start_time"),
        ).alias("trip"),
        F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label")).alias("vehicle"),
        F.struct(text("latitude"), text("longitude"), text("bearing"), text("speed_mps", "speed")).alias("position"),
        text("current_stop_sequence"), "stop_id", "current_status", "occupancy_status", F.unix_seconds("event_ts").cast("string").alias("timestamp"),
    )
    return rows.select(
        F.lit("vehicle_positions").alias("feed"), F.unix_seconds("feed_header_ts").cast("string").alias("feed_header_ts"),
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
        F.to_json(F.struct(F.col("vehicle_id").alias("id"), vehicle.alias("vehicle"))).alias("entity"), "_source_file", "_ingested_at",
    )


@query(f"""SELECT vehicle_id, date_trunc('second', event_ts) AS event_ts, coalesce(trip_start_date, CAST(event_ts {LOCAL} AS DATE)) AS service_date, route_id, trip_id, direction_id,
  trip_start_date, trip_start_time, vehicle_label, current_status, stop_id, current_stop_sequence, latitude, longitude, bearing, speed_mps, occupancy_status,
  CAST(floor(epoch(fetched_at)) - floor(epoch(event_ts)) AS BIGINT) AS staleness_s, date_trunc('second', feed_header_ts) AS feed_header_ts,
  date_trunc('second', fetched_at) AS fetched_at, _source_file, _ingested_at FROM {VP} WHERE {_REASON} IS NULL""")
def parse_positions(spark, d):
    """Positions as raw JSON messages, parsed and typed again, all columns."""
    return feeds.valid(feeds.typed(raw_positions(T(spark, d, VP)), feeds.POSITIONS))


@query(f"SELECT event_id, CAST(ts {LOCAL} AS DATE) AS local_day, CAST(hour(ts {LOCAL}) AS INTEGER) AS local_hour FROM events")
def service_day(spark, d):
    """Local calendar day and hour of UTC instants."""
    return T(spark, d, "events").select("event_id", S.local_day(F.col("ts")).alias("local_day"), F.hour(F.from_utc_timestamp("ts", LOCAL_ZONE)).alias("local_hour"))


_CLOCK = "lpad(CAST(event_id % 30 AS VARCHAR), CASE WHEN event_id % 2 = 0 THEN 2 ELSE CAST(length(CAST(event_id % 30 AS VARCHAR)) AS INTEGER) END, '0') || ':' || lpad(CAST(event_id % 63 AS VARCHAR), 2, '0') || ':05'"


@query(f"""SELECT event_id, CASE WHEN regexp_full_match({_CLOCK}, '[0-9]{{1,3}}:[0-5][0-9]:[0-5][0-9]') THEN
  CAST((event_id % 30) * 3600 + (event_id % 63) * 60 + 5 AS INTEGER) END AS secs FROM events""")
def gtfs_seconds(spark, d):
    """Schedule clock text, beyond 24 hours too, as seconds."""
    n = lambda m: (F.col("event_id") % m).cast("string")
    hours = F.when(F.col("event_id") % 2 == 0, F.lpad(n(30), 2, "0")).otherwise(n(30))
    return T(spark, d, "events").select("event_id", S.clock_seconds(F.concat(hours, F.lit(":"), F.lpad(n(63), 2, "0"), F.lit(":05"))).alias("secs"))


@query(f"""SELECT trip_id, service_date, stop_sequence, (CAST(service_date AS TIMESTAMP) + to_seconds(stop_sequence * 4000)) AT TIME ZONE '{LOCAL_ZONE}'
  AT TIME ZONE 'UTC' AS scheduled FROM {DEP}""")
def schedule_to_utc(spark, d):
    """Seconds of a service day as UTC instants."""
    return T(spark, d, DEP).select("trip_id", "service_date", "stop_sequence", S.schedule_instant(F.col("service_date"), F.col("stop_sequence") * 4000).alias("scheduled"))


@query(f"""SELECT DISTINCT service_date, CAST((stop_sequence * 4000 // 3600) % 24 AS INTEGER) AS hour_local, strftime(service_date, '%a') AS day_of_week FROM {DEP}""")
def hour_dow(spark, d):
    """Scheduled hour of day and name of the weekday."""
    return T(spark, d, DEP).select(
        "service_date", S.schedule_hour(F.col("stop_sequence") * 4000).alias("hour_local"), S.weekday_name(F.col("service_date")).alias("day_of_week")
    ).distinct()


# ---------------------------------------------------------------- dedupe and streams


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_keys(spark, d):
    """Distinct keys."""
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def dedupe_latest(spark, d):
    """The latest row of each key under a total order, by one partial aggregation instead of a sort."""
    rows = T(spark, d, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    best = F.min(F.struct((-F.unix_micros("l_shipdate")).alias("o"), *rest, "l_shipdate")).alias("r")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(best).select("l_orderkey", "l_linenumber", *[f"r.{c}" for c in [*rest, "l_shipdate"]])


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    """Keys that a stream with a watermark lets through once."""
    source = f"{d}/events.parquet"
    rows = distinct_in_stream(
        spark, source, spark.read.parquet(source).schema, "ts", ["user_id", "event_type"], "60 days", shared_path(spark, "stream")
    )
    return rows.select("user_id", "event_type")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_insert_merge(spark, d):
    """Inserts of new keys by a stream; a second, replayed stream adds nothing."""
    lake, source = _lake(spark), f"{d}/events.parquet"
    rows = stream_files(spark, source, spark.read.parquet(source).schema).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.select("user_id", "event_type", "ts")
    lake.create_like("merged", T(spark, d, "events").select("user_id", "event_type", "ts"))
    for attempt in ("first", "replay"):
        q = rows.writeStream.foreachBatch(each_batch_inserts(lake, "merged", ["user_id", "event_type"], None)).option(
            "checkpointLocation", f"{lake.root}/_checkpoints/{attempt}"
        ).trigger(availableNow=True).start()
        q.awaitTermination()
    return lake.read("merged").select("user_id", "event_type")


@query("""SELECT user_id, event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, event_id FROM events
  WHERE event_id % 2 = 1 AND ts >= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 5 DAY FROM events WHERE event_id % 2 = 0)""")
def stream_late_drop(spark, d):
    """Rows of a second batch that come behind the watermark of the first are dropped."""
    rows, folder = T(spark, d, "events").select("user_id", "event_id", "ts"), shared_path(spark, "late")
    out, spark_schema = f"{folder}/out", rows.schema
    for part in (0, 1):  # a batch each, as they are delivered
        rows.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{folder}/in")
        q = (
            spark.readStream.schema(spark_schema).parquet(f"{folder}/in").withWatermark("ts", "5 days").dropDuplicates(["event_id", "ts"])
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_id")


# ---------------------------------------------------------------- versions and dimensions

_VERSIONS = """v0 AS (SELECT feed_version, min(CAST(strptime(feed_start_date, '%Y%m%d') AS DATE)) AS valid_from FROM static_feed_info GROUP BY 1),
versions AS (SELECT *, lead(valid_from) OVER (ORDER BY valid_from, feed_version) AS valid_to FROM v0)"""


@query(f"WITH {_VERSIONS} SELECT * FROM versions")
def schedule_versions(spark, d):
    """Periods in which each release is in force."""
    return marts.schedule_versions(T(spark, d, "static_feed_info"))


@query(f"""WITH {_VERSIONS} SELECT DISTINCT p.trip_id, p.service_date, v.feed_version FROM {VP} p JOIN versions v
  ON p.service_date >= v.valid_from AND (v.valid_to IS NULL OR p.service_date < v.valid_to) WHERE p.trip_id IS NOT NULL""")
def pit_join(spark, d):
    """The release in force for each trip instance."""
    trips = T(spark, d, VP).where("trip_id is not null").select("trip_id", "service_date").distinct()
    return trips.join(marts.release_of_day(trips, marts.schedule_versions(T(spark, d, "static_feed_info"))), "service_date").select("trip_id", "service_date", "feed_version")


@query(f"""SELECT p.vehicle_id, p.event_ts, p.route_id, r.route_sk, r.route_short_name, r.route_long_name,
  CASE WHEN p.route_id IS NULL OR trim(p.route_id) = '' THEN 'not_on_trip' WHEN r.route_sk IS NULL THEN 'unknown_route' ELSE 'matched' END AS route_match
  FROM {VP} p LEFT JOIN dim_routes r ON p.route_id = r.route_id AND p.service_date >= r.valid_from AND (r.valid_to IS NULL OR p.service_date < r.valid_to)""")
def pit_enriched(spark, d):
    """Positions with the route names of their day and how the route matched."""
    rows = marts.enriched(T(spark, d, VP), T(spark, d, "dim_routes"))
    return rows.select("vehicle_id", "event_ts", "route_id", "route_sk", "route_short_name", "route_long_name", "route_match")


_CUSTOMER = Tracked("c_custkey", ("c_name", "c_mktsegment"), "c_sk")


@query("""WITH a AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer),
s AS (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment AS old, CASE WHEN c_custkey % 7 = 0 THEN 'NEW' ELSE c_mktsegment END AS new,
  CASE WHEN c_acctbal < 0 THEN 'later' WHEN c_acctbal > 9000 THEN 'gone' ELSE 'both' END AS seen FROM a)
SELECT c_custkey, c_name, old AS c_mktsegment, DATE '2024-01-01' AS valid_from, CASE WHEN seen = 'gone' OR old IS DISTINCT FROM new THEN DATE '2024-02-01' END AS valid_to,
  seen = 'both' AND old IS NOT DISTINCT FROM new AS is_current FROM s WHERE seen <> 'later'
UNION ALL SELECT c_custkey, c_name, new, DATE '2024-02-01', NULL, true FROM s WHERE seen = 'later' OR (seen = 'both' AND old IS DISTINCT FROM new)""")
def scd2_apply(spark, d):
    """Two releases of customers applied one after the other: changed, gone, new and unchanged keys."""
    from datetime import date

    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    seventh = lambda new: F.when(key % 7 == 0, new).otherwise(F.col("c_mktsegment"))
    c = T(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    one = c.where(balance >= 0).withColumn("c_mktsegment", seventh(F.lit(None)))
    two = c.where(balance <= 9000).withColumn("c_mktsegment", seventh(F.lit("NEW")))
    rows = empty_dimension(spark, _CUSTOMER)
    for release, name, start in ((one, "v1", date(2024, 1, 1)), (two, "v2", date(2024, 2, 1))):
        shaped = release_rows(release.withColumn("c_custkey", key.cast("string")), _CUSTOMER, name, start)
        rows = next_state(rows, shaped, _CUSTOMER, start).drop("_change")
    return rows.select("c_custkey", "c_name", "c_mktsegment", "valid_from", "valid_to", "is_current")


@query("SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 5000 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert_apply(spark, d):
    """A second batch updates keys that are there and adds the others, partition by partition; a null key is a key."""
    lake, c = _lake(spark), T(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    for name, parts in (("whole", []), ("parts", ["c_nationkey"])):
        lake.upsert(name, c.where("c_acctbal >= 0"), ["c_custkey"], parts)
        lake.upsert(name, c.where("c_acctbal < 5000").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])
    # Both ways give the same rows, each once.
    return lake.read("whole").unionByName(lake.read("parts")).groupBy("c_custkey", "c_nationkey", "c_acctbal").count().where("count = 2").drop("count")


@query(f"""SELECT service_date, stop_id, trip_id, headway_s FROM {GAPS} WHERE service_date <> (SELECT min(service_date) FROM {GAPS})
  UNION ALL SELECT service_date, stop_id, trip_id, headway_s FROM {GAPS} WHERE service_date = (SELECT min(service_date) FROM {GAPS}) AND headway_s > 1000""")
def replace_range(spark, d):
    """A date range replaced twice by fewer rows: what was there before is gone, the rest stays."""
    lake, rows = _lake(spark), T(spark, d, GAPS).select("service_date", "stop_id", "trip_id", "headway_s")
    lake.overwrite("t", rows, ["service_date"])
    first = rows.agg(F.min("service_date")).first()[0]
    fresh = rows.where((F.col("service_date") == F.lit(first)) & (F.col("headway_s") > 1000))
    for _ in range(2):
        lake.replace_range("t", fresh, "service_date", first, first, ["service_date"])
    return lake.read("t")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def compaction(spark, d):
    """A table in many files rewritten in ranges of its keys: fewer files, the same rows."""
    lake = _lake(spark)
    lake.overwrite("t", T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").repartition(24))
    sizes = lake.cluster("t", ["l_shipdate", "l_orderkey"])
    assert sizes["after"]["num_files"] < sizes["before"]["num_files"]
    return lake.read("t")


# ---------------------------------------------------------------- marts


def stop_times(spark: SparkSession, d: str) -> DataFrame:
    """The schedule that the departures were graded by, in the shape of typed stop times."""
    local = F.unix_seconds(F.from_utc_timestamp("scheduled_ts", LOCAL_ZONE)) - F.unix_date("service_date") * 86_400
    return T(spark, d, DEP).groupBy("feed_version", "trip_id", "stop_sequence").agg(F.min("stop_id").alias("stop_id"), F.min(local).cast("int").alias("departure_secs")).withColumn("timepoint", F.lit(1))


_STOP_TIMES = f"""stops AS (SELECT feed_version, trip_id, stop_sequence, min(stop_id) AS stop_id,
  CAST(min(epoch(scheduled_ts {LOCAL}) - epoch(CAST(service_date AS TIMESTAMP))) AS INTEGER) AS departure_secs FROM {DEP} GROUP BY 1, 2, 3)"""
_PINGS = f"pings AS (SELECT *, CAST(floor(epoch(event_ts)) AS BIGINT) AS t FROM {VP} WHERE trip_id IS NOT NULL AND current_stop_sequence IS NOT NULL)"
_DEPARTURES = f"""{_VERSIONS}, {_STOP_TIMES}, {_PINGS},
trips AS (SELECT DISTINCT trip_id, service_date FROM pings),
planned AS (SELECT t.trip_id, t.service_date, s.feed_version, s.stop_sequence, s.stop_id, s.departure_secs FROM trips t JOIN versions v
  ON t.service_date >= v.valid_from AND (v.valid_to IS NULL OR t.service_date < v.valid_to) JOIN stops s ON s.feed_version = v.feed_version AND s.trip_id = t.trip_id),
sides AS (SELECT l.trip_id, l.service_date, l.feed_version, l.stop_sequence, l.stop_id, l.departure_secs,
  max(CASE WHEN p.current_stop_sequence <= l.stop_sequence THEN p.t END) AS b, min(CASE WHEN p.current_stop_sequence > l.stop_sequence THEN p.t END) AS a,
  max(p.vehicle_id) AS vehicle_id, max(p.route_id) AS route_id, max(p.direction_id) AS direction_id
  FROM planned l JOIN pings p ON p.trip_id = l.trip_id AND p.service_date = l.service_date GROUP BY ALL),
seen AS (SELECT *, (CAST(service_date AS TIMESTAMP) + to_seconds(departure_secs)) AT TIME ZONE '{LOCAL_ZONE}' AT TIME ZONE 'UTC' AS scheduled_ts,
  make_timestamp((b + (a - b) // 2) * 1000000) AS observed_ts FROM sides WHERE a - b BETWEEN 1 AND 120),
dep AS (SELECT service_date, route_id, direction_id, trip_id, vehicle_id, stop_id, stop_sequence, scheduled_ts, observed_ts, CAST((a - b) // 2 AS INTEGER) AS max_error_s,
  CAST((departure_secs // 3600) % 24 AS INTEGER) AS hour_local, strftime(service_date, '%a') AS day_of_week, feed_version,
  CAST(epoch(observed_ts) - epoch(scheduled_ts) AS INTEGER) AS delay_s FROM seen),
departures AS (SELECT *, CASE WHEN delay_s < -120 THEN 'early' WHEN delay_s > 420 THEN 'late' ELSE 'on_time' END AS otp_status FROM dep)"""


def observed(spark: SparkSession, d: str) -> DataFrame:
    """Departures observed in the positions."""
    return marts.departures(T(spark, d, VP), marts.graded_stops(stop_times(spark, d)), marts.schedule_versions(T(spark, d, "static_feed_info")))


@query(f"WITH {_DEPARTURES} SELECT * FROM departures")
def timepoint_departures(spark, d):
    """Departures bracketed by pings and graded against the schedule in force."""
    return observed(spark, d)


@query(f"""WITH {_DEPARTURES} SELECT service_date, day_of_week, route_id, hour_local, CAST(count(*) AS INTEGER) AS departures,
  CAST(count(*) FILTER (WHERE otp_status = 'on_time') AS INTEGER) AS on_time, CAST(count(*) FILTER (WHERE otp_status = 'early') AS INTEGER) AS early,
  CAST(count(*) FILTER (WHERE otp_status = 'late') AS INTEGER) AS late, round(avg(delay_s), 1) + 0.0 AS avg_delay_s,
  round(100.0 * count(*) FILTER (WHERE otp_status = 'on_time') / count(*), 1) AS pct_on_time FROM departures GROUP BY 1, 2, 3, 4""")
def otp_hour(spark, d):
    """Punctuality by route, date and hour, from positions to the mart."""
    return marts.hourly_performance(observed(spark, d)).drop("p50_delay_s", "p90_delay_s")


# Spark's approximate percentile is an element of the group, and the exact one up to its accuracy of 10,000 rows a group.
@query(f"""SELECT service_date, route_id, hour_local, quantile_disc(delay_s, 0.5) AS p50_delay_s, quantile_disc(delay_s, 0.9) AS p90_delay_s
  FROM {DEP} GROUP BY service_date, day_of_week, route_id, hour_local""")
def approx_delay_pct(spark, d):
    """Approximate percentiles of the mart."""
    return marts.hourly_performance(T(spark, d, DEP)).select("service_date", "route_id", "hour_local", "p50_delay_s", "p90_delay_s")


_ONCE = f"one AS (SELECT * FROM {DEP} QUALIFY row_number() OVER (PARTITION BY trip_id, service_date, stop_sequence ORDER BY _gold_built_at DESC, delay_s NULLS FIRST, observed_ts NULLS FIRST) = 1)"
_HEADWAYS = f"""{_ONCE}, l AS (SELECT *, lag(trip_id) OVER w AS prev_trip_id, lag(observed_ts) OVER w AS po, lag(scheduled_ts) OVER w AS ps FROM one
  WINDOW w AS (PARTITION BY service_date, route_id, direction_id, stop_id ORDER BY observed_ts NULLS FIRST, trip_id)),
h AS (SELECT service_date, day_of_week, route_id, direction_id, stop_id, hour_local, trip_id, prev_trip_id,
  CAST(floor(epoch(observed_ts)) - floor(epoch(po)) AS INTEGER) AS headway_s, CAST(floor(epoch(scheduled_ts)) - floor(epoch(ps)) AS INTEGER) AS sched_headway_s
  FROM l WHERE prev_trip_id IS NOT NULL),
hr AS (SELECT *, CASE WHEN sched_headway_s > 0 THEN round(CAST(headway_s AS DOUBLE) / sched_headway_s, 3) END AS headway_ratio FROM h),
hw AS (SELECT *, CASE WHEN sched_headway_s <= 0 THEN 'out_of_order' WHEN headway_ratio < 0.25 THEN 'bunched' WHEN headway_ratio > 1.5 THEN 'gapped'
  ELSE 'regular' END AS headway_status FROM hr)"""


def _one_build(spark: SparkSession, d: str) -> DataFrame:
    """The latest build of each departure."""
    rows = T(spark, d, DEP)
    rest = [c for c in rows.columns if c not in ("trip_id", "service_date", "stop_sequence", "delay_s", "observed_ts")]
    best = F.min(F.struct((-F.unix_micros("_gold_built_at")).alias("o"), "delay_s", "observed_ts", *rest)).alias("r")
    return rows.groupBy("trip_id", "service_date", "stop_sequence").agg(best).select("trip_id", "service_date", "stop_sequence", "r.*").drop("o")


@query(f"WITH {_HEADWAYS} SELECT * FROM hw")
def headways(spark, d):
    """Gaps between consecutive buses against the scheduled gaps."""
    return marts.headways(_one_build(spark, d)).drop("observed_ts", "scheduled_ts")


@query(f"""WITH {_HEADWAYS} SELECT service_date, day_of_week, route_id, hour_local, CAST(count(*) AS INTEGER) AS headways,
  CAST(count(*) FILTER (WHERE headway_status = 'bunched') AS INTEGER) AS bunched, CAST(count(*) FILTER (WHERE headway_status = 'gapped') AS INTEGER) AS gapped,
  CAST(count(*) FILTER (WHERE headway_status = 'out_of_order') AS INTEGER) AS out_of_order,
  round(100.0 * count(*) FILTER (WHERE headway_status = 'bunched') / count(*), 1) AS pct_bunched FROM hw GROUP BY 1, 2, 3, 4""")
def bunching(spark, d):
    """Share of bunched and gapped headways."""
    return marts.hourly_bunching(marts.headways(_one_build(spark, d))).drop("p50_headway_ratio")


@query(f"""SELECT DISTINCT service_date FROM {VP} WHERE _silver_loaded_at > (SELECT min(_silver_loaded_at) + INTERVAL 2 DAY FROM {VP})""")
def hwm_incremental(spark, d):
    """Service dates with rows loaded after a mark."""
    rows = T(spark, d, VP)
    mark = rows.agg(F.min("_silver_loaded_at") + F.expr("interval 2 days")).first()[0]
    return marts.stale_days(rows, mark)


# ---------------------------------------------------------------- quality


def _checked(spark: SparkSession, d: str) -> DataFrame:
    tables = {t: T(spark, d, t) for t in (VP, TU, DEP, GAPS)}
    return quality.check_tables(tables | {"gold_route_hour_performance": marts.hourly_performance(tables[DEP])})


def _rule_sql(r: quality.Rule, inside: str = "true") -> str:
    source = f"(SELECT * FROM {r.table} WHERE {inside})"
    if r.table == "gold_route_hour_performance":
        source = f"""(SELECT count(*) AS departures, count(*) FILTER (WHERE otp_status = 'on_time') AS on_time, count(*) FILTER (WHERE otp_status = 'early') AS early,
          count(*) FILTER (WHERE otp_status = 'late') AS late, round(100.0 * count(*) FILTER (WHERE otp_status = 'on_time') / count(*), 1) AS pct_on_time
          FROM {DEP} WHERE {inside} GROUP BY service_date, day_of_week, route_id, hour_local)"""
    bad = f"count(*) OVER (PARTITION BY {', '.join(r.key)}) > 1" if r.key else r.bad
    return f"""SELECT '{r.name}' AS check_name, '{r.table}' AS table_name, '{r.severity}' AS severity, count(*) FILTER (WHERE bad) AS failed, count(*) AS total,
      CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE bad) / count(*), 3) ELSE 0 END AS fail_pct,
      100.0 * count(*) FILTER (WHERE bad) <= {r.limit_pct} * count(*) AS passed FROM (SELECT {bad} AS bad FROM {source})"""


@query(" UNION ALL ".join(map(_rule_sql, quality.RULES)))
def dq_checks(spark, d):
    """Verdicts of all rules, one pass per table."""
    return _checked(spark, d)


# ---------------------------------------------------------------- metrics over a log made from events


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as attempts: a run per user and day, four steps, a tenth of them failed, user 7 a manual run."""
    k, e = F.get_json_object("props", "$.k").try_cast("bigint"), F.col("event_id")
    steps = F.array(*map(F.lit, ("bronze", "silver", "gold", "quality")))
    body = F.struct(k.alias("vehicle_positions_rows_added"), (k * 2).alias("trip_updates_rows_added"), (k + 300).alias("freshness_s"))
    return T(spark, d, "events").select(
        F.when(F.col("user_id") == 7, "manual").otherwise(F.concat_ws("-", "user_id", F.to_date("ts"))).alias("run_id"),
        F.element_at(steps, (e % 4 + 1).cast("int")).alias("step"), F.col("ts").alias("started_at"),
        F.timestamp_seconds(F.unix_seconds("ts") + e % 600).alias("finished_at"), F.when(k < 10, "failed").otherwise("succeeded").alias("status"),
        F.to_json(body).alias("metrics"), "event_id",
    )


_LOG = """k0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
log AS (SELECT CASE WHEN user_id = 7 THEN 'manual' ELSE user_id || '-' || CAST(ts AS DATE) END AS run_id, ['bronze','silver','gold','quality'][event_id % 4 + 1] AS step,
  ts AS started_at, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + event_id % 600 AS f, CASE WHEN k < 10 THEN 'failed' ELSE 'succeeded' END AS status,
  k, event_id FROM k0)"""
_WINDOW = ("2024-01-05", "2024-01-20")
_IN = f"CAST({{}} {LOCAL} AS DATE) BETWEEN DATE '{_WINDOW[0]}' AND DATE '{_WINDOW[1]}'"


def _metric(fn: Callable[..., DataFrame], spark: SparkSession, d: str) -> DataFrame:
    return fn(run_log(spark, d), metrics.Window.of(*_WINDOW))


@query(f"""WITH {_LOG} SELECT CAST(started_at {LOCAL} AS DATE) AS run_date, count(DISTINCT run_id) AS runs, CAST(sum(k) AS BIGINT) AS vehicle_positions,
  CAST(sum(2 * k) AS BIGINT) AS trip_updates, CAST(sum(3 * k) AS BIGINT) AS events FROM log WHERE step = 'bronze' AND status = 'succeeded' AND {_IN.format('started_at')} GROUP BY 1""")
def events_per_day(spark, d):
    """Rows added per local day."""
    return _metric(metrics.events_per_day, spark, d)


@query(f"""WITH {_LOG} SELECT count(*) AS builds, quantile_cont(k + 300, 0.5) AS median_s, round(quantile_cont(k + 300, 0.95), 6) AS p95_s, round(avg(k + 300), 1) AS mean_s,
  CAST(min(k + 300) AS INTEGER) AS min_s, CAST(max(k + 300) AS INTEGER) AS max_s FROM log WHERE step = 'gold' AND status = 'succeeded' AND run_id <> 'manual' AND {_IN.format('started_at')}""")
def freshness_stats(spark, d):
    """Exact percentiles of freshness."""
    return _metric(metrics.freshness, spark, d).withColumn("p95_s", F.round("p95_s", 6))


@query(f"""WITH r AS (SELECT 'vehicle_positions' AS feed, (SELECT count(*) FROM {VP}) AS bronze, (SELECT count(*) FROM (SELECT DISTINCT vehicle_id, event_ts FROM {VP} WHERE NOT coalesce(latitude = 0, false))) AS silver,
  (SELECT count(*) FROM {VP} WHERE latitude = 0) AS quarantined UNION ALL SELECT 'trip_updates', (SELECT count(*) FROM {TU}), (SELECT count(*) FROM (SELECT DISTINCT trip_id, trip_start_date, event_ts FROM {TU})), 0)
SELECT *, bronze - silver - quarantined AS removed, round(100.0 * (bronze - silver - quarantined) / bronze, 2) AS pct_removed FROM r""")
def rows_removed(spark, d):
    """Rows that reached neither table nor quarantine."""
    vp, tu = T(spark, d, VP), T(spark, d, TU)
    zero = F.coalesce(F.col("latitude") == 0, F.lit(False))
    once = lambda rows, keys: rows.select(*keys).distinct().withColumn("_ingested_at", F.lit("2026-01-01").cast("timestamp"))
    aside = vp.where(zero).select(F.lit("vehicle_positions").alias("feed"), F.col("_ingested_at").alias("_quarantined_at"))
    return metrics.rows_removed(
        {"vehicle_positions": vp, "trip_updates": tu},
        {"vehicle_positions": once(vp.where(~zero), ["vehicle_id", "event_ts"]), "trip_updates": once(tu, ["trip_id", "trip_start_date", "event_ts"])}, aside,
    )


def check_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as check results of the runs."""
    log = run_log(spark, d).join(T(spark, d, "events").select("event_id", "event_type", "value"), "event_id")
    return log.select(
        "run_id", F.col("event_type").alias("check_name"), F.lit("t").alias("table_name"), F.when(F.col("value") > 20, "critical").otherwise("warning").alias("severity"),
        F.get_json_object("metrics", "$.vehicle_positions_rows_added").try_cast("bigint").alias("failed"), F.lit(100).cast("long").alias("total"), (F.col("value") > 5).alias("passed"),
    )


_CHECKS = f"""{_LOG}, dq AS (SELECT l.run_id, e.event_type AS check_name, 't' AS table_name, CASE WHEN e.value > 20 THEN 'critical' ELSE 'warning' END AS severity,
  l.k AS failed, 100 AS total, e.value > 5 AS passed FROM log l JOIN events e USING (event_id))"""


@query(f"""WITH {_CHECKS} SELECT count(DISTINCT run_id) AS runs, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed,
  round(100.0 * count(*) FILTER (WHERE passed) / count(*), 2) AS pct_checks_passed, count(DISTINCT run_id) - count(DISTINCT CASE WHEN NOT passed THEN run_id END) AS runs_all_passed
  FROM dq WHERE run_id IN (SELECT run_id FROM log WHERE {_IN.format('started_at')})""")
def semi_quality(spark, d):
    """Checks passed, of the runs in the window."""
    return metrics.data_quality(check_log(spark, d), run_log(spark, d), metrics.Window.of(*_WINDOW))


@query(f"""WITH {_CHECKS} SELECT check_name, table_name, severity, count(*) AS runs, count(*) FILTER (WHERE passed) AS passed, CAST(sum(failed) AS BIGINT) AS rows_failed,
  CAST(sum(total) AS BIGINT) AS rows_checked FROM dq GROUP BY 1, 2, 3""")
def dq_rollup(spark, d):
    """Check results by check."""
    return datasets.of("dq_checks", check_log(spark, d))


@query(f"""WITH {_LOG} SELECT step, count(*) AS attempts, count(*) FILTER (WHERE status = 'failed') AS failed, quantile_cont(f - s, 0.5) AS median_s, max(f - s) AS max_s
  FROM log WHERE {_IN.format('started_at')} GROUP BY 1""")
def step_runtime(spark, d):
    """Attempts and seconds per step."""
    return _metric(metrics.step_runtime, spark, d)


_RUNS = f"""{_LOG}, la AS (SELECT run_id, step, arg_max(status, started_at) AS last, min(started_at) AS first FROM log WHERE run_id <> 'manual' GROUP BY 1, 2),
runs AS (SELECT run_id, min(first) AS first_start, count(*) FILTER (WHERE last = 'failed') AS failed_steps FROM la GROUP BY 1)"""


@query(f"""WITH {_RUNS} SELECT count(*) AS runs, count(*) FILTER (WHERE failed_steps = 0) AS succeeded, round(100.0 * count(*) FILTER (WHERE failed_steps = 0) / count(*), 2) AS pct_succeeded,
  min(first_start) AS first_run, max(first_start) AS last_run FROM runs WHERE {_IN.format('first_start')}""")
def job_runs(spark, d):
    """Runs whose every step succeeded at last."""
    return _metric(metrics.job_runs, spark, d)


@query(f"""WITH {_RUNS}, r AS (SELECT CAST(first_start {LOCAL} AS DATE) AS run_date, CAST(hour(first_start {LOCAL}) AS INTEGER) AS h, failed_steps FROM runs),
days AS (SELECT CAST(unnest(generate_series(greatest(DATE '{_WINDOW[0]}', min(run_date)), least(DATE '{_WINDOW[1]}', max(run_date)), INTERVAL 1 DAY)) AS DATE) AS run_date FROM r)
SELECT d.run_date, count(h) AS runs, CAST(9 - count(DISTINCT CASE WHEN h IN (6,8,10,12,14,16,18,20,22) THEN h END) AS INTEGER) AS missing_runs, count(*) FILTER (WHERE failed_steps > 0) AS failed_runs,
  count(*) FILTER (WHERE h NOT IN (6,8,10,12,14,16,18,20,22)) AS off_schedule_runs, CAST(coalesce(sum(h), 0) AS BIGINT) AS hours_sum FROM days d LEFT JOIN r USING (run_date) GROUP BY 1""")
def run_coverage(spark, d):
    """Missed, failed and off-schedule runs per calendar day."""
    rows = _metric(metrics.run_coverage, spark, d)
    return rows.withColumn("hours_sum", F.aggregate("start_hours", F.lit(0).cast("long"), lambda a, x: a + x)).drop("start_hours")


# ---------------------------------------------------------------- published datasets

_RUSH = "(day_of_week NOT IN ('Sat','Sun') AND hour_local IN (6,7,8,16,17,18))"
_TYPE = "CASE WHEN day_of_week IN ('Sat','Sun') THEN 'weekend' ELSE 'weekday' END"
_N = lambda c, v: f"count(*) FILTER (WHERE {c} = '{v}') AS {v}"
_OTP, _HW = partial(_N, "otp_status"), partial(_N, "headway_status")


def _dep(spark, d):
    return T(spark, d, DEP)


def _gaps(spark, d):
    return T(spark, d, GAPS)


_SUMMARY = f"""d AS (SELECT route_id, count(*) AS departures, {_OTP('on_time')}, {_OTP('early')}, {_OTP('late')}, round(avg(delay_s), 1) + 0.0 AS avg_delay_s,
  round(quantile_cont(delay_s, 0.9), 6) + 0.0 AS p90_delay_s, count(*) FILTER (WHERE {_RUSH}) AS rush_departures, count(*) FILTER (WHERE {_RUSH} AND otp_status = 'on_time') AS rush_on_time,
  count(DISTINCT service_date) AS days FROM {DEP} GROUP BY 1), h AS (SELECT route_id, count(*) AS headways, {_HW('bunched')}, {_HW('gapped')} FROM {GAPS} GROUP BY 1),
summary AS (SELECT d.*, r.route_short_name, r.route_long_name, coalesce(h.headways, 0) AS headways, coalesce(h.bunched, 0) AS bunched, coalesce(h.gapped, 0) AS gapped
  FROM d LEFT JOIN h USING (route_id) LEFT JOIN dim_routes r ON r.route_id = d.route_id AND r.is_current)"""


def _summary(spark, d):
    rows = datasets.of("route_summary", _dep(spark, d), _gaps(spark, d), T(spark, d, "dim_routes"))
    return rows.withColumn("p90_delay_s", F.round("p90_delay_s", 6))


@query(f"WITH {_SUMMARY} SELECT * FROM summary")
def route_summary(spark, d):
    """Punctuality and bunching per route."""
    return _summary(spark, d)


_ROUTE_HOUR = f"""d AS (SELECT route_id, {_TYPE} AS day_type, hour_local, count(*) AS departures, {_OTP('on_time')}, {_OTP('late')}, {_OTP('early')}, CAST(sum(delay_s) AS BIGINT) AS delay_s_sum FROM {DEP} GROUP BY 1, 2, 3),
h AS (SELECT route_id, {_TYPE} AS day_type, hour_local, count(*) AS headways, {_HW('bunched')}, {_HW('gapped')} FROM {GAPS} GROUP BY 1, 2, 3),
route_hour AS (SELECT coalesce(d.route_id, h.route_id) AS route_id, coalesce(d.day_type, h.day_type) AS day_type, coalesce(d.hour_local, h.hour_local) AS hour_local,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('departures', 'on_time', 'late', 'early', 'delay_s_sum', 'headways', 'bunched', 'gapped'))}
  FROM d FULL OUTER JOIN h ON d.route_id = h.route_id AND d.day_type = h.day_type AND d.hour_local = h.hour_local)"""


def _route_hour(spark, d):
    return datasets.of("route_hour", _dep(spark, d), _gaps(spark, d))


@query(f"WITH {_ROUTE_HOUR} SELECT * FROM route_hour")
def route_hour_full(spark, d):
    """Counts per route, day type and hour."""
    return _route_hour(spark, d)


@query(f"""WITH d AS (SELECT service_date, min(day_of_week) AS day_of_week, count(*) AS departures, {_OTP('on_time')}, count(DISTINCT route_id) AS routes, count(DISTINCT vehicle_id) AS vehicles FROM {DEP} GROUP BY 1),
h AS (SELECT service_date, count(*) AS headways, {_HW('bunched')} FROM {GAPS} GROUP BY 1) SELECT d.*, coalesce(headways, 0) AS headways, coalesce(bunched, 0) AS bunched FROM d LEFT JOIN h USING (service_date)""")
def daily_trend(spark, d):
    """Counts per service date."""
    return datasets.of("daily", _dep(spark, d), _gaps(spark, d))


_STOPS = f"""d AS (SELECT stop_id, count(*) AS departures, {_OTP('on_time')}, round(avg(delay_s), 1) + 0.0 AS avg_delay_s, count(DISTINCT route_id) AS routes,
  coalesce(string_agg(DISTINCT route_id, ' ' ORDER BY route_id), '') AS route_ids FROM {DEP} GROUP BY 1), h AS (SELECT stop_id, count(*) AS headways, {_HW('bunched')} FROM {GAPS} GROUP BY 1),
stops AS (SELECT d.*, s.stop_name, TRY_CAST(s.stop_lat AS DOUBLE) AS lat, TRY_CAST(s.stop_lon AS DOUBLE) AS lon, coalesce(headways, 0) AS headways, coalesce(bunched, 0) AS bunched
  FROM d LEFT JOIN h USING (stop_id) JOIN dim_stops s ON s.stop_id = d.stop_id AND s.is_current)"""


def _stop_rows(spark, d):
    return datasets.of("stops", _dep(spark, d), T(spark, d, "dim_stops"), _gaps(spark, d))


@query(f"WITH {_STOPS} SELECT * FROM stops")
def stop_map(spark, d):
    """Counts per stop with its place and routes."""
    return _stop_rows(spark, d)


def weather_hours(spark: SparkSession, d: str) -> DataFrame:
    """A wet or dry mark for each hour with departures, but none on the first day."""
    hours = T(spark, d, DEP).where("hour_local is not null").select(F.col("service_date").alias("local_date"), F.col("hour_local").alias("local_hour")).distinct()
    rain = (F.dayofmonth("local_date") + F.col("local_hour")) % 3
    return hours.where(F.dayofmonth("local_date") != 5).select(
        "*", F.lit(10.0).alias("temperature_c"), rain.cast("double").alias("precipitation_mm"), (rain == 0).alias("is_wet")
    )


_WEATHER = f"""w AS (SELECT DISTINCT service_date AS local_date, hour_local AS local_hour, (day(service_date) + hour_local) % 3 = 0 AS is_wet FROM {DEP} WHERE hour_local IS NOT NULL AND day(service_date) <> 5),
p AS (SELECT service_date, day_of_week, route_id, hour_local, count(*) AS departures, {_OTP('on_time')}, round(avg(delay_s), 1) + 0.0 AS avg_delay_s FROM {DEP} GROUP BY 1, 2, 3, 4),
weather AS (SELECT CASE WHEN is_wet THEN 'wet' ELSE 'dry' END AS weather, {_RUSH} AS rush, count(DISTINCT (service_date, hour_local)) AS hours, CAST(sum(departures) AS BIGINT) AS departures,
  CAST(sum(on_time) AS BIGINT) AS on_time, round(sum(avg_delay_s * departures) / sum(departures), 1) + 0.0 AS avg_delay_s FROM p JOIN w ON local_date = service_date AND local_hour = hour_local GROUP BY 1, 2)"""


def _weather(spark, d):
    return datasets.of("weather", datasets.route_hour_weather(marts.hourly_performance(_dep(spark, d)), weather_hours(spark, d)))


@query(f"WITH {_WEATHER} SELECT * FROM weather")
def weather_split(spark, d):
    """Wet against dry hours."""
    return _weather(spark, d)


_EXAMPLE = f"""pick AS (SELECT service_date, route_id, direction_id, stop_id, {_HW('bunched')}, count(*) AS n FROM {GAPS} GROUP BY 1, 2, 3, 4 HAVING count(*) >= 6
  ORDER BY bunched DESC, n DESC, service_date DESC, route_id NULLS FIRST, stop_id, direction_id NULLS FIRST LIMIT 1),
example AS (SELECT d.service_date, d.route_id, d.direction_id, d.stop_id, s.stop_name, d.trip_id, d.vehicle_id, CAST(floor(epoch(d.scheduled_ts)) AS BIGINT) AS scheduled_epoch,
  CAST(floor(epoch(d.observed_ts)) AS BIGINT) AS observed_epoch, d.delay_s, h.headway_s, h.sched_headway_s, h.headway_status FROM {DEP} d
  JOIN pick p ON d.service_date = p.service_date AND d.route_id IS NOT DISTINCT FROM p.route_id AND d.direction_id IS NOT DISTINCT FROM p.direction_id AND d.stop_id = p.stop_id
  LEFT JOIN {GAPS} h ON h.service_date = d.service_date AND h.route_id IS NOT DISTINCT FROM d.route_id AND h.direction_id IS NOT DISTINCT FROM d.direction_id AND h.stop_id = d.stop_id AND h.trip_id = d.trip_id
  LEFT JOIN dim_stops s ON s.stop_id = d.stop_id AND s.is_current)"""


def _example(spark, d):
    return datasets.of("bunching_example", _dep(spark, d), _gaps(spark, d), T(spark, d, "dim_stops"))


@query(f"WITH {_EXAMPLE} SELECT * FROM example")
def bunching_example(spark, d):
    """Every bus of the most bunched stop-day."""
    return _example(spark, d)


@query(f"""WITH {_LOG} SELECT run_id, step, status, s AS started_epoch, f - s AS duration_s, 3 * k AS bronze_rows, CAST(k + 300 AS INTEGER) AS freshness_s FROM log WHERE run_id <> 'manual'""")
def pipeline_runs(spark, d):
    """Attempts of scheduled runs."""
    return datasets.of("pipeline_runs", run_log(spark, d))


@query(f"""WITH g AS (SELECT trip_id, service_date, stop_id, observed_ts, delay_s FROM {DEP} WHERE observed_ts IS NOT NULL),
t AS (SELECT trip_id, trip_start_date, event_ts, delay_s AS told FROM {TU} WHERE delay_s IS NOT NULL),
p AS (SELECT g.*, t.told, abs(CAST(floor(epoch(t.event_ts)) AS BIGINT) - CAST(floor(epoch(g.observed_ts)) AS BIGINT)) AS gap_s FROM g JOIN t ON g.trip_id = t.trip_id AND g.service_date = t.trip_start_date),
n AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY trip_id, service_date, stop_id ORDER BY gap_s, told, delay_s NULLS FIRST) = 1)
SELECT count(*) AS pairs, count(DISTINCT service_date) AS days, round(corr(delay_s, told), 3) AS correlation, quantile_cont(abs(delay_s - told), 0.5) AS median_abs_diff_s,
  round(quantile_cont(abs(delay_s - told), 0.9), 6) AS p90_abs_diff_s, quantile_cont(gap_s, 0.5) AS median_match_gap_s FROM n""")
def crosscheck_nearest(spark, d):
    """Observed delays against the operator's own, the update nearest in time; one aggregation finds the nearest."""
    return marts.agreement(marts.nearest_reports(_dep(spark, d), T(spark, d, TU))).withColumn("p90_abs_diff_s", F.round("p90_abs_diff_s", 6))


# ---------------------------------------------------------------- benchmark reads


def _busiest(t: str) -> str:
    route = f"SELECT route_id FROM (SELECT route_id, count(*) AS n FROM {t} WHERE route_id IS NOT NULL GROUP BY 1) ORDER BY n DESC, route_id DESC LIMIT 1"
    return f"route_id = ({route}) AND service_date = (SELECT max(service_date) FROM {t} WHERE route_id = ({route}))"


@query(f"SELECT vehicle_id, count(*) AS pings, max(event_ts) AS last_seen FROM {VP} WHERE {_busiest(VP)} GROUP BY 1")
def bench_silver_lookup(spark, d):
    """Pings per vehicle of the busiest route on its last day."""
    return benchmarks.pings_by_vehicle(T(spark, d, VP))


@query(f"SELECT stop_id, count(*) AS departures, round(avg(delay_s), 6) + 0.0 AS avg_delay_s FROM {DEP} WHERE {_busiest(DEP)} GROUP BY 1")
def bench_gold_lookup(spark, d):
    """Departures per stop of the busiest route on its last day."""
    return benchmarks.departures_by_stop(T(spark, d, DEP)).withColumn("avg_delay_s", F.round("avg_delay_s", 6))


@query(f"SELECT route_id, hour_local, count(*) AS departures, {_OTP('on_time')}, round(quantile_cont(delay_s, 0.9), 6) + 0.0 AS p90_delay_s FROM {DEP} GROUP BY 1, 2")
def bench_full_aggregate(spark, d):
    """Exact 90th percentile by route and hour."""
    return benchmarks.delays_by_hour(T(spark, d, DEP)).withColumn("p90_delay_s", F.round("p90_delay_s", 6))


@query("""WITH b AS (SELECT 'query' AS kind, p_brand AS name, avg(p_retailprice) AS m, count(*) AS n FROM part GROUP BY p_brand)
SELECT a.kind, a.name, a.n AS files_before, a.n AS files_after, round(a.m, 6) AS median_s_before, round(a.m / 2, 6) AS median_s_after, CAST(50.0 AS DOUBLE) AS pct_faster FROM b a""")
def bench_compare(spark, d):
    """Results of two labels side by side."""
    p = T(spark, d, "part").groupBy(F.lit("query").alias("kind"), F.col("p_brand").alias("name")).agg(F.avg("p_retailprice").alias("median_s"), F.count("*").alias("num_files"))
    both = p.withColumn("label", F.lit("before")).unionByName(p.withColumn("median_s", F.col("median_s") / 2).withColumn("label", F.lit("after")))
    rows = benchmarks.compared(both)
    return rows.withColumns({c: F.round(c, 6) for c in ("median_s_before", "median_s_after")})


# ---------------------------------------------------------------- dashboard


def _p(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(100.0 * {part} / {whole}, 1) END"


_R = "(day_type = 'weekday' AND coalesce(hour_local IN (6,7,8,16,17,18), false))"


def _side(column: str, cond: str) -> str:
    return f"sum({column}) FILTER (WHERE {cond})"


@query(f"""WITH {_ROUTE_HOUR} SELECT CAST(sum(departures) AS BIGINT) AS departures, {_p('sum(on_time)', 'sum(departures)')} AS pct_on_time, {_p('sum(late)', 'sum(departures)')} AS pct_late,
  {_p('sum(early)', 'sum(departures)')} AS pct_early, round(sum(delay_s_sum) / sum(departures) / 60, 1) + 0.0 AS avg_delay_min, CAST(sum(headways) AS BIGINT) AS headways,
  {_p('sum(bunched)', 'sum(headways)')} AS pct_bunched, {_p('sum(gapped)', 'sum(headways)')} AS pct_gapped, {_p(_side('on_time', _R), _side('departures', _R))} AS rush_pct_on_time,
  {_p(_side('on_time', 'NOT ' + _R), _side('departures', 'NOT ' + _R))} AS rest_pct_on_time, {_p(_side('bunched', _R), _side('headways', _R))} AS rush_pct_bunched,
  {_p(_side('bunched', 'NOT ' + _R), _side('headways', 'NOT ' + _R))} AS rest_pct_bunched FROM route_hour""")
def kpis_weighted(spark, d):
    """Headline figures as ratios of sums."""
    return dashboard.kpis(_route_hour(spark, d).where("day_type is not null").withColumn("hour_local", F.coalesce("hour_local", F.lit(-1))))


_PROFILE = f"""{_p('sum(on_time)', 'sum(departures)')} AS pct_on_time, {_p('sum(late)', 'sum(departures)')} AS pct_late, {_p('sum(bunched)', 'sum(headways)')} AS pct_bunched,
  CASE WHEN sum(departures) > 0 THEN round(sum(delay_s_sum) / sum(departures) / 60, 1) + 0.0 END AS avg_delay_min"""


@query(f"""WITH {_ROUTE_HOUR} SELECT hour_local, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('departures', 'on_time', 'late', 'headways', 'bunched', 'delay_s_sum'))}, {_PROFILE}
  FROM route_hour WHERE day_type = 'weekday' GROUP BY 1""")
def hour_profile(spark, d):
    """Weekday figures per hour."""
    return dashboard.hour_profile(_route_hour(spark, d), "weekday")


@query(f"""WITH {_SUMMARY}, n AS (SELECT coalesce(max(t), 5) AS least FROM (VALUES (100), (50), (30), (20), (10)) v(t) WHERE (SELECT count(*) FROM summary WHERE departures >= t) >= 10)
SELECT route_id, departures, least AS least_departures, round(100.0 * on_time / departures, 1) AS pct_on_time, {_p('rush_on_time', 'rush_departures')} AS rush_pct_on_time, {_p('bunched', 'headways')} AS pct_bunched,
  trim(concat_ws(' ', coalesce(route_short_name, route_id), coalesce(route_long_name, ''))) AS route FROM summary, n WHERE departures >= least
  ORDER BY pct_on_time, departures DESC, route_id LIMIT 15""")
def min_sample_routes(spark, d):
    """The fifteen least punctual of the routes with enough departures."""
    rows = _summary(spark, d)
    least = dashboard.enough_departures(rows)
    return dashboard.route_table(rows, least).limit(15).select(
        "route_id", "departures", F.lit(least).alias("least_departures"), "pct_on_time", "rush_pct_on_time", "pct_bunched", "route"
    )


@query(f"""WITH {_ROUTE_HOUR}, top AS (SELECT route_id FROM (SELECT route_id, sum(departures) AS n FROM route_hour WHERE route_id IS NOT NULL GROUP BY 1) ORDER BY n DESC, route_id LIMIT 10)
SELECT route_id, hour_local, departures, round(100.0 * on_time / departures, 1) AS pct_on_time FROM route_hour WHERE day_type = 'weekday' AND departures >= 5 AND route_id IN (FROM top)""")
def route_hour_grid(spark, d):
    """Punctuality per hour of the ten busiest routes, where the sample is large enough."""
    rows = _route_hour(spark, d)
    top = rows.where("route_id is not null").groupBy("route_id").agg(F.sum("departures").alias("n")).orderBy(F.desc("n"), "route_id").limit(10)
    return dashboard.route_hour_grid(rows, [r.route_id for r in top.collect()], "weekday", 5)


@query(f"WITH {_STOPS} SELECT *, round(100.0 * on_time / departures, 1) AS pct_on_time, {_p('bunched', 'headways')} AS pct_bunched FROM stops WHERE lat IS NOT NULL AND lon IS NOT NULL AND departures >= 5")
def stop_points(spark, d):
    """Stops for the map."""
    return dashboard.stop_points(_stop_rows(spark, d), 5)


_PERIOD = "CASE WHEN rush THEN 'Weekday rush' ELSE 'Other hours' END"


@query(f"WITH {_WEATHER} SELECT {_PERIOD} AS period, weather, hours, departures, round(100.0 * on_time / departures, 1) AS pct_on_time, round(avg_delay_s / 60, 1) + 0.0 AS avg_delay_min FROM weather")
def weather_table(spark, d):
    """Wet and dry figures with their samples."""
    return dashboard.weather_table(_weather(spark, d))


def _bar(w: str) -> str:
    s = lambda c: f"coalesce(sum({c}) FILTER (WHERE weather = '{w}'), 0)"
    return f"{_p(s('on_time'), s('departures'))} AS {w}, CAST({s('hours')} AS BIGINT) AS {w}_hours, CAST({s('departures')} AS BIGINT) AS {w}_departures"


@query(f"WITH {_WEATHER} SELECT {_PERIOD} AS period, {_bar('dry')}, {_bar('wet')} FROM weather GROUP BY 1")
def weather_bars(spark, d):
    """Wet next to dry per period."""
    return dashboard.weather_bars(_weather(spark, d))


_TIMELINE = "SELECT '{0}' AS kind, trip_id, vehicle_id, {1} AS epoch, round(delay_s / 60.0, 1) + 0.0 AS delay_min, headway_status, to_timestamp({1}) AT TIME ZONE '" + LOCAL_ZONE + "' AS time FROM example"


@query(f"WITH {_EXAMPLE} {_TIMELINE.format('Scheduled', 'scheduled_epoch')} UNION ALL {_TIMELINE.format('Actual', 'observed_epoch')}")
def unpivot_timeline(spark, d):
    """Two rows per bus of the example, scheduled and actual."""
    return dashboard.bunching_timeline(_example(spark, d)).drop("clock")


@query("""SELECT CAST(hour(ts) AS INTEGER) AS hour_local, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1""")
def hour_series_pivot(spark, d):
    """One row per hour, a column per series."""
    counts = T(spark, d, "events").groupBy(F.hour("ts").alias("hour_local"), F.col("event_type").alias("series")).agg(F.count("*").alias("value"))
    return dashboard.hour_lines(counts, ["click", "view", "purchase"]).fillna(0)


@query(f"""WITH {_LOG} SELECT to_timestamp(s) AT TIME ZONE '{LOCAL_ZONE}' AS time, round((k + 300) / 60.0, 1) AS freshness_min FROM log
  WHERE run_id <> 'manual' AND step = 'gold' AND status = 'succeeded'""")
def freshness_series(spark, d):
    """Age at each build in minutes."""
    return dashboard.freshness_series(datasets.of("pipeline_runs", run_log(spark, d)))


@query(f"""WITH {_LOG} SELECT CAST(to_timestamp(s) AT TIME ZONE '{LOCAL_ZONE}' AS DATE) AS date, CAST(sum(3 * k) AS BIGINT) AS events, count(DISTINCT run_id) AS runs FROM log
  WHERE run_id <> 'manual' AND step = 'bronze' AND status = 'succeeded' GROUP BY 1""")
def dashboard_events_per_day(spark, d):
    """Rows added per local day, from the published runs."""
    return dashboard.events_per_day(datasets.of("pipeline_runs", run_log(spark, d)))


@query(f"""WITH {_LOG} SELECT step, quantile_cont(f - s, 0.5) AS median_s, max(f - s) AS max_s, count(*) AS attempts FROM log WHERE run_id <> 'manual' AND status = 'succeeded' GROUP BY 1""")
def dashboard_step_runtimes(spark, d):
    """Seconds of succeeded attempts per step."""
    return dashboard.step_runtimes(datasets.of("pipeline_runs", run_log(spark, d)))


_KEYS = "SELECT DISTINCT user_id, event_type, CAST(day(ts) AS INTEGER) AS day FROM events WHERE {}"


@query(f"""WITH a AS ({_KEYS.format("event_type <> 'purchase'")}), b AS ({_KEYS.format("event_type <> 'view'")}) SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS in_both,
  (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS only_first, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS only_second""")
def snapshot_overlap(spark, d):
    """Keys that two snapshots share, by one aggregation."""
    e = T(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    return overlap(e.where("event_type <> 'purchase'"), e.where("event_type <> 'view'"), ["user_id", "event_type", "day"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
