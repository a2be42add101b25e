"""The queries of the general training-data operators, over whole tables, and SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.asof import as_known
from punctual.operators.compaction import compact, forget, live_files, log_actions, plan, small_files, vacuum, write_small
from punctual.operators.dedup import exactly_once, repeated_identifiers
from punctual.operators.history import ROUTES, STOPS, Tracked, full_history
from punctual.operators.late import LateAware, Lateness
from punctual.operators.late_store import LateStore
from punctual.session import cut, shared_path, table
from punctual.sources.lake import Lake

HOUR, DAY = 3_600, 86_400
DELIVERED = ["_silver_loaded_at", "_ingested_at", "fetched_at", "feed_header_ts", "_source_file"]
POSITION = ["vehicle_id", "event_ts"]
UPDATE = ["trip_id", "trip_start_date", "event_ts"]


def _events(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    rows = table(spark, d, "silver_vehicle_positions")
    return rows.select(*columns) if columns else rows


def _as_known(spark: SparkSession, d: str, events: DataFrame, attributes: list[str]) -> DataFrame:
    return as_known(
        events, table(spark, d, "dim_routes"), "route_id", "service_date", "valid_from", "valid_to", attributes, known_as="route_known"
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Positions of known routes whose valid version isn't the current one."""
    rows = _as_known(spark, d, _events(spark, d, [*POSITION, "route_id", "service_date"]), ["route_sk", "is_current"])
    return rows.where("route_known and not coalesce(is_current, false)").select(
        "vehicle_id", F.unix_seconds("event_ts").alias("event_epoch_s"), F.coalesce("route_sk", F.lit(0).cast("long")).alias("route_sk")
    ).distinct()


def p2_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Every position row with the route attributes valid on its service date."""
    return _as_known(
        spark, d, _events(spark, d),
        ["route_short_name", "route_long_name", "route_type", "route_color", "feed_version", "valid_from", "route_sk"],
    )


def _scan(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers that were delivered more than once: those of the copies that the deletion vectors drop."""
    vp = repeated_identifiers(spark, f"{d}/silver_vehicle_positions.parquet", POSITION, DELIVERED)
    tu = repeated_identifiers(spark, f"{d}/silver_trip_updates.parquet", UPDATE, DELIVERED)
    epoch = F.unix_seconds(F.col("event_ts").cast("timestamp")).alias("event_epoch_s")
    return vp.select(
        F.lit("vehicle_positions").alias("feed"), F.col("vehicle_id").alias("entity_id"), epoch, F.lit("").alias("trip_start")
    ).unionByName(
        tu.select(
            F.lit("trip_updates").alias("feed"), F.col("trip_id").alias("entity_id"), epoch,
            F.coalesce(F.col("trip_start_date").cast("string"), F.lit("")).alias("trip_start"),
        )
    )


def p3_positions(spark: SparkSession, d: str) -> DataFrame:
    """The positions, each identifier once, the first delivered copy."""
    return exactly_once(spark, f"{d}/silver_vehicle_positions.parquet", POSITION, DELIVERED)


def p3_updates(spark: SparkSession, d: str) -> DataFrame:
    """The trip updates, each identifier once, the first delivered copy."""
    return exactly_once(spark, f"{d}/silver_trip_updates.parquet", UPDATE, DELIVERED)


def p3_first_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Identifier and delivery of the copies that stay (copies delivered together may differ in the other columns)."""
    return p3_positions(spark, d).select(*POSITION, *DELIVERED)


def _untied(spark: SparkSession, d: str, name: str, identifier: list[str], once: DataFrame) -> DataFrame:
    """``once`` without the identifiers whose first delivery brought differing copies, of which either may stay."""
    rows = table(spark, d, name)
    keys = [F.col(c).alias(f"_{c}") for c in identifier]
    copies = rows.select(*keys, F.struct(*DELIVERED).alias("at"), F.xxhash64(*rows.columns).alias("whole"))
    lots = copies.groupBy(*[f"_{c}" for c in identifier], "at").agg(F.min("whole").alias("a"), F.max("whole").alias("b"))
    first = lots.groupBy(*[f"_{c}" for c in identifier]).agg(F.min(F.struct("at", (F.col("a") != F.col("b")).alias("differ"))).alias("f"))
    return once.join(first.where("f.differ"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identifier], "left_anti")


def p3_positions_whole(spark: SparkSession, d: str) -> DataFrame:
    """All columns of the positions that stay, where delivery order tells which one does."""
    return _untied(spark, d, "silver_vehicle_positions", POSITION, p3_positions(spark, d))


def p3_updates_whole(spark: SparkSession, d: str) -> DataFrame:
    """All columns of the trip updates that stay, where delivery order tells which one does."""
    return _untied(spark, d, "silver_trip_updates", UPDATE, p3_updates(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Live files so small that the first level of merges takes them."""
    return small_files(table(spark, d, "data_files")).select("table_name", "path")


def p4_plan(spark: SparkSession, d: str) -> DataFrame:
    """The files that the live files become, by table and service date: rows and bytes stay, files become few."""
    files = plan(live_files(table(spark, d, "data_files")), ["table_name", "service_date"], ["route_id", "path"])
    return files.groupBy("table_name", "service_date").agg(
        F.sum("n_files").alias("files_before"), F.count("*").alias("files_after"), F.sum("n_rows").alias("n_rows"),
        F.sum("size_bytes").alias("size_bytes"),
    )


def p4_rows(spark: SparkSession, d: str) -> DataFrame:
    """Both tables written as the many small files of the log, compacted by service date and route, and counted.

    The compaction is broken off: an eighth of the first level's merges lose their commits, and it is run again. The
    merged files take the small ones' place in a log by one append, and what that log names is read.
    """
    lake, parts = Lake(spark, shared_path(spark, "files")), []
    for name, stamp, pieces in (
        ("silver_vehicle_positions", "event_ts", F.col("_silver_loaded_at").cast("string")), ("gold_headways", "observed_ts", F.crc32(F.col("stop_id").cast("binary")) % 3)
    ):
        log, root = f"log_{name}", shared_path(spark, f"compact-{name}")
        rows = _scan(spark, d, name).withColumn("_piece", pieces)
        written = cut(write_small(rows, ["service_date", "route_id", "_piece"], root))
        lake.append(log, log_actions(written.limit(0), written, name, 1))
        small = live_files(lake.read(log)).withColumn("path", F.col("uri"))
        given = dict(scope=["service_date"], cluster=["route_id", "path"])
        cut(compact(spark, root, name, small, levels=1, **given))
        forget(spark, root, 8)
        files = cut(compact(spark, root, name, small, **given))
        before, after, days = small.count(), files.count(), small.select("service_date").distinct().count()
        if before > days and after >= before:  # two small files of a day are always merged
            raise AssertionError(f"{name}: {after} files of {before}")
        lake.append(log, log_actions(small, files, name, 2))
        vacuum(spark, root)
        # The driver needs the files' names to read them, as for any table.
        names = [r.uri for r in live_files(lake.read(log)).select("uri").toLocalIterator()]
        found = spark.read.schema(rows.schema).parquet(*names) if names else rows.limit(0)
        parts.append(
            found.groupBy("service_date", "route_id").agg(
                F.count("*").alias("n_rows"), F.sum(F.unix_seconds(F.col(stamp).cast("timestamp"))).alias("stamp_sum")
            ).withColumn("table_name", F.lit(name))
        )
    return parts[0].unionByName(parts[1])


def _history(spark: SparkSession, d: str, spec: Tracked, name: str) -> DataFrame:
    return full_history(table(spark, d, f"dim_{name}"), table(spark, d, f"static_{name}"), table(spark, d, "static_feed_info"), spec)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """All versions of routes and stops with their periods."""
    def shown(spec: Tracked, name: str, entity: str) -> DataFrame:
        return _history(spark, d, spec, name).select(
            F.lit(entity).alias("entity"), F.col(spec.key).alias("entity_id"), F.col("valid_from").cast("string").alias("valid_from"),
            F.coalesce(F.col("valid_to").cast("string"), F.lit("")).alias("valid_to"),
        )

    return shown(ROUTES, "routes", "route").unionByName(shown(STOPS, "stops", "stop"))


def p5_routes(spark: SparkSession, d: str) -> DataFrame:
    """The full history of every route (without the opaque surrogate key)."""
    return _history(spark, d, ROUTES, "routes").drop("route_sk")


def p5_stops(spark: SparkSession, d: str) -> DataFrame:
    """The full history of every stop (without the opaque surrogate key)."""
    return _history(spark, d, STOPS, "stops").drop("stop_sk")


def _hourly(spark: SparkSession, d: str) -> LateAware:
    rows = table(spark, d, "silver_vehicle_positions")
    return LateAware(
        rows, POSITION, F.unix_seconds("event_ts"), "_silver_loaded_at", HOUR, HOUR, Lateness(3 * HOUR, 48 * HOUR),
        {"speed_mps": F.col("speed_mps"), "staleness_s": F.col("staleness_s")}, block=6 * HOUR,
    )


def _daily(spark: SparkSession, d: str) -> LateAware:
    rows = table(spark, d, "gold_timepoint_departures")
    return LateAware(
        rows, ["trip_id", "service_date", "stop_sequence"], F.unix_date("service_date") * DAY, "_gold_built_at", DAY, 0,
        Lateness(36 * HOUR, 7 * DAY), {"delay_s": F.col("delay_s")}, block=4 * DAY, batch=6 * HOUR,
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Late records and what becomes of them."""
    vp = _hourly(spark, d).late_rows().select(
        F.lit("silver_vehicle_positions").alias("source_table"), F.col("vehicle_id").alias("entity_id"),
        F.unix_seconds("event_ts").cast("string").alias("event_key"), "outcome",
    )
    dep = _daily(spark, d).late_rows().select(
        F.lit("gold_timepoint_departures").alias("source_table"), F.col("trip_id").alias("entity_id"),
        F.concat_ws("/", F.col("service_date").cast("string"), F.col("stop_sequence").cast("string")).alias("event_key"), "outcome",
    )
    return vp.unionByName(dep).distinct()


def p6_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Positions per UTC hour of the event, late rows in place up to the cut-off."""
    return _hourly(spark, d).periods().select(
        F.timestamp_seconds("period_s").alias("hour_utc"), "n_events", "n_late", F.round("sum_speed_mps", 3).alias("speed_sum"),
        "n_speed_mps", F.col("sum_staleness_s").alias("staleness_sum"),
    )


def p6_daily(spark: SparkSession, d: str) -> DataFrame:
    """Departures per service date, late builds in place up to the cut-off."""
    return _daily(spark, d).periods().select(
        F.timestamp_seconds("period_s").cast("date").alias("service_date"), "n_events", "n_late",
        F.col("sum_delay_s").alias("delay_sum"), "n_delay_s",
    )


def p6_store_hourly(spark: SparkSession, d: str) -> DataFrame:
    """As p6_hourly, from a table corrected batch by batch: the positions come in six batches in the order of their loads."""
    rows = table(spark, d, "silver_vehicle_positions").select(*POSITION, "_silver_loaded_at", "speed_mps", "staleness_s")
    store = LateStore(
        Lake(spark, shared_path(spark, "late")), "hourly", POSITION, "event_ts", "_silver_loaded_at", HOUR, Lateness(3 * HOUR, 48 * HOUR),
        ["speed_mps", "staleness_s"], block=DAY,
    )
    loaded = F.unix_seconds("_silver_loaded_at")
    span = rows.agg(F.min(loaded).alias("low"), F.max(loaded).alias("high")).first()
    share = F.when(loaded < span.high, F.floor((loaded - span.low) * 6 / (span.high - span.low))).otherwise(5) if span.low is not None else F.lit(0)
    for n in range(6):
        store.apply(rows.where(share == n))
    return store.periods().select(
        F.timestamp_seconds("period_s").alias("hour_utc"), "n_events", "n_late", F.round("sum_speed_mps", 3).alias("speed_sum"), "n_speed_mps",
        F.col("sum_staleness_s").alias("staleness_sum"),
    )


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            p2_found, p2_attributes, p3_found, p3_positions, p3_updates, p3_first_delivery, p3_positions_whole, p3_updates_whole, p4_found, p4_plan, p4_rows, p5_found, p5_routes,
            p5_stops, p6_found, p6_hourly, p6_store_hourly, p6_daily,
        )
    }


# ---------------------------------------------------------------- SQL

_VERSIONS = "dim_routes r ON p.route_id = r.route_id AND p.service_date >= r.valid_from AND (r.valid_to IS NULL OR p.service_date < r.valid_to)"
_LIVE = """
files AS (SELECT table_name, log_version, log_action, service_date, n_rows, size_bytes,
                 regexp_replace('/' || regexp_replace(path, '^[A-Za-z]+:', ''), '/+', '/', 'g') AS path FROM data_files),
live AS (SELECT DISTINCT table_name, path, service_date, n_rows, size_bytes FROM files
         QUALIFY rank() OVER (PARTITION BY table_name, path ORDER BY log_version DESC) = 1 AND log_action = 'add')
"""


def _once(name: str, identifier: list[str]) -> str:
    return (
        f"SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {', '.join(identifier)} "
        f"ORDER BY {', '.join(f'{c} NULLS FIRST' for c in DELIVERED)}) = 1"
    )


def _untied_sql(name: str, identifier: list[str]) -> str:
    ids, order = ", ".join(identifier), ", ".join(f"{c} NULLS FIRST" for c in DELIVERED)
    return (
        f"WITH first AS (SELECT * FROM (SELECT DISTINCT * FROM {name}) QUALIFY rank() OVER (PARTITION BY {ids} ORDER BY {order}) = 1) "
        f"SELECT * FROM first QUALIFY count(*) OVER (PARTITION BY {ids}) = 1"
    )


def _history_sql(spec: Tracked, name: str, columns: str) -> str:
    """Gaps and islands over what each release in force showed of each entity."""
    attrs = ", ".join(spec.columns)
    packed = "concat_ws(chr(31), " + ", ".join(f"coalesce({c}, chr(0))" for c in spec.columns) + ")"
    return f"""
WITH info AS (SELECT strptime(feed_start_date, '%Y%m%d')::DATE AS start, feed_version, max(_loaded_at) AS loaded
              FROM static_feed_info GROUP BY ALL),
force AS (SELECT start, feed_version FROM info QUALIFY row_number() OVER (PARTITION BY start ORDER BY loaded DESC, feed_version DESC) = 1),
given AS (SELECT DISTINCT feed_version FROM static_{name}),
edge AS (SELECT greatest(max(valid_from), max(valid_to)) AS d FROM dim_{name}),
applied AS (SELECT start, feed_version, feed_version IN (FROM given) AS fresh, row_number() OVER (ORDER BY start) AS k,
                   lead(start) OVER (ORDER BY start) AS until
            FROM force WHERE feed_version IN (FROM given) OR start <= (SELECT d FROM edge)),
rows AS (SELECT DISTINCT * EXCLUDE (_source_file, _loaded_at) FROM static_{name}
         QUALIFY rank() OVER (PARTITION BY feed_version ORDER BY _loaded_at DESC) = 1),
seen AS (SELECT {spec.key}, {attrs}, k, start, until, false AS begins, a.feed_version FROM rows JOIN applied a USING (feed_version) WHERE fresh
         UNION ALL
         SELECT {spec.key}, {attrs}, k, start, until, start = valid_from, o.feed_version FROM dim_{name} o
         JOIN applied a ON NOT fresh AND start >= valid_from AND (valid_to IS NULL OR start < valid_to)),
hashed AS (SELECT *, sha256({packed}) AS attr_hash FROM seen),
marked AS (SELECT *, CASE WHEN begins OR lag(k) OVER w IS DISTINCT FROM k - 1 OR lag(attr_hash) OVER w IS DISTINCT FROM attr_hash
                          THEN 1 ELSE 0 END AS new FROM hashed WINDOW w AS (PARTITION BY {spec.key} ORDER BY k)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY {spec.key} ORDER BY k) AS island FROM marked),
versions AS (SELECT {spec.key}, {attrs}, attr_hash, min(start) AS valid_from, arg_min(feed_version, k) AS feed_version,
                    CASE WHEN max(CASE WHEN until IS NULL THEN 1 ELSE 0 END) = 1 THEN NULL ELSE max(until) END AS valid_to
             FROM numbered GROUP BY {spec.key}, {attrs}, attr_hash, island)
SELECT {columns} FROM versions"""


def _late_sql(rows: str, ids: str, loaded: str, end: str, allowed: str, cutoff: str, rest: str) -> str:
    return (
        f"(SELECT *, {loaded} > {end} + INTERVAL {allowed} AS late, {loaded} > {end} + INTERVAL {cutoff} AS cut FROM "
        f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {ids} ORDER BY {loaded}, {rest}) = 1))"
    )


def oracle_sql() -> dict[str, str]:
    epoch = "CAST(floor(epoch(event_ts)) AS BIGINT)"
    twice = lambda t, ids: f"SELECT {ids} FROM {t} GROUP BY {ids} HAVING count(*) > 1"
    hours = _late_sql(
        "silver_vehicle_positions", "vehicle_id, event_ts", "_silver_loaded_at", "date_trunc('hour', event_ts) + INTERVAL 1 HOUR",
        "3 HOUR", "48 HOUR", "speed_mps NULLS FIRST, staleness_s NULLS FIRST",
    )
    days = _late_sql(
        "gold_timepoint_departures", "trip_id, service_date, stop_sequence", "_gold_built_at", "CAST(service_date AS TIMESTAMP)",
        "36 HOUR", "7 DAY", "delay_s NULLS FIRST",
    )
    full = lambda s: f"{s.key}, {', '.join(s.columns)}, attr_hash, feed_version, valid_from, valid_to, valid_to IS NULL AS is_current"
    shown = lambda s, e: f"'{e}' AS entity, {s.key} AS entity_id, CAST(valid_from AS VARCHAR) AS valid_from, coalesce(CAST(valid_to AS VARCHAR), '') AS valid_to"
    hourly = f"""SELECT date_trunc('hour', event_ts) AS hour_utc, count(*) AS n_events, count(*) FILTER (WHERE late) AS n_late,
            round(coalesce(sum(speed_mps), 0), 3) AS speed_sum, count(speed_mps) AS n_speed_mps, CAST(coalesce(sum(staleness_s), 0) AS BIGINT) AS staleness_sum
            FROM {hours} WHERE NOT cut GROUP BY 1"""
    return {
        "p2_found": f"""SELECT DISTINCT vehicle_id, {epoch} AS event_epoch_s, coalesce(r.route_sk, 0) AS route_sk
            FROM silver_vehicle_positions p LEFT JOIN {_VERSIONS}
            WHERE p.route_id IN (SELECT route_id FROM dim_routes) AND NOT coalesce(r.is_current, false)""",
        "p2_attributes": f"""SELECT p.*, r.route_short_name, r.route_long_name, r.route_type, r.route_color, r.feed_version, r.valid_from,
            r.route_sk, coalesce(p.route_id IN (SELECT route_id FROM dim_routes), false) AS route_known
            FROM silver_vehicle_positions p LEFT JOIN {_VERSIONS}""",
        "p3_found": f"""SELECT 'vehicle_positions' AS feed, vehicle_id AS entity_id, {epoch} AS event_epoch_s, '' AS trip_start
            FROM ({twice("silver_vehicle_positions", "vehicle_id, event_ts")})
            UNION ALL SELECT 'trip_updates', trip_id, {epoch}, coalesce(CAST(trip_start_date AS VARCHAR), '')
            FROM ({twice("silver_trip_updates", "trip_id, trip_start_date, event_ts")})""",
        "p3_first_delivery": _once("silver_vehicle_positions", POSITION).replace("*", ", ".join(POSITION + DELIVERED), 1),
        "p3_positions_whole": _untied_sql("silver_vehicle_positions", POSITION),
        "p3_updates_whole": _untied_sql("silver_trip_updates", UPDATE),
        "p4_found": f"WITH {_LIVE} SELECT table_name, path FROM live WHERE size_bytes < 65536",
        "p4_rows": """SELECT 'silver_vehicle_positions' AS table_name, service_date, route_id, count(*) AS n_rows,
            CAST(sum(CAST(floor(epoch(event_ts)) AS BIGINT)) AS BIGINT) AS stamp_sum FROM silver_vehicle_positions GROUP BY ALL
            UNION ALL SELECT 'gold_headways', service_date, route_id, count(*),
            CAST(sum(CAST(floor(epoch(observed_ts)) AS BIGINT)) AS BIGINT) FROM gold_headways GROUP BY ALL""",
        "p5_found": f"SELECT * FROM ({_history_sql(ROUTES, 'routes', shown(ROUTES, 'route'))}) UNION ALL "
        f"SELECT * FROM ({_history_sql(STOPS, 'stops', shown(STOPS, 'stop'))})",
        "p5_routes": _history_sql(ROUTES, "routes", full(ROUTES)),
        "p5_stops": _history_sql(STOPS, "stops", full(STOPS)),
        "p6_found": f"""SELECT DISTINCT 'silver_vehicle_positions' AS source_table, vehicle_id AS entity_id,
            CAST({epoch} AS VARCHAR) AS event_key, CASE WHEN cut THEN 'cut' ELSE 'corrects' END AS outcome FROM {hours} WHERE late
            UNION SELECT 'gold_timepoint_departures', trip_id, concat_ws('/', CAST(service_date AS VARCHAR), CAST(stop_sequence AS VARCHAR)),
            CASE WHEN cut THEN 'cut' ELSE 'corrects' END FROM {days} WHERE late""",
        "p6_hourly": hourly,
        "p6_store_hourly": hourly,
        "p6_daily": f"""SELECT service_date, count(*) AS n_events, count(*) FILTER (WHERE late) AS n_late,
            CAST(coalesce(sum(delay_s), 0) AS BIGINT) AS delay_sum, count(delay_s) AS n_delay_s
            FROM {days} WHERE NOT cut GROUP BY 1""",
    }
