"""Timed reads before and after a layout change."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from datetime import UTC, datetime
from statistics import median

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.plans.relations import Relation, table

_LABEL = re.compile(r"[\w.-]+")
CLUSTERED = {
    "silver_vehicle_positions": ["service_date", "route_id"], "silver_trip_updates": ["service_date", "route_id"],
    "gold_timepoint_departures": ["service_date", "route_id"], "gold_headways": ["service_date", "route_id"],
}
RESULT = (
    "label string, measured_at timestamp, kind string, name string, first_s double, median_s double, runs int, num_files long, size_bytes long"
)


def busiest_route_last_day(rows: DataFrame) -> DataFrame:
    """Rows of the route with most rows (ties: the last id) on its last service date.

    Both values come from the table itself as scalar subqueries, so the scan prunes by them at run time.
    """
    routes = rows.where("route_id is not null").groupBy("route_id").agg(F.count("*").alias("n"), F.max("service_date").alias("last"))
    busiest = lambda c: routes.agg(F.max_by(c, F.struct("n", "route_id"))).scalar()
    return rows.where((F.col("service_date") == busiest("last")) & (F.col("route_id") == busiest("route_id")))


def pings_by_vehicle(rows: DataFrame) -> DataFrame:
    return busiest_route_last_day(rows).groupBy("vehicle_id").agg(F.count("*").alias("pings"), F.max("event_ts").alias("last_seen"))


def departures_by_stop(rows: DataFrame) -> DataFrame:
    return busiest_route_last_day(rows).groupBy("stop_id").agg(F.count("*").alias("departures"), F.avg("delay_s").alias("avg_delay_s"))


def delays_by_hour(rows: DataFrame) -> DataFrame:
    return rows.groupBy("route_id", "hour_local").agg(
        F.count("*").alias("departures"), F.count_if(F.col("otp_status") == "on_time").alias("on_time"), F.percentile("delay_s", 0.9).alias("p90_delay_s")
    )


READS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "silver_route_day_lookup": ("silver_vehicle_positions", pings_by_vehicle),
    "gold_route_day_lookup": ("gold_timepoint_departures", departures_by_stop),
    "gold_full_aggregate": ("gold_timepoint_departures", delays_by_hour),
}


def timed(make: Callable[[], DataFrame], repeats: int = 5) -> list[float]:
    """Seconds of each run; all rows are computed and none reaches the driver."""
    out = []
    for _ in range(repeats):
        began = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - began)
    return out


def measure(lake, label: str, repeats: int = 5) -> list[tuple]:
    """Times the reads, the first run apart, notes each table's files, and appends both to ``ops_benchmarks``."""
    now, rows = datetime.now(UTC), []
    for name, (source, read) in READS.items():
        if lake.exists(source):
            first, *rest = timed(lambda read=read, source=source: read(lake.read(source)), repeats + 1)
            rows.append((label, now, "query", name, first, median(rest), repeats, None, None))
    for source in CLUSTERED:
        if lake.exists(source):
            d = lake.detail(source)
            rows.append((label, now, "table", source, None, None, None, d["num_files"], d["size_bytes"]))
    lake.append("ops_benchmarks", lake.spark.createDataFrame(rows, RESULT))
    return rows


def cluster_all(lake) -> dict[str, dict]:
    """Compacts the large tables in ranges of date and route."""
    return {t: lake.cluster(t, keys) for t, keys in CLUSTERED.items() if lake.exists(t)}


def comparison(before: str = "before", after: str = "after") -> Relation:
    """Benchmarks of two labels side by side, with how much faster the second is."""
    for label in (before, after):
        if not _LABEL.fullmatch(label):
            raise ValueError(f"not a label: {label!r}")
    side = lambda label, end: table("ops_benchmarks").where(f"label = '{label}'").columns(
        "kind", "name", f"num_files as files_{end}", f"median_s as median_s_{end}"
    )
    gain = "round(100d * (median_s_before - median_s_after) / median_s_before, 1) as pct_faster"
    return side(before, "before").joined(side(after, "after"), ["kind", "name"]).columns("*", gain).ordered("kind desc", "name")


def compared(results: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    return comparison(before, after).frame({"ops_benchmarks": results})
