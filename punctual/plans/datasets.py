"""The published datasets: small tables of counts, so that any roll-up of them stays exact; as DataFrames or SQL text."""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Sequence
from dataclasses import asdict
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.marts import GRADING
from punctual.plans import metrics
from punctual.plans.relations import Relation, table

# Weekday rush hours by scheduled local hour, and weekend days.
RUSH_HOURS = (6, 7, 8, 16, 17, 18)
WEEKEND = ("Sat", "Sun")


IN_RUSH = f"(hour_local in {RUSH_HOURS} and day_of_week not in {WEEKEND})"
DAY_TYPE = f"if(day_of_week in {WEEKEND}, 'weekend', 'weekday') as day_type"
DEP, GAPS = table("gold_timepoint_departures"), table("gold_headways")
MEAN_DELAY = "round(avg(delay_s), 1) as avg_delay_s"


def graded(*statuses: str) -> list[str]:
    return ["count(*) as departures", *[f"count_if(otp_status = '{s}') as {s}" for s in statuses]]


def spaced(*statuses: str) -> list[str]:
    return ["count(*) as headways", *[f"count_if(headway_status = '{s}') as {s}" for s in statuses]]


def zero(*columns: str) -> list[str]:
    return [f"coalesce({c}, 0) as {c}" for c in columns]


def current(dim: str, *columns: str) -> Relation:
    return table(dim).where("is_current").columns(*columns)


#: Per route: punctuality overall and at rush hour, delay, bunching, and the current names.
ROUTE_SUMMARY = (
    DEP.grouped(
        ["route_id"], *graded("on_time", "early", "late"), MEAN_DELAY, "percentile(delay_s, 0.9) as p90_delay_s", f"count_if({IN_RUSH}) as rush_departures",
        f"count_if({IN_RUSH} and otp_status = 'on_time') as rush_on_time", "count(distinct service_date) as days",
    )
    .joined(GAPS.grouped(["route_id"], *spaced("bunched", "gapped")), ["route_id"], "left")
    .joined(current("dim_routes", "route_id", "route_short_name", "route_long_name"), ["route_id"], "left")
    .columns(
        "route_id", "route_short_name", "route_long_name", "departures", "on_time", "early", "late", "avg_delay_s", "p90_delay_s", "rush_departures",
        "rush_on_time", "days", *zero("headways", "bunched", "gapped"),
    )
    .ordered("route_id")
)
_CELL = ["route_id", "day_type", "hour_local"]
#: Per route, weekday or weekend, and hour; cells that only one side has are kept.
ROUTE_HOUR = (
    DEP.columns("*", DAY_TYPE).grouped(_CELL, *graded("on_time", "late", "early"), "sum(delay_s) as delay_s_sum")
    .joined(GAPS.columns("*", DAY_TYPE).grouped(_CELL, *spaced("bunched", "gapped")), _CELL, "full")
    .columns(*_CELL, *zero("departures", "on_time", "late", "early", "delay_s_sum", "headways", "bunched", "gapped"))
    .ordered(*_CELL)
)
#: Per service date: departures, on time, routes and vehicles seen, headways.
DAILY = (
    DEP.grouped(
        ["service_date"], "min(day_of_week) as day_of_week", *graded("on_time"), "count(distinct route_id) as routes", "count(distinct vehicle_id) as vehicles"
    )
    .joined(GAPS.grouped(["service_date"], *spaced("bunched")), ["service_date"], "left")
    .columns("service_date", "day_of_week", "departures", "on_time", "routes", "vehicles", *zero("headways", "bunched"))
    .ordered("service_date")
)
#: Per stop with a current version: its place, punctuality, and the routes that were graded there.
STOPS = (
    DEP.grouped(
        ["stop_id"], *graded("on_time"), MEAN_DELAY, "count(distinct route_id) as routes", "array_join(sort_array(collect_set(route_id)), ' ') as route_ids"
    )
    .joined(current("dim_stops", "stop_id", "stop_name", "try_cast(stop_lat as double) as lat", "try_cast(stop_lon as double) as lon"), ["stop_id"])
    .joined(GAPS.grouped(["stop_id"], *spaced("bunched")), ["stop_id"], "left")
    .columns("stop_id", "departures", "on_time", "avg_delay_s", "routes", "route_ids", "stop_name", "lat", "lon", *zero("headways", "bunched"))
    .ordered("stop_id")
)
#: Wet against dry hours, at rush hour and otherwise, with delays weighted by departures.
WEATHER = (
    table("gold_route_hour_weather")
    .grouped(
        ["if(is_wet, 'wet', 'dry') as weather", f"{IN_RUSH} as rush"], "count(distinct service_date, hour_local) as hours", "sum(departures) as departures",
        "sum(on_time) as on_time", "round(sum(avg_delay_s * departures) / sum(departures), 1) as avg_delay_s",
    )
    .ordered("weather", "rush")
)
# A stop-day as one value: its parts may be null, and then equal another's null.
_PLACE = "struct(service_date, route_id, direction_id, stop_id) as place"
#: The stop-day with the most bunched headways among those with at least six; ties go by a total order.
WORST_STOP_DAY = (
    GAPS.columns(_PLACE, "headway_status").grouped(["place"], *spaced("bunched")).where("headways >= 6")
    .columns("place", "headways", "bunched", "place.service_date as d", "place.route_id as r", "place.stop_id as s", "place.direction_id as i")
    .ordered("bunched desc", "headways desc", "d desc", "r", "s", "i", first=1)
    .columns("place")
)
#: Every bus of the worst stop-day, scheduled and observed, with its headway.
BUNCHING_EXAMPLE = (
    DEP.columns("*", _PLACE).joined(WORST_STOP_DAY, ["place"], "left semi")
    .joined(GAPS.columns(_PLACE, "trip_id", "headway_s", "sched_headway_s", "headway_status"), ["place", "trip_id"], "left")
    .joined(current("dim_stops", "stop_id", "stop_name"), ["stop_id"], "left")
    .columns(
        "service_date", "route_id", "direction_id", "stop_id", "stop_name", "trip_id", "vehicle_id", "unix_seconds(scheduled_ts) as scheduled_epoch",
        "unix_seconds(observed_ts) as observed_epoch", "delay_s", "headway_s", "sched_headway_s", "headway_status",
    )
    .ordered("observed_epoch", "trip_id")
)
#: Each attempt of a scheduled run with its time, rows added and freshness.
PIPELINE_RUNS = (
    metrics.LOG.where(f"run_id <> '{metrics.MANUAL}'")
    .columns(
        "run_id", "step", "status", "unix_seconds(started_at) as started_epoch", f"{metrics.TOOK_S} as duration_s",
        f"{' + '.join(metrics.ADDED)} as bronze_rows", f"{metrics.logged('freshness_s', 'int')} as freshness_s",
    )
    .ordered("started_epoch", "run_id", "step")
)
#: Per check: runs, passes, rows failed and checked.
DQ_CHECKS = metrics.RESULTS.grouped(
    ["check_name", "table_name", "severity"], "count(*) as runs", "count_if(passed) as passed", "sum(failed) as rows_failed", "sum(total) as rows_checked"
).ordered("severity", "check_name")

DATASETS: dict[str, Relation] = {
    "route_summary": ROUTE_SUMMARY, "route_hour": ROUTE_HOUR, "daily": DAILY, "stops": STOPS, "weather": WEATHER, "bunching_example": BUNCHING_EXAMPLE,
    "pipeline_runs": PIPELINE_RUNS, "dq_checks": DQ_CHECKS,
}


def of(name: str, *tables: DataFrame) -> DataFrame:
    """A dataset from its tables, in the order of ``DATASETS[name].tables``."""
    found = DATASETS[name]
    return found.frame(dict(zip(found.tables, tables, strict=True)))


def route_hour_weather(performance: DataFrame, weather_hours: DataFrame) -> DataFrame:
    """Hourly performance with the weather of its local hour; hours without weather drop out."""
    w = weather_hours.select("local_date", "local_hour", "temperature_c", "precipitation_mm", "is_wet")
    same_hour = (F.col("service_date") == F.col("local_date")) & (F.col("hour_local") == F.col("local_hour"))
    return performance.join(w, same_hour).drop("local_date", "local_hour")


def build(lake) -> tuple[dict[str, DataFrame], list[str]]:
    """The datasets whose tables exist, and the names of the others."""
    found, skipped = {}, []
    for name, relation in DATASETS.items():
        if all(map(lake.exists, relation.tables)):
            found[name] = relation.frame({t: lake.read(t) for t in relation.tables})
        else:
            skipped.append(name)
    return found, skipped


def write_whole(path: Path, text: str) -> None:
    """Replaces a file in one step."""
    part = path.parent / f".{path.name}.part"
    part.write_text(text, encoding="utf-8")
    os.replace(part, path)


def write_csv(path: Path, rows: DataFrame, span_of: Sequence[int] = ()) -> tuple[int, tuple[str, str] | None]:
    """Writes rows as they come, one part of them in memory at a time; returns how many, and a column's ends as text."""
    part, n, ends = path.parent / f".{path.name}.part", 0, None
    with part.open("w", encoding="utf-8", newline="") as out:
        to = csv.writer(out, lineterminator="\n")
        to.writerow(rows.columns)
        for row in rows.toLocalIterator():
            to.writerow(["" if x is None else x for x in row])
            n += 1
            for k in span_of:
                x = str(row[k])
                ends = (min(ends[0], x), max(ends[1], x)) if ends else (x, x)
    os.replace(part, path)
    return n, ends


def export(lake, folder: str, run_id: str = "manual") -> dict[str, Any]:
    """Writes each dataset as CSV and then the manifest, so that a new manifest never names old files."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    found, skipped = build(lake)
    sizes, span = {}, None
    for name, rows in found.items():
        days = [rows.columns.index("service_date")] if name == "daily" else []
        sizes[name], seen = write_csv(target / f"{name}.csv", rows, days)
        if seen:
            span = {"first_service_date": seen[0], "last_service_date": seen[1]}
    manifest = {
        "generated_at_utc": datetime.now(UTC).isoformat(timespec="seconds"), "run_id": run_id, "service_dates": span, "rows": sizes,
        "skipped": skipped, "definitions": asdict(GRADING) | {"rush_hours": list(RUSH_HOURS)},
        "metrics": None if skipped else metrics.compute(lake),
    }
    write_whole(target / "manifest.json", json.dumps(manifest, indent=2, default=metrics.plain))
    return {"rows": sizes, "skipped": skipped}
