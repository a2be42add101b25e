"""Data quality rules over the latest build's dates: row rules of a table in one pass, key rules by one partial count each."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULTS = (
    "run_id string, start_date date, end_date date, check_name string, table_name string, severity string, failed long, total long, "
    "fail_pct double, passed boolean"
)
CRITICAL, WARNING = "critical", "warning"


class QualityError(RuntimeError):
    """A critical rule failed."""


@dataclass(frozen=True)
class Rule:
    """Rows of ``table`` for which ``bad`` is true fail; a null is no failure. ``key``: rows sharing it fail instead."""

    name: str
    table: str
    bad: str = ""
    key: tuple[str, ...] = ()
    severity: str = CRITICAL
    limit_pct: float = 0.0

    def condition(self) -> Column:
        return F.expr(self.bad)


# The rules, their bounds and limits.
RULES = (
    Rule("vp_vehicle_id_present", "silver_vehicle_positions", "vehicle_id is null"),
    Rule("vp_key_unique", "silver_vehicle_positions", key=("vehicle_id", "event_ts")),
    Rule(
        "vp_in_dc_region", "silver_vehicle_positions",
        "latitude < 38.5 or latitude > 39.5 or longitude < -77.7 or longitude > -76.6", severity=WARNING, limit_pct=0.5,
    ),
    Rule("tu_key_unique", "silver_trip_updates", key=("trip_id", "trip_start_date", "event_ts")),
    Rule("tu_delay_plausible", "silver_trip_updates", "abs(delay_s) > 7200", severity=WARNING, limit_pct=0.5),
    Rule("dep_key_unique", "gold_timepoint_departures", key=("trip_id", "service_date", "stop_sequence")),
    Rule("dep_error_bounded", "gold_timepoint_departures", "max_error_s not between 0 and 60"),
    Rule("dep_status_valid", "gold_timepoint_departures", "coalesce(otp_status, '') not in ('early', 'on_time', 'late')"),
    Rule("dep_delay_plausible", "gold_timepoint_departures", "abs(delay_s) > 10800", severity=WARNING, limit_pct=1.0),
    Rule("perf_counts_add_up", "gold_route_hour_performance", "departures <> on_time + early + late"),
    Rule("perf_pct_in_range", "gold_route_hour_performance", "pct_on_time not between 0 and 100"),
    Rule("headway_non_negative", "gold_headways", "headway_s < 0"),
)


def count_failures(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: (check_name, failed, total).

    Rows that share a key are counted by aggregation, which is partial in each task, so no task gets all rows of a
    key however often it comes.
    """
    plain, keyed = [r for r in rules if not r.key], [r for r in rules if r.key]
    parts = []
    if plain:
        counted = rows.agg(F.count("*").alias("total"), *[F.count_if(r.condition()).alias(f"_{n}") for n, r in enumerate(plain)])
        each = F.array(*[F.struct(F.lit(r.name).alias("check_name"), F.col(f"_{n}").alias("failed")) for n, r in enumerate(plain)])
        parts.append(counted.select("total", F.inline(each)).select("check_name", "failed", "total"))
    for r in keyed:
        shared = rows.groupBy(*r.key).agg(F.count("*").alias("_n"))
        zero = F.lit(0).cast("long")
        parts.append(shared.agg(
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), zero).alias("failed"), F.coalesce(F.sum("_n"), zero).alias("total")
        ).select(F.lit(r.name).alias("check_name"), "failed", "total"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def judged(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """With table, severity, percentage (3 digits) and verdict. The verdict uses the exact share, not the rounded one."""
    about = counts.sparkSession.createDataFrame(
        [(r.name, r.table, r.severity, float(r.limit_pct)) for r in rules], "check_name string, table_name string, severity string, limit_pct double"
    )
    return counts.join(F.broadcast(about), "check_name").select(  # as many rows as there are rules
        "check_name", "table_name", "severity", "failed", "total",
        F.when(F.col("total") > 0, F.round(F.lit(100.0) * F.col("failed") / F.col("total"), 3)).otherwise(0.0).alias("fail_pct"),
        (F.lit(100.0) * F.col("failed") <= F.col("limit_pct") * F.col("total")).alias("passed"),
    )


def check_tables(tables: dict[str, DataFrame], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Verdicts of all rules over the given tables."""
    by_table = defaultdict(list)
    for r in rules:
        by_table[r.table].append(r)
    out = None
    for name, own in by_table.items():
        part = count_failures(tables[name], own)
        out = part if out is None else out.unionByName(part)
    return judged(out, rules)


def latest_build(lake) -> tuple[date, date] | None:
    """First and last service date of the latest build."""
    if not lake.exists("gold_build_log"):
        return None
    row = lake.read("gold_build_log").agg(F.max_by(F.struct("start_date", "end_date"), "built_at").alias("r")).first().r
    return (row.start_date, row.end_date) if row else None


def run_checks(lake, run_id: str = "manual", rules: Sequence[Rule] = RULES) -> dict[str, int]:
    """Checks the latest build, records the verdicts, and only then fails on critical ones."""
    span = latest_build(lake)
    if span is None:
        return {"checks": 0, "passed": 0, "critical_failed": 0, "warnings": 0}
    inside = F.col("service_date").between(*map(F.lit, span))
    tables = {t: lake.read(t).where(inside) for t in {r.table for r in rules}}
    found = check_tables(tables, rules).collect()
    rows = [
        (run_id, *span, r.check_name, r.table_name, r.severity, r.failed, r.total, r.fail_pct, r.passed) for r in found
    ]
    lake.append("dq_results", lake.spark.createDataFrame(rows, RESULTS))
    bad = sorted(r.check_name for r in found if not r.passed and r.severity == CRITICAL)
    if bad:
        raise QualityError("critical checks failed: " + ", ".join(bad))
    warnings = sum(not r.passed for r in found)
    return {"checks": len(found), "passed": len(found) - warnings, "critical_failed": 0, "warnings": warnings}
