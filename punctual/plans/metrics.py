"""Pipeline metrics over the log and data tables, within a window of local calendar days; as DataFrames or SQL text."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame

from punctual.plans.relations import Relation, table
from punctual.session import LOCAL_ZONE

# Local hours at which a run is scheduled, and the window that published figures are from.
SCHEDULED_HOURS = (6, 8, 10, 12, 14, 16, 18, 20, 22)
PUBLISHED_WINDOW = ("2026-10-02", "2026-10-08")
MANUAL = "manual"
FEED_NAMES = ("vehicle_positions", "trip_updates")
LOG, RESULTS = table("ops_run_log"), table("dq_results")


def local(column: str) -> str:
    return f"from_utc_timestamp({column}, '{LOCAL_ZONE}')"


@dataclass(frozen=True)
class Window:
    """Local calendar days from ``start`` to ``end``, both included; None is open."""

    start: date | None = None
    end: date | None = None

    @classmethod
    def of(cls, start: str | date | None = None, end: str | date | None = None) -> Window:
        day = lambda x: date.fromisoformat(x) if isinstance(x, str) else x
        return cls(day(start), day(end))

    def holds(self, column: str) -> str:
        """The condition that a UTC timestamp lies in it; null doesn't."""
        bounds = [f"date({local(column)}) {sign} date'{day}'" for sign, day in ((">=", self.start), ("<=", self.end)) if day]
        return " and ".join([f"{column} is not null", *bounds])


def logged(key: str, kind: str = "bigint") -> str:
    """A number in the log's JSON; null where it isn't one."""
    return f"try_cast(get_json_object(metrics, '$.{key}') as {kind})"


def share(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then round(100d * ({part}) / {whole}, 2) end"


ADDED = tuple(f"coalesce({logged(f + '_rows_added')}, 0L)" for f in FEED_NAMES)
TOOK_S = "unix_seconds(finished_at) - unix_seconds(started_at)"
DONE = "step = '{}' and status = 'succeeded'"


def _events_per_day(w: Window) -> Relation:
    """Raw rows added per local day by succeeded attempts, and the runs that added them."""
    rows = LOG.where(f"{DONE.format('bronze')} and {w.holds('started_at')}").columns(
        f"date({local('started_at')}) as run_date", "run_id", *[f"{a} as {f}" for a, f in zip(ADDED, FEED_NAMES)]
    )
    sums = [f"sum({f}) as {f}" for f in FEED_NAMES]
    return rows.grouped(["run_date"], "count(distinct run_id) as runs", *sums, f"sum({' + '.join(FEED_NAMES)}) as events").ordered("run_date")


def _freshness(w: Window) -> Relation:
    """Age of the newest departure when a scheduled build ended: exact percentiles, mean and range."""
    built = LOG.where(f"{DONE.format('gold')} and run_id <> '{MANUAL}' and {w.holds('started_at')}")
    ages = built.columns(f"{logged('freshness_s', 'int')} as s").where("s is not null")
    return ages.grouped(
        [], "count(*) as builds", "percentile(s, 0.5) as median_s", "percentile(s, 0.95) as p95_s", "round(avg(s), 1) as mean_s", "min(s) as min_s",
        "max(s) as max_s",
    )


def _rows_removed(w: Window) -> Relation:
    """Per feed, raw rows that reached neither the typed table nor quarantine. One scan per table."""
    def counted(name: str, feed: str, at: str, stage: str) -> Relation:
        return table(name).where(w.holds(at)).grouped([f"{feed} as feed", f"'{stage}' as stage"], "count(*) as n")

    parts = [counted(f"{stage}_{f}", f"'{f}'", "_ingested_at", stage) for stage in ("bronze", "silver") for f in FEED_NAMES]
    parts.append(counted("silver_quarantine", "feed", "_quarantined_at", "quarantined"))
    of = [f"coalesce(sum(n) filter (where stage = '{s}'), 0L) as {s}" for s in ("bronze", "silver", "quarantined")]
    wide = parts[0].followed_by(*parts[1:]).where(f"feed in {FEED_NAMES}").grouped(["feed"], *of)
    lost = "bronze - silver - quarantined"
    return wide.columns("*", f"{lost} as removed", f"{share(lost, 'bronze')} as pct_removed")


def _data_quality(w: Window) -> Relation:
    """Checks and runs that passed, of the runs in the window."""
    runs = LOG.where(w.holds("started_at")).columns("run_id")
    counted = RESULTS.joined(runs, ["run_id"], "left semi").grouped(
        [], "count(distinct run_id) as runs", "count(*) as checks", "count_if(passed) as passed", "count(distinct if(passed, null, run_id)) as failing"
    )
    return counted.columns("runs", "checks", "passed", f"{share('passed', 'checks')} as pct_checks_passed", "runs - failing as runs_all_passed")


def _step_runtime(w: Window) -> Relation:
    """Attempts, failures, median and longest seconds per step."""
    rows = LOG.where(w.holds("started_at")).columns("step", "status", f"{TOOK_S} as took_s")
    return rows.grouped(
        ["step"], "count(*) as attempts", "count_if(status = 'failed') as failed", "percentile(took_s, 0.5) as median_s", "max(took_s) as max_s"
    ).ordered("step")


#: (run_id, first_start, failed_steps) of scheduled runs: a step failed if its last attempt did.
OUTCOMES = (
    LOG.where(f"run_id <> '{MANUAL}'")
    .grouped(["run_id", "step"], "max_by(status, started_at) as last", "min(started_at) as first")
    .grouped(["run_id"], "min(first) as first_start", "count_if(last = 'failed') as failed_steps")
)


def _job_runs(w: Window) -> Relation:
    """Scheduled runs that began in the window, and those whose every step succeeded in the end."""
    counted = OUTCOMES.where(w.holds("first_start")).grouped(
        [], "count(*) as runs", "count_if(failed_steps = 0) as succeeded", "min(first_start) as first_run", "max(first_start) as last_run"
    )
    return counted.columns("runs", "succeeded", f"{share('succeeded', 'runs')} as pct_succeeded", "first_run", "last_run")


def _run_coverage(w: Window) -> Relation:
    """One row per calendar day, days without a run too: runs, missed slots, failed and off-schedule runs."""
    runs = OUTCOMES.columns(f"date({local('first_start')}) as run_date", f"hour({local('first_start')}) as start_hour", "failed_steps")
    low = f"greatest(min(run_date), date'{w.start}')" if w.start else "min(run_date)"
    high = f"least(max(run_date), date'{w.end}')" if w.end else "max(run_date)"
    span = runs.grouped([], f"{low} as low", f"{high} as high").where("low <= high")
    slots = ", ".join(map(str, SCHEDULED_HOURS))
    days = span.columns("explode(sequence(low, high)) as run_date").joined(runs, ["run_date"], "left").grouped(
        ["run_date"], "count(start_hour) as runs", "array_sort(collect_list(start_hour)) as start_hours", "count_if(failed_steps > 0) as failed_runs",
        f"count_if(start_hour not in ({slots})) as off_schedule_runs",
    )
    missing = f"size(array_except(array({slots}), start_hours)) as missing_runs"
    return days.columns("run_date", "runs", missing, "failed_runs", "off_schedule_runs", "start_hours").ordered("run_date")


METRICS: dict[str, Callable[[Window], Relation]] = {
    "events_per_day": _events_per_day, "freshness": _freshness, "rows_removed": _rows_removed, "data_quality": _data_quality,
    "step_runtime": _step_runtime, "job_runs": _job_runs, "run_coverage": _run_coverage,
}


def _over_log(name: str) -> Callable[..., DataFrame]:
    def run(log: DataFrame, window: Window = Window()) -> DataFrame:
        return METRICS[name](window).frame({"ops_run_log": log})

    run.__name__, run.__doc__ = name, METRICS[name].__doc__
    return run


events_per_day, freshness, step_runtime, job_runs, run_coverage = map(_over_log, ("events_per_day", "freshness", "step_runtime", "job_runs", "run_coverage"))


def rows_removed(bronze: dict[str, DataFrame], silver: dict[str, DataFrame], quarantine: DataFrame, window: Window = Window()) -> DataFrame:
    tables = {f"{stage}_{f}": t for stage, by in (("bronze", bronze), ("silver", silver)) for f, t in by.items()}
    return _rows_removed(window).frame(tables | {"silver_quarantine": quarantine})


def data_quality(results: DataFrame, log: DataFrame, window: Window = Window()) -> DataFrame:
    return _data_quality(window).frame({"dq_results": results, "ops_run_log": log})


def metric(lake, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One metric over a lake's tables."""
    found = METRICS[name](Window.of(start, end))
    return found.frame({t: lake.read(t) for t in found.tables})


def metric_sql(name: str, start: str | None = None, end: str | None = None, prefix: str = "") -> str:
    """One metric as a statement over tables below ``prefix``."""
    return METRICS[name](Window.of(start, end)).sql(prefix)


def metrics_file(start: str, end: str, prefix: str = "") -> str:
    """All metrics for one window as a file of statements, to keep beside published figures."""
    parts = [f"-- Local calendar days {start} to {end}, both included."]
    parts += [f"\n-- {name}\n{metric_sql(name, start, end, prefix)};" for name in METRICS]
    return "\n".join(parts) + "\n"


def compute(lake, start: str | None = None, end: str | None = None) -> dict[str, Any]:
    """All metrics in one dictionary. Without a window the first and last logged day, mostly partial, don't count
    towards events per day if there are three days or more."""
    # One row in all, or one for each day, feed or step.
    rows = lambda name: [r.asDict() for r in metric(lake, name, start, end).collect()]
    days = rows("events_per_day")
    events = [d["events"] for d in (days if start or len(days) < 3 else days[1:-1])]
    coverage = rows("run_coverage")
    total = lambda key: sum(r[key] for r in coverage)
    return {
        "window": {"start": start, "end": end} if start else None,
        "days_logged": len(days),
        "avg_events_per_full_day": round(sum(events) / len(events)) if events else None,
        "min_events_per_day": min(events, default=None),
        "max_events_per_day": max(events, default=None),
        "total_events": sum(d["events"] for d in days),
        **{name: rows(name)[0] for name in ("freshness", "data_quality", "job_runs")},
        "rows_removed": {r["feed"]: r for r in rows("rows_removed")},
        "step_runtime": {r["step"]: r for r in rows("step_runtime")},
        "run_coverage": {
            "days": len(coverage), **{k: total(k) for k in ("missing_runs", "failed_runs", "off_schedule_runs")}, "per_day": coverage,
        },
    }


def plain(value: object) -> object:
    """JSON form of what JSON doesn't know: decimals as numbers, the rest as text."""
    return float(value) if isinstance(value, Decimal) else str(value)


def save(lake, figures: dict[str, Any]) -> None:
    """Appends one dated measurement."""
    window = figures.get("window") or {}
    row = (datetime.now(UTC), window.get("start"), window.get("end"), json.dumps(figures, default=plain, sort_keys=True))
    lake.append("ops_metric_results", lake.spark.createDataFrame([row], "measured_at timestamp, window_start string, window_end string, metrics string"))


def main(argv: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Prints every metric's SQL for a window.")
    p.add_argument("--start", default=PUBLISHED_WINDOW[0])
    p.add_argument("--end", default=PUBLISHED_WINDOW[1])
    p.add_argument("--prefix", default="")
    args = p.parse_args(argv)
    print(metrics_file(args.start, args.end, args.prefix), end="")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
