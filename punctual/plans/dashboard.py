"""What the dashboard shows, from the published datasets: always ratios of sums, never means of ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.scalars import local_clock, percent_text, share
from punctual.plans.datasets import RUSH_HOURS
from punctual.session import LOCAL_ZONE

ENOUGH = (100, 50, 30, 20, 10)


def at_rush(hours: Sequence[int] = RUSH_HOURS) -> Column:
    return (F.col("day_type") == "weekday") & F.col("hour_local").isin(*hours)


def minutes(seconds: Column, over: Column | None = None) -> Column:
    """Seconds (by ``over`` if given) as minutes with one digit; null over nothing."""
    return F.round(seconds / 60, 1) if over is None else F.when(over > 0, F.round(seconds / over / 60, 1))


def kpis(route_hour: DataFrame, rush_hours: Sequence[int] = RUSH_HOURS) -> DataFrame:
    """One row of headline figures, overall and at rush hour against the rest; none for an empty input."""
    rush, c = at_rush(rush_hours), F.col
    counted = ["departures", "on_time", "late", "early", "delay_s_sum", "headways", "bunched", "gapped"]
    parts = ["departures", "on_time", "headways", "bunched"]
    sums = route_hour.agg(
        F.count("*").alias("_n"), *[F.sum(x).alias(x) for x in counted],
        *[F.sum(F.when(cond, c(x)).otherwise(0)).alias(f"{p}_{x}") for p, cond in (("rush", rush), ("rest", ~rush)) for x in parts],
    ).where("_n > 0")
    return sums.select(
        "departures", share(c("on_time"), c("departures")).alias("pct_on_time"), share(c("late"), c("departures")).alias("pct_late"),
        share(c("early"), c("departures")).alias("pct_early"), minutes(c("delay_s_sum"), c("departures")).alias("avg_delay_min"), "headways",
        share(c("bunched"), c("headways")).alias("pct_bunched"), share(c("gapped"), c("headways")).alias("pct_gapped"),
        *[share(c(f"{p}_on_time"), c(f"{p}_departures")).alias(f"{p}_pct_on_time") for p in ("rush", "rest")],
        *[share(c(f"{p}_bunched"), c(f"{p}_headways")).alias(f"{p}_pct_bunched") for p in ("rush", "rest")],
    )


def route_table(summary: DataFrame, least: int) -> DataFrame:
    """Routes with at least ``least`` departures, the least punctual first, the busier first among equals."""
    c = F.col
    label = F.trim(F.concat_ws(" ", F.coalesce("route_short_name", "route_id"), F.coalesce("route_long_name", F.lit(""))))
    return summary.where(c("departures") >= least).select(
        "*", label.alias("route"), share(c("on_time"), c("departures")).alias("pct_on_time"), share(c("late"), c("departures")).alias("pct_late"),
        share(c("rush_on_time"), c("rush_departures")).alias("rush_pct_on_time"), share(c("bunched"), c("headways")).alias("pct_bunched"),
        minutes(c("avg_delay_s")).alias("avg_delay_min"), minutes(c("p90_delay_s")).alias("p90_delay_min"),
    ).orderBy(F.asc("pct_on_time"), F.desc("departures"), F.asc("route_id"))


def enough_departures(summary: DataFrame, want: int = 10, steps: Sequence[int] = ENOUGH, least: int = 5) -> int:
    """The largest of ``steps`` that leaves at least ``want`` routes, else ``least``; counted in one pass."""
    counts = summary.agg(*[F.count_if(F.col("departures") >= s).alias(f"n{s}") for s in steps]).first()
    return next((s for s in sorted(steps, reverse=True) if counts[f"n{s}"] >= want), least)


def hour_profile(route_hour: DataFrame, day_type: str, route_id: str | None = None) -> DataFrame:
    """Per hour of one day type, for one route or all."""
    c = F.col
    rows = route_hour.where(c("day_type") == day_type)
    rows = rows if route_id is None else rows.where(c("route_id") == route_id)
    sums = rows.groupBy("hour_local").agg(*[F.sum(x).alias(x) for x in ("departures", "on_time", "late", "headways", "bunched", "delay_s_sum")])
    return sums.select(
        "*", share(c("on_time"), c("departures")).alias("pct_on_time"), share(c("late"), c("departures")).alias("pct_late"),
        share(c("bunched"), c("headways")).alias("pct_bunched"), minutes(c("delay_s_sum"), c("departures")).alias("avg_delay_min"),
    ).orderBy("hour_local")


def route_hour_grid(route_hour: DataFrame, route_ids: Sequence[str], day_type: str, least: int) -> DataFrame:
    """Cells of the chosen routes with enough departures."""
    c = F.col
    rows = route_hour.where((c("day_type") == day_type) & c("route_id").isin(*route_ids) & (c("departures") >= least))
    return rows.select("route_id", "hour_local", "departures", share(c("on_time"), c("departures")).alias("pct_on_time"))


def stop_points(stops: DataFrame, least: int) -> DataFrame:
    """Stops with a place and enough departures."""
    c = F.col
    return stops.dropna(subset=["lat", "lon"]).where(c("departures") >= least).select(
        "*", share(c("on_time"), c("departures")).alias("pct_on_time"), share(c("bunched"), c("headways")).alias("pct_bunched")
    )


def _period(rush: Column) -> Column:
    return F.when(rush.cast("string").isin("true", "True", "1"), "Weekday rush").otherwise("Other hours")


def weather_table(weather: DataFrame) -> DataFrame:
    """Wet and dry, rush and other hours, with the sample behind each figure."""
    c = F.col
    return weather.select(
        _period(c("rush")).alias("period"), "weather", "hours", "departures", share(c("on_time"), c("departures")).alias("pct_on_time"),
        minutes(c("avg_delay_s")).alias("avg_delay_min"),
    )


def weather_bars(weather: DataFrame) -> DataFrame:
    """One row per period with the wet and the dry side next to one another."""
    c = F.col
    side = lambda w, x: F.coalesce(F.sum(F.when(c("weather") == w, c(x))), F.lit(0))
    sums = weather.groupBy(_period(c("rush")).alias("period")).agg(
        *[side(w, x).alias(f"{w}_{x}") for w in ("dry", "wet") for x in ("on_time", "departures", "hours")]
    )
    return sums.select(
        "period", *[share(c(f"{w}_on_time"), c(f"{w}_departures")).alias(w) for w in ("dry", "wet")],
        *[f"{w}_{x}" for x in ("hours", "departures") for w in ("dry", "wet")],
    )


def bunching_timeline(example: DataFrame) -> DataFrame:
    """Two long rows per bus, scheduled and actual, with local wall time."""
    wide = example.select("trip_id", "vehicle_id", "delay_s", "headway_status", F.col("scheduled_epoch").alias("Scheduled"), F.col("observed_epoch").alias("Actual"))
    long = wide.unpivot(["trip_id", "vehicle_id", "delay_s", "headway_status"], ["Scheduled", "Actual"], "kind", "epoch")
    return long.select(
        "kind", "trip_id", "vehicle_id", "epoch", minutes(F.col("delay_s")).alias("delay_min"), "headway_status",
        F.from_utc_timestamp(F.timestamp_seconds("epoch"), LOCAL_ZONE).alias("time"), local_clock(F.col("epoch")).alias("clock"),
    )


def _started() -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds("started_epoch"), LOCAL_ZONE)


def events_per_day(runs: DataFrame) -> DataFrame:
    """Raw rows added per local day by succeeded attempts."""
    done = runs.where("step = 'bronze' and status = 'succeeded'")
    return done.groupBy(_started().cast("date").alias("date")).agg(F.sum("bronze_rows").alias("events"), F.count_distinct("run_id").alias("runs")).orderBy("date")


def step_runtimes(runs: DataFrame) -> DataFrame:
    """Median and longest seconds of succeeded attempts per step."""
    return runs.where("status = 'succeeded'").groupBy("step").agg(
        F.percentile("duration_s", 0.5).alias("median_s"), F.max("duration_s").alias("max_s"), F.count("run_id").alias("attempts")
    ).orderBy("step")


def freshness_series(runs: DataFrame) -> DataFrame:
    """Minutes of age at each succeeded build, in local time."""
    built = runs.where("step = 'gold' and status = 'succeeded' and freshness_s is not null")
    return built.select(_started().alias("time"), minutes(F.col("freshness_s")).alias("freshness_min")).orderBy("time")


def hour_lines(rows: DataFrame, series: Sequence[str], name: str = "series", value: str = "value") -> DataFrame:
    """One row per hour with a column per series, null where a series has no point."""
    return rows.groupBy("hour_local").pivot(name, list(series)).agg(F.first(value)).orderBy("hour_local")


def headline(route_hour: DataFrame, summary: DataFrame, rush_hours: Sequence[int] = RUSH_HOURS) -> list[str]:
    """The findings in plain sentences; empty without departures."""
    shown = kpis(route_hour, rush_hours).select(
        "*", F.format_number("departures", 0).alias("_departures"), percent_text(F.col("pct_on_time")).alias("_on_time")
    ).first()
    if shown is None or shown.pct_on_time is None:
        return []
    said = [f"{shown.pct_on_time:g}% of {shown._departures} graded departures left on time."]
    rush, rest = shown.rush_pct_on_time, shown.rest_pct_on_time
    if rush is not None and rest is not None and abs(rush - rest) >= 1:
        said.append(f"At weekday rush hour it is {'worse' if rush < rest else 'better'}: {rush:g}% on time, {rest:g}% at other hours.")
    if shown.pct_bunched is not None:
        said.append(f"{shown.pct_bunched:g}% of headways were bunched, below a quarter of the scheduled one.")
    least = enough_departures(summary)
    worst = route_table(summary, least).first()
    if worst:
        said.append(f"Of routes with at least {least} departures, {worst.route} is the least punctual: {worst.pct_on_time:g}% on time.")
    return said
