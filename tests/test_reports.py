"""Metrics, datasets, export and dashboard figures against hand-computed expectations."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from punctual.plans import benchmarks, control, dashboard, datasets, metrics
from punctual.sources import snapshot

DAY = date(2026, 10, 1)
LOG = "run_id string, step string, started_at timestamp, finished_at timestamp, status string, metrics string"


def log_row(run, step, start, minutes=1, status="succeeded", **figures):
    a = datetime.fromisoformat(start)
    return (run, step, a, datetime.fromtimestamp(a.timestamp() + 60 * minutes), status, json.dumps(figures))


@pytest.fixture
def run_log(spark):
    return spark.createDataFrame([
        # Local days are 1 and 3 October; 10:00 UTC is 6 a.m.
        log_row("r1", "bronze", "2026-10-01 10:00:00", vehicle_positions_rows_added=100, trip_updates_rows_added=20),
        log_row("r1", "gold", "2026-10-01 10:05:00", 2, "failed"),
        log_row("r1", "gold", "2026-10-01 10:10:00", 2, freshness_s=300),
        log_row("r2", "bronze", "2026-10-01 12:00:00", vehicle_positions_rows_added=50),
        log_row("r2", "gold", "2026-10-01 12:05:00", 4, "failed"),
        log_row("r3", "bronze", "2026-10-03 15:00:00", trip_updates_rows_added=5),
        log_row("r3", "gold", "2026-10-03 15:10:00", 3, freshness_s=500),
        log_row("manual", "bronze", "2026-10-02 02:00:00", vehicle_positions_rows_added=7),
        log_row("manual", "gold", "2026-10-03 20:00:00", freshness_s=90000),
    ], LOG)


def test_events_and_freshness(run_log):
    rows = [tuple(r) for r in metrics.events_per_day(run_log).collect()]
    assert rows == [(date(2026, 10, 1), 3, 157, 20, 177), (date(2026, 10, 3), 1, 0, 5, 5)]  # 02:00 UTC is still the 1st
    assert tuple(metrics.freshness(run_log).first()) == (2, 400.0, 490.0, 400.0, 300, 500)
    assert metrics.events_per_day(run_log, metrics.Window.of("2026-10-02", "2026-10-03")).count() == 1


def test_runs(run_log):
    r = metrics.job_runs(run_log).first()
    assert (r.runs, r.succeeded, r.pct_succeeded) == (3, 2, 66.67)
    rows = [(str(x.run_date), x.runs, x.missing_runs, x.failed_runs, x.off_schedule_runs, x.start_hours) for x in metrics.run_coverage(run_log).collect()]
    assert rows == [("2026-10-01", 2, 7, 1, 0, [6, 8]), ("2026-10-02", 0, 9, 0, 0, []), ("2026-10-03", 1, 9, 0, 1, [11])]
    steps = {r.step: (r.attempts, r.failed, r.median_s, r.max_s) for r in metrics.step_runtime(run_log).collect()}
    assert steps["gold"] == (5, 2, 120.0, 240)


def test_rows_removed_and_quality(spark, run_log):
    rows = lambda n: spark.range(n).select(F.lit(datetime(2026, 10, 1, 12)).alias("_ingested_at"))
    aside = spark.createDataFrame([("vehicle_positions", datetime(2026, 10, 1, 12))], "feed string, _quarantined_at timestamp")
    got = {r.feed: (r.removed, r.pct_removed) for r in metrics.rows_removed({"vehicle_positions": rows(10), "trip_updates": rows(4)}, {"vehicle_positions": rows(7), "trip_updates": rows(4)}, aside).collect()}
    assert got == {"vehicle_positions": (2, 20.0), "trip_updates": (0, 0.0)}
    dq = spark.createDataFrame([("r1", True), ("r1", False), ("r2", True), ("gone", False)], "run_id string, passed boolean")
    assert tuple(metrics.data_quality(dq, run_log).first()) == (2, 3, 2, 66.67, 1)


def test_window_must_be_dates():
    with pytest.raises(ValueError):
        metrics.Window.of("2026-10-01' or 1=1", None)


DEP = (
    "service_date date, route_id string, direction_id int, trip_id string, vehicle_id string, stop_id string, stop_sequence int, scheduled_ts timestamp, "
    "observed_ts timestamp, max_error_s int, hour_local int, day_of_week string, feed_version string, delay_s int, otp_status string"
)
GAPS = (
    "service_date date, day_of_week string, route_id string, direction_id int, stop_id string, hour_local int, trip_id string, observed_ts timestamp, "
    "scheduled_ts timestamp, prev_trip_id string, headway_s int, sched_headway_s int, headway_ratio double, headway_status string"
)


@pytest.fixture
def full_lake(spark, lake, run_log):
    t = datetime(2026, 10, 1, 12)
    dep = [(DAY, "070", None, f"t{n}", "v1", "A", 1, t, t, 5, 8 if n < 6 else 20, "Thu", "v", 60 * n, "on_time" if n < 6 else "late") for n in range(8)]
    dep.append((date(2026, 10, 3), "X2", 1, "w", "v2", "B", 1, t, t, 5, 9, "Sat", "v", None, None))
    gaps = [(DAY, "Thu", "070", None, "A", 8, f"t{n}", t, t, f"t{n - 1}", 60, 600, 0.1, "bunched" if n < 4 else "regular") for n in range(1, 8)]
    gaps.append((DAY, "Thu", "Q", 0, "A", 8, "q", t, t, "p", 60, 60, 1.0, "regular"))
    lake.overwrite("gold_timepoint_departures", spark.createDataFrame(dep, DEP))
    lake.overwrite("gold_headways", spark.createDataFrame(gaps, GAPS))
    lake.overwrite("dim_routes", spark.createDataFrame([("070", "70", "Georgia Av", True), ("070", "70", "Old", False)], "route_id string, route_short_name string, route_long_name string, is_current boolean"))
    lake.overwrite("dim_stops", spark.createDataFrame([("A", "Main St", "38.9", "-77.0", True)], "stop_id string, stop_name string, stop_lat string, stop_lon string, is_current boolean"))
    lake.overwrite("ops_run_log", run_log)
    return lake


def rows_of(lake, name):
    return [r.asDict() for r in datasets.build(lake)[0][name].collect()]


def test_datasets(full_lake):
    found, skipped = datasets.build(full_lake)
    assert skipped == ["weather", "dq_checks"]
    a, b = rows_of(full_lake, "route_summary")
    assert (a["route_id"], a["route_long_name"], a["departures"], a["on_time"], a["late"], a["rush_departures"], a["headways"], a["bunched"]) == ("070", "Georgia Av", 8, 6, 2, 6, 7, 3)
    assert (b["route_short_name"], b["headways"], b["avg_delay_s"]) == (None, 0, None)
    cells = {(r["route_id"], r["day_type"], r["hour_local"]): (r["departures"], r["headways"]) for r in rows_of(full_lake, "route_hour")}
    assert cells == {("070", "weekday", 8): (6, 7), ("070", "weekday", 20): (2, 0), ("Q", "weekday", 8): (0, 1), ("X2", "weekend", 9): (1, 0)}
    assert [(r["departures"], r["routes"], r["vehicles"], r["headways"]) for r in rows_of(full_lake, "daily")] == [(8, 1, 1, 8), (1, 1, 1, 0)]
    stops = rows_of(full_lake, "stops")
    assert [(s["stop_id"], s["lat"], s["route_ids"]) for s in stops] == [("A", 38.9, "070")]  # B has no current place
    example = rows_of(full_lake, "bunching_example")
    assert len(example) == 8 and example[0]["direction_id"] is None and sum(r["headway_s"] is not None for r in example) == 7
    assert len(rows_of(full_lake, "pipeline_runs")) == 7


def test_export_and_read_back(spark, full_lake, tmp_path):
    done = datasets.export(full_lake, str(tmp_path / "out"), "r9")
    assert done["rows"]["route_summary"] == 2
    s = snapshot.load(spark, tmp_path / "out")
    assert s.manifest["run_id"] == "r9" and s.manifest["service_dates"]["last_service_date"] == "2026-10-03" and s.metrics == {}
    assert [r.route_id for r in s["route_summary"].collect()] == ["070", "X2"]  # ids stay text
    assert snapshot.load(spark, tmp_path) is None
    assert not list((tmp_path / "out").glob(".*"))


def test_compute_and_save(spark, full_lake):
    full_lake.overwrite("dq_results", spark.createDataFrame([("r1", True)], "run_id string, passed boolean"))
    one = spark.range(3).select(F.lit(datetime(2026, 10, 1, 12)).alias("_ingested_at"))
    for t in ("bronze_vehicle_positions", "bronze_trip_updates", "silver_vehicle_positions", "silver_trip_updates"):
        full_lake.overwrite(t, one)
    full_lake.overwrite("silver_quarantine", spark.createDataFrame([], "feed string, _quarantined_at timestamp"))
    m = metrics.compute(full_lake)
    assert (m["days_logged"], m["total_events"], m["avg_events_per_full_day"], m["freshness"]["p95_s"]) == (2, 182, 91, 490.0)
    assert m["run_coverage"]["missing_runs"] == 25
    metrics.save(full_lake, m)
    assert json.loads(full_lake.read("ops_metric_results").first().metrics)["total_events"] == 182
    assert "-- job_runs" in metrics.metrics_file("2026-10-01", "2026-10-03")


ROUTE_HOUR = "route_id string, day_type string, hour_local int, departures long, on_time long, late long, early long, delay_s_sum long, headways long, bunched long, gapped long"


@pytest.fixture
def route_hour(spark):
    return spark.createDataFrame([("A", "weekday", 8, 10, 5, 4, 1, 900, 8, 4, 1), ("A", "weekday", 12, 50, 35, 10, 5, 3000, 20, 1, 0), ("B", "weekend", 8, 40, 22, 10, 8, 2100, 10, 0, 2)], ROUTE_HOUR)


def test_kpis_are_ratios_of_sums(route_hour):
    k = dashboard.kpis(route_hour).first()
    assert (k.departures, k.pct_on_time, k.rush_pct_on_time, k.rest_pct_on_time, k.pct_bunched, k.avg_delay_min) == (100, 62.0, 50.0, 63.3, 13.2, 1.0)
    assert dashboard.kpis(route_hour.limit(0)).count() == 0


def test_profiles(route_hour):
    rows = dashboard.hour_profile(route_hour, "weekday").collect()
    assert [(r.hour_local, r.pct_on_time, r.avg_delay_min) for r in rows] == [(8, 50.0, 1.5), (12, 70.0, 1.0)]
    assert dashboard.hour_profile(route_hour, "weekday", "B").count() == 0
    assert [tuple(r) for r in dashboard.route_hour_grid(route_hour, ["A"], "weekday", 20).collect()] == [("A", 12, 50, 70.0)]


def test_routes_and_headline(spark, route_hour):
    schema = "route_id string, route_short_name string, route_long_name string, departures long, on_time long, late long, early long, avg_delay_s double, p90_delay_s double, rush_departures long, rush_on_time long, days long, headways long, bunched long, gapped long"
    s = spark.createDataFrame([("070", None, None, 60, 30, 20, 10, 90.0, 300.0, 0, 0, 5, 0, 0, 0), ("B", "B1", "Broad", 30, 15, 10, 5, 30.0, 90.0, 10, 9, 5, 10, 1, 0), ("C", "C", "", 4, 0, 4, 0, 0.0, 0.0, 0, 0, 1, 0, 0, 0)], schema)
    assert dashboard.enough_departures(s) == 5 and dashboard.enough_departures(s, want=2) == 30
    rows = dashboard.route_table(s, 5).collect()
    assert [(r.route, r.pct_on_time, r.rush_pct_on_time, r.pct_bunched) for r in rows] == [("070", 50.0, None, None), ("B1 Broad", 50.0, 90.0, 10.0)]
    said = dashboard.headline(route_hour, s)
    assert said[0].startswith("62% of 100") and "worse" in said[1] and "070" in said[-1]
    assert dashboard.headline(route_hour.limit(0), s) == []


def test_weather(spark):
    w = spark.createDataFrame([("wet", True, 2, 10, 5, 60.0), ("dry", True, 3, 30, 27, 30.0), ("dry", False, 9, 50, 40, 0.0)], "weather string, rush boolean, hours long, departures long, on_time long, avg_delay_s double")
    assert {(r.period, r.weather): r.pct_on_time for r in dashboard.weather_table(w).collect()}[("Weekday rush", "wet")] == 50.0
    bars = {r.period: (r.dry, r.wet, r.wet_hours) for r in dashboard.weather_bars(w).collect()}
    assert bars == {"Weekday rush": (90.0, 50.0, 2), "Other hours": (80.0, None, 0)}


def test_timeline_and_lines(spark):
    e = spark.createDataFrame([("t", "v", 90, None, 1790000000, 1790000090)], "trip_id string, vehicle_id string, delay_s int, headway_status string, scheduled_epoch long, observed_epoch long")
    rows = {r.kind: (r.epoch, r.delay_min, r.clock) for r in dashboard.bunching_timeline(e).collect()}
    assert rows == {"Scheduled": (1790000000, 1.5, "10:13"), "Actual": (1790000090, 1.5, "10:14")}
    lines = spark.createDataFrame([(6, "a", 1.0), (7, "b", 2.0)], "hour_local int, series string, value double")
    assert [tuple(r) for r in dashboard.hour_lines(lines, ["a", "b"]).collect()] == [(6, 1.0, None), (7, None, 2.0)]


def test_benchmark(spark, full_lake):
    benchmarks.measure(full_lake, "before", 1)
    assert set(benchmarks.cluster_all(full_lake)) == {"gold_timepoint_departures", "gold_headways"}
    benchmarks.measure(full_lake, "after", 1)
    assert {r.name for r in benchmarks.compared(full_lake.read("ops_benchmarks")).collect()} >= {"gold_full_aggregate", "gold_headways"}


def test_control(spark, lake):
    assert [s.name for s in control.plan()][-1] == "export" and control.arguments(["gold", "--root", "x"]).step == "gold"
    with pytest.raises(ValueError):
        control.plan([control.Step("a", ("b",)), control.Step("b", ("a",))])
    calls = []

    def act(name):
        def go():
            calls.append(name)
            if name in ("collect", "gold"):
                raise RuntimeError(f"{name} broke " + "x" * 5000)
            return {"done": name}

        return go

    status = control.run(lake, {s.name: act(s.name) for s in control.JOB}, "r")
    assert status == {"collect": "failed", "weather": "succeeded", "bronze": "succeeded", "silver": "succeeded", "gold": "failed", "quality": "skipped", "export": "skipped"}
    log = lake.read("ops_run_log")
    assert log.where("step = 'gold' and status = 'failed'").count() == 2 == calls.count("gold")
    assert len(json.loads(log.where("step = 'gold'").first().metrics)["error"]) == control.ERROR_CHARS


def test_overlap(spark):
    a = spark.createDataFrame([("1", 1), ("1", 1), ("2", 1), (None, 1)], "v string, t int")
    b = spark.createDataFrame([("1", 1), ("3", 1), (None, 1)], "v string, t int")
    assert tuple(snapshot.overlap(a, b, ["v", "t"]).first()) == (2, 1, 1)


def same(a, b):
    return sorted(a.columns) == sorted(b.columns) and sorted(map(str, (tuple(r[c] for c in a.columns) for r in a.collect()))) == sorted(
        map(str, (tuple(r[c] for c in a.columns) for r in b.collect()))
    )


def test_sql_texts_agree_with_the_dataframes(spark, full_lake):
    lake = full_lake
    one = spark.range(3).select(F.lit(datetime(2026, 10, 1, 12)).alias("_ingested_at"))
    for t in ("bronze_vehicle_positions", "bronze_trip_updates", "silver_vehicle_positions", "silver_trip_updates"):
        lake.overwrite(t, one)
    lake.overwrite("silver_quarantine", spark.createDataFrame([("trip_updates", datetime(2026, 10, 1, 12))], "feed string, _quarantined_at timestamp"))
    lake.overwrite("dq_results", spark.createDataFrame([("r1", "c", "t", "critical", 1, 9, True), ("r3", "c", "t", "critical", 2, 9, False)], "run_id string, check_name string, table_name string, severity string, failed long, total long, passed boolean"))
    hours = spark.createDataFrame([(DAY, "Thu", "070", 8, 3, 2, 10.0, True), (DAY, "Thu", "070", 12, 1, 1, 5.0, False)], "service_date date, day_of_week string, route_id string, hour_local int, departures int, on_time int, avg_delay_s double, is_wet boolean")
    lake.overwrite("gold_route_hour_weather", hours)
    lake.view("ops_run_log", "dq_results", "silver_quarantine", "gold_timepoint_departures", "gold_headways", "dim_routes", "dim_stops", "gold_route_hour_weather", *[f"{a}_{b}" for a in ("bronze", "silver") for b in metrics.FEED_NAMES])
    for window in ((None, None), ("2026-10-01", "2026-10-02")):
        for name in metrics.METRICS:
            assert same(metrics.metric(lake, name, *window), spark.sql(metrics.metric_sql(name, *window))), (name, window)
    found, skipped = datasets.build(lake)
    assert not skipped
    for name, rows in found.items():
        assert same(rows, spark.sql(datasets.DATASETS[name].sql())), name
    for t in ("silver_vehicle_positions", "silver_trip_updates"):
        lake.drop(t)
    for label in ("before", "after"):
        benchmarks.measure(lake, label, 1)
    lake.view("ops_benchmarks")
    assert same(benchmarks.compared(lake.read("ops_benchmarks")), spark.sql(benchmarks.comparison().sql()))
    assert metrics.metrics_file("2026-10-02", "2026-10-08", "a.b.").count("a.b.ops_run_log") >= 6
    for bad in (lambda: metrics.metric_sql("freshness", "2026-10-01' or 1=1"), lambda: datasets.DATASETS["daily"].sql("x; drop"), lambda: benchmarks.comparison("a'b")):
        with pytest.raises(ValueError):
            bad()
