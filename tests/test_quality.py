from datetime import date, datetime

import pytest

from punctual.operators import quality
from punctual.operators.quality import Rule

DAY = date(2026, 10, 1)
RULES = (
    Rule("positive", "t", "n < 0"), Rule("once", "t", key=("k",)), Rule("small", "t", "n > 5", severity=quality.WARNING, limit_pct=50.0),
)


def table(spark, *rows):
    return spark.createDataFrame(rows, "service_date date, k string, n int")


def test_counts(spark):
    found = {r.check_name: (r.failed, r.total, r.fail_pct, r.passed) for r in quality.check_tables({"t": table(spark, (DAY, "a", 1), (DAY, "a", None), (DAY, None, 9))}, RULES).collect()}
    assert found == {"positive": (0, 3, 0.0, True), "once": (2, 3, 66.667, False), "small": (1, 3, 33.333, True)}
    empty = quality.check_tables({"t": table(spark, (DAY, "a", 1)).limit(0)}, RULES).collect()
    assert all(r.passed and r.total == 0 for r in empty)


def test_one_bad_row_among_many_fails(spark):
    many = spark.range(300_000).selectExpr("date'2026-10-01' as service_date", "string(id) as k", "int(if(id = 0, -1, 1)) as n")
    r = quality.check_tables({"t": many}, RULES[:1]).first()
    assert r.fail_pct == 0.0 and not r.passed


def test_results_are_kept_before_failing(spark, lake):
    assert quality.run_checks(lake, "r0", RULES)["checks"] == 0
    log = "start_date date, end_date date, silver_loaded_through timestamp, built_at timestamp"
    lake.append("gold_build_log", spark.createDataFrame([(date(2026, 9, 1), date(2026, 9, 1), None, datetime(2026, 9, 2)), (DAY, DAY, None, datetime(2026, 10, 2))], log))
    lake.overwrite("t", table(spark, (DAY, "a", 1), (date(2026, 9, 1), "b", -1)))
    assert quality.run_checks(lake, "r1", RULES) == {"checks": 3, "passed": 3, "critical_failed": 0, "warnings": 0}
    lake.append("t", table(spark, (DAY, "a", -1)))
    with pytest.raises(quality.QualityError, match="once, positive"):
        quality.run_checks(lake, "r2", RULES)
    assert lake.read("dq_results").where("run_id = 'r2' and not passed").count() == 2


def test_all_rules_compile(spark):
    columns = {
        "silver_vehicle_positions": "vehicle_id string, event_ts timestamp, latitude double, longitude double",
        "silver_trip_updates": "trip_id string, trip_start_date date, event_ts timestamp, delay_s int",
        "gold_timepoint_departures": "trip_id string, service_date date, stop_sequence int, max_error_s int, otp_status string, delay_s int",
        "gold_route_hour_performance": "departures int, on_time int, early int, late int, pct_on_time double", "gold_headways": "headway_s int",
    }
    assert quality.check_tables({t: spark.createDataFrame([], c) for t, c in columns.items()}).count() == 12
