from datetime import date

import pytest

from punctual.operators.dimensions import apply_release, load_release, release_rows
from punctual.operators.history import ROUTES

D1, D2, D3 = date(2026, 9, 1), date(2026, 10, 1), date(2026, 11, 1)


def release(spark, version, start, rows):
    df = spark.createDataFrame(rows, "route_id string, route_long_name string, route_short_name string")
    return release_rows(df, ROUTES, version, start)


def history(lake):
    return sorted((r.route_id, r.route_long_name, r.valid_from, r.valid_to, r.is_current) for r in lake.read("dim_routes").collect())


def test_releases(spark, lake):
    first = release(spark, "v1", D1, [("A", "Alpha", "A"), ("B", "Beta", "B"), ("Z", "Zeta", "Z"), ("Z", "Zeta", "Z")])
    assert apply_release(lake, "dim_routes", first, ROUTES) == {"inserted": 3, "closed": 0}
    assert apply_release(lake, "dim_routes", first, ROUTES) == {"inserted": 0, "closed": 0}
    second = release(spark, "v2", D2, [("A", "Alpha new", "A"), ("B", "Beta", "B"), ("C", "Gamma", "C")])
    assert apply_release(lake, "dim_routes", second, ROUTES) == {"inserted": 2, "closed": 2}
    assert history(lake) == [
        ("A", "Alpha", D1, D2, False), ("A", "Alpha new", D2, None, True), ("B", "Beta", D1, None, True), ("C", "Gamma", D2, None, True),
        ("Z", "Zeta", D1, D2, False),
    ]
    assert lake.history("dim_routes")[-1]["inserted"] == 2
    with pytest.raises(ValueError):  # releases apply in order
        apply_release(lake, "dim_routes", first, ROUTES)
    with pytest.raises(ValueError):  # a version can't end on the day it began
        apply_release(lake, "dim_routes", release(spark, "v2b", D2, [("A", "Other", "A")]), ROUTES)
    back = release(spark, "v3", D3, [("Z", "Zeta", "Z")])
    assert apply_release(lake, "dim_routes", back, ROUTES) == {"inserted": 1, "closed": 3}
    with pytest.raises(ValueError):
        apply_release(lake, "dim_routes", back.limit(0), ROUTES)


def test_null_and_empty_differ(spark, lake):
    apply_release(lake, "dim_routes", release(spark, "v1", D1, [("A", None, "x")]), ROUTES)
    assert apply_release(lake, "dim_routes", release(spark, "v2", D2, [("A", "", "x")]), ROUTES) == {"inserted": 1, "closed": 1}
    assert apply_release(lake, "dim_routes", release(spark, "v3", D3, [("A", "x", "")]), ROUTES) == {"inserted": 1, "closed": 1}


def test_load_release(spark, lake):
    lake.overwrite("static_feed_info", spark.createDataFrame([("v1", "20260901")], "feed_version string, feed_start_date string"))
    lake.overwrite("static_routes", spark.createDataFrame([("v1", "A", "Alpha")], "feed_version string, route_id string, route_long_name string"))
    lake.overwrite("static_stops", spark.createDataFrame([("v1", "1", "Stop")], "feed_version string, stop_id string, stop_name string"))
    assert load_release(lake, "v1") == {"routes": {"inserted": 1, "closed": 0}, "stops": {"inserted": 1, "closed": 0}}
    with pytest.raises(ValueError):
        load_release(lake, "v2")
    with pytest.raises(ValueError):
        load_release(lake, "v1'; drop")
