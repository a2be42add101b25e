import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctual.operators.asof import NEVER, as_known, latest_valid

EVENT = "id int, route string, day date, name string"
CHANGE = "route string, a date, b date, seen date, name string, sk long"


def d(n):
    return None if n is None else date(2026, 1, 1) + timedelta(days=n)


def brute(at, versions):
    fits = [(v[0], v[2], k) for k, v in enumerate(versions) if v[0] <= at < v[1] and v[2] <= at]
    return max(fits)[2] if fits else -1


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 12), st.integers(1, 9), st.integers(0, 14), st.booleans()), max_size=7), st.lists(st.integers(-2, 25), max_size=12)
)
def test_search_like_brute_force(rows, times):
    versions = sorted(((a, NEVER if never else a + n, r) for a, n, r, never in rows), key=lambda v: (v[0], v[2]))
    cols = [np.array([v[k] for v in versions], np.int64) for k in range(3)]
    got = latest_valid(np.array(times, np.int64), *cols)
    for t, g in zip(times, got):
        want = brute(t, versions)
        assert (g == want) or (g >= 0 and versions[g] == versions[want])


def run(spark, events, changes, **options):
    ev = spark.createDataFrame([(i, r, d(t), n) for i, r, t, n in events], EVENT)
    ch = spark.createDataFrame([(r, d(a), d(b), d(s), n, k) for r, a, b, s, n, k in changes], CHANGE)
    return as_known(ev, ch, "route", "day", "a", "b", ["name", "sk"], known_as="known", **options)


def test_half_open_periods_and_unknowns(spark):
    changes = [("A", 0, 10, 0, "old", 1), ("A", 10, None, 10, "new", 2), ("B", 5, 6, 5, None, 3), (None, 0, None, 0, "x", 9), ("C", None, None, None, "x", 8)]
    events = [(1, "A", -1, "e"), (2, "A", 0, "e"), (3, "A", 9, "e"), (4, "A", 10, None), (5, "B", 6, "e"), (6, "Z", 1, "e"), (7, None, 1, "e"), (8, "A", None, "e"), (9, "", 1, "e"), (10, "C", 1, "e"), (3, "A", 9, "e")]
    rows = run(spark, events, changes).collect()
    assert len(rows) == len(events)
    assert {r.id: (r.dim_name, r.sk, r.known) for r in rows} == {
        1: (None, None, True), 2: ("old", 1, True), 3: ("old", 1, True), 4: ("new", 2, True), 5: (None, None, True), 6: (None, None, False),
        7: (None, None, False), 8: (None, None, True), 9: (None, None, False), 10: (None, None, True),
    }
    assert rows[0].asDict().keys() == {"id", "route", "day", "name", "dim_name", "sk", "known"}


def test_never_a_version_recorded_later(spark):
    changes = [("A", 0, None, 0, "first", 1), ("A", 5, None, 8, "corrected", 2)]
    rows = run(spark, [(1, "A", 6, None), (2, "A", 8, None)], changes, recorded="seen").collect()
    assert {r.id: r.sk for r in rows} == {1: 1, 2: 2}


def test_empty_tables(spark):
    assert run(spark, [], [("A", 0, None, 0, "x", 1)]).count() == 0
    assert [r.sk for r in run(spark, [(1, "A", 1, None)], []).collect()] == [None]


def test_hot_entity_is_split_and_stays_whole(spark):
    rnd = random.Random(1)
    changes = [("HOT", 10 * k, 10 * k + 8, 0, str(k), k) for k in range(20)] + [("cold", 0, None, 0, "c", 99)]
    events = [(k, "HOT" if k % 3 else "cold", rnd.randint(0, 210), None) for k in range(3000)] + [(5000, "HOT", 3, None)] * 500
    rows = run(spark, events, changes, rows_per_part=300).collect()
    want = {(i, t): (99 if r == "cold" else (t // 10 if t % 10 < 8 and t < 200 else None)) for i, r, t, _ in events}
    assert len(rows) == 3500 and all(r.sk == want[r.id, (r.day - d(0)).days] for r in rows)


def test_clashing_columns_pass_through(spark):
    ev = spark.createDataFrame([("A", d(1), 1, 2, "m")], "route string, day date, _salt int, _at int, sk string")
    ch = spark.createDataFrame([("A", d(0), None, None, None, 5)], CHANGE)
    assert as_known(ev, ch, "route", "day", "a", "b", ["sk"]).first().asDict() == {"route": "A", "day": d(1), "_salt": 1, "_at": 2, "sk": "m", "dim_sk": 5}


def test_timestamps(spark):
    ev = spark.createDataFrame([("A", datetime(2026, 1, 1, 12))], "k string, t timestamp")
    ch = spark.createDataFrame([("A", datetime(2026, 1, 1, 12), datetime(2026, 1, 1, 12, 0, 1), 7)], "k string, a timestamp, b timestamp, v int").withColumn("a", F.col("a").cast("timestamp_ntz"))
    assert as_known(ev, ch, "k", "t", "a", "b", ["v"]).first().v == 7
    with pytest.raises(Exception):
        as_known(ev, ch, "k", "t", "a", "b", ["missing"]).first()
