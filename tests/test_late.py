import random
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctual.operators.late import Fold, LateAware, Lateness

HOUR = 3600
T0 = datetime(2026, 3, 1)
SCHEMA = "vid string, at timestamp, loaded timestamp, speed double, _event int, n string"


NEVER_CUT = Lateness(10**9, 10**10)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 99), st.integers(0, 9)), min_size=1, max_size=8), max_size=8))
def test_replay_equals_in_place(batches):
    fold = Fold(10, NEVER_CUT, 10, every=3)
    for b in batches:
        times = np.array([t for t, _ in b])
        assert not fold.apply(times, times * 0, [np.array([v for _, v in b])]).any()
    every = [x for b in batches for x in b]
    want = {p: (sum(t // 10 == p for t, _ in every), 0, sum(v for t, v in every if t // 10 == p)) for p in {t // 10 for t, _ in every}}
    assert {p: tuple(v) for p, v in fold.outputs.items()} == want
    assert np.all(np.diff(fold.times) >= 0)
    for at, period, state in fold.checkpoints:
        assert period == fold.times[at - 1] // 10
        own = slice(int(np.searchsorted(fold.times, period * 10)), at)
        assert state == [x[own].sum() for x in fold.columns]


def test_replay_starts_at_the_checkpoint_before():
    fold, one = Fold(10, NEVER_CUT, 10, every=100), np.ones(1)
    fold.apply(np.arange(1000), np.zeros(1000, np.int64), [np.ones(1000)])
    fold.replayed = 0
    fold.apply(np.array([950]), np.zeros(1, np.int64), [one])
    assert fold.replayed <= 101


def test_what_the_fold_did_with_each_row():
    fold = Fold(10, Lateness(5, 20), 10)  # a period [0, 10) is published at 15 and closed at 30
    at, us = np.array([3]), lambda s: np.array([s * 1_000_000])
    seen = [fold.apply(at, us(s), [np.ones(1)])[0] for s in (4, 15, 16, 30, 31)]
    assert seen == [0, 0, 1, 1, 2] and fold.outputs == {0: [4, 2, 4.0]}


def test_a_period_keeps_its_own_extremes(spark):
    hours = [T0 + timedelta(hours=k) for k in range(4)]
    for big in (1e17, float("inf")):
        rows = [("a", hours[0], hours[0], big), ("a", hours[1], hours[1], 5.0), ("a", hours[2], hours[2], 7.0), ("a", hours[3], hours[3], float("nan"))]
        got = [(r.sum_speed, r.n_speed) for r in aware(rows_of(spark, rows)).periods().orderBy("period_s").collect()]
        assert got == [(big, 1), (5.0, 1), (7.0, 1), (0.0, 0)]
    n = 2**53 + 1
    rows = spark.createDataFrame([("a", T0, T0, n), ("b", T0, T0, n)], "vid string, at timestamp, loaded timestamp, n long")
    a = LateAware(rows, ["vid", "at"], F.unix_seconds("at"), "loaded", HOUR, HOUR, Lateness(1, 2), {"n": F.col("n")})
    assert a.periods().first().sum_n == 2 * n


def aware(df, **more):
    return LateAware(df, ["vid", "at"], F.unix_seconds("at"), "loaded", HOUR, HOUR, Lateness(3 * HOUR, 48 * HOUR), {"speed": F.col("speed")}, **more)


def rows_of(spark, rows):
    return spark.createDataFrame([(v, a, b, s, 1, "x") for v, a, b, s in rows], SCHEMA)


def test_bounds_belong_to_the_better_side(spark):
    at, end = T0, T0 + timedelta(hours=1)
    rows = [("a", at, end + timedelta(hours=3), 1.0), ("b", at, end + timedelta(hours=3, seconds=1), 1.0), ("c", at, end + timedelta(hours=48), 1.0), ("d", at, end + timedelta(hours=48, seconds=1), 1.0)]
    a = aware(rows_of(spark, rows))
    assert {r.vid: r.outcome for r in a.late_rows().collect()} == {"b": "corrects", "c": "corrects", "d": "cut"}
    r = a.periods().first()
    assert (r.n_events, r.n_late, r.sum_speed, r.n_speed) == (3, 2, 3.0, 3)


def test_first_loaded_row_decides(spark):
    rows = [("a", T0, T0 + timedelta(hours=60), 5.0), ("a", T0, T0 + timedelta(hours=1), 1.0), (None, T0, T0 + timedelta(hours=60), 1.0), (None, T0, T0 + timedelta(hours=2), None), ("z", None, T0, 1.0), ("y", T0, None, 1.0)]
    a = aware(rows_of(spark, rows))
    assert a.late_rows().count() == 0
    r = a.periods().first()
    assert (r.n_events, r.sum_speed, r.n_speed) == (2, 1.0, 1)


def test_copy_without_a_time_hides_no_other(spark):
    rows = [("a", T0, None, 9.0), ("a", T0, T0 + timedelta(hours=5), 1.0), ("b", T0, T0 + timedelta(hours=1), 2.0), ("b", T0, None, 9.0)]
    a = aware(rows_of(spark, rows))
    r = a.periods().first()
    assert (r.n_events, r.n_late, r.sum_speed) == (2, 1, 3.0)
    assert [(r.vid, r.outcome) for r in a.late_rows().collect()] == [("a", "corrects")]
    # The event time needn't belong to the identifier.
    b = LateAware(
        spark.createDataFrame([("c", None, T0, 9.0, 1, "x"), ("c", T0, T0 + timedelta(hours=1), 1.0, 1, "x")], SCHEMA),
        ["vid"], F.unix_seconds("at"), "loaded", HOUR, HOUR, Lateness(3 * HOUR, 48 * HOUR), {"speed": F.col("speed")},
    )
    assert [(r.n_events, r.sum_speed) for r in b.periods().collect()] == [(1, 1.0)]


def test_empty(spark):
    a = aware(rows_of(spark, []))
    assert a.periods().count() == 0 and a.late_rows().count() == 0


def test_like_brute_force_with_hot_blocks(spark, monkeypatch):
    monkeypatch.setattr("punctual.operators.late.ROWS_PER_PART", 400)
    rnd = random.Random(2)
    rows = []
    for k in range(3000):
        at = T0 + timedelta(seconds=rnd.randint(0, 5) * 60 if k % 3 == 0 else rnd.randint(0, 3 * 86400))  # a third in one hour
        rows.append((f"v{k % 400}", at, at + timedelta(hours=rnd.choice([0, 0, 1, 5, 30, 49, 70])), float(rnd.randint(0, 9))))
    first = {}
    for r in rows:
        if r[:2] not in first or (r[2], r[3]) < first[r[:2]]:
            first[r[:2]] = (r[2], r[3])
    want, late = {}, {}
    for (v, at), (loaded, speed) in first.items():
        hour = at.replace(minute=0, second=0)
        after = (loaded - hour).total_seconds() - HOUR
        if after > 48 * HOUR:
            late[v, at] = "cut"
            continue
        if after > 3 * HOUR:
            late[v, at] = "corrects"
        n, m, s = want.get(hour, (0, 0, 0.0))
        want[hour] = (n + 1, m + (after > 3 * HOUR), s + speed)
    a = aware(rows_of(spark, rows), every=16)
    got = {datetime.fromtimestamp(r.period_s): (r.n_events, r.n_late, r.sum_speed) for r in a.periods().collect()}
    assert got == want
    assert {(r.vid, datetime.fromtimestamp(r.event_s)): r.outcome for r in a.late_rows().collect()} == late
