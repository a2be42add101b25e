import random
from datetime import datetime, timedelta

import pytest

from punctual.operators.late import Lateness
from punctual.operators.late_store import LateStore

HOUR = 3600
T0 = datetime(2026, 3, 1)
SCHEMA = "vid string, at timestamp, loaded timestamp, speed double, block int, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def store(lake, every=4, parts=2):
    return LateStore(lake, "hourly", ["vid", "at"], "at", "loaded", HOUR, Lateness(3 * HOUR, 48 * HOUR), ["speed"], every=every, parts=parts)


def expected(batches):
    seen, want = set(), {}
    for batch in batches:
        first = {}
        for vid, at, loaded, speed in batch:
            if at is None or loaded is None:
                continue
            if (vid, at) not in first or (loaded, -1 if speed is None else speed) < first[vid, at][:2]:
                first[vid, at] = (loaded, -1 if speed is None else speed, speed)
        for (vid, at), (loaded, _, speed) in first.items():
            hour = at.replace(minute=0, second=0)
            after = (loaded - hour).total_seconds() - HOUR
            if after > 48 * HOUR or (vid, at) in seen:
                continue
            seen.add((vid, at))
            n, m, s, k = want.get(hour, (0, 0, 0.0, 0))
            want[hour] = (n + 1, m + (after > 3 * HOUR), s + (speed or 0.0), k + (speed is not None))
    return want


def shown(st):
    return {T0 + timedelta(seconds=r.period_s - T0.timestamp()): (r.n_events, r.n_late, r.sum_speed, r.n_speed) for r in st.periods().collect()}


def test_batches_end_where_all_in_place_would(spark, lake):
    rnd = random.Random(3)
    batches = []
    for b in range(5):
        rows = []
        for _ in range(120):
            at = T0 + timedelta(minutes=rnd.randint(0, 900))
            rows.append((rnd.choice([None, "a", "b", "c", "d"]), rnd.choice([None, at, at, at]), at + timedelta(hours=rnd.choice([0, 1, 6, 40, 60])), rnd.choice([None, float(rnd.randint(0, 9))])))
        batches.append(rows)
    st = store(lake)
    for n, b in enumerate(batches):
        done = st.apply(frame(spark, b))
        assert sum(done.values()) == len({r[:2] for r in b if r[1] is not None})
        assert shown(st) == expected(batches[: n + 1])
    again = st.apply(frame(spark, batches[2]))
    assert again["on_time"] == again["corrects"] == 0 and shown(st) == expected(batches)


def test_a_batch_that_dies_changes_nothing(spark, lake, monkeypatch):
    st = store(lake)
    st.apply(frame(spark, [("a", T0, T0, 1.0)]))
    late = frame(spark, [("b", T0, T0 + timedelta(hours=9), 2.0)])
    with monkeypatch.context() as m:
        m.setattr(lake, "replace_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            st.apply(late)
    assert shown(st) == {T0: (1, 0, 1.0, 1)}
    assert st.apply(late) == {"on_time": 0, "corrects": 1, "cut": 0, "known": 0} and shown(st) == {T0: (2, 1, 3.0, 2)}


def test_only_touched_blocks_are_written(spark, lake):
    st = store(lake)
    st.apply(frame(spark, [("a", T0 + timedelta(hours=12 * k), T0 + timedelta(hours=12 * k), 1.0) for k in range(6)]))
    before = set(lake._pointer("hourly")["folders"])
    st.apply(frame(spark, [("b", T0 + timedelta(hours=24), T0 + timedelta(hours=30), 1.0)]))
    assert len(before - set(lake._pointer("hourly")["folders"])) == 1


def test_a_period_keeps_its_own_extremes(spark, lake):
    n = 2**53 + 1
    st = LateStore(lake, "t", ["vid", "at"], "at", "loaded", HOUR, Lateness(3 * HOUR, 48 * HOUR), ["x", "n"], every=1)
    rows = lambda *r: spark.createDataFrame(r, "vid string, at timestamp, loaded timestamp, x double, n long")
    at = [T0 + timedelta(hours=k) for k in range(3)]
    st.apply(rows(("a", at[0], T0, float("inf"), n), ("a", at[1], T0, 5.0, 1), ("a", at[2], T0, 7.0, None)))
    st.apply(rows(("b", at[0], T0, 1.0, n), ("b", at[1], T0, 1e17, None)))
    got = [(r.sum_x, r.sum_n, r.n_n) for r in st.periods().orderBy("period_s").collect()]
    assert got == [(float("inf"), 2 * n, 2), (1e17 + 5.0, 1, 1), (7.0, 0, 0)]


def test_empty_batch(spark, lake):
    st = store(lake)
    assert sum(st.apply(frame(spark, [])).values()) == 0
    assert st.periods().collect() == [] and st.periods().columns == ["period_s", "n_events", "n_late", "sum_speed", "n_speed"]
    with pytest.raises(ValueError):
        LateStore(lake, "t", ["vid"], "at", "loaded", HOUR, Lateness(1, 2), [], block=5000)
