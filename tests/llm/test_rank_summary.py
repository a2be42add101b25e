import random
from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from punctual.llm.rank_summary import (
    FAN, Tree, combine_days, compress, daily_summaries, group_percentiles, merge, merge_all, percentiles, query, uncertainty,
)


def exact(values):
    v = np.sort(np.array(values, float))
    r = np.arange(1, len(v) + 1)
    return v, r, r.copy()


def true_error(values, x, q):
    """Least distance of a rank of ``x`` from the asked rank."""
    v = np.sort(values)
    rank = max(1, int(np.ceil(round(q * len(v), 9))))
    lo, hi = np.searchsorted(v, x, "left") + 1, np.searchsorted(v, x, "right")
    return max(0, lo - rank, rank - hi)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=80), min_size=1, max_size=6), st.sampled_from([0.01, 0.05, 0.1]))
def test_answers_keep_their_own_bound(parts, eps):
    merged = [(len(p), compress(exact(p), len(p), eps / 4)) for p in parts]
    n, s = merge_all(merged, eps / 4, eps)
    every = [x for p in parts for x in p]
    assert n == len(every) and np.all(np.diff(s[0]) >= 0)
    v = np.sort(every)
    for x, lo, hi in zip(*s):  # the interval holds a rank of its value
        assert lo <= np.searchsorted(v, x, "right") and hi >= np.searchsorted(v, x, "left") + 1
    worst = uncertainty(s, n)
    for q in (0.0, 0.01, 0.25, 0.5, 0.9, 1.0):
        x, bound = query(s, n, q)
        assert true_error(every, x, q) <= bound <= worst
    assert worst <= max(1, eps * n + 1)


def test_merging_exact_summaries_is_exact():
    a, b = exact([1, 1, 2, 5]), exact([1, 3, 3])
    n, s = merge([(4, a), (3, b)])
    assert n == 7
    assert s[0].tolist() == [1, 1, 1, 2, 3, 3, 5] and s[1].tolist() == s[2].tolist() == [1, 2, 3, 4, 5, 6, 7]
    assert uncertainty(s, 7) == 0


def test_compression_is_bounded():
    rnd = np.random.default_rng(0)
    v = exact(rnd.normal(size=100_000))
    s = compress(v, 100_000, 0.001)
    assert len(s[0]) <= 1 / 0.001 and s[0][0] == v[0][0] and s[0][-1] == v[0][-1] and uncertainty(s, 100_000) <= 101


def test_a_tree_over_thousands_of_parts_holds_few_values():
    rnd, eps, every = np.random.default_rng(1), 0.002, []
    tree, most = Tree(eps / 4, eps / 2), 0
    for _ in range(4096):
        part = np.round(rnd.normal(size=1001), 3)
        every.append(part)
        tree.add(1001, compress(exact(part), 1001, eps / 4))
        most = max(most, tree.held)
    n, s = tree.result()
    every = np.concatenate(every)
    # After a merge at height h a summary has 2**h / (eps / 4) values at most, and a few.
    assert n == len(every) and most <= FAN * 1001 + FAN * 4 / eps * 7 and len(s[0]) <= 8 / eps
    assert uncertainty(s, n) <= eps / 2 * n + 1
    for q in (0.001, 0.25, 0.5, 0.999):
        x, bound = query(s, n, q)
        assert true_error(every, x, q) <= bound <= eps / 2 * n + 1


SCHEMA = "route string, hour int, day date, x int, n string"


def rows_of(spark, rows):
    return spark.createDataFrame([(r, h, d, x, "n") for r, h, d, x in rows], SCHEMA)


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(11)
    out = []
    for k in range(30_000):
        hot = k % 3 == 0
        out.append(("hot" if hot else rnd.choice([None, "a", "b", ""]), 8 if hot else rnd.choice([None, 7, 8]), date(2026, 3, 1 + rnd.randint(0, 4)), None if k % 17 == 0 else int(rnd.gauss(0, 300)) if k % 5 else 0))
    return out


def test_percentiles_within_bound(spark, data):
    at = (0.05, 0.5, 0.9, 0.99)
    df = rows_of(spark, data).repartition(12)
    got = group_percentiles(df, ["route", "hour"], "day", "x", at).collect()
    groups = {}
    for r, h, _, x in data:
        if x is not None:
            groups.setdefault((r, h), []).append(x)
    assert {(r.route, r.hour): r.n for r in got} == {g: len(v) for g, v in groups.items()}
    for r in got:
        v = groups[r.route, r.hour]
        assert r.rank_error <= 0.002 * len(v) + 1
        for q, x in zip(at, (r.p5, r.p50, r.p90, r.p99)):
            assert true_error(v, x, q) <= r.rank_error


def test_days_combine_to_the_whole(spark, data):
    df = rows_of(spark, data)
    daily = daily_summaries(df, ["route", "hour"], "day", "x", 0.01)
    days = percentiles(daily, ["route", "hour", "day"], [0.5]).collect()
    whole = percentiles(combine_days(daily, ["route", "hour"], 0.01), ["route", "hour"], [0.5]).collect()
    for w in whole:
        assert w.n == sum(x.n for x in days if (x.route, x.hour) == (w.route, w.hour))


def test_deterministic(spark, data):
    df = rows_of(spark, data)
    once = lambda k: sorted(map(tuple, group_percentiles(df.coalesce(4), ["route"], "day", "x", [0.5]).collect()), key=repr)
    assert once(0) == once(1)


def test_empty_null_and_extra_columns(spark):
    df = rows_of(spark, [("a", 1, date(2026, 3, 1), None)])
    assert group_percentiles(df, ["route"], "day", "x", [0.5]).count() == 0
    assert group_percentiles(df.limit(0), ["route"], "day", "x", [0.5]).count() == 0
    one = rows_of(spark, [(None, None, None, 5), (None, None, None, 5)])
    assert [tuple(r) for r in group_percentiles(one, ["route", "hour"], "day", "x", [0.0, 0.5, 1.0]).collect()] == [(None, None, 2, 5.0, 5.0, 5.0, 0)]
    nan = spark.createDataFrame([("a", float("nan")), ("a", 1.0)], "g string, x double").selectExpr("*", "date(null) as day")
    assert group_percentiles(nan, ["g"], "day", "x", [0.5]).first().p50 == 1.0
