import random
from datetime import date, datetime, timedelta

from punctual.operators.history import Tracked, attr_hash, full_history

SPEC = Tracked("k", ("x", "y"), "sk")
OLD = "k string, x string, y string, attr_hash string, feed_version string, valid_from date, sk long, valid_to date, is_current boolean"
NEW = "feed_version string, k string, x string, y string, _source_file string, _loaded_at timestamp"
INFO = "feed_version string, feed_start_date string, feed_publisher_name string, _loaded_at timestamp"


def d(n):
    return date(2026, 1, 1) + timedelta(days=n)


def t(n):
    return datetime(2026, 1, 1) + timedelta(hours=n)


def frames(spark, old, new, info):
    o = spark.createDataFrame([(k, x, y, None, v, d(a), s, None if b is None else d(b), b is None) for k, x, y, v, a, b, s in old], OLD)
    n = spark.createDataFrame([(v, k, x, y, "f", t(h)) for v, k, x, y, h in new], NEW)
    i = spark.createDataFrame([(v, s if isinstance(s, str) or s is None else d(s).strftime("%Y%m%d"), "p", t(h)) for v, s, h in info], INFO)
    return full_history(o, n, i, SPEC)


def shown(df):
    n = lambda x: None if x is None else (x - d(0)).days
    return sorted(((r.k, r.x, r.y, n(r.valid_from), n(r.valid_to)) for r in df.collect()), key=repr)


def test_changes_absence_and_return(spark):
    old = [("A", "a", None, "v1", 0, 10, 1), ("A", "a2", None, "v2", 10, None, 2), ("B", "b", None, "v1", 0, None, 3)]
    new = [("v3", "A", "a2", "", 30), ("v3", "A", "a2", "", 30), ("v4", "A", "a2", "", 40), ("v4", "B", "b", None, 40), ("v4", "C", "c", "c", 40), ("v4", None, "c", "c", 40)]
    info = [("v1", 0, 0), ("v2", 10, 9), ("v3", 20, 30), ("v4", 30, 40)]
    rows = frames(spark, old, new, info)
    assert shown(rows) == sorted([
        ("A", "a", None, 0, 10), ("A", "a2", None, 10, 20), ("A", "a2", "", 20, None),  # null and empty differ
        ("B", "b", None, 0, 20), ("B", "b", None, 30, None),  # away on day 20, back on day 30
        ("C", "c", "c", 30, None),
    ], key=repr)
    by = {(r.k, (r.valid_from - d(0)).days): r for r in rows.collect()}
    assert by["A", 0].sk == 1 and by["A", 10].sk == 2 and by["A", 20].is_current and not by["B", 0].is_current
    assert by["C", 30].attr_hash == spark.createDataFrame([("c", "c")], "x string, y string").select(attr_hash(SPEC.columns)).first()[0]


def test_reload_of_an_applied_release_and_rivals(spark):
    old = [("A", "a", None, "v1", 0, 10, 1), ("A", "wrong", None, "v2", 10, None, 2), ("B", "b", None, "v1", 0, 10, 3)]
    # v2 is loaded again without the error; of v3 and v3b, both from day 20, v3b came last; v3's first load is void.
    new = [("v2", "A", "a", None, 50), ("v2", "B", "b", None, 50), ("v3", "A", "no", None, 60), ("v3", "Q", "no", None, 55), ("v3b", "A", "yes", None, 70)]
    info = [("v1", 0, 0), ("v2", 10, 9), ("v2", 10, 50), ("v3", 20, 55), ("v3", 20, 60), ("v3b", 20, 70), ("odd", "soon", 80), ("late", None, 81)]
    assert shown(frames(spark, old, new, info)) == sorted([("A", "a", None, 0, 20), ("A", "yes", None, 20, None), ("B", "b", None, 0, 20)], key=repr)


def test_empty_inputs(spark):
    old = [("A", "a", None, "v1", 0, None, 1)]
    assert shown(frames(spark, old, [], [("v1", 0, 0)])) == [("A", "a", None, 0, None)]
    assert shown(frames(spark, old, [], [])) == [("A", "a", None, 0, None)]
    assert shown(frames(spark, [], [("v1", "A", "a", "b", 1)], [("v1", 0, 1)])) == [("A", "a", "b", 0, None)]
    assert shown(frames(spark, [], [], [])) == []


def test_like_brute_force(spark):
    rnd = random.Random(7)
    for _ in range(3):
        releases = [(f"v{n}", 10 * n) for n in range(8)]
        state = {v: {k: (rnd.choice("xy"), rnd.choice([None, ""])) for k in "ABCDE" if rnd.random() < 0.7} for v, _ in releases}
        want = []
        for k in "ABCDE":
            run = None
            for v, s in releases:
                now = state[v].get(k)
                if run and now != run[1]:
                    want.append((k, *run[1], run[0], s))
                    run = None
                if now and not run:
                    run = (s, now)
            if run:
                want.append((k, *run[1], run[0], None))
        new = [(v, k, *a, 100) for v, _ in releases for k, a in state[v].items()] + [("v3", "A", "old", "old", 50)]
        rnd.shuffle(new)
        assert shown(frames(spark, [], new, [(v, s, 1) for v, s in releases])) == sorted(want, key=repr)


def test_many_releases_and_many_more_versions(spark):
    new = [(f"v{n}", "A", f"a{n // 3}", None, n) for n in range(12_000)]
    info = [(f"v{n}", n, n) for n in range(12_000)]
    rows = shown(frames(spark, [], new, info))
    assert len(rows) == 4000 and ("A", "a3999", None, 11_997, None) in rows and ("A", "a0", None, 0, 3) in rows
    # All from one day: the last loaded is in force.
    new = [(f"v{n}", "A", f"a{n}", None, n) for n in range(60)]
    for last in (7, 31, 59):
        info = [(f"v{n}", 0, 99 if n == last else n) for n in range(60)]
        assert shown(frames(spark, [], new, info)) == [("A", f"a{last}", None, 0, None)]
