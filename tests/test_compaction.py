import json
import random
from collections import Counter
from datetime import date
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from punctual.operators import compaction
from punctual.operators.compaction import Tiers, compact, live_files, log_actions, merge_files, plain_path, plan, small_files, write_small

LOG = "log_version long, logged_at timestamp, table_name string, log_action string, path string, service_date date, route_id string, n_rows long, size_bytes long"
SMALL = Tiers(small=1000, fan=4, target=16_000, least=100)


def log(spark, *rows):
    return spark.createDataFrame([(v, None, "t", a, p, None, None, n, s) for v, a, p, n, s in rows], LOG)


@pytest.mark.parametrize(("given", "plain"), [("file:///a//b", "/a/b"), ("file:/a/b", "/a/b"), ("/a/b", "/a/b"), ("//a///b", "/a/b"), ("a/b", "/a/b")])
def test_one_form_of_a_path(spark, given, plain):
    assert spark.range(1).select(plain_path(F.lit(given))).first()[0] == plain


def test_last_action_decides(spark):
    rows = log(
        spark, (1, "add", "/a/x", 1, 10), (1, "add", "file:/a/x", 1, 10), (2, "add", "/a/y", 2, 70_000), (3, "remove", "file:///a//x", 1, 10), (4, "add", "/a/x", 1, 10),
        (5, "add", "/a/z", 0, 65_535), (6, "remove", "/a/w", 0, 5), (7, "add", None, 0, 5), (8, "add", "/a/v", 0, 65_536),
    )
    assert {r.path for r in live_files(rows).collect()} == {"/a/x", "/a/y", "/a/z", "/a/v"}
    assert {r.path for r in small_files(rows).collect()} == {"/a/x", "/a/z"}
    assert live_files(rows.limit(0)).count() == 0


def test_small_files_come_from_the_planned_first_level(spark):
    rows = log(spark, *[(k, "add", f"/a/{k}", 1, n) for k, n in enumerate([10, 20, 70_000, 65_535, 70_000_000])]).withColumn(
        "table_name", F.when(F.col("path") == "/a/3", "lone").otherwise("t")
    )
    small = {r.path: r for r in small_files(rows).collect()}
    assert set(small) == {"/a/0", "/a/1", "/a/3"}
    assert small["/a/0"].bin == small["/a/1"].bin == 0 and small["/a/3"].bin is None


def files(spark, sizes, scope=lambda k: "s"):
    return spark.createDataFrame([(scope(k), f"/f{k:05}", f"r{k % 7}", 10, s) for k, s in enumerate(sizes)], "scope string, path string, route string, n_rows long, size_bytes long")


def test_plan_is_a_partition_into_few_well_sized_files(spark):
    rnd = random.Random(4)
    sizes = [rnd.choice([0, 10, 200, 900, 3000, 15_000, 20_000]) for _ in range(800)]
    rows = plan(files(spark, sizes, lambda k: f"s{k % 3}"), ["scope"], ["route", "path"], SMALL).collect()
    assert sum(r.n_files for r in rows) == 800 and sum(r.size_bytes for r in rows) == sum(sizes) and sum(r.n_rows for r in rows) == 8000
    assert all((r.n_files > 1) == (r.level > 0) for r in rows) and {r.level for r in rows} >= {0, 1, 2}
    for s in ("s0", "s1", "s2"):
        mine = [r for r in rows if r.scope == s]
        assert sum(r.size_bytes < SMALL.done for r in mine) <= 2  # files without bytes count as some in a merge
        assert all(r.size_bytes <= 1.5 * SMALL.target for r in mine if r.n_files > 1)
    again = plan(files(spark, sizes, lambda k: f"s{k % 3}").orderBy(F.desc("path")), ["scope"], ["route", "path"], SMALL).collect()
    assert set(rows) == set(again)


def test_merges_stay_in_their_tier(spark):
    rows = compaction.in_lots(files(spark, [10] * 30 + [2000] * 30 + [9000] * 3), ["scope"], ["path"])
    level = compaction.plan_level(rows, ["scope"], ["path"], SMALL, 1).collect()
    assert {(r.tier, r.size_bytes) for r in level} == {(0, 10), (1, 2000), (SMALL.levels, 9000)} and all(r.bin is None for r in level if r.size_bytes == 9000)
    bins = Counter((r.tier, r.bin) for r in level if r.bin is not None)
    assert all(n > 1 for n in bins.values()) and max(n for (t, _), n in bins.items() if t == 0) <= SMALL.small * SMALL.fan / SMALL.least + 1


def test_hot_scope_goes_in_lots(spark, monkeypatch):
    monkeypatch.setattr(compaction, "FILES_PER_LOT", 50)
    rows = plan(files(spark, [100] * 500), ["scope"], ["path"], SMALL).collect()
    assert sum(r.n_files for r in rows) == 500 and len(rows) <= 500 * SMALL.least / SMALL.done + 10


def small_table(spark, place, n=60):
    rnd = random.Random(6)
    rows = [(k % 9, rnd.choice(["a", "b", None]), None if k % 5 else float(k)) for k in range(n * 5)]
    spark.createDataFrame(rows, "k int, s string, x double").repartition(n).write.parquet(place)
    return rows


def scanned(spark, place):
    return compaction.list_files(spark.read.parquet(place))


FEW = Tiers(small=2_000, fan=4, target=1 << 16, least=100)


def test_rows_stay_exactly_as_often(spark, tmp_path):
    rows = small_table(spark, f"{tmp_path}/t")
    before = scanned(spark, f"{tmp_path}/t")
    root = f"file://{tmp_path}/out"
    out = compact(spark, root, "t", before, tiers=FEW).collect()
    names = [r.path for r in out]
    assert len(names) < before.count() and sum(r.n_rows for r in out) == len(rows)
    got = Counter(tuple(r) for r in spark.read.parquet(*names).select("k", "s", "x").collect())
    assert got == Counter(rows)
    # Level by level: what one level wrote is an input of the next, and all of it is in the journal.
    done = compaction.committed(root)
    levels = {t["output"].split("/")[-1]: t["level"] for t in done}
    assert set(levels.values()) >= {1, 2}
    for t in done:
        assert all(levels.get(p.split("/")[-1], 0) < t["level"] for p in t["inputs"])
    # Done again, the same transactions are found in the journal and nothing is written twice.
    stamps = {p: p.stat().st_mtime_ns for p in Path(f"{tmp_path}/out").glob("*.parquet")}
    assert sorted(r.path for r in compact(spark, root, "t", before, tiers=FEW).collect()) == sorted(names)
    assert {p: p.stat().st_mtime_ns for p in Path(f"{tmp_path}/out").glob("*.parquet")} == stamps
    assert compaction.recover(root) == []
    assert compaction.vacuum(spark, root) == len(stamps) - len(names)
    assert Counter(tuple(r) for r in spark.read.parquet(*names).select("k", "s", "x").collect()) == Counter(rows)


def test_paths_without_a_scheme_and_an_empty_journal(spark, tmp_path):
    rows = small_table(spark, f"{tmp_path}/t", 8)
    assert compaction.vacuum(spark, f"{tmp_path}/out") == 0
    bare = scanned(spark, f"{tmp_path}/t").withColumn("path", plain_path(F.col("path")))
    out = compact(spark, f"{tmp_path}/out", "t", bare, tiers=FEW).collect()
    assert all(r.path.startswith("file:/") for r in out if r.n_inputs > 1) and sum(r.n_rows for r in out) == len(rows)
    assert all(p.startswith("file:///") for t in compaction.committed(f"{tmp_path}/out") for p in t["inputs"])


def test_broken_off_between_output_and_commit(spark, tmp_path):
    rows = small_table(spark, f"{tmp_path}/t")
    before, root = scanned(spark, f"{tmp_path}/t"), f"file://{tmp_path}/out"
    first = {r.path for r in compact(spark, root, "t", before, tiers=FEW, levels=1).collect()}
    lost = compaction.forget(spark, root, 1)  # all: which of several would hang on the names of the files
    assert lost and len(compaction.recover(root)) == lost
    assert {r.path for r in compact(spark, root, "t", before, tiers=FEW, levels=1).collect()} == first
    names = [r.path for r in compact(spark, root, "t", before, tiers=FEW).collect()]
    assert Counter(tuple(r) for r in spark.read.parquet(*names).select("k", "s", "x").collect()) == Counter(rows)


def test_the_log_swaps_files_in_one_append(spark, lake, tmp_path):
    days = [(d, r, k) for k in range(40) for d in (date(2026, 1, 1), date(2026, 1, 2), None) for r in ("a", None)]
    small = write_small(spark.createDataFrame(days, "service_date date, route_id string, k int"), ["service_date", "route_id", "k"], f"file://{tmp_path}/s")
    lake.append("log", log_actions(small.limit(0), small, "t", 1))
    live = live_files(lake.read("log")).withColumn("path", F.col("uri"))
    assert live.count() == len(days)
    merged = compact(spark, f"file://{tmp_path}/out", "t", live, ["service_date"], ["route_id", "path"], FEW)
    lake.append("log", log_actions(live, merged, "t", 2))
    names = [r.uri for r in live_files(lake.read("log")).collect()]
    assert len(names) < len(days) and not any("/s/" in n for n in names)
    assert Counter(tuple(r) for r in spark.read.parquet(*names).select("service_date", "route_id", "k").collect()) == Counter(days)
    dates = {r.service_date for r in merged.collect()}
    assert dates == {date(2026, 1, 1), date(2026, 1, 2), None}


def test_interrupted_merge_is_done_again(tmp_path):
    for k in range(3):
        pq.write_table(pa.table({"a": [k, k], **({"b": ["x", None]} if k else {})}), tmp_path / f"{k}.parquet")
    inputs = [{"path": f"{tmp_path}/{k}.parquet", "n_rows": 2} for k in range(3)]
    root = f"{tmp_path}/out"
    with pytest.raises(ValueError):  # a file has other rows than the log says
        merge_files(root, "t", [{**inputs[0], "n_rows": 9}, *inputs[1:]])
    Path(root, "running.part").write_text("x")
    assert len(compaction.recover(root)) == 1 and Path(root, "running.part").exists() and compaction.committed(root) == []
    assert len(compaction.recover(root, 0)) == 1 and not list(Path(root).glob("*.part"))
    done = merge_files(root, "t", inputs)
    assert done["n_rows"] == 6 and merge_files(root, "t", inputs) == done
    t = pq.read_table(done["output"]).to_pydict()
    assert t == {"a": [0, 0, 1, 1, 2, 2], "b": [None, None, "x", None, "x", None]}
    # The output was written but the commit wasn't: the rerun puts the same file there.
    commit = next(Path(root, "_journal").glob("*.commit.json"))
    commit.unlink()
    assert merge_files(root, "t", inputs)["output"] == done["output"] and len(list(Path(root).glob("*.parquet"))) == 1
    assert json.loads(commit.read_text())["n_rows"] == 6


def test_missing_input_leaves_old_files_in_force(tmp_path):
    pq.write_table(pa.table({"a": [1]}), tmp_path / "0.parquet")
    with pytest.raises(FileNotFoundError):
        merge_files(f"{tmp_path}/out", "t", [{"path": f"{tmp_path}/0.parquet"}, {"path": f"{tmp_path}/gone.parquet"}])
    assert compaction.committed(f"{tmp_path}/out") == [] and (tmp_path / "0.parquet").exists()


def test_files_without_rows(spark, tmp_path):
    for k in range(4):
        pq.write_table(pa.table({"a": pa.array([], pa.int64())}), tmp_path / f"{k}.parquet")
    done = merge_files(f"{tmp_path}/out", "t", [{"path": f"{tmp_path}/{k}.parquet", "n_rows": 0} for k in range(4)])
    assert done["n_rows"] == 0 and pq.read_table(done["output"]).num_rows == 0
