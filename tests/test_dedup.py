import random
from datetime import datetime, timedelta

import pytest

from punctual.operators import dedup

SCHEMA = "vid string, at timestamp, loaded timestamp, body string, _row int, file string"
KEY, ORDER = ["vid", "at"], ["loaded"]
T0 = datetime(2026, 3, 1)


def write(spark, place, rows, files=5):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(place)
    return place


def random_rows(n=2000):
    rnd = random.Random(3)
    return [
        (rnd.choice([None, "a", "b", *map(str, range(60))]), rnd.choice([None, T0 + timedelta(seconds=rnd.randint(0, 20))]), T0 + timedelta(minutes=rnd.randint(0, 9)), f"body{k}", k, "x")
        for k in range(n)
    ] + [("hot", T0, T0 + timedelta(minutes=k % 7), f"hot{k}", n + k, "x") for k in range(n // 2)]


@pytest.mark.parametrize("limit", [10**6, 1])
def test_one_copy_each_the_first_delivered(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(dedup, "FILES_PER_SHARD", limit)  # 1: a group for each file
    monkeypatch.setattr(dedup, "ROWS_PER_PART", 100 if limit == 1 else 10**6)  # 100: the hot identifier is split
    rows = random_rows()
    place = write(spark, f"{tmp_path}/t", rows)
    got = dedup.exactly_once(spark, place, KEY, ORDER).collect()
    first = {}
    for r in rows:
        first[r[:2]] = min(first.get(r[:2], r[2]), r[2])
    assert len(got) == len(first) and {(r.vid, r.at): r.loaded for r in got} == first
    assert {tuple(r) for r in got} <= set(rows)  # whole rows, as they were
    again = dedup.exactly_once(spark, place, KEY, ORDER).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_vectors_hold_every_other_copy(spark, tmp_path):
    rows = random_rows(300)
    scan = spark.read.parquet(write(spark, f"{tmp_path}/t", rows))
    lost = sum(r.n for r in dedup.deletion_vectors(scan, KEY, ORDER).collect())
    assert lost == len(rows) - len({r[:2] for r in rows})
    many = {r[:2] for r in rows if sum(x[:2] == r[:2] for x in rows) > 1}
    assert {tuple(r) for r in dedup.repeated_identifiers(spark, f"{tmp_path}/t", KEY, ORDER).collect()} == many


def test_bitmaps_of_long_files(spark, tmp_path):
    spark.range(50_000).selectExpr("cast(id % 20000 as string) vid", "timestamp'2026-03-01' at", "timestamp_seconds(id) loaded", "'b' body", "int(id) _row", "'f' file").coalesce(1).write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    found = dedup.deletion_vectors(scan, KEY, ORDER).collect()
    assert {r.block: r.n for r in found} == {1: 12768, 2: 16384, 3: 848} and all(sum(bin(w & (1 << 64) - 1).count("1") for w in r.bits) == r.n for r in found)
    assert sorted(r._row for r in dedup.exactly_once(spark, f"{tmp_path}/t", KEY, ORDER).collect()) == list(range(20_000))


def test_nothing_to_delete_and_empty(spark, tmp_path):
    place = write(spark, f"{tmp_path}/t", [("a", T0, T0, "x", 1, "f"), (None, T0, T0, "x", 2, "f"), ("", T0, T0, "x" * 100_000, 3, "f")])
    assert dedup.exactly_once(spark, place, KEY, ORDER).count() == 3
    place = write(spark, f"{tmp_path}/e", [], 1)
    assert dedup.exactly_once(spark, place, KEY, ORDER).count() == 0


def test_equal_rows_and_one_file(spark, tmp_path):
    place = write(spark, f"{tmp_path}/t", [("a", T0, T0, "x", 1, "f")] * 50, 1)
    assert dedup.exactly_once(spark, place, KEY, ORDER).count() == 1


def test_partitioned_table_keeps_its_columns(spark, tmp_path):
    spark.createDataFrame([("a", T0, T0, "x", 1, "f"), ("a", T0, T0, "y", 2, "g"), ("b", T0, T0, "z", 3, "g")], SCHEMA).write.partitionBy("file").parquet(f"{tmp_path}/t")
    rows = dedup.exactly_once(spark, f"{tmp_path}/t", KEY, ORDER).collect()
    assert sorted(r.vid for r in rows) == ["a", "b"] and {r.file for r in rows} <= {"f", "g"}
