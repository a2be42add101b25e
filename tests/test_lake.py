import pytest
from pyspark.sql import functions as F

from punctual.sources.lake import Conflict, TableMissing


def rows(spark, *given, schema="k string, n int"):
    return spark.createDataFrame(list(given), schema)


def got(lake, table="t"):
    return sorted(map(tuple, lake.read(table).collect()), key=repr)


def test_versions(spark, lake):
    assert not lake.exists("t")
    with pytest.raises(TableMissing):
        lake.read("t")
    lake.overwrite("t", rows(spark, ("a", 1)))
    before = lake.read("t")
    lake.overwrite("t", before.unionByName(rows(spark, ("b", 2))))  # reads what it replaces
    assert got(lake) == [("a", 1), ("b", 2)]
    assert [h["operation"] for h in lake.history("t")] == ["overwrite", "overwrite"]
    lake.drop("t")
    assert not lake.exists("t")
    with pytest.raises(ValueError):
        lake.read("../t")


def test_append_adds_columns(spark, lake):
    lake.append("t", rows(spark, ("a", 1)))
    lake.append("t", rows(spark, ("b", 2, 0.5), schema="k string, n int, x double"))
    lake.append("t", rows(spark, ("c",), schema="k string"))
    assert got(lake) == [("a", 1, None), ("b", 2, 0.5), ("c", None, None)]


def test_insert_new_is_null_safe_and_idempotent(spark, lake):
    lake.create_like("t", rows(spark, ("a", 1)))
    batch = rows(spark, ("a", 1), ("a", 1), (None, 2))
    assert lake.insert_new("t", batch, ["k"], "n") == 2
    assert lake.insert_new("t", batch, ["k"], "n") == 0
    assert lake.insert_new("t", rows(spark).limit(0), ["k"], "n") == 0
    assert got(lake) == [("a", 1), (None, 2)]


def test_upsert(spark, lake):
    lake.upsert("t", rows(spark, ("a", 1), ("b", 2)), ["k"])
    lake.upsert("t", rows(spark, ("b", 3), ("c", 4)), ["k"])
    assert got(lake) == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(ValueError):
        lake.upsert("t", rows(spark, ("z", 1), ("z", 2)), ["k"])


def test_upsert_is_null_safe_and_writes_its_partitions_alone(spark, lake):
    lake.upsert("t", rows(spark, (None, 1), ("b", 2)), ["k"])
    lake.upsert("t", rows(spark, (None, 5)), ["k"])
    assert got(lake) == [("b", 2), (None, 5)]
    lake.upsert("p", rows(spark, ("a", 1), ("b", 2), ("c", None)), ["k"], ["n"])
    before = set(lake._pointer("p")["folders"])
    lake.upsert("p", rows(spark, ("a2", 1), ("c", None), ("d", 4)), ["k"])
    assert got(lake, "p") == [("a", 1), ("a2", 1), ("b", 2), ("c", None), ("d", 4)]
    assert len(before & set(lake._pointer("p")["folders"])) == 1


def test_no_commit_is_lost(spark, lake):
    lake.overwrite("t", rows(spark, ("a", 1)))
    since, stale = lake.version("t"), lake._pointer("t")
    lake.append("t", rows(spark, ("b", 2)))
    with pytest.raises(Conflict):  # made from what the append has changed
        lake.overwrite("t", rows(spark, ("z", 9)), since=since)
    with pytest.raises(Conflict):  # two writers began from one version
        lake._commit("t", stale["folders"], lake.schema("t"), (), "overwrite", stale)
    assert got(lake) == [("a", 1), ("b", 2)]


def test_append_and_insert_begin_anew_after_another_commit(spark, lake, monkeypatch):
    lake.create_like("t", rows(spark))
    write, other = lake._write, []

    def slow(*args):
        done = write(*args)
        if not other:
            other.append(1)
            lake.append("t", rows(spark, ("a", 1)))
        return done

    monkeypatch.setattr(lake, "_write", slow)
    lake.append("t", rows(spark, ("b", 2)))
    other.clear()
    assert lake.insert_new("t", rows(spark, ("a", 1), ("c", 3)), ["k"]) == 1
    assert sorted(x for x, _ in got(lake)) == ["a", "a", "b", "c"]


def test_failed_append_leaves_the_table(spark, lake):
    lake.append("t", rows(spark, ("a", 1)))
    files = lake.detail("t")["num_files"]
    with pytest.raises(Exception):
        lake.append("t", rows(spark, ("b", 1)).withColumn("n", F.raise_error(F.lit("broken")).cast("int")))
    assert got(lake) == [("a", 1)] and lake.detail("t")["num_files"] == files
    many = [lake.append("t", rows(spark, ("c", n))) for n in range(25)]
    assert len(many) == 25 and lake.read("t").count() == 26 and lake.version("t") == 26
    lake.cluster("t", ["n"])
    assert lake.detail("t")["num_files"] == 1 and lake.read("t").count() == 26


def test_replace_range_deletes_what_is_no_more(spark, lake):
    lake.overwrite("t", rows(spark, ("a", 1), ("b", 2), ("c", 3), ("d", None)))
    lake.replace_range("t", rows(spark, ("B", 2)), "n", 2, 3)
    assert got(lake) == [("B", 2), ("a", 1), ("d", None)]
    lake.replace_range("t", rows(spark).limit(0), "n", 2, 3)
    assert got(lake) == [("a", 1), ("d", None)]
    with pytest.raises(ValueError):
        lake.replace_range("t", rows(spark, ("x", 9)), "n", 2, 3)
    assert got(lake) == [("a", 1), ("d", None)]


def test_cluster_keeps_rows(spark, lake):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("int").alias("n"))
    lake.overwrite("t", df.repartition(20))
    sizes = lake.cluster("t", ["n", "k"])
    assert sizes["before"]["num_files"] == 20 and sizes["after"]["num_files"] == 1
    assert lake.read("t").count() == 1000 and lake.read("t").exceptAll(df).isEmpty()


def test_failed_write_leaves_the_table(spark, lake):
    lake.overwrite("t", rows(spark, ("a", 1)))
    with pytest.raises(Exception):
        lake.overwrite("t", lake.read("t").withColumn("n", F.raise_error(F.lit("broken")).cast("int")))
    assert got(lake) == [("a", 1)]


def test_partitions_out_of_range_stay_untouched(spark, lake):
    from datetime import date

    day = lambda n: date(2026, 10, n)
    make = lambda *given: spark.createDataFrame(list(given), "k string, day date")
    lake.overwrite("t", make(("a", day(1)), ("b", day(2)), ("c", day(3)), ("d", None)), ["day"])
    before = set(lake._pointer("t")["folders"])
    lake.replace_range("t", make(("B", day(2)), ("B2", day(2))), "day", day(2), day(3), ["day"])
    assert got(lake) == sorted([("B", day(2)), ("B2", day(2)), ("a", day(1)), ("d", None)], key=repr)  # day 3 has no row any more
    assert len(before & set(lake._pointer("t")["folders"])) == 2
    with pytest.raises(ValueError):
        lake.replace_range("t", make(("x", day(9))), "day", day(2), day(3), ["day"])
    lake.append("t", make(("e", day(1))))
    lake.replace_range("t", make(("z", day(1))).limit(0), "day", day(1), day(31), ["day"])
    assert got(lake) == [("d", None)]
    lake.replace_range("t", make(("n", day(5))), "day", day(5), day(5), ["day"])
    assert got(lake) == sorted([("d", None), ("n", day(5))], key=repr) and lake.read("t").columns == ["k", "day"]
    assert lake.detail("t")["num_files"] == 2
