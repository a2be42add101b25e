"""A table store on plain Parquet with atomic commits.

A table is a set of folders and a numbered log of commits, the last of which lists the folders in force: some for each
partition value of a partitioned table, else one for each append since the last rewrite. A writer fills new folders
and then makes the commit after the one it began from, which fails if another writer was faster. So a reader sees
either the old rows or the new ones, no commit is lost, and a writer that dies leaves the table as it was. Replacing a
range of partition values writes only those partitions; the others' folders stay in force untouched.

Commits and folders are handled through Hadoop's FileSystem, so any storage that Spark can write will do.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from pathlib import Path
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = re.compile(r"[A-Za-z0-9_]+")


STRAY = "row outside the part to be replaced in"
#: Folder names begin with this; as a column it is never part of a table.
VERSION = "_version"
#: Commits whose files are kept.
KEPT_COMMITS = 20
#: Times that an append or insert begins anew after another writer's commit.
ATTEMPTS = 10


class TableMissing(LookupError):
    """The table has no version yet."""


class Conflict(RuntimeError):
    """Another writer committed first; nothing was changed."""


def _partition_value(kind: T.DataType) -> Callable[[str], object]:
    """Reads a partition's value from its folder's name; None for the null partition."""
    read = date.fromisoformat if isinstance(kind, T.DateType) else int if isinstance(kind, T.IntegralType) else unquote
    return lambda text: None if text == "__HIVE_DEFAULT_PARTITION__" else read(text)


class Lake:
    """Named tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ files

    def _path(self, where: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(where)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_text(self, where: str) -> str | None:
        fs, path = self._fs(), self._path(where)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _replace_text(self, where: str, text: str) -> None:
        """Writes a file whole, in place of the one there."""
        self._rename(self._written(where, text), where, True)

    def _written(self, where: str, text: str) -> str:
        part = f"{where}.{uuid.uuid4().hex}.tmp"
        out = self._fs().create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        return part

    def _rename(self, part: str, where: str, over: bool) -> None:
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self.spark._jsc.hadoopConfiguration())
        how = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(how, 1)
        options[0] = how.OVERWRITE if over else how.NONE
        context.rename(self._path(part), self._path(where), options)

    def _create_text(self, where: str, text: str) -> bool:
        """Writes a file whole; False if there is one."""
        part, fs = self._written(where, text), self._fs()
        try:
            if fs.getScheme() == "file":  # a link can't be made twice, whereas a rename looks first and then acts
                files = self.spark._jvm.java.nio.file.Files
                local = lambda x: self._path(self._path(x).toUri().getPath()).toString()
                as_path = lambda x: self.spark._jvm.java.io.File(local(x)).toPath()
                files.createLink(as_path(where), as_path(part))
            else:
                self._rename(part, where, False)
            return True
        except Py4JJavaError:
            if fs.exists(self._path(where)):
                return False
            raise
        finally:
            fs.delete(self._path(part), False)

    def put(self, local: Path, name: str) -> str:
        """Copies a file of this machine below the root, in place of one there; returns its address."""
        where = f"{self.root}/{name}"
        self._fs().copyFromLocalFile(False, True, self._path(Path(local).absolute().as_uri()), self._path(where))
        return where

    def _place(self, table: str) -> str:
        if not _NAME.fullmatch(table):
            raise ValueError(f"not a table name: {table!r}")
        return f"{self.root}/{table}"

    # ------------------------------------------------------------ reading

    def _pointer(self, table: str) -> dict | None:
        """The last commit."""
        fs, log = self._fs(), self._path(f"{self._place(table)}/_log")
        if not fs.exists(log):
            return None
        names = [f.getPath().getName() for f in fs.listStatus(log)]
        last = max((n for n in names if n.endswith(".json")), default=None)
        return json.loads(self._read_text(f"{self._place(table)}/_log/{last}")) if last else None

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def _in_force(self, table: str) -> dict:
        now = self._pointer(table)
        if now is None:
            raise TableMissing(table)
        return now

    def location(self, table: str) -> str:
        """The folder of a table without partitions."""
        (only,) = self._in_force(table)["folders"]
        return f"{self._place(table)}/{only}"

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromJson(self._in_force(table)["schema"])

    def version(self, table: str) -> int:
        """Number of the last commit, 0 for a table that has none."""
        return (self._pointer(table) or {}).get("version", 0)

    def read(self, table: str) -> DataFrame:
        """The rows in force when this is called."""
        now = self._in_force(table)
        schema = T.StructType.fromJson(now["schema"])
        if not now["partition_by"] and len(now["folders"]) == 1:
            return self.spark.read.schema(schema).parquet(self.location(table))
        if not now["folders"]:
            return self.spark.createDataFrame([], schema)
        place = self._place(table)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])).option("basePath", place)
        return rows.parquet(*[f"{place}/{f}" for f in now["folders"]]).select(*[f"`{c}`" for c in schema.fieldNames()])

    def stream(self, table: str) -> DataFrame:
        """New rows of an append-only table as a stream."""
        return self.spark.readStream.schema(self.schema(table)).parquet(self.location(table))

    def view(self, *tables: str) -> None:
        """Temporary views under the tables' names."""
        for t in tables:
            self.read(t).createOrReplaceTempView(t)

    # ------------------------------------------------------------ writing

    def _commit(
        self, table: str, folders: Sequence[str], schema: T.StructType, partition_by: Sequence[str], done: str, before: dict | None, **figures: int
    ) -> None:
        """Makes the commit after ``before``; raises ``Conflict`` if there is one."""
        was = before or {}
        version = was.get("version", 0) + 1
        pointer = {
            "version": version, "folders": list(folders), "partition_by": list(partition_by), "schema": json.loads(schema.json()),
            "retired": [f for f in was.get("folders", []) if f not in folders],
            "history": [*was.get("history", [])[-50:], {"at": time.time(), "operation": done, **figures}],
        }
        place = self._place(table)
        if not self._create_text(f"{place}/_log/{version:012d}.json", json.dumps(pointer)):
            raise Conflict(f"{table}: version {version} is another writer's")
        # Queries that began before the last commit may still read what it retired; what the one before retired goes.
        for f in was.get("retired", []):
            self._fs().delete(self._path(f"{place}/{f}"), True)
        self._fs().delete(self._path(f"{place}/_log/{version - KEPT_COMMITS:012d}.json"), False)

    def _write(self, rows: DataFrame, table: str, partition_by: Sequence[str]) -> list[str]:
        """Writes rows to a new folder, which goes if that fails; returns the folders to put in force."""
        version = f"{VERSION}={uuid.uuid4().hex}"
        where = f"{self._place(table)}/{version}"
        try:
            if not partition_by:
                rows.write.parquet(where)
                return [version]
            # Rows of a partition value come together, so files are few; a value with very many rows is split by AQE.
            rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(where)
        except Exception:
            self._fs().delete(self._path(where), True)
            raise
        found = [version]
        for _ in partition_by:
            found = [f"{f}/{s.getPath().getName()}" for f in found for s in self._fs().listStatus(self._path(f"{self._place(table)}/{f}")) if s.isDirectory()]
        return found

    def overwrite(
        self, table: str, rows: DataFrame, partition_by: Sequence[str] = (), done: str = "overwrite", since: int | None = None, **figures: int
    ) -> None:
        """``rows`` in place of all rows; if they were made from the table, ``since`` is the version that was read."""
        before = self._as_of(table, since)
        self._commit(table, self._write(rows, table, partition_by), rows.schema, partition_by, done, before, **figures)

    def _as_of(self, table: str, since: int | None) -> dict | None:
        before = self._pointer(table)
        if since is not None and (before or {}).get("version", 0) != since:
            raise Conflict(f"{table}: another writer committed after version {since}")
        return before

    def create_like(self, table: str, rows: DataFrame) -> bool:
        """An empty table with the columns of ``rows``; False if the table exists."""
        if self.exists(table):
            return False
        empty = self.spark.createDataFrame([], rows.schema)
        try:
            self._commit(table, self._write(empty, table, ()), rows.schema, (), "create", None)
        except Conflict:
            return False
        return True

    def widen(self, table: str, schema: T.StructType) -> None:
        """Gives the table a schema that has more fields."""
        now = self._in_force(table)
        self._commit(table, now["folders"], schema, now["partition_by"], "widen", now)

    def append(self, table: str, rows: DataFrame, partition_by: Sequence[str] = (), since: int | None = None) -> None:
        """Adds rows; columns new to the table are added to it, missing ones become null.

        Written before it is committed, so another writer's commit in between costs another try, not another write. With
        ``since`` there is none: the rows were chosen from what that version has.
        """
        if not self.exists(table):
            return self.overwrite(table, rows, partition_by, done="append", since=0)
        now = self._in_force(table)
        old = T.StructType.fromJson(now["schema"])
        new = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in old.fieldNames()]
        shaped = rows.select(
            *[
                F.col(f"`{f.name}`").cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in [*old.fields, *new]
            ]
        )
        added = self._write(shaped, table, now["partition_by"])
        for _ in range(ATTEMPTS):
            now = self._as_of(table, since)
            old = T.StructType.fromJson(now["schema"])
            schema = T.StructType([*old.fields, *[f for f in new if f.name not in old.fieldNames()]])
            try:
                return self._commit(table, [*now["folders"], *added], schema, now["partition_by"], "append", now)
            except Conflict:
                if since is not None:
                    raise
        raise Conflict(f"{table}: {ATTEMPTS} commits of others came first")

    def drop(self, table: str) -> None:
        self._fs().delete(self._path(self._place(table)), True)

    def insert_new(self, table: str, rows: DataFrame, key: Sequence[str], time_column: str | None = None) -> int:
        """Appends rows whose key (null equal to null) isn't in the table yet; returns how many.

        Only the table's part from the batch's earliest time on is compared: a file whose statistics end before
        that isn't read. If another writer commits in between, the comparison is made again.
        """
        batch = rows.dropDuplicates(list(key)).persist()
        try:
            earliest = batch.agg(F.min(time_column)).first()[0] if time_column else None
            if time_column and earliest is None:
                return 0
            for attempt in range(ATTEMPTS):
                since, known = self.version(table), self.read(table)
                if time_column:
                    known = known.where(F.col(time_column) >= F.lit(earliest))
                marks = known.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(key)])
                same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(key)]
                fresh = batch.join(marks, same, "left_anti").persist()
                try:
                    n = fresh.count()
                    if n:
                        self.append(table, fresh, since=since)
                    return n
                except Conflict:
                    if attempt + 1 == ATTEMPTS:
                        raise
                finally:
                    fresh.unpersist()
            return 0
        finally:
            batch.unpersist()

    def upsert(self, table: str, rows: DataFrame, key: Sequence[str], partition_by: Sequence[str] = ()) -> None:
        """Rows replace those of the same key (null equal to null) and are added otherwise; a key twice in ``rows`` is an error.

        In a table that is partitioned by one column, only the partitions that ``rows`` have are written; that column must
        belong to the key or follow from it.
        """
        twice = rows.groupBy(*key).count().where("count > 1").limit(1).count()
        if twice:
            raise ValueError(f"{table}: a key of {list(key)} comes more than once")
        now = self._pointer(table)
        if now is None:
            return self.overwrite(table, rows, partition_by, done="upsert", since=0)
        held, parts = self.read(table), now["partition_by"]
        others = rows.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(key)])
        same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(key)]
        if len(parts) != 1:
            kept = held.join(others, same, "left_anti")
            return self.overwrite(table, kept.unionByName(rows, allowMissingColumns=True), parts, done="upsert", since=now["version"])
        # One value a partition, as the commit itself lists.
        values = [r[0] for r in rows.select(*parts).distinct().toLocalIterator()]
        inside = self._among(parts[0], values)
        kept = held.where(inside).join(others, same, "left_anti")
        return self._replace_folders(table, kept.unionByName(rows, allowMissingColumns=True), parts[0], inside, set(values).__contains__, now)

    @staticmethod
    def _among(column: str, values: Sequence) -> Column:
        found = F.col(column).isin([v for v in values if v is not None])
        return F.coalesce(found, F.lit(False)) | F.col(column).isNull() if None in values else F.coalesce(found, F.lit(False))

    def _inside(self, table: str, rows: DataFrame, inside: Column) -> DataFrame:
        """``rows``, of which one that isn't inside fails the write that reads them."""
        stray = F.raise_error(F.lit(f"{STRAY} {table}")).cast("boolean")
        return rows.where(F.when(F.coalesce(inside, F.lit(False)), True).otherwise(stray))

    def replace_where(self, table: str, rows: DataFrame, inside: Column, partition_by: Sequence[str] = ()) -> None:
        """``rows`` take the place of all rows for which ``inside`` holds; rows outside it are refused."""
        since = self.version(table)
        rows = self._inside(table, rows, inside)
        if since:
            rows = self.read(table).where(~F.coalesce(inside, F.lit(False))).unionByName(rows, allowMissingColumns=True)
        with refusing(table):
            self.overwrite(table, rows, partition_by, done="replace", since=since)

    def replace_range(self, table: str, rows: DataFrame, column: str, low, high, partition_by: Sequence[str] = ()) -> None:
        """``rows`` take the place of all rows with ``low <= column <= high``.

        For a table partitioned by ``column`` only the partitions in the range are written; a partition in the range
        that gets no row is gone.
        """
        inside = F.col(column).between(F.lit(low), F.lit(high))
        now = self._pointer(table)
        if not now or now["partition_by"] != [column]:
            return self.replace_where(table, rows, inside, partition_by)
        return self._replace_folders(table, rows, column, inside, lambda v: v is not None and low <= v <= high, now)

    def replace_partitions(self, table: str, rows: DataFrame, column: str, values: Sequence, since: int | None = None) -> None:
        """``rows`` take the place of the partitions with the given values of ``column``; others aren't touched.

        If they were made from the table, ``since`` is the version that was read.
        """
        now = self._as_of(table, since)
        if now is None:
            return self.overwrite(table, rows, [column], done="replace", since=0)
        if now["partition_by"] != [column]:
            raise ValueError(f"{table} isn't partitioned by {column}")
        chosen = set(values)
        return self._replace_folders(table, rows, column, self._among(column, list(chosen)), chosen.__contains__, now)

    def _replace_folders(self, table: str, rows: DataFrame, column: str, inside: Column, replaced: Callable[[object], bool], now: dict) -> None:
        schema = T.StructType.fromJson(now["schema"])
        value = _partition_value(schema[column].dataType)
        stay = [f for f in now["folders"] if not replaced(value(f.rsplit("=", 1)[1]))]
        new = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in schema.fieldNames()]
        with refusing(table):
            written = self._write(self._inside(table, rows, inside), table, [column])
        self._commit(table, [*stay, *written], T.StructType([*schema.fields, *new]), [column], "replace", now)

    # ------------------------------------------------------------ layout

    def cluster(self, table: str, keys: Sequence[str], target_bytes: int = 128 << 20) -> dict:
        """Rewrites the table in ranges of ``keys``, in files of about ``target_bytes``; rows stay as they are."""
        since = self.version(table)
        before, parts = self.detail(table), self._in_force(table)["partition_by"]
        files = max(1, -(-before["size_bytes"] // target_bytes))
        rows = self.read(table).repartitionByRange(int(files), *keys).sortWithinPartitions(*keys)
        self.overwrite(table, rows, parts, done="cluster", since=since)
        return {"before": before, "after": self.detail(table)}

    def detail(self, table: str) -> dict:
        """Files and bytes of the version in force."""
        count = size = 0
        for folder in self._in_force(table)["folders"]:
            files = self._fs().listFiles(self._path(f"{self._place(table)}/{folder}"), True)
            while files.hasNext():
                f = files.next()
                if f.getPath().getName().endswith(".parquet"):
                    count, size = count + 1, size + f.getLen()
        return {"table": table, "num_files": count, "size_bytes": size}

    def history(self, table: str) -> list[dict]:
        """The latest commits, oldest first, with the figures they recorded."""
        return (self._pointer(table) or {}).get("history", [])


@contextmanager
def refusing(table: str) -> Iterator[None]:
    """A stray row's error as a ``ValueError``."""
    try:
        yield
    except Exception as error:
        if f"{STRAY} {table}" in str(error):
            raise ValueError(f"{table}: a row lies outside the part to be replaced") from error
        raise


def each_batch_inserts(lake: Lake, table: str, key: Sequence[str], time_column: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. A batch that is run again adds nothing, as its keys are there already."""

    def insert(batch: DataFrame, _: int) -> None:
        Lake(batch.sparkSession, lake.root).insert_new(table, batch, key, time_column)

    return insert
