"""Size-tiered compaction of many small files, with a transaction journal.

Files of one scope (say a table and a service date) and one size tier are merged in runs up to the next tier's size,
level by level: each level's outputs are files of the next. Plans are made from file sizes alone. A merge is a
transaction named by a hash of its inputs: its intent (inputs, output, level) is written before the output, its commit
after; running it again after any failure gives the same file and never a second copy of a row. Readers follow the
log of files: the merged files are added and their inputs removed by one append to it.

Defined results: files without rows are merged like others (their rows are none), an unreadable input fails its
transaction and leaves the old files in force, a scope with one file is left alone, an empty log has no live files.
Merged files keep the columns of all inputs; a column that an input lacks is null.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from punctual.files import filesystem, qualified, write_whole
from punctual.session import cut

KB = 1024
#: Files of a scope are planned in lots of about this many, so no task gets the file list of a hot scope whole.
FILES_PER_LOT = 50_000


@dataclass(frozen=True)
class Tiers:
    """Tier 0 holds files below ``small``, each further tier goes ``fan`` times as far; from half of ``target`` on a
    file is done. Merges are filled so that outputs leave their tier and are at most one and a half times ``target``.
    In a merge a file counts as ``least`` bytes at least, which bounds the inputs of one merge."""

    small: int = 64 * KB
    fan: int = 8
    target: int = 128 * KB * KB
    least: int = 2 * KB

    @property
    def done(self) -> int:
        return self.target // 2

    @property
    def levels(self) -> int:
        """Tiers below ``done``; one more level merges what they have left over."""
        n, size = 1, self.small
        while size < self.done:
            size, n = size * self.fan, n + 1
        return n

    def bound(self, tier: int) -> int:
        """Sizes of the tier are below this."""
        return min(self.done, self.small * self.fan**tier)

    def limit(self, tier: Column) -> Column:
        """Size that a merge in ``tier`` is filled up to."""
        out = F.lit(float(self.target))
        for k in reversed(range(self.levels)):
            out = F.when(tier == k, float(min(self.target, self.bound(k) * self.fan))).otherwise(out)
        return out

    def of(self, size: Column, level: int = 1) -> Column:
        """Tier of a size; for the last level all that isn't done is one tier."""
        if level > self.levels:
            return F.when(size < self.done, self.levels - 1).otherwise(self.levels)
        out = F.lit(self.levels)
        for k in reversed(range(self.levels)):
            out = F.when(size < self.bound(k), k).otherwise(out)
        return out


def plain_path(path: Column) -> Column:
    """Without scheme, runs of ``/`` as one, beginning with one ``/``."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:", "")
    return F.regexp_replace(F.concat(F.lit("/"), bare), "/+", "/")


def absolute(spark: SparkSession, path: Column) -> Column:
    """A path without a scheme on Spark's default file system, where tasks must look for it too."""
    home = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString().rstrip("/")
    home = "file://" if home == "file:" else home
    return F.when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), path).otherwise(F.concat(F.lit(home), path))


def live_files(log: DataFrame) -> DataFrame:
    """(table_name, path, service_date, route_id, n_rows, size_bytes, uri) of the files whose last action is ``add``; ``uri``
    is the path as it was logged.

    Of the same version's actions on a file (logged twice) one counts; a remove counts before an add.
    """
    last = F.max(F.struct("log_version", (F.col("log_action") == "remove").alias("gone"), "service_date", "route_id", "n_rows", "size_bytes", F.col("path").alias("uri")))
    files = log.where("path is not null").groupBy("table_name", plain_path(F.col("path")).alias("path")).agg(last.alias("f"))
    return files.where(~F.col("f.gone")).select(
        "table_name", "path", "f.service_date", "f.route_id", "f.n_rows", "f.size_bytes", "f.uri"
    )


def log_actions(before: DataFrame, after: DataFrame, table: str, version: int) -> DataFrame:
    """The log's rows that put ``after`` in the place of ``before``: new files are added, files no more in force removed.

    Both have uri or path, service_date, route_id, n_rows and size_bytes.
    """
    rest = ["service_date", "route_id", "n_rows", "size_bytes"]
    shaped = lambda df: df.select(F.col("uri" if "uri" in df.columns else "path").alias("path"), *rest)
    old, new = shaped(before), shaped(after)
    steps = [new.join(old.select("path"), "path", "left_anti").withColumn("log_action", F.lit("add"))]
    steps.append(old.join(new.select("path"), "path", "left_anti").withColumn("log_action", F.lit("remove")))
    return steps[0].unionByName(steps[1]).select(
        F.lit(version).cast("long").alias("log_version"), F.current_timestamp().alias("logged_at"), F.lit(table).alias("table_name"), "log_action", "path", *rest
    )


# ---------------------------------------------------------------- plans


def in_lots(files: DataFrame, scope: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Files with ``_lot``: a range of hashes of the first clustering column, so it keeps neighbours together where it can."""
    lots = files.groupBy(*scope).agg(F.ceil(F.count("*") / FILES_PER_LOT).cast("int").alias("_lots"))
    if scope:
        on = [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in scope]
        rows = files.alias("f").join(lots.alias("l"), on, "left").select("f.*", "_lots")
    else:
        rows = files.withColumn("_lots", lots.scalar())
    lot = F.pmod(F.xxhash64(*cluster[:1], F.hash("path") % 64), F.col("_lots"))
    return rows.withColumn("_lot", F.when(F.col("_lots") > 1, lot).otherwise(F.lit(0).cast("long"))).drop("_lots")


def plan_level(files: DataFrame, scope: Sequence[str], cluster: Sequence[str], tiers: Tiers, level: int) -> DataFrame:
    """Files in lots with ``tier`` and ``bin``: files of one scope, lot, tier and bin are merged by this level.

    ``bin`` is null for a file that the level leaves as it is. Neighbours by ``cluster`` are merged, so outputs cover
    narrow ranges of it.
    """
    size = F.greatest(F.col("size_bytes"), F.lit(tiers.least)).cast("double")
    rows = files.withColumn("tier", tiers.of(F.col("size_bytes"), level))
    group = [*scope, "_lot", "tier"]
    before = F.sum(size).over(W.partitionBy(*group).orderBy(*cluster, "path").rowsBetween(W.unboundedPreceding, 0)) - size
    rows = rows.withColumn("bin", F.floor(before / tiers.limit(F.col("tier"))))
    together = F.count("*").over(W.partitionBy(*group, "bin")) > 1
    return rows.withColumn("bin", F.when((F.col("tier") < tiers.levels) & together, F.col("bin")))


def small_files(
    log: DataFrame, tiers: Tiers = Tiers(), scope: Sequence[str] = ("table_name", "service_date"), cluster: Sequence[str] = ("route_id", "path"),
) -> DataFrame:
    """The planned first level of the live files: those of tier 0; ``bin`` is null for one that has no other to merge with."""
    return plan_level(in_lots(live_files(log), scope, cluster), scope, cluster, tiers, 1).where("tier = 0")


def plan(files: DataFrame, scope: Sequence[str], cluster: Sequence[str], tiers: Tiers = Tiers()) -> DataFrame:
    """(scope, cluster, path, n_rows, size_bytes, n_files, level): the files after all levels, if sizes add up.

    ``path`` is the first input's; ``level`` is that of the last merge, 0 for a file that stays as it is.
    """
    near = [c for c in cluster if c != "path"]
    rows = in_lots(files, scope, cluster).withColumns({"n_files": F.lit(1).cast("long"), "level": F.lit(0)})
    for level in range(1, tiers.levels + 2):
        unit = F.when(F.col("bin").isNull(), F.col("path"))
        first = F.min(F.struct(*cluster, *([] if "path" in cluster else ["path"]))).alias("_first")
        rows = plan_level(rows, scope, cluster, tiers, level).groupBy(*scope, "_lot", "tier", "bin", unit.alias("_unit")).agg(
            first, F.sum("n_rows").alias("n_rows"), F.sum("size_bytes").alias("size_bytes"), F.sum("n_files").alias("n_files"),
            F.max(F.when(F.col("bin").isNull(), F.col("level")).otherwise(level)).alias("level"),
        ).select(*scope, "_lot", *[F.col(f"_first.{c}").alias(c) for c in [*near, "path"]], "n_rows", "size_bytes", "n_files", "level")
    return rows.drop("_lot")


# ---------------------------------------------------------------- files


def transaction_id(inputs: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(inputs)).encode()).hexdigest()[:32]


def merge_files(root: str, table: str, inputs: list[dict], level: int = 1, row_group_rows: int = 1 << 20) -> dict:
    """One transaction: reads the inputs in order, writes their rows to one file, commits. Safe to run again.

    ``root`` and the inputs' ``path`` are qualified addresses (or local paths); ``n_rows`` is checked where it is given. Two tasks running it at once write the same rows under the same name.
    """
    fs, base = filesystem(root)
    paths = [i["path"] for i in inputs]
    txn = transaction_id(paths)
    journal, out, address = f"{base}/_journal", f"{base}/{table}-{txn}.parquet", f"{root.rstrip('/')}/{table}-{txn}.parquet"
    commit = f"{journal}/{txn}.commit.json"
    fs.create_dir(journal, recursive=True)
    if fs.get_file_info(commit).type == pafs.FileType.File:
        with fs.open_input_stream(commit) as f:
            return json.loads(f.read())
    about = {"id": txn, "table": table, "level": level, "inputs": paths, "output": address}
    write_whole(fs, f"{journal}/{txn}.intent.json", json.dumps(about).encode())
    footers = [_footer(p) for p in paths]
    schema = pa.unify_schemas([f.schema.to_arrow_schema() for f in footers], promote_options="permissive").remove_metadata()
    part, n = f"{out}.{uuid.uuid4().hex}.part", 0
    with fs.open_output_stream(part) as sink, pq.ParquetWriter(sink, schema, compression="zstd") as writer:
        held, rows = [], 0
        for p, footer in zip(paths, footers):
            source, inner = filesystem(p)
            with source.open_input_file(inner) as f:
                for t in _tables(pq.ParquetFile(f, metadata=footer)):
                    held.append(_shaped(t, schema))
                    rows += t.num_rows
                    if rows >= row_group_rows:
                        writer.write_table(pa.concat_tables(held), row_group_size=row_group_rows)
                        n, held, rows = n + rows, [], 0
        if held:
            writer.write_table(pa.concat_tables(held), row_group_size=row_group_rows)
            n += rows
    expected = [i.get("n_rows") for i in inputs]
    if None not in expected and sum(expected) != n:
        fs.delete_file(part)
        raise ValueError(f"{txn}: inputs should hold {sum(expected)} rows and hold {n}")
    fs.move(part, out)
    done = about | {"n_rows": n, "size_bytes": fs.get_file_info(out).size}
    write_whole(fs, commit, json.dumps(done).encode())
    return done


def _footer(path: str) -> pq.FileMetaData:
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as f:
        return pq.read_metadata(f)


def _tables(file: pq.ParquetFile) -> Iterator[pa.Table]:
    """A file's rows in pieces that fit into memory; a small file in one."""
    if file.metadata.num_rows <= 1 << 16:
        yield file.read(use_threads=False)
    else:
        for batch in file.iter_batches(batch_size=1 << 16):
            yield pa.Table.from_batches([batch])


def _shaped(t: pa.Table, schema: pa.Schema) -> pa.Table:
    """With the columns of ``schema``; those that the file lacks are null."""
    if t.schema.equals(schema):
        return t.replace_schema_metadata()
    columns = [t.column(x.name).cast(x.type) if x.name in t.column_names else pa.nulls(t.num_rows, x.type) for x in schema]
    return pa.table(columns, schema=schema)


def list_files(df: DataFrame) -> DataFrame:
    """(path, n_rows, size_bytes) of a scan's files, from the files' own sizes and one count without columns."""
    return df.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes")).agg(F.count("*").alias("n_rows"))


def _run_merges(root: str, table: str, level: int):
    """Runs the merges that a task gets; gives (path, n_rows, size_bytes, n_inputs) beside the columns that pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [merge_files(root, table, inputs, level) for inputs in batch.column("inputs").to_pylist()]
            passed = [n for n in batch.schema.names if n != "inputs"]
            figures = [("path", "output", pa.string()), ("n_rows", "n_rows", pa.int64()), ("size_bytes", "size_bytes", pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in passed] + [pa.array([d[f] for d in done], k) for _, f, k in figures]
                + [pa.array([len(d["inputs"]) for d in done], pa.int64())],
                [*passed, *[n for n, _, _ in figures], "n_inputs"],
            )

    return run


def compact(
    spark: SparkSession, root: str, table: str, files: DataFrame, scope: Sequence[str] = (), cluster: Sequence[str] = ("path",),
    tiers: Tiers = Tiers(), levels: int | None = None,
) -> DataFrame:
    """Merges ``files`` (path, n_rows, size_bytes, scope, cluster) below ``root`` level by level; returns those in force then.

    The result has (scope, cluster, path, n_rows, size_bytes, level, n_inputs); a merged file has the least clustering
    values of its inputs. No row is shuffled: each merge reads its inputs and writes its output in one task. Inputs stay
    where they are; ``vacuum`` removes those between the levels.
    """
    root = qualified(spark, root)
    near = [c for c in cluster if c != "path"]
    keep = [*scope, "_lot", *near, "path", "n_rows", "size_bytes"]
    now = in_lots(files, list(scope), cluster).select(*keep, F.lit(0).alias("level"), F.lit(1).cast("long").alias("n_inputs"))
    for level in range(1, (levels or tiers.levels + 1) + 1):
        planned = cut(plan_level(now, list(scope), cluster, tiers, level))
        inputs = F.array_sort(F.collect_list(F.struct(*near, absolute(spark, F.col("path")).alias("path"), "n_rows"))).alias("inputs")
        merges = planned.where("bin is not null").groupBy(*scope, "_lot", "tier", "bin").agg(
            inputs, *[F.min(c).alias(c) for c in near], F.sum("size_bytes").alias("_bytes")
        )
        size = merges.agg(F.count("*").alias("n"), F.sum("_bytes").alias("b")).first()
        if not size.n:
            now = planned.drop("tier", "bin")
            continue
        # Small merges share a task, up to about the bytes of one well-sized file; large ones have their own.
        tasks = min(size.n, max(4 * spark.sparkContext.defaultParallelism, -(-size.b // tiers.target)))
        work = merges.select(*scope, "_lot", *near, "inputs").repartition(int(tasks), *scope, "inputs")
        shape = ", ".join(f"`{n}` {k}" for n, k in work.drop("inputs").dtypes) + ", path string, n_rows long, size_bytes long, n_inputs long"
        done = work.mapInArrow(_run_merges(root, table, level), shape).withColumn("level", F.lit(level))
        folder = f"{root}/_journal/level-{level}-{uuid.uuid4().hex}"
        done.write.parquet(folder)
        staying = planned.where("bin is null").select(*keep, "level", "n_inputs")
        now = staying.unionByName(spark.read.parquet(folder).select(*keep, "level", "n_inputs"))
    return now.drop("_lot")


def committed(root: str) -> list[dict]:
    """The journal's committed transactions."""
    fs, base = filesystem(root)
    out = []
    for info in fs.get_file_info(pafs.FileSelector(f"{base}/_journal", allow_not_found=True)):
        if info.path.endswith(".commit.json"):
            with fs.open_input_stream(info.path) as f:
                out.append(json.loads(f.read()))
    return sorted(out, key=lambda t: t["id"])


def recover(root: str, idle_s: float = 3_600) -> list[str]:
    """Ids of transactions with an intent and no commit; running them again is safe.

    Partial files are removed if nothing was written to them for ``idle_s`` seconds, so those of running merges stay.
    """
    fs, base = filesystem(root)
    infos = fs.get_file_info(pafs.FileSelector(f"{base}/_journal", allow_not_found=True))
    names = {os.path.basename(i.path) for i in infos}
    for info in [*infos, *fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))]:
        if info.path.endswith(".part") and (info.mtime_ns or 0) / 1e9 <= time.time() - idle_s:
            fs.delete_file(info.path)
    return sorted(n.split(".")[0] for n in names if n.endswith(".intent.json") and n.replace(".intent.", ".commit.") not in names)


def forget(spark: SparkSession, root: str, one_in: int) -> int:
    """Takes away the commits of one in so many merges, as if their tasks had died before; returns how many. For drills."""
    fs, base = filesystem(qualified(spark, root))
    found = [i.path for i in fs.get_file_info(pafs.FileSelector(f"{base}/_journal", allow_not_found=True)) if i.path.endswith(".commit.json")]
    lost = [p for p in found if int(os.path.basename(p)[:8], 16) % one_in == 0]
    for path in lost:
        fs.delete_file(path)
    return len(lost)


def vacuum(spark: SparkSession, root: str) -> int:
    """Removes files below ``root`` that a committed merge has taken in, once the log names its output; returns how many.

    The journal is read, and files are removed, by tasks.
    """
    root = qualified(spark, root)
    try:
        journal = spark.read.schema("inputs array<string>").json(f"{root}/_journal/*.commit.json")
    except AnalysisException:  # no merge was committed
        return 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        for batch in batches:
            paths = [f"{base}/{os.path.basename(p)}" for p in batch.column(0).to_pylist()]
            there = [i.path for i in fs.get_file_info(paths) if i.type == pafs.FileType.File]
            for path in there:
                fs.delete_file(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(there)], pa.int64())], ["n"])

    taken = journal.select(F.explode("inputs").alias("path")).where(F.col("path").startswith(f"{root}/")).distinct()
    return taken.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_small(rows: DataFrame, keys: Sequence[str], folder: str) -> DataFrame:
    """Writes one file for each combination of ``keys``, named by its hash, as a pipeline without compaction would.

    Returns (path, service_date, route_id, n_rows, size_bytes); lazy, so it is to be written or cut.
    """
    folder = qualified(rows.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        held: list[pa.Table] = []
        done: list[tuple] = []

        def flush() -> None:
            t = pa.concat_tables(held)
            name = f"{t.column('_key')[0].as_py() & (1 << 64) - 1:016x}.parquet"
            sink = pa.BufferOutputStream()
            pq.write_table(t.drop_columns(["_key"]), sink, store_schema=False, write_statistics=False)
            body = sink.getvalue()
            write_whole(fs, f"{base}/{name}", body)
            done.append((f"{folder}/{name}", t.column("service_date")[0].as_py(), t.column("route_id")[0].as_py(), t.num_rows, body.size))
            held.clear()

        for batch in batches:
            t = pa.Table.from_batches([batch])
            key = t.column("_key").to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else []
            for a, b in zip(edges, edges[1:]):
                piece = t.slice(a, b - a)
                if held and held[0].column("_key")[0] != piece.column("_key")[0]:
                    flush()
                held.append(piece)
        if held:
            flush()
        kinds = [("path", pa.string()), ("service_date", pa.date32()), ("route_id", pa.string()), ("n_rows", pa.int64()), ("size_bytes", pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

    named = rows.withColumn("_key", F.xxhash64(*keys))
    together = named.repartition("_key").sortWithinPartitions("_key")
    return together.mapInArrow(write, "path string, service_date date, route_id string, n_rows long, size_bytes long")
