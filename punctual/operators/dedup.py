"""Exactly one copy of each message, without moving the messages.

Only identifier, delivery order and file-row position are shuffled to select winners. The other copies' positions
become deletion vectors, a bitmap per file and block of 16,384 rows, written to the shared folder by groups of files.
Wide rows are then read where they lie: a task loads the vectors of the file that it reads, looks its rows up by their
position alone, and drops those whose bit is set. Nothing is broadcast, and wide rows neither move nor leave the JVM.

Defined results: null equals null in identifiers; of copies delivered at the same time the one first in file order
(hash of the file, then row) stays; an empty table stays empty; columns of any name and type pass through.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.files import filesystem, qualified
from punctual.operators.skew import OWN, SALT, Salts
from punctual.session import cut, shared_path, utc_timestamps

WORDS = 256
BLOCK = 64 * WORDS
#: Files whose vectors are written together; a task reads those of the file it is at.
FILES_PER_SHARD = 16
#: Copies of one identifier that are compared with its winner in one task.
ROWS_PER_PART = 200_000
#: Files whose vectors a Python worker holds at once (2 KB for each block with a deleted row).
HELD_FILES = 4


def _file_id(path) -> Column:
    return F.xxhash64(F.regexp_replace(path, "^([a-z0-9]+):/*", "$1:/"))


def _keys(identifier: Sequence[str]) -> list[str]:
    return [f"k{n}" for n in range(len(identifier))]


def positions(scan: DataFrame, identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(k0, k1, ..., at): identifier, and delivery order with the position of every row; reads no other column."""
    where = scan.metadataColumn("_metadata")
    place = [_file_id(where["file_path"]).alias("file"), where["row_index"].alias("row")]
    when = [F.col(f"`{c}`").alias(f"o{n}") for n, c in enumerate(order)]
    return scan.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(identifier, _keys(identifier))], F.struct(*when, *place).alias("at"))


def repeated(scan: DataFrame, identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(k0, k1, ..., winner, copies) of each identifier found on more than one row.

    The first delivered copy wins. The aggregation is partial in each task, so one identifier on a third of all rows
    costs one row per task.
    """
    counted = positions(scan, identifier, order).groupBy(*_keys(identifier))
    return counted.agg(F.min("at").alias("winner"), F.count("*").alias("copies")).where("copies > 1")


def deletion_vectors(scan: DataFrame, identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(file, block, bits, n): a bitmap, in 64-bit words, of the rows in the block that aren't the winner's, and their number."""
    keys = _keys(identifier)
    many = cut(repeated(scan, identifier, order))
    salts = Salts(many, keys, ROWS_PER_PART, counted="copies")
    rows = salts.spread(positions(scan, identifier, []), ["at"]).alias("a")  # who isn't the winner, its place alone tells
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    winners = salts.copies(many).alias("b")
    met = rows.join(winners, [*on, F.col(f"a.{SALT}") == F.col(f"b.{SALT}")])
    lost = met.where("a.at.file <> b.winner.file or a.at.row <> b.winner.row").select(F.col("a.at.file").alias("file"), F.col("a.at.row").alias("row"))
    words = lost.groupBy("file", F.expr(f"row div {BLOCK}").alias("block"), F.expr(f"int(row % {BLOCK} div 64)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(row % 64)))").alias("bits")
    )
    blocks = words.groupBy("file", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"), F.sum(F.bit_count("bits")).alias("n")
    )
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.element_at("words", w), F.lit(0).cast("long")))
    return blocks.select("file", "block", dense.alias("bits"), "n")


def write_vectors(scan: DataFrame, identifier: Sequence[str], order: Sequence[str]) -> tuple[str, int]:
    """Writes the deletion vectors by groups of files; returns their folder and the number of groups."""
    spark = scan.sparkSession
    folder = qualified(spark, shared_path(spark, "deleted"))
    shards = max(1, -(-len(scan.inputFiles()) // FILES_PER_SHARD))
    vectors = deletion_vectors(scan, identifier, order).withColumn("shard", F.pmod(F.col("file"), F.lit(shards)))
    vectors.repartition("shard").sortWithinPartitions("shard", "file", "block").write.partitionBy("shard").parquet(folder)
    return folder, shards


def _lookup(folder: str, shards: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Tells of (file, row) pairs whether the row is deleted; holds the vectors of the last few files."""
    held: OrderedDict[int, dict[int, np.ndarray]] = OrderedDict()

    def vectors(file: int) -> dict[int, np.ndarray]:
        if file not in held:
            fs, base = filesystem(f"{folder}/shard={file % shards}")
            found = {}
            if fs.get_file_info(base).type == pafs.FileType.Directory:  # a group without deleted rows has none
                t = ds.dataset(base, filesystem=fs, format="parquet").to_table(columns=["block", "bits"], filter=ds.field("file") == file)
                for block, bits in zip(t.column("block").to_pylist(), t.column("bits")):
                    found[block] = np.asarray(bits.values, dtype="<i8").view(np.uint8)
            held[file] = found
            while len(held) > HELD_FILES:
                held.popitem(last=False)
        held.move_to_end(file)
        return held[file]

    def deleted(files: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), bool)
        if not len(rows):
            return out
        blocks = rows // BLOCK
        edges = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])])
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(rows)]):
            bits = vectors(int(files[a])).get(int(blocks[a]))
            if bits is not None:
                at = rows[a:b] % BLOCK
                out[a:b] = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return out

    return deleted


def marked(rows: DataFrame, folder: str, shards: int) -> tuple[DataFrame, Column]:
    """``rows``, a scan, with the positions of its rows, and the condition that a row's bit is set.

    Only the two numbers of the position go to Python, in Arrow batches; the row waits in the JVM.
    """
    where = rows.metadataColumn("_metadata")
    placed = rows.select("*", _file_id(where["file_path"]).alias(f"{OWN}file"), where["row_index"].alias(f"{OWN}row"))
    lookup: list = []

    @F.pandas_udf("boolean")
    def deleted(file: pd.Series, row: pd.Series) -> pd.Series:
        if not lookup:
            lookup.append(_lookup(folder, shards))
        return pd.Series(lookup[0](file.to_numpy(), row.to_numpy()))

    return placed, deleted(f"{OWN}file", f"{OWN}row")


def _scan(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def exactly_once(spark: SparkSession, paths: str | Sequence[str], identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table at ``paths`` with one row of each identifier."""
    scan = _scan(spark, paths)
    rows, gone = marked(scan, *write_vectors(scan, identifier, order))
    return utc_timestamps(rows.where(~gone).select(*[f"`{c}`" for c in scan.columns]))


def repeated_identifiers(spark: SparkSession, paths: str | Sequence[str], identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The identifiers of the copies that the deletion vectors drop, each once: those on more than one row."""
    scan = _scan(spark, paths)
    rows, gone = marked(scan.select(*[f"`{c}`" for c in identifier]), *write_vectors(scan, identifier, order))
    return utc_timestamps(rows.where(gone).select(*[f"`{c}`" for c in identifier])).distinct()
