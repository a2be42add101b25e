"""Mergeable quantile summaries with tracked rank error.

A summary is a sorted list of values, each with an interval [rmin, rmax] that holds its rank (1-based, ties in any
order) among all n values. Merging adds the intervals of all sides; compressing drops values as long as no two
neighbours are further apart than the permitted uncertainty. The largest ``rmax(i) - rmin(i - 1)`` of a summary is
its accumulated uncertainty, so any rank is answered within half of it, and every answer carries its own bound.

Each stage (task, block of tasks, day, whole) may spend a quarter of the permitted error, and within a stage each
height of the merge tree half of what is left, so every compression has room to drop values: a tree over any number of
parts holds a bounded number of values.

Defined results: null and NaN values are left out, null group keys form a group of their own, groups without a value
give no row; results do not depend on order, partitioning or repeated merging beyond the stated bound, and are exact
(bound 0) while a group has fewer than ``1 / eps`` values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUMMARY_DDL = "n long, v array<double>, rmin array<long>, rmax array<long>"
FLUSH_ROWS = 400_000
FAN = 32  # summaries that are merged at once
PARTS_PER_BLOCK = 256  # tasks whose summaries of a group meet in one task first

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]


def compress(s: Summary, n: int, eps: float) -> Summary:
    """Drops values while neighbours stay within ``2 * eps * n`` ranks; the least and the greatest stay."""
    v, lo, hi = s
    width = int(2 * eps * n)
    if len(v) <= 2 or width < 2:
        return s
    reach = hi - width  # whole numbers, as the ranks are
    keep, j = [len(v) - 1], len(v) - 1
    while j > 0:
        i = int(lo.searchsorted(reach[j]))
        j = min(i, j - 1) if i > 0 else 0
        keep.append(j)
    at = np.array(keep[::-1])
    return v[at], lo[at], hi[at]


def merge(parts: Sequence[tuple[int, Summary]]) -> tuple[int, Summary]:
    """The summary of all parts, by one sort: each value's interval grows by those of its neighbours in every other part.

    A part adds a step function of the value to both ends, so the ends of all parts are running sums of its steps.
    """
    if len(parts) == 1:
        return parts[0]
    v = np.concatenate([s[0] for _, s in parts])
    low = np.concatenate([np.diff(s[1], prepend=0) for _, s in parts])
    high = np.concatenate([np.diff(s[2], append=n + 1) for n, s in parts])
    base = sum(int(s[2][0]) - 1 for _, s in parts)
    order = np.argsort(v, kind="stable")
    high = high[order]
    return sum(n for n, _ in parts), (v[order], np.cumsum(low[order]), base + 1 + np.cumsum(high) - high)


class Tree:
    """Merges summaries, of uncertainty ``start`` at most, one after the other to one of ``eps``."""

    def __init__(self, start: float, eps: float) -> None:
        self.start, self.eps = start, eps
        self.heights: list[list[tuple[int, Summary]]] = []

    def add(self, n: int, s: Summary, height: int = 0) -> None:
        while len(self.heights) <= height:
            self.heights.append([])
        here = self.heights[height]
        here.append((n, s))
        if len(here) == FAN:
            n, s = merge(here)
            here.clear()
            spent = self.start + (self.eps - self.start) * (1 - 0.5 ** (height + 1))
            self.add(n, compress(s, n, spent), height + 1)

    @property
    def held(self) -> int:
        """Values in memory."""
        return sum(len(s[0]) for h in self.heights for _, s in h)

    def result(self) -> tuple[int, Summary]:
        n, s = merge([p for h in self.heights for p in h])
        return n, compress(s, n, self.eps)


def merge_all(parts: Sequence[tuple[int, Summary]], start: float, eps: float) -> tuple[int, Summary]:
    """One summary of uncertainty ``eps`` from parts of ``start``."""
    tree = Tree(start, eps)
    for n, s in parts:
        tree.add(n, s)
    return tree.result()


def uncertainty(s: Summary, n: int) -> int:
    """The largest rank error of any answer."""
    _, lo, hi = s
    gaps = np.r_[hi[0] - 1, hi[1:] - lo[:-1] - 1]
    return int((gaps.max() + 1) // 2)


def query(s: Summary, n: int, q: float) -> tuple[float, int]:
    """(value, bound): the value whose rank is within bound of ``ceil(q * n)`` (at least 1)."""
    v, lo, hi = s
    rank = max(1, int(np.ceil(np.round(q * n, 9))))
    off = np.maximum(np.maximum(rank - lo, hi - rank), 0)
    i = int(np.argmin(off))
    return float(v[i]), int(off[i])


def _lists(parts: list[Summary]) -> list[pa.ListArray]:
    bounds = pa.array(np.r_[0, np.cumsum([len(p[0]) for p in parts])].astype(np.int32), pa.int32())
    kinds = pa.float64(), pa.int64(), pa.int64()
    return [
        pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([p[k] for p in parts]) if parts else [], kinds[k]))
        for k in range(3)
    ]


def _codes(columns: list[pa.Array]) -> np.ndarray:
    """One number per distinct key, null being a key."""
    code = np.zeros(len(columns[0]) if columns else 0, np.int64)
    for c in columns:
        d = pc.dictionary_encode(c, null_encoding="encode")
        d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
        code = code * max(1, len(d.dictionary)) + np.asarray(d.indices)
        code = np.unique(code, return_inverse=True)[1]
    return code


def _summarise(keys: int, eps: float) -> Callable:
    def flush(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        code = _codes([t.column(k) for k in range(keys)]) if keys else np.zeros(t.num_rows, np.int64)
        value = t.column(keys).to_numpy(zero_copy_only=False).astype(float)
        order = np.lexsort((value, code))
        code, value = code[order], value[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        sizes = np.diff(np.r_[first, len(code)])
        parts = []
        for f, n in zip(first.tolist(), sizes.tolist()):
            rank = np.arange(1, n + 1)
            parts.append(compress((value[f : f + n], rank, rank), n, eps))
        names = t.column_names[:keys]
        at = pa.array(order[first])
        return pa.RecordBatch.from_arrays(
            [t.column(k).combine_chunks().take(at) if t.column(k).num_chunks != 1 else t.column(k).chunk(0).take(at) for k in range(keys)]
            + [pa.array(sizes, pa.int64()), *_lists(parts)],
            [*names, "n", "v", "rmin", "rmax"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= FLUSH_ROWS:
                yield flush(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield flush(pa.Table.from_batches(held))

    return run


def _merge_runs(keys: int, start: float, eps: float) -> Callable:
    """Merges neighbouring rows of equal keys; the rows come sorted by key, so only one group's tree is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        types: list[pa.DataType] = []
        group: tuple | None = None
        tree: Tree | None = None
        done: list[tuple[tuple, int, Summary]] = []

        def out() -> pa.RecordBatch:
            rows = list(done)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0][k] for r in rows], types[k]) for k in range(keys)]
                + [pa.array([r[1] for r in rows], pa.int64()), *_lists([r[2] for r in rows])],
                [*names[:keys], "n", "v", "rmin", "rmax"],
            )

        for batch in batches:
            names, types = batch.schema.names, batch.schema.types
            tags = list(zip(*(batch.column(k).to_pylist() for k in range(keys)))) if keys else [()] * batch.num_rows
            sizes = batch.column(keys).to_pylist()
            cols = [batch.column(keys + 1 + k) for k in range(3)]
            bounds = [np.asarray(c.offsets) for c in cols]
            flat = [np.asarray(c.values) for c in cols]
            for r, (tag, n) in enumerate(zip(tags, sizes)):
                if tree is None or tag != group:
                    if tree is not None:
                        done.append((group, *tree.result()))
                    group, tree = tag, Tree(start, eps)
                tree.add(n, tuple(f[b[r] : b[r + 1]] for f, b in zip(flat, bounds)))
            if len(done) >= 2000:
                yield out()
        if tree is not None:
            done.append((group, *tree.result()))
        if done:
            yield out()

    return run


def _ddl(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys] + [SUMMARY_DDL])


def summarise(df: DataFrame, keys: Sequence[str], value: str, eps: float) -> DataFrame:
    """(keys, part, n, v, rmin, rmax) per task and group, within ``eps``; no shuffle."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_value")).where("_value is not null and not isnan(_value)")
    return rows.mapInArrow(_summarise(len(keys), eps), _ddl(df, keys)).withColumn("part", F.spark_partition_id())


def merge_summaries(df: DataFrame, keys: Sequence[str], start: float, eps: float) -> DataFrame:
    """One summary of uncertainty ``eps`` per group of ``keys`` from those of ``start``; only summaries are shuffled."""
    rows = df.select(*keys, "n", "v", "rmin", "rmax")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys) if keys else rows.coalesce(1)
    return rows.mapInArrow(_merge_runs(len(keys), start, eps), _ddl(df, keys))


def daily_summaries(df: DataFrame, keys: Sequence[str], day: str, value: str, eps: float = 0.002) -> DataFrame:
    """(keys, day, n, v, rmin, rmax): a summary per group and day, to be stored, and combined later with ``combine_days``.

    A group's summaries from blocks of tasks are merged first, so no task gets those of all tasks.
    """
    parts = summarise(df, [*keys, day], value, eps / 4).withColumn("block", F.expr(f"part div {PARTS_PER_BLOCK}"))
    blocks = merge_summaries(parts, [*keys, day, "block"], eps / 4, eps / 2)
    return merge_summaries(blocks, [*keys, day], eps / 2, eps * 3 / 4)


def combine_days(daily: DataFrame, keys: Sequence[str], eps: float = 0.002) -> DataFrame:
    """Summaries per group, within ``eps``, from daily ones that were made for the same ``eps``."""
    return merge_summaries(daily, keys, eps * 3 / 4, eps)


def percentiles(summaries: DataFrame, keys: Sequence[str], at: Sequence[float]) -> DataFrame:
    """(keys, n, one column pNN per percentile, rank_error): rank_error bounds the rank error of each of them."""
    names = [f"p{100 * q:g}".replace(".", "_") for q in at]
    schema = T.StructType(
        [summaries.schema[k] for k in keys] + [T.StructField("n", T.LongType())]
        + [T.StructField(x, T.DoubleType()) for x in names] + [T.StructField("rank_error", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, worst = [], []
            lists = [batch.column(c) for c in ("v", "rmin", "rmax")]
            for r, n in enumerate(batch.column("n").to_pylist()):
                s = tuple(np.asarray(x.values)[x.offsets[r].as_py() : x.offsets[r + 1].as_py()] for x in lists)
                answers = [query(s, n, q) for q in at]
                found.append([a for a, _ in answers])
                worst.append(max(b for _, b in answers))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keys] + [batch.column("n")]
                + [pa.array([f[k] for f in found], pa.float64()) for k in range(len(names))] + [pa.array(worst, pa.int64())],
                [*keys, "n", *names, "rank_error"],
            )

    return summaries.select(*keys, "n", "v", "rmin", "rmax").mapInArrow(run, schema)


def group_percentiles(
    df: DataFrame, keys: Sequence[str], day: str, value: str, at: Sequence[float], eps: float = 0.002
) -> DataFrame:
    """Percentiles per group within ``eps * n`` ranks, by way of the daily summaries."""
    return percentiles(combine_days(daily_summaries(df, keys, day, value, eps), keys, eps), keys, at)
