"""Period aggregates kept in a table and corrected batch by batch as late events arrive.

The table holds, by block of periods, the events in order, checkpoints of the state, and the state at each period's
end. The state starts anew with each period. A batch restores, in each block it touches, the checkpoint before its
first event, replays the sorted suffix with its own events in place, and replaces what comes after. All of it is one commit, so a batch that
dies halfway changes nothing, and a batch that is run again finds its identifiers known.

Within a block events are dealt into parts by identifier, so a hot block is spread over tasks; the parts' states are
added up when periods are read.

Defined results: as for ``late``: the first-loaded row of an identifier counts (in one batch by load time, between
batches by batch), events later than the cut-off are refused, null values add nothing, null times put a row in no
period. Whole numbers are added up as such.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators.late import CORRECTS, CUT, EVERY, MICRO, ON_TIME, Lateness, summed, totals
from punctual.session import cut

EVENT, MARK, END = "event", "mark", "end"
# Columns of whole numbers and of doubles are apart, so neither is rounded.
HELD = "struct<at: long, whole: array<long>, real: array<double>>"
STATE = f"block long, part int, kind string, state {HELD}, since long"


def running_states(t: pa.Table, width_us: int, every: int, names: list[str]) -> pa.Table:
    """Replays one part of a block: the state at each period's end and at checkpoints.

    ``t`` has the events after the checkpoint (all of them without one), which ``mark`` holds. A checkpoint never stands
    between events of one time.
    """
    t = t.sort_by("at")
    at = t.column("at").to_numpy()
    late = (t.column("outcome").to_numpy() == CORRECTS).astype(np.int64)
    columns = [np.ones(len(at), np.int64), late, *summed(t, names)]
    real = [x.dtype.kind == "f" for x in columns]
    mark = t.column("mark")[0].as_py()
    held = None
    if mark:
        rest = {True: iter(mark["real"]), False: iter(mark["whole"])}
        held = mark["at"] // width_us, [next(rest[r]) for r in real]
    cuts = np.flatnonzero(np.r_[at[1:] != at[:-1], True])[every - 1 :: every] + 1
    _, ends, _, states = totals(at, columns, width_us, cuts, held)
    last = np.flatnonzero(np.r_[at[1:] // width_us != at[:-1] // width_us, True])
    rows = [(END, last, ends), (MARK, cuts - 1, states)]
    pick = lambda s, k, r: [x[k].item() for x, y in zip(s, real) if y == r]
    found = [(kind, {"at": int(at[i]), "whole": pick(s, k, False), "real": pick(s, k, True)}) for kind, where, s in rows for k, i in enumerate(where.tolist())]
    same = lambda name, kind: pa.array([t.column(name)[0].as_py()] * len(found), kind)
    shape = pa.struct([("at", pa.int64()), ("whole", pa.list_(pa.int64())), ("real", pa.list_(pa.float64()))])
    return pa.table({
        "block": same("block", pa.int64()), "part": same("part", pa.int32()), "kind": pa.array([k for k, _ in found], pa.string()),
        "state": pa.array([s for _, s in found], shape), "since": pa.array([mark["at"] if mark else None] * len(found), pa.int64()),
    })


class LateStore:
    """``event`` and ``loaded`` are timestamps, ``width`` and ``block`` seconds, a block being whole periods."""

    def __init__(
        self, lake, table: str, identifier: Sequence[str], event: str, loaded: str, width: int, rule: Lateness, sums: Sequence[str],
        block: int = 21_600, every: int = EVERY, parts: int = 8,
    ) -> None:
        if block % width:
            raise ValueError("a block must be whole periods")
        self.lake, self.table, self.identifier, self.event, self.loaded = lake, table, list(identifier), event, loaded
        self.width, self.rule, self.sums, self.block, self.every, self.parts = width, rule, list(sums), block, every, parts
        self.kinds: dict[str, str] = {}  # of the summed columns, as the last batch had them
        self.keys, self.values = [f"k{n}" for n in range(len(self.identifier))], [f"s{n}" for n in range(len(self.sums))]

    def _narrow(self, batch: DataFrame) -> DataFrame:
        """First-loaded rows by identifier with outcome, block and part; names of the batch don't matter any more."""
        kinds = self.kinds = {s: "long" if isinstance(batch.schema[c].dataType, T.IntegralType) else "double" for c, s in zip(self.sums, self.values)}
        micros = lambda c: F.unix_micros(F.col(f"`{c}`").cast("timestamp"))
        rows = batch.select(
            *[F.col(f"`{c}`").alias(k) for c, k in zip(self.identifier, self.keys)], micros(self.event).alias("at"), micros(self.loaded).alias("loaded"),
            *[F.col(f"`{c}`").cast(kinds[s]).alias(s) for c, s in zip(self.sums, self.values)],
        ).where("at is not null and loaded is not null")
        first = rows.groupBy(*self.keys).agg(F.min(F.struct("loaded", "at", *self.values)).alias("r")).select(*self.keys, "r.*")
        due = (F.floor(F.col("at") / (self.width * MICRO)) + 1) * self.width * MICRO
        late = F.col("loaded") - due
        outcome = F.when(late > self.rule.cutoff * MICRO, CUT).when(late > self.rule.allowed * MICRO, CORRECTS).otherwise(ON_TIME)
        return first.select(
            "*", outcome.cast("int").alias("outcome"), F.floor(F.col("at") / (self.block * MICRO)).alias("block"),
            F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int").alias("part"),
        )

    def _held(self, blocks: list[int]) -> DataFrame | None:
        return self.lake.read(self.table).where(F.col("block").isin(blocks)) if self.lake.exists(self.table) else None

    def apply(self, batch: DataFrame) -> dict[str, int]:
        """Takes in a batch; returns how many rows were new on time, corrections, cut, or known already."""
        rows = self._narrow(batch).persist()
        try:
            total, refused = rows.count(), rows.where(F.col("outcome") == CUT).count()
            fresh = rows.where(F.col("outcome") != CUT)
            # A few blocks for each day of event time in the batch.
            since = self.lake.version(self.table)
            blocks = sorted(r.block for r in fresh.select("block").distinct().toLocalIterator())
            held = self._held(blocks)
            if held is not None and blocks:
                known = held.where(F.col("kind") == EVENT).select(F.col("block").alias("_b"), *[F.col(k).alias(f"_{k}") for k in self.keys])
                fresh = fresh.join(known, [F.col("block") == F.col("_b"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]], "left_anti")
            fresh = cut(fresh)  # what is known is decided before anything is replaced
            counts = {r.outcome: r["count"] for r in fresh.groupBy("outcome").count().collect()}
            if counts:
                self._replay(fresh, since)
            return {
                "on_time": counts.get(ON_TIME, 0), "corrects": counts.get(CORRECTS, 0), "cut": refused,
                "known": total - refused - sum(counts.values()),
            }
        finally:
            rows.unpersist()

    def _replay(self, fresh: DataFrame, since: int) -> None:
        group = ["block", "part"]
        touched = sorted(r.block for r in fresh.select("block").distinct().toLocalIterator())
        held = self._held(touched)
        event = [*group, "at", "outcome", *self.values]
        feed, marks = fresh.select(*event), None
        if held is not None:
            low = fresh.groupBy(*group).agg(F.min("at").alias("low"))
            marks = held.where(F.col("kind") == MARK).join(low, group).where("at < low").groupBy(*group).agg(
                F.max_by("state", "at").alias("mark")
            )
            suffix = held.where(F.col("kind") == EVENT).join(low, group).join(marks, group, "left").where("mark is null or at > mark.at")
            feed = feed.unionByName(suffix.select(*event))
        marked = feed.join(marks, group, "left") if marks is not None else feed.withColumn("mark", F.lit(None).cast(HELD))
        given = self.width * MICRO, self.every, self.values
        done = cut(marked.groupBy(*group).applyInArrow(lambda t: running_states(t, *given), STATE))

        none = lambda name, kind: F.lit(None).cast(kind).alias(name)
        rest = [*self.keys, "loaded", "outcome", *self.values]
        kinds = dict(fresh.dtypes)
        states = done.select("block", "part", "kind", F.col("state.at").alias("at"), "state", *[none(c, kinds[c]) for c in rest])
        events = fresh.select("block", "part", F.lit(EVENT).alias("kind"), "at", none("state", HELD), *rest)
        rows = states.unionByName(events)
        if held is not None:
            replayed = done.groupBy(*group).agg(F.max("since").alias("since"), F.lit(1).alias("hit"))
            stay = held.join(replayed, group, "left").where((F.col("kind") == EVENT) | F.col("hit").isNull() | (F.col("at") <= F.col("since")))
            rows = rows.unionByName(stay.select(rows.columns))
        self.lake.replace_partitions(self.table, rows, "block", touched, since)

    def periods(self) -> DataFrame:
        """(period_s, n_events, n_late, then sum and non-null count of each summed column), all batches in place."""
        if not self.lake.exists(self.table):
            kinds = ", ".join(f"`sum_{c}` {self.kinds.get(s, 'double')}, `n_{c}` long" for c, s in zip(self.sums, self.values))
            return self.lake.spark.createDataFrame([], "period_s long, n_events long, n_late long" + (f", {kinds}" if kinds else ""))
        ends = self.lake.read(self.table).where(F.col("kind") == END).withColumn("period", F.floor(F.col("at") / (self.width * MICRO)))
        latest = ends.groupBy("block", "part", "period").agg(F.max_by("state", "at").alias("state"))
        kinds = dict(ends.dtypes)
        columns = [("n_events", "whole"), ("n_late", "whole")]
        for c, s in zip(self.sums, self.values):
            columns += [(f"sum_{c}", "whole" if kinds[s] == "bigint" else "real"), (f"n_{c}", "whole")]
        seen = {"whole": 0, "real": 0}
        figures = []
        for name, side in columns:
            seen[side] += 1
            figures.append(F.sum(F.element_at(f"state.{side}", seen[side])).alias(name))
        return latest.groupBy((F.col("period") * self.width).alias("period_s")).agg(*figures)
