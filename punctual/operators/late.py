"""Aggregates per event-time period that late events correct, up to a cut-off.

Events are folded in event order per block of periods, in the order of their loads. The state starts anew with each
period; at intervals it is kept as a checkpoint. A batch of loads restores the checkpoint before its first event,
replays the sorted suffix with its own events in place, and replaces the outputs of the periods it touches. An event
whose period had been published when it arrived corrects it; one that arrives after the cut-off is refused.

Totals are mergeable, so a hot block is split into parts by identifier and the parts' outputs are added up.

Defined results: the first-loaded row of an identifier counts, its repeats don't; null identifiers are values like
any other; a row with a null event or load time is left out, its other copies aren't; null and NaN values count as
events but add nothing to sums; whole numbers are added up as such (exact within 64 bits), others as doubles, of which
an infinite or very large one changes its own period alone; an empty table gives no period.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators.skew import SALT, Salts

ON_TIME, CORRECTS, CUT = 0, 1, 2
OUTCOMES = ("on_time", "corrects", "cut")
EVERY = 256  # events between two checkpoints
ROWS_PER_PART = 200_000
MICRO = 1_000_000

Columns = list[np.ndarray]
State = list  # one number per column


@dataclass
class Lateness:
    """Seconds after a period's end: until ``allowed`` a row is on time, until ``cutoff`` it corrects, later it is cut."""

    allowed: int
    cutoff: int


def totals(times: np.ndarray, columns: Columns, width: int, cuts: np.ndarray, held: tuple[int, State] | None = None) -> tuple[np.ndarray, Columns, np.ndarray, Columns]:
    """Folds events in time order: (periods, their totals per column, period at each cut, the state there).

    ``cuts`` are numbers of events, ascending and above 0; a state is what its own period has added up so far. ``held``
    is (period, state) before the first event.
    """
    period = times // width
    begins = np.flatnonzero(np.r_[True, period[1:] != period[:-1]])
    edges = np.union1d(begins, cuts[cuts < len(times)]).astype(np.int64)
    owner = period[edges]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(edges)] - 1
    at_cut = np.searchsorted(edges, cuts) - 1
    ends, states = [], []
    for n, x in enumerate(columns):
        with np.errstate(over="ignore", invalid="ignore"):
            run = np.add.reduceat(x, edges)
            if held is not None and held[0] == owner[0]:
                run[0] += held[1][n]
            for a, b in zip(first.tolist(), last.tolist()):
                if b > a:
                    run[a : b + 1] = np.cumsum(run[a : b + 1])
        ends.append(run[last])
        states.append(run[at_cut])
    return owner[first], ends, owner[at_cut], states


@dataclass
class Fold:
    """Ordered events of one block, checkpoints of the state, and the outputs of its periods.

    A period's outputs are published ``rule.allowed`` seconds, and closed ``rule.cutoff`` seconds, after it is due: at
    its start plus ``due``.
    """

    width: int
    rule: Lateness
    due: int
    every: int = EVERY
    times: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    columns: Columns = field(default_factory=list)
    checkpoints: list[tuple[int, int, State]] = field(default_factory=list)  # (events before, period, state)
    outputs: dict[int, State] = field(default_factory=dict)
    replayed: int = 0

    def apply(self, times: np.ndarray, loaded_us: np.ndarray, columns: Columns) -> np.ndarray:
        """Takes in a batch of loads; returns what became of each row: an outcome.

        A column for corrections is put second, after that of the events.
        """
        since_due = loaded_us - ((times // self.width) * self.width + self.due) * MICRO
        taken = since_due <= self.rule.cutoff * MICRO
        published = since_due > self.rule.allowed * MICRO
        outcome = np.full(len(times), CUT)
        if taken.any():
            counts = [np.ones(len(times), np.int64), published.astype(np.int64)]
            replaced = self._replay(times[taken], [x[taken] for x in counts + columns])
            # What was put into a published period, whose output was replaced, is a correction.
            late = published & np.isin(times // self.width, replaced)
            outcome[taken] = np.where(late[taken], CORRECTS, ON_TIME)
        return outcome

    def _replay(self, times: np.ndarray, columns: Columns) -> np.ndarray:
        order = np.argsort(times, kind="stable")
        times, columns = times[order], [x[order] for x in columns]
        if not self.columns:
            self.columns = [np.empty(0, x.dtype) for x in columns]
        low = int(np.searchsorted(self.times, times[0], "right"))
        while self.checkpoints and self.checkpoints[-1][0] > low:  # those miss the late events
            self.checkpoints.pop()
        start, *held = self.checkpoints[-1] if self.checkpoints else (0,)
        place = np.searchsorted(self.times[start:], times, "right")
        suffix = np.insert(self.times[start:], place, times)
        moved = [np.insert(old[start:], place, x) for old, x in zip(self.columns, columns)]
        cuts = np.arange(self.every, len(suffix) + 1, self.every)
        periods, ends, at, states = totals(suffix, moved, self.width, cuts, tuple(held) if held else None)
        self.times = np.r_[self.times[:start], suffix]
        self.columns = [np.r_[old[:start], x] for old, x in zip(self.columns, moved)]
        self.checkpoints += [(start + int(c), int(p), [s[k] for s in states]) for k, (c, p) in enumerate(zip(cuts, at))]
        self.replayed += len(suffix)
        touched = np.unique(times // self.width)
        spot = np.searchsorted(periods, touched)
        for p, k in zip(touched.tolist(), spot.tolist()):
            self.outputs[p] = [x[k] for x in ends]
        return touched


def first_loaded(rows: DataFrame, identifier: Sequence[str], loaded: str, keep: Sequence[str]) -> DataFrame:
    """One row per identifier, the one loaded first (ties: the least of the kept columns)."""
    return (
        rows.select(*identifier, F.struct(loaded, *keep).alias("_row")).groupBy(*identifier).agg(F.min("_row").alias("_row"))
        .select(*identifier, *[F.col(f"_row.{c}").alias(c) for c in dict.fromkeys([loaded, *keep])])
    )


def summed(t: pa.Table, names: Sequence[str]) -> Columns:
    """Of each named column its values, nulls as 0, and whether each row has one."""
    out = []
    for n in names:
        x = t.column(n)
        whole = pa.types.is_integer(x.type)
        if not whole:
            x = pc.if_else(pc.fill_null(pc.is_nan(x), False), None, x)
        out += [pc.fill_null(x, 0).to_numpy().astype(np.int64 if whole else float), pc.is_valid(x).to_numpy(zero_copy_only=False).astype(np.int64)]
    return out


def replay(t: pa.Table, width: int, every: int, rule: Lateness, due: int, batch: int, sums: Sequence[str]) -> tuple[Fold, np.ndarray]:
    """Feeds a block's rows as they were loaded, the loads of ``batch`` seconds at a time: (fold, outcome of each row)."""
    times, loaded = t.column("_event").to_numpy(), t.column("_loaded").cast(pa.int64()).to_numpy()
    columns = summed(t, [f"_s_{n}" for n in sums])
    fold, outcome = Fold(width, rule, due, every), np.empty(len(times), np.int64)
    load = loaded // (batch * MICRO)
    order = np.argsort(load, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(load[order])) + 1) if len(order) else []:
        outcome[rows] = fold.apply(times[rows], loaded[rows], [x[rows] for x in columns])
    return fold, outcome


class LateAware:
    """Events with event time, period width and lateness rules, all in seconds.

    ``event_s`` is the event's time in seconds since 1970 (a column); ``measured_from`` is added to its period's start to
    give the moment that lateness is measured from. ``sums`` are numeric columns to add up per period; loads of ``batch``
    seconds are taken in together.
    """

    def __init__(
        self, rows: DataFrame, identifier: Sequence[str], event_s: Column, loaded: str, width: int, measured_from: int,
        rule: Lateness, sums: dict[str, Column], block: int = 86_400, every: int = EVERY, batch: int = 3_600,
    ) -> None:
        self.width, self.sums, self.identifier = width, list(sums), list(identifier)
        self.given = width, every, rule, measured_from, batch, self.sums
        # Repeats counted too: a block's parts may be smaller than asked, and the identifiers needn't be shuffled to count.
        self.salts = Salts(rows.select(F.floor(event_s.cast("long") / block).alias("_block")), ["_block"], ROWS_PER_PART)
        kinds = rows.select(*[c.alias(n) for n, c in sums.items()]).schema if sums else T.StructType()
        self.whole = {n: isinstance(kinds[n].dataType, T.IntegralType) for n in sums}
        self.kind = {n: "long" if w else "double" for n, w in self.whole.items()}
        # Before the first-loaded row is chosen, so a copy without a time doesn't stand for one that has both.
        narrow = rows.where(F.col(loaded).isNotNull() & event_s.isNotNull()).select(
            *identifier, F.col(loaded).alias("_loaded"), event_s.cast("long").alias("_event"),
            *[c.cast(self.kind[n]).alias(f"_s_{n}") for n, c in sums.items()],
        )
        first = first_loaded(narrow, identifier, "_loaded", ["_event", *[f"_s_{n}" for n in sums]])
        self.events = first.select("*", F.floor(F.col("_event") / block).alias("_block"))

    def _parts(self) -> DataFrame:
        # Dealt by identifier, of which each has one row: a task that is run again deals its rows the same way.
        return self.salts.spread(self.events, self.identifier).groupBy("_block", SALT)

    def periods(self) -> DataFrame:
        """(period_s, n_events, n_late, then sum and non-null count of each summed column); ``n_late`` are corrections."""
        kinds = {"n_events": "long", "n_late": "long"}
        for n in self.sums:
            kinds |= {f"sum_{n}": self.kind[n], f"n_{n}": "long"}
        width, given, whole = self.width, self.given, [k == "long" for k in kinds.values()]

        def run(t: pa.Table) -> pa.Table:
            fold, _ = replay(t, *given)
            keys = sorted(fold.outputs)
            columns = [pa.array([fold.outputs[k][n] for k in keys], pa.int64() if w else pa.float64()) for n, w in enumerate(whole)]
            return pa.table({"period_s": pa.array([k * width for k in keys], pa.int64())} | dict(zip(kinds, columns)))

        parts = self._parts().applyInArrow(run, "period_s long, " + ", ".join(f"`{n}` {k}" for n, k in kinds.items()))
        return parts.groupBy("period_s").agg(*[F.sum(n).alias(n) for n in kinds])

    def late_rows(self) -> DataFrame:
        """(identifier, event_s, outcome) of every row that came late: the fold put it into a published period, or refused it."""
        ids, given = self.identifier, self.given
        kinds = {f.name: f.dataType.simpleString() for f in self.events.schema.fields}

        def run(t: pa.Table) -> pa.Table:
            _, outcome = replay(t, *given)
            at = pa.array(np.flatnonzero(outcome != ON_TIME))
            names = pa.array([OUTCOMES[k] for k in outcome[outcome != ON_TIME]], pa.string())
            return pa.table([t.column(c).take(at) for c in [*ids, "_event"]] + [names], names=[*ids, "event_s", "outcome"])

        schema = ", ".join(f"`{c}` {kinds[c]}" for c in ids) + ", event_s long, outcome string"
        return self._parts().applyInArrow(run, schema)
