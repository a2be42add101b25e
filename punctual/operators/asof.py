"""Attributes as they were known at the time of an event.

Events and attribute versions are co-grouped by entity; in a group a vectorised binary search finds, for all events
at once, the latest version that began, and was recorded, by the event's time and had not ended. Hot entities are
split into parts, each with a copy of the entity's versions.

Defined results: every event row comes out exactly once, repeated rows too. Events with a null entity or time,
of an unknown entity, or at a time without a valid version get null attributes. Of versions that begin together the
last recorded wins, then the last by the attributes' order. An attribute named like an event column is returned with
the prefix ``dim_``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators.skew import OWN, SALT, Salts

NEVER = np.iinfo(np.int64).max
ROWS_PER_PART = 50_000
AT, FROM, TO, RECORDED = (f"{OWN}{x}" for x in ("at", "from", "to", "recorded"))


def _number(df: DataFrame, column: str) -> Column:
    """Dates as days, timestamps as microseconds, numbers as they are."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.col(column).cast("long")


def latest_valid(at: np.ndarray, begins: np.ndarray, ends: np.ndarray, recorded: np.ndarray | None = None) -> np.ndarray:
    """Index of the version for each time, or -1; versions sorted by begin.

    Where the latest version to begin doesn't hold (ended, or recorded later) earlier ones are tried, only as far as
    some earlier version can still hold.
    """
    pick = np.searchsorted(begins, at, "right") - 1
    if not len(begins):
        return pick
    reach = np.maximum.accumulate(ends)
    known = np.minimum.accumulate(recorded) if recorded is not None else None
    while True:
        k = np.maximum(pick, 0)
        bad = (pick >= 0) & (ends[k] <= at)
        if recorded is not None:
            bad |= (pick >= 0) & (recorded[k] > at)
        if not bad.any():
            return pick
        pick = np.where(bad, pick - 1, pick)
        k = np.maximum(pick, 0)
        hopeless = bad & (reach[k] <= at)
        if known is not None:
            hopeless |= bad & (known[k] > at)
        pick = np.where(hopeless, -1, pick)


def as_known(
    events: DataFrame, changes: DataFrame, entity: str, at: str, valid_from: str, valid_to: str, attributes: Sequence[str],
    recorded: str | None = None, known_as: str | None = None, rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Events with the ``attributes`` valid at column ``at``; ``known_as`` names a flag: the entity has versions.

    ``events`` is a scan, a checkpoint or made from one without a shuffle: rows of a hot entity go round its parts in
    their order, which a task that is run again must find the same.
    """
    names = {a: f"dim_{a}" if a in events.columns else a for a in attributes}
    fields = list(events.schema.fields) + [T.StructField(names[a], changes.schema[a].dataType) for a in attributes]
    if known_as:
        fields.append(T.StructField(known_as, T.BooleanType()))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    usable = F.col(f"`{entity}`").isNotNull()
    rest = events.where(~usable).select(
        "*", *[F.lit(None).cast(changes.schema[a].dataType).alias(names[a]) for a in attributes],
        *([F.lit(False).alias(known_as)] if known_as else []),
    )
    named = events.where(usable)
    salts = Salts(named, [entity], rows_per_part)
    left = salts.spread(named.withColumn(AT, F.coalesce(_number(events, at), F.lit(-int(NEVER)))))  # no time is before all versions
    versions = changes.where(F.col(entity).isNotNull()).select(  # without a begin a version is never valid
        F.col(entity), *[F.col(a).alias(f"{OWN}a_{a}") for a in attributes], F.coalesce(_number(changes, valid_from), F.lit(int(NEVER))).alias(FROM),
        F.coalesce(_number(changes, valid_to), F.lit(int(NEVER))).alias(TO),
        (F.coalesce(_number(changes, recorded), F.lit(int(NEVER))) if recorded else F.lit(0).cast("long")).alias(RECORDED),
    )
    right = salts.copies(versions)

    def find(ev: pa.Table, ch: pa.Table) -> pa.Table:
        time = ev.column(AT).to_numpy()
        if ch.num_rows:
            order = [(FROM, "ascending"), (RECORDED, "ascending")]
            ch = ch.take(pa.compute.sort_indices(ch, order + [(f"{OWN}a_{a}", "ascending") for a in attributes]))
            rec = ch.column(RECORDED).to_numpy() if recorded else None
            pick = latest_valid(time, ch.column(FROM).to_numpy(), ch.column(TO).to_numpy(), rec)
        else:
            pick = np.full(len(time), -1)
        at_row = pa.array(pick, pa.int64(), mask=pick < 0)
        columns = [ev.column(c) for c in out_events] + [ch.column(f"{OWN}a_{a}").take(at_row) for a in attributes]
        if known_as:
            columns.append(pa.array(np.full(len(time), ch.num_rows > 0)))
        return pa.Table.from_arrays(columns, names=schema.names)

    out_events = events.columns
    found = left.groupBy(entity, SALT).cogroup(right.groupBy(entity, SALT)).applyInArrow(find, schema)
    return found.unionByName(rest)
