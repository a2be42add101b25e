"""Splitting of hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.session import cut

#: Columns that operators add for themselves begin with this, so they don't clash with a table's own.
OWN = "__punctual_"
SALT, PARTS = f"{OWN}salt", f"{OWN}parts"
#: Hot keys up to this number are broadcast (a few MB); more are joined by a shuffle.
MAX_BROADCAST_KEYS = 100_000


class Salts:
    """How many parts each hot key of ``df`` is split into; keys with at most ``rows_per_part`` rows have one.

    Counting reads only the key columns and is pre-aggregated in each task. With ``counted`` the rows are keys already,
    that column holding their counts.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], rows_per_part: int, counted: str | None = None) -> None:
        self.keys = list(keys)
        n = F.col(counted or "count")
        hot = (df if counted else df.groupBy(*keys).count()).where(n > rows_per_part)
        self.hot = cut(hot.select(*keys, F.ceil(n / rows_per_part).cast("int").alias(PARTS)))
        self.n = self.hot.count()

    def _joined(self, df: DataFrame) -> DataFrame:
        if not self.n:
            return df.withColumn(PARTS, F.lit(1))
        hot = F.broadcast(self.hot) if self.n <= MAX_BROADCAST_KEYS else self.hot
        hot = hot.select(*[F.col(k).alias(f"{OWN}hot_{k}") for k in self.keys], PARTS)
        on = [F.col(k).eqNullSafe(F.col(f"{OWN}hot_{k}")) for k in self.keys]
        joined = df.join(hot, on, "left").drop(*[f"{OWN}hot_{k}" for k in self.keys])
        return joined.withColumn(PARTS, F.coalesce(PARTS, F.lit(1)))

    def spread(self, df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """Rows with a ``SALT`` column: the parts of a hot key are dealt by a hash of ``by``.

        Without it rows go round the parts in turn, equal rows too; then ``df`` must be a scan, whose rows keep their
        order if a task is run again.
        """
        turn = F.xxhash64(*by) if by else F.monotonically_increasing_id()
        return self._joined(df).withColumn(SALT, F.pmod(turn, F.col(PARTS)).cast("int")).drop(PARTS)

    def copies(self, df: DataFrame) -> DataFrame:
        """Rows once for each part of their key."""
        parts = F.sequence(F.lit(0), F.col(PARTS) - 1)
        return self._joined(df).withColumn(SALT, F.explode(parts)).drop(PARTS)
