"""Relations declared once, run as DataFrames or printed as Spark SQL.

A declaration is a chain of filters, columns, groups and joins over named tables; its expressions are SQL, which both
forms read, so the published text and the computed figures can't differ.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PREFIX = re.compile(r"([A-Za-z_]\w*\.){0,2}")

Tables = Mapping[str, DataFrame]


def checked_prefix(prefix: str) -> str:
    """``catalog.schema.`` or less."""
    if not _PREFIX.fullmatch(prefix):
        raise ValueError(f"not a prefix of table names: {prefix!r}")
    return prefix


@dataclass(frozen=True)
class Relation:
    """``run`` makes the DataFrame from tables by name, ``show`` the statement from a prefix of table names."""

    run: Callable[[Tables], DataFrame]
    show: Callable[[str], str]
    tables: tuple[str, ...]
    name: str | None = None

    def frame(self, tables: Tables) -> DataFrame:
        return self.run(tables)

    def sql(self, prefix: str = "") -> str:
        return self.show(checked_prefix(prefix))

    def _as_source(self, prefix: str) -> str:
        inner = self.show(prefix)
        return prefix + self.name if self.name else "(\n" + "\n".join("  " + line for line in inner.splitlines()) + "\n)"

    def _then(self, step: Callable[[DataFrame], DataFrame], what: str, after: str = "") -> Relation:
        return Relation(lambda t: step(self.run(t)), lambda p: f"select {what} from {self._as_source(p)}" + (f"\n{after}" if after else ""), self.tables)

    def where(self, condition: str) -> Relation:
        return self._then(lambda df: df.where(condition), "*", f"where {condition}")

    def columns(self, *columns: str) -> Relation:
        """Each an expression, named by ``as`` where it isn't a column's name."""
        return self._then(lambda df: df.selectExpr(*columns), ", ".join(columns))

    def grouped(self, by: Sequence[str], *measures: str) -> Relation:
        """One row per value of ``by`` (one row in all without any)."""
        order = ", ".join(str(n + 1) for n in range(len(by)))
        return self._then(
            lambda df: df.groupBy(*map(F.expr, by)).agg(*map(F.expr, measures)), ", ".join([*by, *measures]), f"group by {order}" if by else ""
        )

    def joined(self, other: Relation, on: Sequence[str], how: str = "inner") -> Relation:
        """``how``: inner, left, full or left semi; each joining column comes once."""
        return Relation(
            lambda t: self.run(t).join(other.run(t), list(on), how.replace(" ", "_")),
            lambda p: f"select * from {self._as_source(p)} a\n{how} join {other._as_source(p)} b using ({', '.join(on)})",
            tuple(dict.fromkeys(self.tables + other.tables)),
        )

    def followed_by(self, *others: Relation) -> Relation:
        """The rows of all, columns by position."""
        every = (self, *others)

        def run(t: Tables) -> DataFrame:
            out = self.run(t)
            for o in others:
                out = out.union(o.run(t))
            return out

        return Relation(run, lambda p: "\nunion all\n".join(r.show(p) for r in every), tuple(dict.fromkeys(x for r in every for x in r.tables)))

    def ordered(self, *by: str, first: int | None = None) -> Relation:
        """``by`` are columns, descending with `` desc``; only the ``first`` rows if given."""
        def run(df: DataFrame) -> DataFrame:
            df = df.orderBy(*[F.desc(c[:-5]) if c.endswith(" desc") else F.asc(c) for c in by])
            return df.limit(first) if first else df

        return self._then(run, "*", f"order by {', '.join(by)}" + (f" limit {first}" if first else ""))


def table(name: str) -> Relation:
    return Relation(lambda t: t[name], lambda p: f"select * from {p}{name}", (name,), name)
