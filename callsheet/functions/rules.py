"""Ordered rule tables compiled to one CASE expression.

A rule table is ``[(label, predicate), ...]`` plus an else label. The first
predicate that is true wins; a NULL predicate counts as not true, so NULL
inputs fall through to the else label, as SQL CASE does. The result is a
single ``CASE WHEN`` Column: it stays inside whole-stage codegen and costs
one projection, however many tables are applied together.

Predicates are SQL text (built by the helpers below from column names and
fixed values) or Columns; a table of text predicates is handed to Spark as
one expression string, parsed on the JVM side in one call.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class RuleTable:
    rules: Sequence[tuple[str, str | Column]]
    otherwise: str | None

    def sql(self) -> str:
        whens = " ".join(f"WHEN {p} THEN {sql_literal(label)}" for label, p in self.rules)
        other = "NULL" if self.otherwise is None else sql_literal(self.otherwise)
        return f"CASE {whens} ELSE {other} END" if self.rules else other

    def column(self) -> Column:
        if all(isinstance(p, str) for _, p in self.rules):
            return F.expr(self.sql())
        expr = None
        for label, p in self.rules:
            pred = F.expr(p) if isinstance(p, str) else p
            expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
        return expr.otherwise(F.lit(self.otherwise))


def bands(col: str, table: Sequence[tuple[str, float | None, float]], otherwise: str) -> RuleTable:
    """Numeric bands ``(label, lo, hi)``: lo None means col < hi, else lo <= col <= hi."""
    c = ident(col)
    return RuleTable([(label, f"{c} < {hi}" if lo is None else f"{c} BETWEEN {lo} AND {hi}")
                      for label, lo, hi in table], otherwise)


def members(col: str, table: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> RuleTable:
    """Membership ``(label, [values])``: ``col IN (values)``."""
    c = ident(col)
    return RuleTable([(label, f"{c} IN ({', '.join(sql_literal(v) for v in values)})")
                      for label, values in table], otherwise)


def equals(col: str, table: Sequence[tuple[str, str]], otherwise: str) -> RuleTable:
    c = ident(col)
    return RuleTable([(label, f"{c} = {sql_literal(value)}") for label, value in table], otherwise)


def floors(col: str, table: Sequence[tuple[str, float]], otherwise: str) -> RuleTable:
    """Descending floors ``(label, floor)``: ``col >= floor``."""
    c = ident(col)
    return RuleTable([(label, f"{c} >= {floor}") for label, floor in table], otherwise)


def above(col: str, table: Sequence[tuple[str, float]], otherwise: str) -> RuleTable:
    """Descending strict thresholds ``(label, bound)``: ``col > bound``."""
    c = ident(col)
    return RuleTable([(label, f"{c} > {bound}") for label, bound in table], otherwise)


def apply_rules(df: DataFrame, tables: Mapping[str, RuleTable]) -> DataFrame:
    """Add one column per rule table in a single projection."""
    if all(all(isinstance(p, str) for _, p in t.rules) for t in tables.values()):
        return df.selectExpr("*", *[f"{t.sql()} AS {ident(name)}" for name, t in tables.items()])
    return df.withColumns({name: table.column() for name, table in tables.items()})
