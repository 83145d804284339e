"""Conversion measures as SQL expression text (JVM-side aggregate functions).

Measures are written as Spark SQL text and turned into Columns with one
``F.expr`` call each: building the same expression from Column objects costs
a JVM round trip per node. Every rate multiplies by a double literal
(``100.0D``) so no DECIMAL arithmetic appears, and every ratio divides by
``NULLIF(den, 0)`` so a zero denominator yields NULL under ANSI mode instead
of an error.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDRED = "100.0D"
SECONDS_PER_HOUR = "3600.0D"
YES = "subscribed = 'yes'"
NO = "subscribed = 'no'"


def q(name: str) -> str:
    """A quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def pct_sql(num: str, den: str, digits: int | None = 2) -> str:
    """``ROUND(num * 100.0 / NULLIF(den, 0), digits)``; ``digits=None`` keeps it unrounded."""
    value = f"({num}) * {HUNDRED} / NULLIF({den}, 0)"
    return value if digits is None else f"ROUND({value}, {digits})"


def per_hour_sql(num: str, seconds: str, digits: int = 2) -> str:
    return f"ROUND(({num}) * {SECONDS_PER_HOUR} / NULLIF({seconds}, 0), {digits})"


def pct(num: Column, den: Column, digits: int | None = 2) -> Column:
    """Column form of ``pct_sql`` for callers that hold Columns."""
    value = num * F.lit(100.0) / F.nullif(den, F.lit(0))
    return value if digits is None else F.round(value, digits)


def unique_sql(columns: Sequence[str], key: str = "customer_id") -> str:
    """Distinct customers of a frame with these columns: exact where the key
    is there. A frame without it has not been numbered yet, and the number
    that staging would give is unique by row."""
    return f"count(DISTINCT {q(key)})" if key in columns else "count(1)"


def as_of_sql(as_of: dt.date | None) -> str:
    if as_of is None:
        return "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    return f"TIMESTAMP_NTZ '{as_of.isoformat()} 00:00:00'"


def exprs(named: dict[str, str]) -> list[Column]:
    return [F.expr(f"{sql} AS {q(name)}") for name, sql in named.items()]


def conversion_sql(names: dict[str, str], subscribed: str = "subscribed",
                   amount: str = "call_duration_seconds", as_of: dt.date | None = None,
                   columns: Sequence[str] = ()) -> dict[str, str]:
    """Aggregates of one conversion roll-up over a frame that has these
    columns, as ``{output_name: sql}``.

    Roles: size, unique, yes, no, rate, avg, sum, per_minute, updated. A
    role missing from ``names`` is skipped. ``unique``: see ``unique_sql``.
    """
    s, a = q(subscribed), q(amount)
    conv = f"count_if({s} = 'yes')"
    built = {
        "size": "count(1)",
        "unique": unique_sql(columns),
        "yes": conv,
        "no": f"count_if({s} = 'no')",
        "rate": pct_sql(conv, "count(1)"),
        "avg": f"avg({a})",
        "sum": f"sum({a})",
        "per_minute": pct_sql(conv, f"sum({a})", 4),
        "updated": f"max({as_of_sql(as_of)})",
    }
    return {out: built[role] for role, out in names.items()}


def conversion_aggs(names: dict[str, str], subscribed: str = "subscribed",
                    amount: str = "call_duration_seconds", as_of: dt.date | None = None,
                    columns: Sequence[str] = ()) -> list[Column]:
    return exprs(conversion_sql(names, subscribed, amount, as_of, columns))


def rule_pivot_sql(axis: str, table: list[tuple[str, str]], value: str) -> dict[str, str]:
    """Static pivot: ``SUM(CASE WHEN axis = label THEN value ELSE 0 END)`` per label."""
    out = {}
    for label, name in table:
        lit = "'" + label.replace("'", "\\'") + "'"
        out[name] = f"sum(CASE WHEN {q(axis)} = {lit} THEN {q(value)} ELSE 0 END)"
    return out


def rule_pivot(axis: str, table: list[tuple[str, str]], value: str) -> list[Column]:
    return exprs(rule_pivot_sql(axis, table, value))


def yes(subscribed: str = "subscribed") -> Column:
    return F.col(subscribed) == "yes"


def no(subscribed: str = "subscribed") -> Column:
    return F.col(subscribed) == "no"
