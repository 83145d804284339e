"""Generic roll-up operators: axis re-aggregation, share of total, trend, unpivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import exprs, pct, pct_sql


def axis_rollups(metrics: DataFrame, axes: Mapping[str, Sequence[str]], size: str, conversions: str,
                 duration_sum: str, duration_n: str) -> dict[str, DataFrame]:
    """Re-aggregate an additive segment table along each axis.

    Counts and sums are additive and an average is ``sum / count``, so each
    single-axis roll-up is computed from the (small) segment table instead of
    a second scan of the contacts. Output per axis: keys, ``size``,
    ``conversions``, ``rate`` (2 dp), ``avg_duration``.
    """
    out = {}
    for axis, keys in axes.items():
        out[axis] = metrics.groupBy(*keys).agg(*exprs({
            "size": f"sum({size})",
            "conversions": f"sum({conversions})",
            "rate": pct_sql(f"sum({conversions})", f"sum({size})"),
            "avg_duration": f"CAST(sum({duration_sum}) AS DOUBLE) / NULLIF(sum({duration_n}), 0)",
        }))
    return out


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """``ROUND(value * 100.0 / SUM(value) OVER (), digits)``.

    The total is a scalar subquery: one partial-then-final aggregate whose
    single value is handed to every task; no single-partition window and no
    join are planned.
    """
    total = df.agg(F.expr(f"sum({value})")).scalar()
    return df.withColumn(out, pct(F.col(value), total, digits))


def trend(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
          previous: str, change: str, digits: int = 2) -> DataFrame:
    """Previous-period value and the rounded change (LAG over one window)."""
    over = f"OVER (PARTITION BY {', '.join(partition)} ORDER BY {', '.join(order)})"
    prev = f"lag({value}) {over}"
    return df.select("*", *exprs({previous: prev, change: f"ROUND({value} - {prev}, {digits})"}))


def unpivot_columns(df: DataFrame, columns: Sequence[tuple[str, str]], label: str, value: str,
                    ids: Sequence[str] = ()) -> DataFrame:
    """Columns -> rows: ``(ids..., label, value)``; ``columns`` is ``[(label_text, column)]``.

    A narrow generator (explode of a fixed-size array), no shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(lbl).alias(label), F.col(c).alias(value)) for lbl, c in columns])
    return df.select(*ids, F.explode(pairs).alias("_kv")).select(*ids, f"_kv.{label}", f"_kv.{value}")
