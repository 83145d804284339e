"""Distributed surrogate keys: a global ROW_NUMBER without a single partition.

``ROW_NUMBER() OVER (ORDER BY k)`` is planned by Spark as one task holding
every row. Here rows are numbered in groups that follow the order: a group is
one combination of the leading keys or, where one holds more than
``rows_per_group`` rows, a slice of it between quantiles of its own tie-break
values. A row's number is its place in its group plus the rows of all groups
before, which come from a count per group (combined map-side), summed within
each value of the first key and then over these values.

The source is read twice. The first pass keeps only keys and tie-break, written
as a narrow table from which the quantiles and the counts come. The quantiles
are those of a sketch of each hot combination, so they follow its values
however unevenly those lie; they are written, too: they are data, and a task
that is computed again deals its rows as before. They only spread rows; the
numbers don't depend on them. The second pass is one shuffle of the rows.

At most total / ``rows_per_group`` combinations are hot, so their edges are a
small table; it is broadcast where it is counted to be. Only the totals by first
key meet in one task, so that column must have few values, whatever the number
of rows (an age, for example).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

ROWS_PER_GROUP = 1_000_000
SLICES = 256  # of a hot combination, at most
ACCURACY = 4 * SLICES  # of the sketch: a quantile is off by at most 1 / ACCURACY of the rows
BROADCAST_ROWS = 10_000
_GROUP, _SLICE, _TIE, _LEAD, _N, _OFF, _EDGES = "_sk_group", "_sk_slice", "_sk_tie", "_sk_lead", "_sk_n", "_sk_off", "_sk_edges"


def _tie_order(df: DataFrame, tie: Sequence[str]) -> tuple[Column, list[Column]]:
    """The number that slices follow, and the order of rows with equal keys: one integral column, else a hash
    of the columns and then the columns."""
    columns = [F.col(f"`{c}`") for c in tie]
    if len(tie) == 1 and isinstance(df.schema[tie[0]].dataType, T.IntegralType):
        return columns[0].cast("bigint"), [columns[0].asc_nulls_first()]
    code = F.xxhash64(*columns)
    return code, [code, *[c.asc_nulls_first() for c in columns]]


def _slice(tie: str, edges: str) -> Column:
    """Edges below the value: a null and all up to the first edge are in slice 0, in the order of the values."""
    return F.coalesce(F.size(F.filter(edges, lambda e: e < F.col(tie))), F.lit(0))


def _hot_edges(narrow: DataFrame, keys: Sequence[str], counts: DataFrame, rows_per_group: int) -> DataFrame:
    """Of each hot combination, the tie-break values that cut it into slices of about ``rows_per_group`` rows."""
    hot = counts.where(F.col(_N) > rows_per_group)
    same = [narrow[k].eqNullSafe(hot[k]) for k in keys]
    points = [q / SLICES for q in range(1, SLICES)]
    sketched = narrow.join(hot, same, "left_semi").groupBy(*keys).agg(
        F.percentile_approx(_TIE, points, ACCURACY).alias("_points"), F.count(F.lit(1)).alias(_N))
    # every so many of the points; all of them where the slices would be more
    step = F.greatest(F.lit(1), F.ceil(F.lit(SLICES * rows_per_group) / F.col(_N))).cast("int")
    return sketched.select(*keys, F.filter("_points", lambda _, i: (i + 1) % step == 0).alias(_EDGES))


def _with_groups(df: DataFrame, keys: Sequence[str], tie: Column, edges: DataFrame | None) -> DataFrame:
    df = df.withColumn(_TIE, tie)
    part = F.lit(0)
    if edges is not None:
        renamed = edges.select(*[F.col(k).alias(f"_e_{k}") for k in keys], _EDGES)
        df = df.join(renamed, [df[k].eqNullSafe(renamed[f"_e_{k}"]) for k in keys], "left").drop(*[f"_e_{k}" for k in keys])
        part = _slice(_TIE, _EDGES)
    return df.withColumn(_GROUP, F.struct(*[F.col(f"`{k}`") for k in keys], part.alias(_SLICE))).drop(_TIE, _EDGES)


def surrogate_key(df: DataFrame, name: str, keys: Sequence[str], tie: Sequence[str],
                  rows_per_group: int = ROWS_PER_GROUP, eager: bool = True) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the order of ``keys``
    (ascending, nulls first), equal keys in the order of ``tie``.

    ``tie`` must tell rows apart for the result to be reproducible; only
    rows equal in every column may swap their numbers. The narrow pass runs at
    once; with ``eager=False`` (a lazy view) it is part of the plan, which
    then reads the source once for the quantiles, the counts and the rows each.
    """
    value, order = _tie_order(df, tie)
    narrow = df.select(*[F.col(f"`{k}`").alias(k) for k in keys], value.alias(_TIE))
    keep = (lambda frame, what: stored(frame, what)) if eager else (lambda frame, _: frame)
    narrow = keep(narrow, "key_values")
    plain = keep(narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)), "key_counts")
    edges: DataFrame | None = _hot_edges(narrow, keys, plain, rows_per_group)
    if eager:
        edges = stored(edges, "key_edges")
        found = edges.limit(BROADCAST_ROWS + 1).count()
        edges = None if not found else F.broadcast(edges) if found <= BROADCAST_ROWS else edges
    grouped = _with_groups(df, keys, value, edges)
    if edges is None:
        counts = plain.select(F.struct(*keys, F.lit(0).alias(_SLICE)).alias(_GROUP), _N)
    else:
        counts = _with_groups(narrow.withColumnRenamed(_TIE, "_sk_value"), keys, F.col("_sk_value"), edges) \
            .groupBy(_GROUP).agg(F.count(F.lit(1)).alias(_N))
    counts = counts.withColumn(_LEAD, F.col(_GROUP)[keys[0]])
    totals = counts.groupBy(_LEAD).agg(F.sum(_N).alias(_N))

    def before(window) -> Column:
        return F.coalesce(F.sum(_N).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    base = totals.select(F.col(_LEAD).alias("_sk_first"), before(Window.orderBy(F.asc_nulls_first(_LEAD))).alias("_sk_base"))
    inside = counts.withColumn(_OFF, before(Window.partitionBy(_LEAD).orderBy(_GROUP)))
    # one row per value of the first key
    offsets = inside.join(F.broadcast(base), F.col(_LEAD).eqNullSafe(F.col("_sk_first"))).select(
        _GROUP, (F.col(_OFF) + F.col("_sk_base")).alias(_OFF))
    place = F.row_number().over(Window.partitionBy(_GROUP).orderBy(*order))
    return (grouped.withColumn(_N, place).join(offsets, _GROUP)
            .withColumn(name, (F.col(_OFF) + F.col(_N)).cast("bigint")).drop(_GROUP, _N, _OFF))
