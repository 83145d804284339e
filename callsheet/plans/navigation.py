"""Aggregate navigation: explores are answered from the contact cube where it holds what they ask for.

The cube (day x campaign x the seven segment labels) keeps additive totals,
so any measure of the semantic layer that is a ratio or sum of totals rolls up
exactly to any of its axes and to any period of whole days. A query goes to the
cube if all its dimensions, filters and measures are covered, else to the
contacts; the rule looks at names only, so the choice is known before anything
runs. Both answers are equal.

Distinct clients aren't additive: exact counts go to the contacts. The cube can
keep a sketch of each cell's clients (HyperLogLog, ``2 ** SKETCH_BITS``
registers), whose unions estimate them for any axis without a scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.metrics import exprs, pct_sql
from ..functions.time import last_days, timeframe
from . import tiles
from .pipeline import CUBE_KEYS, SKETCH

DAY = "campaign_date"
PERIODS = ("date", "week", "month", "quarter", "year")  # of whole days


def _among_yes(column: str, label: str) -> str:
    return f"sum(CASE WHEN {column} = '{label}' THEN yes ELSE 0 END)"


def cube_measures(numbered: bool) -> dict[str, str]:
    """The measures over the cube's totals. Of contacts that carry their number, distinct ones are not among them."""
    out = {
        "total_contacts": "sum(n)", "successful_contacts": "sum(yes)",
        "conversion_rate": pct_sql("sum(yes)", "sum(n)", None),
        "avg_call_duration": "CAST(sum(dur) AS DOUBLE) / NULLIF(sum(n_dur), 0)",
        "total_call_duration_hours": "sum(dur) / 3600.0D",
        "young_conversions": _among_yes("age_group", fixed.AGE_PIVOT[0][0]),
        "professional_conversions": _among_yes("job_category", fixed.JOB_PIVOT[0][0]),
        "low_risk_conversions": _among_yes("credit_risk_profile", fixed.RISK_PIVOT[0][0]),
    }
    return out if numbered else {**out, "unique_customers": "sum(n)"}


def covers(dims: Sequence[str], names: Sequence[str], filters: Mapping[str, Sequence] | None, numbered: bool) -> bool:
    """Whether the cube holds all that the query names."""
    fields = [d for d in dims if not d.startswith("created_")] + [f for f, values in (filters or {}).items() if values]
    periods = [d.removeprefix("created_") for d in dims if d.startswith("created_")]
    return (set(fields) <= set(CUBE_KEYS) and set(periods) <= set(PERIODS) and set(names) <= set(cube_measures(numbered)))


def from_cube(cube: DataFrame, dims: Sequence[str], names: Sequence[str], filters: Mapping[str, Sequence] | None = None,
              sorts: Sequence[Column] = (), limit: int | None = None, as_of: dt.date | None = None,
              window_days: int | None = None, numbered: bool = False) -> DataFrame:
    """``tiles.measure_query`` over the cube's totals, for what it covers."""
    if as_of is not None and window_days:
        cube = cube.where(last_days(DAY, as_of, window_days))
    cond = tiles.field_filters(filters)
    cube = cube if cond is None else cube.where(cond)
    axes = [timeframe(DAY, d.removeprefix("created_")).alias(d) if d.startswith("created_") else F.col(d) for d in dims]
    m = cube_measures(numbered)
    out = cube.groupBy(*axes).agg(*exprs({n: m[n] for n in names})) if names else cube.select(*axes).distinct()
    out = out.orderBy(*sorts) if sorts else out
    return out.limit(limit) if limit else out


def measure_query(contacts: DataFrame, cube: DataFrame | None, dims: Sequence[str], names: Sequence[str],
                  filters: Mapping[str, Sequence] | None = None, **how) -> DataFrame:
    """A measure query over contacts, from their cube where that covers it."""
    numbered = "customer_id" in contacts.columns
    if cube is not None and covers(dims, names, filters, numbered):
        return from_cube(cube, dims, names, filters, numbered=numbered, **how)
    return tiles.measure_query(contacts, dims, names, filters, **how)


def explore(name: str, contacts: DataFrame, cube: DataFrame | None, dims: Sequence[str], names: Sequence[str] = (),
            as_of: dt.date | None = None, days: int = fixed.TILE_WINDOW_DAYS, **how) -> DataFrame:
    """A contact explore with its mandatory window, from the cube where that covers it."""
    if tiles.EXPLORE_DATE_FIELDS[name] != "processed_at":
        raise ValueError(f"{name} is not an explore of contacts")
    return measure_query(contacts, cube, dims, names, as_of=as_of or dt.date.today(), window_days=days, **how)


def estimated_clients(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct clients per key, from the union of the cells' sketches."""
    if SKETCH not in cube.columns:
        raise ValueError("the cube was built without client sketches")
    return cube.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("estimated_clients"))


AXES = ("age_group", "job_category", "credit_risk_profile", "customer_engagement_level", "call_duration_category", "campaign_number")


def by_axis(frame: DataFrame, count: Column, name: str) -> DataFrame:
    """``axis``, ``label`` and an aggregate for every label of every axis, in one pass."""
    pairs = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("label")) for a in AXES])
    return frame.select("*", F.inline(pairs)).groupBy("axis", "label").agg(count.alias(name))


def clients_by_axis(contacts: DataFrame, cube: DataFrame, bound: float = 0.05) -> DataFrame:
    """Exact distinct clients by label of each axis, their estimate from the cube, and whether that is within ``bound``."""
    exact = by_axis(contacts.select(*AXES, "client_key"), F.count_distinct("client_key"), "exact_clients")
    guess = by_axis(cube.select(*AXES, SKETCH), F.hll_sketch_estimate(F.hll_union_agg(SKETCH)), "estimated_clients")
    near = F.abs(F.col("estimated_clients") - F.col("exact_clients")) <= bound * F.col("exact_clients")
    return exact.join(guess, ["axis", "label"], "left").withColumn("within_bound", near)
