"""Semantic layer and dashboard tiles as DataFrame queries.

``MEASURES`` maps a measure name to an aggregate Column; ``measure_query``
is the explore: dimensions + measures + field filters + a trailing day
window + sorts + limit. Tiles are fixed explores over the marts. A query
that selects only dimensions groups by them (distinct rows), as a BI
explore does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.metrics import YES, exprs, pct_sql, unique_sql
from ..functions.time import last_days, timeframe
from ..operators.rollup import unpivot_columns
from . import marts


def measure_sql(columns: Sequence[str] = ()) -> dict[str, str]:
    """The measures as SQL over a frame that has these columns."""
    conv = f"count_if({YES})"
    return {
        "total_contacts": "count(1)",
        "successful_contacts": conv,
        "conversion_rate": pct_sql(conv, "count(1)", None),
        "avg_call_duration": "avg(call_duration_seconds)",
        "total_call_duration_hours": "sum(call_duration_seconds) / 3600.0D",
        "unique_customers": unique_sql(columns),
        "young_conversions": f"count_if({YES} AND age_group = 'Young (18-24)')",
        "professional_conversions": f"count_if({YES} AND job_category = 'Professional')",
        "low_risk_conversions": f"count_if({YES} AND credit_risk_profile = 'Low Risk')",
    }


def measures() -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in measure_sql().items()}


def field_filters(filters: Mapping[str, Sequence] | None) -> Column | None:
    """Equality filters ``field IN (values)``; an empty value list is no filter."""
    cond = None
    for field, values in (filters or {}).items():
        if values:
            c = F.col(field).isin(list(values))
            cond = c if cond is None else cond & c
    return cond


def measure_query(df: DataFrame, dims: Sequence[str], names: Sequence[str],
                  filters: Mapping[str, Sequence] | None = None, sorts: Sequence[Column] = (),
                  limit: int | None = None, as_of: dt.date | None = None, window_days: int | None = None,
                  date_col: str = "processed_at") -> DataFrame:
    """Dimensions ``created_<timeframe>`` are derived from ``date_col``."""
    if as_of is not None and window_days:
        df = df.where(last_days(date_col, as_of, window_days))
    cond = field_filters(filters)
    if cond is not None:
        df = df.where(cond)
    dim_cols = [timeframe(date_col, d.split("_", 1)[1]).alias(d) if d.startswith("created_") else F.col(d)
                for d in dims]
    m = measure_sql(df.columns)
    out = df.groupBy(*dim_cols).agg(*exprs({n: m[n] for n in names})) if names else \
        df.select(*dim_cols).distinct()
    if sorts:
        out = out.orderBy(*sorts)
    return out.limit(limit) if limit else out


def by_timeframe(contacts: DataFrame,
                 frames: Sequence[str] = ("date", "week", "month", "quarter", "year")) -> DataFrame:
    """KPIs per period for several timeframes of a day and more in one pass:
    contacts are first aggregated by day into additive parts, then each day
    counts towards one period per frame. The finer frames (``raw``, ``time``)
    are ``measure_query`` dimensions."""
    days = contacts.groupBy(F.expr("to_date(processed_at) AS _day")).agg(*exprs({
        "_n": "count(1)", "_yes": f"count_if({YES})", "_seconds": "sum(call_duration_seconds)",
        "_timed": "count(call_duration_seconds)"}))
    periods = F.array(*[F.struct(F.lit(f).alias("timeframe"), timeframe("_day", f).alias("period_start"))
                        for f in frames])
    return (days.select("*", F.inline(periods))
            .groupBy("timeframe", "period_start").agg(*exprs({
                "total_contacts": "sum(_n)", "successful_contacts": "sum(_yes)",
                "conversion_rate": pct_sql("sum(_yes)", "sum(_n)", None),
                "avg_call_duration": "CAST(sum(_seconds) AS DOUBLE) / NULLIF(sum(_timed), 0)"})))


def _window_contacts(contacts: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return contacts.where(last_days("processed_at", as_of, days))


def _window_fct(contacts: DataFrame, as_of: dt.date, days: int = fixed.TILE_WINDOW_DAYS) -> DataFrame:
    # A campaign-day row depends on that day's contacts only: filter first.
    return marts.fct_campaigns(_window_contacts(contacts, as_of, days), as_of, with_trend=False, sort=False)


def tile_conversion(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    fields = ["campaign_number", "overall_conversion_rate", "total_contacts", "total_conversions"]
    return _window_fct(contacts, as_of).select(*fields).distinct().orderBy(*fields)


def _segment_rows(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    """Segment rows as the dimension's tiles see them. The dimension repeats a
    segment row 1, 2 or 4 times with every segment column unchanged, so the
    distinct tuples (and any max) of segment columns equal those of the
    segment table: no roll-ups or joins are needed for these tiles."""
    return marts.segment_metrics(contacts, as_of)


def tile_segmentation(contacts: DataFrame, as_of: dt.date, n: int = fixed.TILE_TOP_SEGMENTS) -> DataFrame:
    dim = _segment_rows(contacts, as_of)
    dim = dim.where(last_days("last_updated", as_of, fixed.TILE_WINDOW_DAYS))
    fields = ["age_group", "job_category", "segment_conversion_rate", "segment_size"]
    return (dim.select(*fields).distinct()
            .orderBy(F.desc("segment_conversion_rate"), "age_group", "job_category", F.desc("segment_size"))
            .limit(n))


def _tile_pivot(contacts: DataFrame, as_of: dt.date, table: list[tuple[str, str]], label: str) -> DataFrame:
    fct = _window_fct(contacts, as_of)
    totals = fct.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for _, c in table])
    return unpivot_columns(totals, table, label, "conversions")


def tile_by_age(contacts, as_of):
    return _tile_pivot(contacts, as_of, fixed.AGE_PIVOT, "age_group")


def tile_by_job(contacts, as_of):
    return _tile_pivot(contacts, as_of, fixed.JOB_PIVOT, "job_category")


def tile_by_risk(contacts, as_of):
    return _tile_pivot(contacts, as_of, fixed.RISK_PIVOT, "credit_risk_profile")


def tile_call_duration(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    return measure_query(contacts, ["call_duration_category"], ["total_contacts", "conversion_rate"],
                         as_of=as_of, window_days=fixed.TILE_WINDOW_DAYS)


def tile_daily_trend(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    fields = ["campaign_date", "overall_conversion_rate", "total_conversions"]
    return _window_fct(contacts, as_of).select(*fields).distinct().orderBy(*fields)


def tile_summary(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: window totals plus the best segment (highest rate; ties by
    age group, job category).

    The two one-row aggregates are stacked and folded into one row (each
    field is non-null in exactly one of them): each source is scanned once,
    with no join and no subquery per field.
    """
    w = _window_contacts(contacts, as_of, fixed.TILE_WINDOW_DAYS)
    totals = w.agg(*exprs({
        "overall_conversion_rate": pct_sql(f"count_if({YES})", "count(1)"), "total_contacts": "count(1)",
        "total_conversions": f"count_if({YES})", "avg_call_duration": "avg(call_duration_seconds)"}))
    best = _segment_rows(contacts, as_of).agg(F.expr(
        "min_by(named_struct('age_group', age_group, 'job_category', job_category, "
        "'rate', segment_conversion_rate), "
        "named_struct('r', -segment_conversion_rate, 'a', age_group, 'j', job_category)) AS b")).selectExpr(
        "b.age_group AS top_age_group", "b.job_category AS top_job_category",
        "b.rate AS top_segment_conversion_rate")
    stacked = totals.unionByName(best, allowMissingColumns=True)
    cols = totals.columns + best.columns
    return stacked.agg(*[F.expr(f"max({c}) AS {c}") for c in cols])


DASHBOARD_FILTERS = {"campaign_number": [1, 2], "age_group": [], "job_category": ["Professional", "Skilled"],
                     "credit_risk_profile": ["High Risk"]}


def tile_filtered(contacts: DataFrame, as_of: dt.date, filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Dashboard filters (date range, campaign, age group, job category, risk)."""
    return measure_query(contacts, ["campaign_number", "age_group", "job_category"],
                         ["total_contacts", "successful_contacts", "conversion_rate", "avg_call_duration"],
                         filters=filters if filters is not None else DASHBOARD_FILTERS,
                         as_of=as_of, window_days=fixed.TILE_WINDOW_DAYS)


# Explores: the date field each one must be filtered on (the last 30 days by
# default, always applied).
EXPLORE_DATE_FIELDS = {
    "staged_contacts": "processed_at",
    "segmented_contacts": "processed_at",
    "campaign_fact": "campaign_date",
    "segment_dimension": "last_updated",
}


def explore(name: str, frame: DataFrame, dims: Sequence[str], names: Sequence[str] = (),
            as_of: dt.date | None = None, days: int = fixed.TILE_WINDOW_DAYS,
            filters: Mapping[str, Sequence] | None = None, sorts: Sequence[Column] = (),
            limit: int | None = None) -> DataFrame:
    """An explore: ``measure_query`` over one source with its mandatory date
    filter (the last ``days`` days up to ``as_of``, today when not given).
    Contact explores accept measures; mart explores select fields (grouped,
    so distinct rows)."""
    field = EXPLORE_DATE_FIELDS[name]
    as_of = as_of or dt.date.today()
    frame = frame.where(last_days(field, as_of, days))
    return measure_query(frame, dims, names, filters=filters, sorts=sorts, limit=limit, date_col=field)
