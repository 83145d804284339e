"""The two marts: customer-segment dimension and campaign-performance fact.

Both start from the intermediate contacts. All heavy work is one scan with
map-side partial aggregation; everything after the first aggregate runs on
tables whose row count is bounded by the label domains of the rule tables
(segments) or by campaigns x days (fact).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.metrics import conversion_aggs, exprs, pct_sql, per_hour_sql, rule_pivot_sql
from ..functions.rules import floors
from ..operators.rollup import axis_rollups, share_of_total, trend
from ..session import materialize

SEGMENT_KEYS = ["age_group", "age_category", "job_category", "income_level", "credit_risk_profile",
                "customer_engagement_level", "call_duration_category"]
DAILY_KEYS = ["campaign_date", "campaign_number", "age_group", "job_category", "income_level",
              "credit_risk_profile", "customer_engagement_level", "call_duration_category"]

SEGMENT_METRICS = {
    "size": "segment_size", "unique": "unique_customers", "yes": "segment_conversions",
    "no": "segment_non_conversions", "rate": "segment_conversion_rate",
    "avg": "avg_call_duration_segment", "sum": "total_call_duration_segment",
    "per_minute": "segment_conversion_per_minute", "updated": "last_updated",
}
DAILY_METRICS = {
    "size": "total_contacts", "unique": "unique_customers", "yes": "successful_contacts",
    "no": "unsuccessful_contacts", "rate": "conversion_rate", "avg": "avg_call_duration",
    "sum": "total_call_duration", "per_minute": "conversion_per_minute", "updated": "last_updated",
}

# Axis roll-ups of the dimension: (name, right-hand keys, join keys, output names).
AXES = [
    ("age", ["age_group", "age_category"], ["age_group"],
     "age_segment_conversion_rate", "avg_age_call_duration"),
    ("job", ["job_category", "income_level"], ["job_category"],
     "job_segment_conversion_rate", "avg_job_call_duration"),
    ("risk", ["credit_risk_profile"], ["credit_risk_profile"],
     "risk_segment_conversion_rate", "avg_risk_call_duration"),
    ("engagement", ["customer_engagement_level"], ["customer_engagement_level"],
     "engagement_segment_conversion_rate", "avg_engagement_call_duration"),
]

_N_DUR = "_n_duration"


def segment_metrics(contacts: DataFrame, as_of: dt.date | None = None, keep_count: bool = False) -> DataFrame:
    """7-key segment metrics. ``keep_count`` also keeps the count of
    non-null durations, needed to re-aggregate averages exactly."""
    aggs = conversion_aggs(SEGMENT_METRICS, as_of=as_of, columns=contacts.columns)
    if keep_count:
        aggs.append(F.expr(f"count(call_duration_seconds) AS {_N_DUR}"))
    return contacts.groupBy(*SEGMENT_KEYS).agg(*aggs)


def segment_axes(metrics: DataFrame) -> dict[str, DataFrame]:
    """Age, job, risk and engagement roll-ups re-aggregated from the segment table."""
    axes = {name: keys for name, keys, *_ in AXES}
    return axis_rollups(metrics, axes, "segment_size", "segment_conversions",
                        "total_call_duration_segment", _N_DUR)


def _dimension(contacts: DataFrame, as_of: dt.date | None, exact: bool) -> DataFrame:
    # The only pass over the contacts; every later step reads this table.
    return dimension_from_metrics(materialize(segment_metrics(contacts, as_of, keep_count=True)), exact)


def dimension_from_metrics(sm: DataFrame, exact: bool) -> DataFrame:
    """The dimension from a (materialized) segment table that carries the
    non-null duration count."""
    rolled = segment_axes(sm)
    out = sm
    for name, right_keys, join_keys, rate_name, avg_name in AXES:
        keys = right_keys if exact else join_keys
        right = rolled[name].selectExpr(*keys, f"rate AS {rate_name}", f"avg_duration AS {avg_name}")
        # The right side has at most one row per label combination of a rule
        # table (<= 18 rows), a size bound that holds at any data volume.
        out = out.join(F.broadcast(right), keys, "left")
    perf = floors("segment_conversion_rate", fixed.SEGMENT_PERFORMANCE, fixed.SEGMENT_PERFORMANCE_ELSE).sql()
    out = out.select("*", *exprs({
        "segment_performance_category": perf,
        "segment_conversions_per_hour": per_hour_sql("segment_conversions", "total_call_duration_segment"),
    }))
    out = share_of_total(out, "segment_size", "segment_size_percentage")
    cols = SEGMENT_KEYS + list(SEGMENT_METRICS.values()) + [
        "age_segment_conversion_rate", "avg_age_call_duration", "job_segment_conversion_rate",
        "avg_job_call_duration", "risk_segment_conversion_rate", "avg_risk_call_duration",
        "engagement_segment_conversion_rate", "avg_engagement_call_duration",
        "segment_performance_category", "segment_conversions_per_hour", "segment_size_percentage"]
    return out.select(*cols).orderBy(F.desc("segment_conversion_rate"), *SEGMENT_KEYS)


def dim_segments(contacts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Segment dimension as the studied mart builds it: the age and job
    roll-ups are joined on half of their keys, so a segment row repeats once
    per matching (age_category) x (income_level), and the share of total is
    taken over the repeated rows."""
    return _dimension(contacts, as_of, exact=False)


def dim_segments_exact(contacts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Segment dimension with every roll-up joined on its full key: one row
    per segment, shares summing to 100."""
    return _dimension(contacts, as_of, exact=True)


def daily_performance(contacts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Per day x campaign x six segments."""
    return (contacts.groupBy(F.expr("to_date(processed_at) AS campaign_date"), *DAILY_KEYS[1:])
            .agg(*conversion_aggs(DAILY_METRICS, as_of=as_of, columns=contacts.columns)))


def campaign_summary(contacts: DataFrame, as_of: dt.date | None = None, mean_digits: int | None = 6,
                     daily: DataFrame | None = None) -> DataFrame:
    """Campaign x day roll-up of the daily table, with the static pivots.

    ``avg_call_duration`` is the unweighted mean of the daily segment means,
    as the studied mart defines it; ``mean_digits`` rounds it so the value
    does not depend on the order in which partial sums are combined.
    ``weighted_avg_call_duration`` is the per-contact mean.
    """
    daily = daily if daily is not None else daily_performance(contacts, as_of)
    mean = "avg(avg_call_duration)"
    aggs = {
        "total_contacts": "sum(total_contacts)",
        "total_conversions": "sum(successful_contacts)",
        "overall_conversion_rate": pct_sql("sum(successful_contacts)", "sum(total_contacts)"),
        "avg_call_duration": f"ROUND({mean}, {mean_digits})" if mean_digits is not None else mean,
        "total_call_duration_hours": "sum(total_call_duration)",
        **rule_pivot_sql("age_group", fixed.AGE_PIVOT, "successful_contacts"),
        **rule_pivot_sql("job_category", fixed.JOB_PIVOT, "successful_contacts"),
        **rule_pivot_sql("credit_risk_profile", fixed.RISK_PIVOT, "successful_contacts"),
        "last_updated": "max(last_updated)",
    }
    return daily.groupBy("campaign_number", "campaign_date").agg(*exprs(aggs))


FCT_COLUMNS = [
    "campaign_number", "campaign_date", "total_contacts", "total_conversions", "overall_conversion_rate",
    "avg_call_duration", "total_call_duration_hours", *[c for _, c in fixed.AGE_PIVOT],
    *[c for _, c in fixed.JOB_PIVOT], *[c for _, c in fixed.RISK_PIVOT], "last_updated",
    "performance_category", "conversions_per_hour", "previous_conversion_rate", "conversion_rate_change",
]


def with_performance(summary: DataFrame) -> DataFrame:
    perf = floors("overall_conversion_rate", fixed.CAMPAIGN_PERFORMANCE, fixed.CAMPAIGN_PERFORMANCE_ELSE).sql()
    return summary.select("*", *exprs({
        "performance_category": perf,
        "conversions_per_hour": per_hour_sql("total_conversions", "total_call_duration_hours"),
    }))


def fct_campaigns(contacts: DataFrame | None, as_of: dt.date | None = None, with_trend: bool = True,
                  sort: bool = True, daily: DataFrame | None = None) -> DataFrame:
    """Campaign-performance fact.

    ``with_trend=False`` leaves out the LAG columns; a day filter on that
    frame then reaches the source scan (it cannot pass a window ordered by
    day). ``daily`` may be given precomputed (see ``plans.pipeline``).
    """
    out = with_performance(campaign_summary(contacts, as_of, daily=daily))
    if with_trend or sort:
        # One range exchange on the (small) campaign x day table serves both
        # the LAG window (clustered by campaign) and the final order
        # (campaign, day): a hot campaign only concentrates its day rows.
        out = out.repartitionByRange("campaign_number")
    if with_trend:
        out = trend(out, ["campaign_number"], ["campaign_date"], "overall_conversion_rate",
                    "previous_conversion_rate", "conversion_rate_change")
        out = out.select(*FCT_COLUMNS)
    else:
        out = out.select(*[c for c in FCT_COLUMNS if c not in ("previous_conversion_rate",
                                                               "conversion_rate_change")])
    return out.orderBy("campaign_number", "campaign_date") if sort else out


def fct_campaigns_extended(contacts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Campaign x day extras kept out of the parity fact: the per-contact
    (weighted) mean call duration next to the mean of daily segment means,
    and the conversions of the ``Other`` job category that the fact's job
    pivot leaves out. One aggregate over the daily table."""
    daily = daily_performance(contacts, as_of)
    return daily.groupBy("campaign_number", "campaign_date").agg(*exprs({
        "total_contacts": "sum(total_contacts)",
        "avg_call_duration": "ROUND(avg(avg_call_duration), 6)",
        "weighted_avg_call_duration": "CAST(sum(total_call_duration) AS DOUBLE) / sum(total_contacts)",
        "other_conversions": f"sum(CASE WHEN job_category = '{fixed.JOB_CATEGORY_ELSE}' "
                             "THEN successful_contacts ELSE 0 END)",
    }))
