"""Daily report and alert queries (yesterday relative to an explicit ``as_of``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.metrics import YES, exprs, pct_sql, unique_sql
from ..functions.time import on_day, yesterday
from ..operators.alerts import AlertRule, threshold_alerts, no_data_alert
from ..session import materialize
from . import marts


def kpi_daily(staged: DataFrame, as_of: dt.date) -> DataFrame:
    """Yesterday's KPI row."""
    day = yesterday(as_of)
    return (staged.where(on_day("processed_at", day))
            .groupBy(F.expr("to_date(processed_at) AS report_date"))
            .agg(*exprs({"total_contacts": "count(1)", "successful_contacts": f"count_if({YES})",
                         "conversion_rate": pct_sql(f"count_if({YES})", "count(1)"),
                         "avg_call_duration": "avg(call_duration_seconds)",
                         "unique_customers": unique_sql(staged.columns)})))


def segment_rates(contacts: DataFrame, keys: list[str]) -> DataFrame:
    return contacts.groupBy(*keys).agg(*exprs({
        "segment_size": "count(1)", "segment_conversions": f"count_if({YES})",
        "segment_conversion_rate": pct_sql(f"count_if({YES})", "count(1)")}))


def top_segments(contacts: DataFrame, as_of: dt.date, n: int = fixed.TOP_SEGMENTS) -> DataFrame:
    """Top age x job segments of yesterday by conversion rate (ties by key)."""
    day_rows = contacts.where(on_day("processed_at", yesterday(as_of)))
    return (segment_rates(day_rows, ["age_group", "job_category"])
            .orderBy(F.desc("segment_conversion_rate"), "age_group", "job_category").limit(n))


def campaign_report(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    """Yesterday's campaigns, best rate first; ``highlight`` marks Excellent/Good.

    A campaign-day row depends on that day's contacts only, so the day filter
    is applied to the contacts (and reaches the scan) before the roll-up.
    """
    day_rows = contacts.where(on_day("processed_at", yesterday(as_of)))
    fct = marts.fct_campaigns(day_rows, as_of, with_trend=False, sort=False)
    return (fct.select("campaign_number", "total_contacts", "total_conversions", "overall_conversion_rate",
                       "performance_category", "avg_call_duration",
                       F.col("performance_category").isin("Excellent", "Good").alias("highlight"))
            .orderBy(F.desc("overall_conversion_rate"), "campaign_number"))


def conversion_by_campaign(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("campaign_number").agg(
        *exprs({"conversion_rate": pct_sql(f"count_if({YES})", "count(1)")}))


def successes(contacts: DataFrame) -> DataFrame:
    """Successful contacts and unique customers among them."""
    return contacts.where(YES).agg(*exprs({"successful_contacts": "count(1)",
                                           "unique_customers": unique_sql(contacts.columns)}))


def unique_clients(contacts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Exact distinct real clients per key. Spark plans the distinct count as
    a group-by on (key, client) first, so a hot key is spread by client."""
    keys = keys or ["campaign_number"]
    return contacts.groupBy(*keys).agg(*exprs({"total_contacts": "count(1)",
                                               "unique_clients": "count(DISTINCT client_key)"}))


def age_job(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("age_group", "job_category").agg(*exprs({
        "customer_count": "count(1)", "segment_conversion_rate": pct_sql(f"count_if({YES})", "count(1)")}))


CONVERSION_RULE = AlertRule("low_conversion", "conversion_rate", fixed.CONVERSION_FLOOR,
                            "Low conversion rate alert: ")
QUALITY_RULE = AlertRule("low_quality", "quality_score", fixed.QUALITY_FLOOR, "Data quality alert: ")


def alerts(daily_kpis: DataFrame, score: DataFrame, as_of: dt.date) -> DataFrame:
    """Low-conversion, low-quality and no-data alerts for yesterday.

    The KPI rows (at most one per report day) are checkpointed once so the
    threshold and no-data checks do not both re-read the day's contacts.
    """
    day = yesterday(as_of)
    daily_kpis = materialize(daily_kpis)
    return (threshold_alerts(daily_kpis, [CONVERSION_RULE], F.col("report_date"))
            .unionByName(threshold_alerts(score, [QUALITY_RULE], F.lit(day)))
            .unionByName(no_data_alert(daily_kpis, day)))
