"""Threshold alerts as rows: ``(alert_date, alert_type, metric_value, threshold, message)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_COLUMNS = ["alert_date", "alert_type", "metric_value", "threshold", "message"]


@dataclass(frozen=True)
class AlertRule:
    name: str
    metric: str
    threshold: float
    message: str  # prefix; the metric value and a percent sign follow
    below: bool = True  # fire when metric < threshold (else metric > threshold)


def threshold_alerts(metrics: DataFrame, rules: Sequence[AlertRule], date: Column) -> DataFrame:
    """One alert row per (metric row, firing rule); a filter per rule, no shuffle."""
    out = None
    for r in rules:
        value = F.col(r.metric).cast("double")
        fired = value < r.threshold if r.below else value > r.threshold
        rows = metrics.where(fired).select(
            date.alias("alert_date"), F.lit(r.name).alias("alert_type"), value.alias("metric_value"),
            F.lit(float(r.threshold)).alias("threshold"),
            F.concat(F.lit(r.message), value.cast("string"), F.lit("%")).alias("message"))
        out = rows if out is None else out.unionByName(rows)
    return out


def no_data_alert(df: DataFrame, day: dt.date, name: str = "no_data",
                  message: str = "No data found for yesterday") -> DataFrame:
    """A row when ``df`` is empty: a global count is exactly one row even on
    empty input, so the check needs no driver round trip."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    return n.where(F.col("_n") == 0).select(
        F.lit(day).alias("alert_date"), F.lit(name).alias("alert_type"),
        F.lit(None).cast("double").alias("metric_value"), F.lit(None).cast("double").alias("threshold"),
        F.lit(message).alias("message"))
