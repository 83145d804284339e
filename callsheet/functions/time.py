"""Report-day arithmetic and time truncation, as range predicates that reach the scan.

Day filters are written as half-open ranges on the raw timestamp
(``ts >= d AND ts < d + 1``) rather than ``to_date(ts) = d``, so Parquet
row-group statistics (and partition pruning on a day-partitioned table)
apply.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMEFRAMES = ["raw", "time", "date", "week", "month", "quarter", "year"]


def _ts(day: dt.date) -> Column:
    return F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")


def on_day(ts: str | Column, day: dt.date) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c >= _ts(day)) & (c < _ts(day + dt.timedelta(days=1)))


def yesterday(as_of: dt.date) -> dt.date:
    return as_of - dt.timedelta(days=1)


def last_days(ts: str | Column, as_of: dt.date, days: int) -> Column:
    """The ``days`` calendar days ending with ``as_of`` (inclusive)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c >= _ts(as_of - dt.timedelta(days=days - 1))) & (c < _ts(as_of + dt.timedelta(days=1)))


def timeframe(ts: str | Column, frame: str) -> Column:
    """A time dimension: raw, time (to the second), date, week (Monday),
    month, quarter or year."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if frame == "raw":
        return c
    if frame == "time":
        return F.date_trunc("second", c)
    if frame == "date":
        return F.to_date(c)
    return F.to_date(F.date_trunc(frame, c))
