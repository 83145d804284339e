"""Staging: filter, cast, normalise and rename raw contacts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from .keys import surrogate_key

# Text columns normalised with LOWER(TRIM(x)).
TEXT_COLUMNS = ["job", "marital", "education", "default", "housing", "loan", "contact",
                "month", "day_of_week", "poutcome", "y"]
INT_COLUMNS = ["age", "duration", "campaign", "pdays", "previous"]
FLOAT_COLUMNS = ["emp_var_rate", "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed"]
CARRY_COLUMNS = ["contact_id", "client_key"]

STAGED_COLUMNS = [
    "customer_id", "age", "job", "marital", "education", "has_default", "has_housing_loan",
    "has_personal_loan", "contact_type", "month", "day_of_week", "call_duration_seconds",
    "campaign_number", "days_since_last_contact", "previous_campaign_contacts",
    "previous_campaign_outcome", "employment_variation_rate", "consumer_price_index",
    "consumer_confidence_index", "euribor_3m_rate", "number_employed", "subscribed", "processed_at",
]


def as_of_timestamp(as_of: dt.date | None) -> Column:
    """Load time: the explicit report day at midnight, else query time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(dt.datetime(as_of.year, as_of.month, as_of.day)).cast("timestamp_ntz")


def normalise_text(c: Column, whitespace: bool = False) -> Column:
    """LOWER(TRIM(c)); ``whitespace=True`` also strips tabs and newlines."""
    if whitespace:
        return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.lower(F.trim(c))


def stage_filter(raw: DataFrame) -> DataFrame:
    """The staging row filter, on raw (un-normalised) columns so that it can
    reach the source scan."""
    lo, hi = fixed.STAGE_AGE_RANGE
    return raw.where(
        f"age IS NOT NULL AND age BETWEEN {lo} AND {hi} AND job IS NOT NULL AND marital IS NOT NULL "
        f"AND education IS NOT NULL AND duration >= {fixed.STAGE_MIN_DURATION} "
        f"AND campaign >= {fixed.STAGE_MIN_CAMPAIGN}")


def _normalise_sql(col: str, whitespace: bool) -> str:
    if whitespace:
        return f"lower(regexp_replace({col}, '^\\\\s+|\\\\s+$', ''))"
    return f"lower(trim({col}))"


def stage(raw: DataFrame, as_of: dt.date | None = None, with_key: bool = True,
          whitespace: bool = False, eager_key: bool = True) -> DataFrame:
    """Staged contacts (23 columns plus carried lineage columns).

    ``customer_id`` is the 1-based position in (age, job, marital) order of
    the raw values; ties are broken by ``contact_id`` when present, else by
    every remaining column. ``with_key=False`` skips it: marts that only
    count rows do not need it, and without it filters on staged columns
    still reach the source scan (a filter cannot cross the numbering).
    ``eager_key=False`` numbers without a job of its own, for lazy views.
    ``processed_at`` is the contact timestamp when the source carries one,
    otherwise the load time.
    """
    kept = stage_filter(raw)
    renames = dict(fixed.STAGE_RENAMES)
    exprs: list[str] = []
    for c, _ in fixed.RAW_COLUMN_TYPES:
        src = f"`{c}`"
        if c in TEXT_COLUMNS:
            e = _normalise_sql(src, whitespace)
        elif c in INT_COLUMNS:
            e = f"CAST({src} AS BIGINT)"
        else:
            e = f"CAST({src} AS DOUBLE)"
        exprs.append(f"{e} AS `{renames.get(c, c)}`")
    carried = [c for c in CARRY_COLUMNS if c in raw.columns]

    if with_key:
        tie = carried[:1] or [c for c in raw.columns if c not in fixed.STAGE_KEY_ORDER]
        kept = surrogate_key(kept, "customer_id", fixed.STAGE_KEY_ORDER, tie, eager=eager_key)
    head = ["customer_id"] if with_key else []
    if "processed_at" in raw.columns:
        out = kept.selectExpr(*head, *exprs, "CAST(processed_at AS TIMESTAMP_NTZ) AS processed_at", *carried)
    else:
        out = kept.selectExpr(*head, *exprs, *carried).withColumn("processed_at", as_of_timestamp(as_of))
        out = out.select(*head, *[renames.get(c, c) for c, _ in fixed.RAW_COLUMN_TYPES], "processed_at", *carried)
    return out
