"""Intermediate layer: rule-based customer segments on staged contacts.

The studied mart computes four segment CTEs and re-attaches them with four
self-joins on the surrogate key. Joining a relation to a projection of itself
on a unique key is the identity, so here every rule table is one column of a
single projection: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from .. import fixed
from ..functions.rules import RuleTable, above, apply_rules, bands, equals, members

INT_COLUMNS = [
    "customer_id", "age", "job", "marital", "education", "subscribed", "call_duration_seconds",
    "campaign_number", "processed_at", "age_group", "age_category", "job_category", "income_level",
    "credit_risk_profile", "customer_engagement_level", "previous_outcome_category", "is_converted",
    "call_duration_category",
]


_D, _H, _L = (f"{c} = 'yes'" for c in ("has_default", "has_housing_loan", "has_personal_loan"))


def risk_rules() -> RuleTable:
    return RuleTable([(fixed.RISK_HIGH, f"{_D} OR {_H} OR {_L}"), (fixed.RISK_MEDIUM, f"{_H} OR {_L}")],
                     fixed.RISK_LOW)


def risk_rules_v2() -> RuleTable:
    """Alternative risk table (data, not code): default alone is High, a
    housing or personal loan is Medium, so every label is reachable."""
    return RuleTable([(fixed.RISK_HIGH, _D), (fixed.RISK_MEDIUM, f"{_H} OR {_L}")], fixed.RISK_LOW)


def segment_rules(risk: RuleTable | None = None) -> dict[str, RuleTable]:
    age, job = "age", "job"
    prev, outcome = "previous_campaign_contacts", "previous_campaign_outcome"
    return {
        "age_group": bands(age, fixed.AGE_GROUPS, fixed.AGE_GROUP_ELSE),
        "age_category": bands(age, fixed.AGE_CATEGORIES, fixed.AGE_CATEGORY_ELSE),
        "job_category": members(job, fixed.JOB_CATEGORIES, fixed.JOB_CATEGORY_ELSE),
        "income_level": members(job, fixed.INCOME_LEVELS, fixed.INCOME_LEVEL_ELSE),
        "credit_risk_profile": risk or risk_rules(),
        "customer_engagement_level": bands(prev, fixed.ENGAGEMENT_LEVELS, fixed.ENGAGEMENT_ELSE),
        "previous_outcome_category": equals(outcome, fixed.PREVIOUS_OUTCOMES, fixed.PREVIOUS_OUTCOME_ELSE),
        "call_duration_category": above("call_duration_seconds", fixed.CALL_DURATIONS,
                                        fixed.CALL_DURATION_ELSE),
    }


IS_CONVERTED = "CASE WHEN subscribed = 'yes' THEN 1 ELSE 0 END"


def segment(staged: DataFrame, rules: Mapping[str, RuleTable] | None = None) -> DataFrame:
    """Intermediate contacts: 18 columns (``customer_id`` only if staged with
    a key) plus carried lineage columns."""
    tables = dict(rules or segment_rules())
    if not all(isinstance(p, str) for t in tables.values() for _, p in t.rules):
        staged = apply_rules(staged, tables)
        tables = {}
    have = set(staged.columns)
    derived = {name: t.sql() for name, t in tables.items()}
    derived["is_converted"] = IS_CONVERTED
    out = []
    for c in INT_COLUMNS:
        if c in derived:
            out.append(f"{derived[c]} AS {c}")
        elif c in have:
            out.append(c)
    carried = [c for c in ("contact_id", "client_key") if c in have]
    # One projection: every rule table is a CASE expression over staged columns.
    return staged.selectExpr(*out, *carried)
