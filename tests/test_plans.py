"""Plan-shape rules for every query of the mart (checked on the physical plan)."""

import pytest

from callsheet.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# Streams and sinks return a read-back of what they wrote; their plans are scans.
DAY_FILTERED = ["kpi_daily", "top_segments", "campaign_report", "dq_history_yesterday", "tile_conversion",
                "tile_by_age", "tile_by_job", "tile_by_risk", "tile_call_duration", "tile_daily_trend",
                "tile_filtered"]


def _plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python_udfs(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", DAY_FILTERED)
def test_day_filters_reach_the_scan(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters") and "o_orderdate" in ln]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]


@pytest.mark.parametrize("name", ["segment_metrics", "fct_campaigns", "dq_suite", "kpi_by_timeframe"])
def test_scans_read_only_needed_columns(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "o_orderkey" in ln]
    assert schemas and "o_orderstatus" not in schemas[0]


def test_fact_uses_one_exchange_for_window_and_order(spark):
    plan = _plan(spark, QUERIES["fct_campaigns"](spark, SF_SMALL))
    assert plan.count("rangepartitioning(") == 1


def test_dimension_scans_contacts_once(spark):
    plan = _plan(spark, QUERIES["dim_segments"](spark, SF_SMALL))
    assert "orders.parquet" not in plan  # every branch reads the checkpointed segment table


@pytest.mark.parametrize("name", ["dq_report", "dq_score", "dq_ingest_gate", "dq_history_yesterday"])
def test_quality_report_scans_its_source_once(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if ln.startswith("Location") and "orders.parquet" in ln]
    assert len(scans) == 1
