"""Plan-shape rules of the operators' queries."""

import pytest

from callsheet.llm import shards
from callsheet.llm.queries import QUERIES
from tests.conftest import SF_SMALL

NATIVE = ["op7_chat_format", "op8_kd_shards", "op9_host_rules"]


def _plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_no_pair_joins(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = _plan(spark, QUERIES[name](spark, SF_SMALL))
    for bad in ("Python", "Pandas", "Arrow"):
        assert bad not in plan, f"{name}: {bad}"


def test_shard_state_is_a_local_table(spark):
    """A table made from a list of rows is an RDD that Python workers read; the plan doesn't name them."""
    nodes = [shards.Node(0, 3, hi=1 << 50, cut=None), shards.Node(3, 4, dim=2, lo=-1, hi=9, cut=1 << 45)]
    state = shards._state(spark.range(1), nodes, "lo", "hi", "width", "cut", "half")
    plan = _plan(spark, state)
    assert "LocalTableScan" in plan and "RDD" not in plan
    assert state.dtypes == [("node", "int"), ("dim", "int"), ("lo", "bigint"), ("hi", "bigint"), ("width", "bigint"),
                            ("cut", "bigint"), ("half", "int")]
    assert sorted(map(tuple, state.collect())) == [(0, 0, 0, 1 << 50, (1 << 40) + 1, None, 1), (3, 2, -1, 9, 1, 1 << 45, 2)]
    unfound = shards._state(spark.range(1), nodes[:1], "cut")
    assert unfound.dtypes[2] == ("cut", "bigint") and unfound.first()["cut"] is None
