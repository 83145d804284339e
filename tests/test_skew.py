"""A third of all rows on one key: the plans stay distributed and exact."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callsheet.operators.segments import segment
from callsheet.operators.staging import stage
from callsheet.plans import marts
from callsheet.plans.catalog import QUERIES
from callsheet.sources.star import contacts_from_star, read_table
from tests.conftest import SF_MID, SF_SMALL


def _skewed_contacts(spark):
    orders = read_table(spark, SF_MID, "orders")
    hot = orders.agg(F.min("o_custkey")).first()[0]
    # a third of the orders move to one customer (data derived from the given tables)
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot))
                               .otherwise(F.col("o_custkey")))
    return contacts_from_star(skewed, read_table(spark, SF_MID, "customer"))


def test_hot_customer_sort_merge_join_and_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        raw = _skewed_contacts(spark)
        st = stage(raw)
        st.select("customer_id").write.format("noop").mode("overwrite").save()
        brute = (raw.where("age IS NOT NULL AND age BETWEEN 18 AND 95 AND job IS NOT NULL AND marital IS NOT NULL "
                           "AND education IS NOT NULL AND duration >= 0 AND campaign >= 1")
                 .select("contact_id", F.row_number().over(Window.orderBy("age", "job", "marital", "contact_id"))
                         .alias("rn")))
        assert st.join(brute, "contact_id").where("rn != customer_id").count() == 0
        assert st.count() == brute.count()
        sm = marts.segment_metrics(segment(stage(raw, with_key=False)))
        assert sm.agg(F.sum("segment_size")).first()[0] == brute.count()
        plan = sm._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes"]:
            spark.conf.unset(k)


def test_explicit_hot_key_split_equals_plain_join(spark):
    from callsheet.operators.joins import skew_safe_join
    orders = read_table(spark, SF_MID, "orders")
    hot = orders.agg(F.min("o_custkey")).first()[0]
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot))
                               .otherwise(F.col("o_custkey"))).select("o_orderkey", "o_custkey")
    cust = read_table(spark, SF_MID, "customer").select("c_custkey", "c_nationkey")
    split = skew_safe_join(skewed, cust, "o_custkey", "c_custkey", force_split=True)
    plain = skewed.join(cust, skewed.o_custkey == cust.c_custkey)
    assert split.count() == plain.count() == skewed.count()
    assert split.exceptAll(plain.select(*split.columns)).count() == 0
    plan = spark._jvm.PythonSQLUtils.explainString(split._jdf.queryExecution(), "formatted")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_split_used_when_aqe_skew_handling_is_off(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        raw = _skewed_contacts(spark)
        plan = spark._jvm.PythonSQLUtils.explainString(raw._jdf.queryExecution(), "formatted")
        assert "LeftAnti" in plan
        assert raw.count() == read_table(spark, SF_MID, "orders").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_streams_split_or_broadcast_without_aqe(spark, monkeypatch):
    from callsheet.operators import joins
    orders = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, SF_MID, "customer").select("c_custkey", "c_nationkey")
    plain = orders.join(cust, orders.o_custkey == cust.c_custkey)
    assert joins._streamed(orders, cust, "o_custkey", "c_custkey").exceptAll(plain).count() == 0
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    salted = joins._streamed(orders, cust, "o_custkey", "c_custkey")
    plan = spark._jvm.PythonSQLUtils.explainString(salted._jdf.queryExecution(), "formatted")
    assert "_salt" in plan and salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_a_streams_copies_are_merged_whatever_their_estimate(spark, monkeypatch):
    """The files of the dimension fit a broadcast by their size; the copies made of them need not."""
    from callsheet.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    orders = spark.createDataFrame([(n, n % 3) for n in range(40)] + [(40, None), (41, 99)], "o_orderkey long, o_custkey long")
    cust = spark.range(20).selectExpr("id AS c_custkey", "id + 7 AS nk")
    salted = joins._streamed(orders, cust, "o_custkey", "c_custkey")
    plan = spark._jvm.PythonSQLUtils.explainString(salted._jdf.queryExecution(), "formatted")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, salted.collect())) == [(n, n % 3, n % 3, n % 3 + 7) for n in range(40)]


@pytest.mark.parametrize("name", ["stream_dq", "stream_gate", "stream_gated_kpis", "stream_kpi_daily"])
def test_streams_with_many_customers_broadcast_nothing(spark, monkeypatch, name):
    from callsheet.operators import joins
    rows = lambda: sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()), key=repr)
    usual = rows()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1k")  # a larger one is an error
    try:
        assert usual and rows() == usual
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")


@pytest.mark.parametrize("name", ["stream_gate", "stream_gated_kpis", "stream_kpi_daily"])
def test_streams_with_many_customers_copy_none(spark, monkeypatch, name):
    """Each batch is joined as a plain frame: a stream's join would repeat a large dimension once per salt."""
    from callsheet.operators import joins
    rows = lambda: sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()), key=repr)
    usual, joined, real = rows(), [], joins.skew_safe_join

    def join(fact, dim, *more, **named):
        joined.append((fact.isStreaming, real(fact, dim, *more, **named)))
        return joined[-1][1]

    monkeypatch.setattr("callsheet.sources.star.skew_safe_join", join)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    assert rows() == usual and joined
    for streaming, frame in joined:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not streaming and "_salt" not in plan and "strategy=merge" in plan


def test_unique_customers_counts_real_keys(spark):
    from callsheet.plans import kpis
    df = spark.createDataFrame([("a", "yes"), ("a", "yes"), ("b", "yes"), ("c", "no")], "customer_id string, subscribed string")
    assert tuple(kpis.successes(df).first()) == (3, 2)
