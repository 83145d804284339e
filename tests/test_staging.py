"""Staging filter, normalisation and the distributed surrogate key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callsheet.operators import keys
from callsheet.operators.keys import surrogate_key
from callsheet.operators.staging import stage
from callsheet.schema import RAW_SCHEMA_WITH_LINEAGE
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL


def test_surrogate_key_equals_global_row_number(spark):
    # A hot key (a third of the rows share k) and many partitions.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 3001).alias("tie"))
    got = surrogate_key(df, "sk", ["k"], ["tie"])
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "tie")))
    joined = got.join(want, ["k", "tie"])
    assert joined.count() == 3000
    assert joined.where(F.col("sk") != F.col("rn")).count() == 0


def test_stage_filter_and_normalise(spark):
    rows = [
        (30, " ADMIN. ", "Married", "basic.4y", "no", "yes", "no", "cellular", "MAY", "Mon", 10, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, " YES", 1, 1, None),
        (17, "admin.", "single", "basic.4y", "no", "no", "no", "cellular", "may", "mon", 10, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 2, 1, None),   # too young
        (96, "admin.", "single", "basic.4y", "no", "no", "no", "cellular", "may", "mon", 10, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 3, 1, None),   # too old
        (40, "admin.", "single", None, "no", "no", "no", "cellular", "may", "mon", 10, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 4, 1, None),   # no education
        (40, "admin.", "single", "basic.4y", "no", "no", "no", "cellular", "may", "mon", -1, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 5, 1, None),   # negative duration
        (40, "admin.", "single", "basic.4y", "no", "no", "no", "cellular", "may", "mon", 0, 0, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 6, 1, None),   # campaign 0
        (40, "admin.", "single", "basic.4y", "no", "no", "no", "cellular", "may", "mon", None, 1, -1, 0,
         "nonexistent", 1.1, 93.9, -36.4, 4.8, 5191.0, "no", 7, 1, None),   # null duration
    ]
    raw = spark.createDataFrame(rows, RAW_SCHEMA_WITH_LINEAGE)
    out = stage(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.job, r.marital, r.month, r.day_of_week, r.subscribed) == ("admin.", "married", "may", "mon", "yes")
    assert r.customer_id == 1 and r.has_housing_loan == "yes" and r.call_duration_seconds == 10


def test_stage_whitespace_option(spark):
    raw = spark.createDataFrame([(30, "\tadmin.\n", "single", "x", 5, 1)],
                                "age bigint, job string, marital string, education string, duration bigint, "
                                "campaign bigint")
    for c, t in [("default", "string"), ("housing", "string"), ("loan", "string"), ("contact", "string"),
                 ("month", "string"), ("day_of_week", "string"), ("pdays", "bigint"), ("previous", "bigint"),
                 ("poutcome", "string"), ("emp_var_rate", "double"), ("cons_price_idx", "double"),
                 ("cons_conf_idx", "double"), ("euribor3m", "double"), ("nr_employed", "double"), ("y", "string")]:
        raw = raw.withColumn(c, F.lit(None).cast(t))
    assert stage(raw, with_key=False).first().job == "\tadmin.\n"
    assert stage(raw, with_key=False, whitespace=True).first().job == "admin."


def test_keys_unique_and_dense_on_star_data(spark):
    st = stage(raw_contacts(spark, SF_SMALL))
    agg = st.agg(F.count("*").alias("n"), F.countDistinct("customer_id").alias("d"),
                 F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi")).first()
    assert agg.n == agg.d == agg.hi and agg.lo == 1


def test_key_free_staging_pushes_day_filter_to_scan(spark):
    import datetime as dt
    from callsheet.functions.time import on_day
    st = stage(raw_contacts(spark, SF_SMALL), with_key=False).where(on_day("processed_at", dt.date(1998, 6, 9)))
    plan = spark._jvm.PythonSQLUtils.explainString(st._jdf.queryExecution(), "formatted")
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters") and "o_orderdate" in ln]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]


def test_surrogate_key_with_aqe_initial_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "5")
    try:
        df = spark.range(0, 500).select((F.col("id") % 7).alias("k"), F.col("id").alias("tie"))
        got = surrogate_key(df, "sk", ["k"], ["tie"])
        want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "tie")))
        assert got.join(want, ["k", "tie"]).where("sk != rn").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_keys_reproducible_across_recomputation(spark):
    """What a recomputed task (lost executor) relies on: an independent
    computation assigns every contact the same key."""
    a = stage(raw_contacts(spark, SF_SMALL)).select("contact_id", F.col("customer_id").alias("a"))
    first = {r.contact_id: r.a for r in a.collect()}
    spark.catalog.clearCache()
    b = stage(raw_contacts(spark, SF_SMALL), ).select("contact_id", F.col("customer_id").alias("b"))
    second = {r.contact_id: r.b for r in b.collect()}
    assert first == second


def _numbered(rows):
    def low(x):
        return (x is not None, x or 0)
    order = sorted(range(len(rows)), key=lambda i: (low(rows[i][0]), (rows[i][1] is not None, rows[i][1] or ""), low(rows[i][2])))
    return {i: n + 1 for n, i in enumerate(order)}


@pytest.mark.parametrize("eager", [True, False])
@pytest.mark.parametrize("per_group", [1, 40, 10 ** 6])
def test_surrogate_key_with_hot_keys_and_outlying_ties(spark, eager, per_group):
    import random
    rng = random.Random(3)
    rows = [(rng.choice((30, 30, 30, None, 41)), rng.choice(("a", "a", None, "b")), t) for t in
            [*range(700), 10 ** 17, -10 ** 17, 2 ** 63 - 1, -2 ** 63, None]]
    want = _numbered(rows)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k bigint, j string, tie bigint, i int").repartition(5)
    got = surrogate_key(df, "sk", ["k", "j"], ["tie"], rows_per_group=per_group, eager=eager)
    assert {r.i: r.sk for r in got.collect()} == want and got.columns == ["k", "j", "tie", "i", "sk"]


def test_one_outlying_id_does_not_crowd_a_slice(spark):
    df = spark.range(0, 20_000).select(F.lit(30).alias("k"), F.col("id").alias("tie"))
    df = df.unionByName(spark.createDataFrame([(30, 2 ** 62)], "k int, tie bigint"))
    narrow = df.withColumnRenamed("tie", keys._TIE)
    edges = keys._hot_edges(narrow, ["k"], narrow.groupBy("k").agg(F.count(F.lit(1)).alias(keys._N)), 500)
    sizes = [r["count"] for r in keys._with_groups(df, ["k"], F.col("tie"), edges).groupBy(keys._GROUP).count().collect()]
    assert sum(sizes) == 20_001 and 30 <= len(sizes) <= 60 and max(sizes) < 1000
    got = surrogate_key(df, "sk", ["k"], ["tie"], rows_per_group=500)
    assert got.where("tie < 20000 and sk != tie + 1 or tie > 20000 and sk != 20001").count() == 0


def test_key_of_several_tie_columns_and_of_nothing(spark):
    df = spark.range(0, 300).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    one = {tuple(r) for r in surrogate_key(df, "sk", ["k"], ["a", "b"], rows_per_group=20).collect()}
    two = {tuple(r) for r in surrogate_key(df.repartition(9), "sk", ["k"], ["a", "b"]).collect()}
    assert one == two and sorted(r[-1] for r in one) == list(range(1, 301))
    assert [r[0] for r in sorted(one, key=lambda r: r[-1])] == [0] * 100 + [1] * 100 + [2] * 100
    assert surrogate_key(df.limit(0), "sk", ["k"], ["a", "b"]).count() == 0


def test_the_source_is_read_twice(spark):
    """Once for the narrow table, which is written before, and once in the plan of the rows."""
    plan = spark._jvm.PythonSQLUtils.explainString(stage(raw_contacts(spark, SF_SMALL))._jdf.queryExecution(), "formatted")
    scans = [ln for ln in plan.splitlines() if ln.startswith("Location") and "orders.parquet" in ln]
    assert len(scans) == 1
