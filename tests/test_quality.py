"""Quality suites on the 5-row unit-test frame (dotted names) and variants."""

import pytest
from pyspark.sql import functions as F

from callsheet.operators import quality
from callsheet.sources.files import normalise_names

COLS = ["age", "job", "marital", "education", "default", "housing", "loan", "contact", "month", "day_of_week",
        "duration", "campaign", "pdays", "previous", "poutcome", "emp.var.rate", "cons.price.idx",
        "cons.conf.idx", "euribor3m", "nr.employed", "y"]
ROWS = [
    (25, "student", "single", "illiterate", "unknown", "telephone", "oct", "fri", 77, "yes"),
    (33, "housemaid", "unknown", "basic.4y", "no", "cellular", "jan", "thu", 1200, "no"),
    (58, "retired", "divorced", "professional.course", "yes", "telephone", "apr", "mon", 15, "no"),
    (71, "entrepreneur", "married", "unknown", "yes", "cellular", "dec", "wed", 480, "yes"),
    (94, "self-employed", "single", "high.school", "no", "cellular", "feb", "tue", 3600, "no"),
]
SCHEMA = ", ".join(f"`{c}` {t}" for c, t in zip(COLS, [
    "bigint", "string", "string", "string", "string", "string", "string", "string", "string", "string", "bigint",
    "bigint", "bigint", "bigint", "string", "double", "double", "double", "double", "double", "string"]))


def frame(spark, rows=ROWS):
    full = [(a, j, m, e, "no", h, "no", c, mo, d, du, 3, -1, 0, "nonexistent", -0.5, 93.0, -40.25, 2.5,
             5100.5, y) for a, j, m, e, h, c, mo, d, du, y in rows]
    return normalise_names(spark.createDataFrame(full, SCHEMA))


def test_clean_frame_passes_everything(spark):
    df = frame(spark)
    rt = quality.run_suite(df, quality.runtime_checks(df.columns))
    assert rt.where("status != 'PASSED'").count() == 0
    sc = quality.run_suite(df, quality.schema_checks(df.columns))
    assert sc.count() == 21 + 12 + 9 and sc.where("status != 'PASSED'").count() == 0
    score = quality.quality_score(quality.test_report(df)).first()
    assert (score.total_tests, score.passed_tests, score.quality_score) == (6, 6, 100.0)


def test_null_semantics_differ_between_suites(spark):
    df = frame(spark).withColumn("poutcome", F.lit(None).cast("string")).withColumn(
        "age", F.when(F.col("age") == 25, F.lit(None)).otherwise(F.col("age")))
    rt = {(r.test_name, r.column_name): r.violations
          for r in quality.run_suite(df, quality.runtime_checks(df.columns)).collect()}
    # runtime: NULL fails accepted values and the previous=0 rule, passes ranges
    assert rt[("Accepted Values Check", "poutcome")] == 5
    assert rt[("Data Consistency Check", "previous=0 implies poutcome=nonexistent")] == 5
    assert rt[("Value Ranges Check", "age")] == 0
    assert rt[("Null Values Check", "age")] == 1
    sc = {(r.test_name, r.column_name): r.violations
          for r in quality.run_suite(df, quality.schema_checks(df.columns)).collect()}
    # schema: NULL passes accepted values, only not_null sees it
    assert sc[("accepted_values", "poutcome")] == 0 and sc[("not_null", "poutcome")] == 5
    assert sc[("accepted_values", "age")] == 0 and sc[("not_null", "age")] == 1


def test_runtime_bounds_inclusive(spark):
    rows = [list(r) for r in ROWS]
    rows[0][0], rows[1][0], rows[2][0] = 18, 95, 96
    rows[3][8], rows[4][8] = 0, 5001
    df = frame(spark, [tuple(r) for r in rows])
    rt = {(r.test_name, r.column_name): r.violations
          for r in quality.run_suite(df, quality.runtime_checks(df.columns)).collect()}
    assert rt[("Value Ranges Check", "age")] == 1
    assert rt[("Value Ranges Check", "duration")] == 1
    assert rt[("Data Consistency Check", "duration>0")] == 1  # duration 0 fails the stricter rule


def test_duplicates_and_report(spark):
    df = frame(spark)
    dup = df.unionByName(df.limit(1))
    d = quality.duplicates(dup).first()
    assert (d.total_rows, d.distinct_rows, d.duplicate_rows) == (6, 5, 1)
    rep = {r.test_name: r.status for r in quality.test_report(dup).collect()}
    assert rep["Duplicate Records Check"] == "FAILED" and len(rep) == 6
    s = quality.quality_score(quality.test_report(dup)).first()
    assert s.failed_tests == 1 and abs(s.quality_score - 500 / 6) < 1e-9


def test_duplicates_with_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert quality.duplicates(df).first().duplicate_rows == 1


def test_ingest_gate_fixture_lacks_loader_columns(spark):
    g = quality.ingest_gate(frame(spark)).first()
    assert g.failed_critical == "has_balance,has_day" and g.passed is False


def test_ingest_gate_soft_checks_warn_unless_strict(spark):
    df = frame(spark).withColumn("balance", F.lit(1.0)).withColumn("day", F.lit(5).cast("bigint"))
    bad = df.unionByName(df.limit(1)).withColumn("age", F.when(F.col("age") == 25, F.lit(100)).otherwise(F.col("age")))
    g = quality.ingest_gate(bad).first()
    assert g.failed_critical == "" and g.passed is True
    assert g.failed_optional == "age_range,no_duplicates"
    assert quality.ingest_gate(bad, strict=True).first().passed is False
    assert quality.ingest_gate(df.limit(0)).first().failed_critical == "total_rows"


def test_failing_rows_and_invalid_values(spark):
    df = frame(spark).withColumn("contact_id", F.monotonically_increasing_id()).withColumn(
        "day_of_week", F.when(F.col("age") == 25, F.lit("sat")).otherwise(F.col("day_of_week")))
    fr = quality.failing_rows(df, quality.schema_checks(df.columns), ["contact_id"]).collect()
    assert [(r.test_name, r.column_name, r.value) for r in fr] == [("accepted_values", "day_of_week", "sat")]
    iv = quality.invalid_values(df).collect()
    assert [(r.column_name, r.invalid_value, r.occurrences) for r in iv] == [("day_of_week", "sat", 1)]


def test_type_check_and_relationships(spark):
    df = frame(spark).withColumn("age", F.col("age").cast("int"))
    assert quality.type_mismatches(df) == ["age: expected bigint, got int"]
    rep = {r.test_name: r.failures for r in quality.test_report(df).collect()}
    assert rep["Data Types Check"] == 1
    child = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,)], "p bigint")
    r = quality.relationships(child, "k", parent, "p").first()
    assert (r.violations, r.status) == (1, "FAILED")
    u = quality.unique_key(spark.createDataFrame([(1,), (1,), (2,)], "k int"), "k").first()
    assert u.duplicated_keys == 1


@pytest.mark.parametrize("group", [True])
def test_grouped_report_per_day(spark, group):
    df = frame(spark).withColumn("d", F.when(F.col("age") < 35, F.lit("a")).otherwise(F.lit("b")))
    rep = quality.test_report(df, group_by=["d"], columns=[c for c in df.columns if c != "d"])
    assert rep.count() == 12


def _loader_frame(spark):
    return frame(spark).withColumn("balance", F.lit(1.0)).withColumn("day", F.lit(5).cast("bigint"))


@pytest.mark.parametrize("variant,critical,optional", [
    ("drop_age", "has_age", ""),
    ("age_100", "", "age_range"),
    ("duration_negative", "", "duration_positive"),
    ("duplicate_row", "", "no_duplicates"),
    ("clean", "", ""),
])
def test_loader_fixture_variants(spark, variant, critical, optional):
    df = _loader_frame(spark)
    if variant == "drop_age":
        df = df.drop("age")
    elif variant == "age_100":
        df = df.withColumn("age", F.when(F.col("age") == 25, F.lit(100)).otherwise(F.col("age")))
    elif variant == "duration_negative":
        df = df.withColumn("duration", F.when(F.col("age") == 25, F.lit(-10)).otherwise(F.col("duration")))
    elif variant == "duplicate_row":
        df = df.unionByName(df.where("age = 25"))
    g = quality.ingest_gate(df).first()
    assert (g.failed_critical, g.failed_optional) == (critical, optional)
    # soft checks only warn; strict mode rejects them as the loader's tests expect
    assert g.passed is (critical == "")
    assert quality.ingest_gate(df, strict=True).first().passed is (critical == "" and optional == "")


def test_relationships_count_planted_orphans(spark):
    orders = spark.sql("SELECT IF(id % 10 = 0, -1L, id % 7) AS o_custkey FROM range(1000)")
    customer = spark.sql("SELECT id AS c_custkey FROM range(7)")
    row = quality.relationships(orders, "o_custkey", customer, "c_custkey").first()
    assert (row["violations"], row["status"]) == (100, "FAILED")
