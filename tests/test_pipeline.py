"""The one-pass pipeline equals the per-mart queries; alert operator rules."""

import datetime as dt

from pyspark.sql import functions as F

from callsheet.operators import quality
from callsheet.operators.alerts import AlertRule, no_data_alert, threshold_alerts
from callsheet.operators.segments import segment
from callsheet.operators.staging import stage
from callsheet.plans import marts
from callsheet.plans.pipeline import daily_report, run_pipeline
from callsheet.schema import RAW_TYPES
from callsheet.sources.files import scratch_path
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL

AS_OF = dt.date(1998, 6, 10)


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pipeline_marts_equal_direct_marts(spark):
    raw = raw_contacts(spark, SF_SMALL)
    target = scratch_path(spark, "test_pipeline")
    paths = run_pipeline(raw, target, AS_OF)
    contacts = segment(stage(raw, AS_OF, with_key=False))
    assert _same(spark.read.parquet(paths["dim_segments"]), marts.dim_segments(contacts, AS_OF))
    assert _same(spark.read.parquet(paths["dim_segments_exact"]), marts.dim_segments_exact(contacts, AS_OF))
    assert _same(spark.read.parquet(paths["fct_campaigns"]), marts.fct_campaigns(contacts, AS_OF))
    assert spark.read.parquet(paths["dq_test_results"]).count() == 6
    assert spark.read.parquet(paths["raw_contacts"]).count() == raw.count()
    run_pipeline(raw, target, AS_OF)  # a retry replaces its day
    history = spark.read.parquet(paths["dq_test_history"])
    assert history.count() == 6 and history.where("execution_time > 0").count() == 6
    tests = daily_report(raw, AS_OF + dt.timedelta(days=1), history)["tests"]
    assert tests.count() == 6
    failing = quality.failing_rows(raw, quality.schema_checks(list(RAW_TYPES)), ["contact_id"])
    assert spark.read.parquet(paths["dq_failing_rows"]).count() == failing.count() > 0


def test_threshold_and_no_data_alerts(spark):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), 4.5), (dt.date(2024, 1, 2), 12.0)], "d date, rate double")
    rules = [AlertRule("low", "rate", 5.0, "Low: "), AlertRule("high", "rate", 10.0, "High: ", below=False)]
    got = {(r.alert_type, r.message) for r in threshold_alerts(m, rules, F.col("d")).collect()}
    assert got == {("low", "Low: 4.5%"), ("high", "High: 12.0%")}
    assert no_data_alert(m.limit(0), dt.date(2024, 1, 3)).count() == 1
    assert no_data_alert(m, dt.date(2024, 1, 3)).count() == 0


def test_slow_run_rule_over_a_run_log(spark):
    log = spark.createDataFrame([("nightly", 12.0), ("nightly", 41.5)], "job string, minutes double")
    rule = AlertRule("slow_run", "minutes", 30, "Run took ", below=False)
    rows = threshold_alerts(log, [rule], F.current_date()).collect()
    assert [r.metric_value for r in rows] == [41.5]
