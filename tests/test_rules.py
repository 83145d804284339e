"""Every CASE boundary of the segment and performance rule tables."""

import pytest
from pyspark.sql import Row

from callsheet.functions.rules import RuleTable, floors
from callsheet.operators.segments import risk_rules_v2, segment, segment_rules
from callsheet import fixed


def _seg(spark, **over):
    base = dict(customer_id=1, age=40, job="admin.", marital="single", education="basic.4y", subscribed="no",
                call_duration_seconds=100, campaign_number=1, processed_at=None, has_default="no",
                has_housing_loan="no", has_personal_loan="no", previous_campaign_contacts=0,
                previous_campaign_outcome="nonexistent")
    base.update(over)
    schema = ("customer_id bigint, age bigint, job string, marital string, education string, subscribed string, "
              "call_duration_seconds bigint, campaign_number bigint, processed_at timestamp_ntz, has_default string, "
              "has_housing_loan string, has_personal_loan string, previous_campaign_contacts bigint, "
              "previous_campaign_outcome string")
    return segment(spark.createDataFrame([Row(**base)], schema)).first()


@pytest.mark.parametrize("age,group,category", [
    (18, "Young (18-24)", "Young"), (24, "Young (18-24)", "Young"), (25, "Young Adult (25-34)", "Young"),
    (29, "Young Adult (25-34)", "Young"), (30, "Young Adult (25-34)", "Middle"),
    (34, "Young Adult (25-34)", "Middle"), (35, "Adult (35-44)", "Middle"), (44, "Adult (35-44)", "Middle"),
    (45, "Middle Age (45-54)", "Middle"), (50, "Middle Age (45-54)", "Middle"),
    (51, "Middle Age (45-54)", "Senior"), (54, "Middle Age (45-54)", "Senior"), (55, "Senior (55-64)", "Senior"),
    (64, "Senior (55-64)", "Senior"), (65, "Elder (65+)", "Senior"), (95, "Elder (65+)", "Senior"),
    (None, "Elder (65+)", "Senior"),
])
def test_age_bands(spark, age, group, category):
    r = _seg(spark, age=age)
    assert (r.age_group, r.age_category) == (group, category)


@pytest.mark.parametrize("job,category,income", [
    ("admin.", "Professional", "High Income"), ("management", "Professional", "High Income"),
    ("executive", "Professional", "High Income"), ("technician", "Skilled", "High Income"),
    ("services", "Skilled", "Medium Income"), ("entrepreneur", "Skilled", "Medium Income"),
    ("blue-collar", "Manual", "Medium Income"), ("housemaid", "Manual", "Low Income"),
    ("unemployed", "Manual", "Low Income"), ("student", "Student/Retired", "Low Income"),
    ("retired", "Student/Retired", "Low Income"), ("self-employed", "Other", "Low Income"),
    ("unknown", "Other", "Low Income"), (None, "Other", "Low Income"),
])
def test_job_tables(spark, job, category, income):
    r = _seg(spark, job=job)
    assert (r.job_category, r.income_level) == (category, income)


@pytest.mark.parametrize("d,h,l,risk", [
    ("yes", "no", "no", "High Risk"), ("no", "yes", "no", "High Risk"), ("no", "no", "yes", "High Risk"),
    ("no", "no", "no", "Low Risk"), ("unknown", "unknown", "unknown", "Low Risk"), (None, None, None, "Low Risk"),
    (None, "yes", None, "High Risk"),
])
def test_risk_medium_unreachable(spark, d, h, l, risk):
    r = _seg(spark, has_default=d, has_housing_loan=h, has_personal_loan=l)
    assert r.credit_risk_profile == risk


def test_risk_v2_reaches_medium(spark):
    rules = segment_rules(risk=risk_rules_v2())
    df = spark.createDataFrame([("no", "yes", "no"), ("yes", "no", "no"), ("no", "no", "no")],
                               "has_default string, has_housing_loan string, has_personal_loan string")
    out = df.select(rules["credit_risk_profile"].column().alias("r")).collect()
    assert [x.r for x in out] == ["Medium Risk", "High Risk", "Low Risk"]


@pytest.mark.parametrize("prev,level", [(0, "New Customer"), (1, "Occasional"), (3, "Occasional"),
                                        (4, "Regular"), (10, "Regular"), (11, "Frequent"), (-1, "Frequent"),
                                        (None, "Frequent")])
def test_engagement(spark, prev, level):
    assert _seg(spark, previous_campaign_contacts=prev).customer_engagement_level == level


@pytest.mark.parametrize("outcome,label", [("success", "Previous Success"), ("failure", "Previous Failure"),
                                           ("other", "Previous Other"), ("nonexistent", "No Previous Contact"),
                                           (None, "No Previous Contact")])
def test_previous_outcome(spark, outcome, label):
    assert _seg(spark, previous_campaign_outcome=outcome).previous_outcome_category == label


@pytest.mark.parametrize("dur,label", [(0, "Short Call"), (120, "Short Call"), (121, "Medium Call"),
                                       (300, "Medium Call"), (301, "Long Call"), (None, "Short Call")])
def test_call_duration(spark, dur, label):
    assert _seg(spark, call_duration_seconds=dur).call_duration_category == label


@pytest.mark.parametrize("sub,conv", [("yes", 1), ("no", 0), (None, 0)])
def test_is_converted(spark, sub, conv):
    assert _seg(spark, subscribed=sub).is_converted == conv


@pytest.mark.parametrize("rate,seg,camp", [
    (4.99, "Underperformer", "Poor"), (5.0, "Low Performer", "Average"), (9.99, "Low Performer", "Average"),
    (10.0, "Medium Performer", "Good"), (14.99, "Medium Performer", "Good"), (15.0, "High Performer", "Excellent"),
    (None, "Underperformer", "Poor"),
])
def test_performance_floors(spark, rate, seg, camp):
    df = spark.createDataFrame([(rate,)], "r double")
    a = floors("r", fixed.SEGMENT_PERFORMANCE, fixed.SEGMENT_PERFORMANCE_ELSE).column()
    b = floors("r", fixed.CAMPAIGN_PERFORMANCE, fixed.CAMPAIGN_PERFORMANCE_ELSE).column()
    r = df.select(a.alias("a"), b.alias("b")).first()
    assert (r.a, r.b) == (seg, camp)


def test_column_predicates_and_first_match(spark):
    from pyspark.sql import functions as F
    t = RuleTable([("big", F.col("x") > 10), ("mid", "x > 5"), ("also_big", F.col("x") > 20)], "small")
    df = spark.createDataFrame([(25,), (7,), (1,), (None,)], "x int")
    assert [r.c for r in df.select(t.column().alias("c")).collect()] == ["big", "mid", "small", "small"]
