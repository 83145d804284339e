"""Explores from the cube, from SQL functions, and distinct clients from sketches, against the contacts themselves."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from callsheet.operators.segments import segment
from callsheet.operators.staging import stage
from callsheet.plans import marts, navigation, tiles
from callsheet.plans.catalog import QUERIES
from callsheet.plans.pipeline import contact_cube
from callsheet.plans.views import register_explores, register_views
from callsheet.session import stored
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL

AS_OF = dt.date(1998, 6, 10)


@pytest.fixture(scope="module")
def layers(spark):
    contacts = segment(stage(raw_contacts(spark, SF_SMALL), AS_OF, with_key=False))
    return contacts, stored(contact_cube(contacts, sketch=True), "test_cube")


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


ALL = list(tiles.measure_sql())
ASKED = [
    (["age_group"], ALL, None, {}),
    (["created_date", "campaign_number"], ["total_contacts", "avg_call_duration"], None, {}),
    (["created_week"], ALL, {"job_category": ["Professional"], "age_group": []}, {"as_of": AS_OF, "window_days": 30}),
    (["created_quarter", "credit_risk_profile"], ["conversion_rate"], {"campaign_number": [1, 2]}, {}),
    (["created_year", "created_month"], ["total_call_duration_hours"], None, {}),
    ([], ALL, None, {"as_of": AS_OF, "window_days": 7}),
    (["job_category", "income_level"], [], {"age_category": ["Young"]}, {}),
    ([], ALL, {"age_group": ["nobody"]}, {}),
]


@pytest.mark.parametrize("asked", ASKED, ids=str)
def test_covered_queries_are_answered_from_the_cube(spark, layers, asked):
    contacts, cube = layers
    dims, names, filters, how = asked
    assert navigation.covers(dims, names, filters, numbered=False)
    got = navigation.measure_query(contacts, cube, dims, names, filters, **how)
    assert "orders.parquet" not in plan(spark, got) and "customer.parquet" not in plan(spark, got)
    want = tiles.measure_query(contacts, dims, names, filters, **how)
    if not dims and filters:  # sums over nothing are null in a cube and 0 in a count; both are one row
        assert got.count() == want.count() == 1
    else:
        assert rows(got) == rows(want)


@pytest.mark.parametrize("dims,names,filters", [
    (["created_raw"], ["total_contacts"], None), (["created_time"], ["total_contacts"], None),
    (["marital"], ["total_contacts"], None), (["age_group"], ["total_contacts"], {"education": ["unknown"]}),
    (["previous_outcome_category"], [], None)])
def test_other_queries_go_to_the_contacts(spark, layers, dims, names, filters):
    contacts, cube = layers
    got = navigation.measure_query(contacts, cube, dims, names, filters)
    assert "orders.parquet" in plan(spark, got)
    assert rows(got) == rows(tiles.measure_query(contacts, dims, names, filters))


def test_distinct_numbers_are_not_taken_from_the_cube(spark, layers):
    _, cube = layers
    numbered = segment(stage(raw_contacts(spark, SF_SMALL), AS_OF))
    got = navigation.measure_query(numbered, cube, ["age_group"], ["unique_customers"])
    assert "cube" not in plan(spark, got)
    assert navigation.covers(["age_group"], ["total_contacts"], None, numbered=True)
    assert not navigation.covers(["age_group"], ["unique_customers"], None, numbered=True)


def test_explores_from_the_cube(spark, layers):
    contacts, cube = layers
    want = tiles.explore("segmented_contacts", contacts, ["age_group"], ["total_contacts"], as_of=AS_OF)
    assert rows(navigation.explore("segmented_contacts", contacts, cube, ["age_group"], ["total_contacts"], as_of=AS_OF)) == rows(want)
    with pytest.raises(ValueError, match="not an explore"):
        navigation.explore("campaign_fact", contacts, cube, ["campaign_number"])


def test_registered_cube_queries_scan_no_contacts(spark):
    for name in ("measure_query_cube", "explore_from_cube"):
        assert "orders.parquet" not in plan(spark, QUERIES[name](spark, SF_SMALL)), name


def test_sketches_estimate_clients_on_any_axis(spark, layers):
    contacts, cube = layers
    for keys in (["age_group"], ["job_category", "income_level"], ["campaign_number"], []):
        guess = {tuple(r)[:-1]: r.estimated_clients for r in navigation.estimated_clients(cube, keys).collect()}
        exact = {tuple(r)[:-1]: r.n for r in contacts.groupBy(*keys).agg(F.count_distinct("client_key").alias("n")).collect()}
        assert guess.keys() == exact.keys()
        assert all(abs(guess[k] - n) <= 0.05 * n for k, n in exact.items())
    with pytest.raises(ValueError, match="without"):
        navigation.estimated_clients(cube.drop("clients"), ["age_group"])


def test_explores_of_sql_users_equal_the_python_ones(spark, layers):
    contacts, _ = layers
    register_views(raw_contacts(spark, SF_SMALL), AS_OF, with_key=False)
    made = register_explores(spark, AS_OF)
    assert made == ["explore_staged_contacts", "explore_segmented_contacts", "explore_campaign_fact", "explore_segment_dimension"]
    rate = "count(*) AS total_contacts, count_if(subscribed = 'yes') * 100.0D / count(*) AS conversion_rate"
    staged = stage(raw_contacts(spark, SF_SMALL), AS_OF, with_key=False)
    pairs = [
        (f"SELECT contact_type, {rate} FROM explore_staged_contacts() GROUP BY 1",
         tiles.explore("staged_contacts", staged, ["contact_type"], ["total_contacts", "conversion_rate"], as_of=AS_OF)),
        (f"SELECT age_group, {rate} FROM explore_segmented_contacts() GROUP BY 1",
         tiles.explore("segmented_contacts", contacts, ["age_group"], ["total_contacts", "conversion_rate"], as_of=AS_OF)),
        ("SELECT DISTINCT campaign_number, campaign_date, total_conversions FROM explore_campaign_fact()",
         tiles.explore("campaign_fact", marts.fct_campaigns(contacts, AS_OF, sort=False),
                       ["campaign_number", "campaign_date", "total_conversions"], as_of=AS_OF)),
        ("SELECT DISTINCT age_group, segment_size FROM explore_segment_dimension()",
         tiles.explore("segment_dimension", marts.dim_segments_exact(contacts, AS_OF), ["age_group", "segment_size"], as_of=AS_OF)),
    ]
    for sql, want in pairs:
        got = rows(spark.sql(sql))
        assert got == rows(want) and got
    # another window is the caller's choice, none is not
    seven = spark.sql(f"SELECT count(*) FROM explore_staged_contacts(DATE'{AS_OF}', 7)").first()[0]
    month = spark.sql("SELECT count(*) FROM explore_staged_contacts()").first()[0]
    assert 0 < seven < month < spark.sql("SELECT count(*) FROM stg_contacts").first()[0]
    assert spark.sql("SELECT count(*) FROM explore_staged_contacts(DATE'2050-01-01')").first()[0] == 0


def test_window_of_a_sql_explore_reaches_the_scan(spark):
    register_views(raw_contacts(spark, SF_SMALL), AS_OF, with_key=False)
    register_explores(spark, AS_OF)
    pushed = [x for x in plan(spark, spark.sql("SELECT count(*) FROM explore_staged_contacts()")).splitlines()
              if x.startswith("PushedFilters") and "o_orderdate" in x]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]


def test_cover_rule_is_about_names_only():
    names = [*navigation.cube_measures(False)]
    for n, dims in itertools.product(names, (["age_group"], ["created_date"], [])):
        assert navigation.covers(dims, [n], None, numbered=False)
    assert set(names) == set(tiles.measure_sql())
