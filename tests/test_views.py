"""SQL over the named layers, as a user of the studied mart writes it."""

import datetime as dt

from callsheet.operators import quality
from callsheet.plans.views import register_views
from callsheet.sources.tables import ensure_database
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL


def test_layer_views_answer_the_documented_kpi_sql(spark):
    register_views(raw_contacts(spark, SF_SMALL), dt.date(1998, 6, 10))
    # one statement over three layers: the fact, the dimension and the contacts tell the same totals
    told = spark.sql("""
        WITH longest AS (SELECT max(customer_id) AS last_number, min(customer_id) AS first_number FROM stg_contacts),
             by_fact AS (SELECT sum(total_contacts) AS n, sum(total_conversions) AS yes FROM fct_campaigns),
             by_segment AS (SELECT sum(segment_size) AS n, sum(segment_conversions) AS yes FROM dim_segments_exact)
        SELECT longest.*, by_fact.n AS fact_n, by_fact.yes AS fact_yes, by_segment.n AS segment_n, by_segment.yes AS segment_yes
        FROM longest, by_fact, by_segment""").first()
    assert told.first_number == 1 and told.last_number == told.fact_n == told.segment_n > told.fact_yes == told.segment_yes > 0
    worst = spark.sql("""
        SELECT marital, avg(is_converted) AS share FROM int_contact_segments
        WHERE call_duration_category = 'Long Call' GROUP BY marital HAVING count(*) > 10 ORDER BY share LIMIT 1""").collect()
    assert len(worst) == 1 and 0 <= worst[0].share < 1


def test_namespace_and_whole_check(spark):
    ensure_database(spark, "raw_data")
    ensure_database(spark, "raw_data")  # idempotent
    assert "raw_data" in [d.name for d in spark.catalog.listDatabases()]
    raw = raw_contacts(spark, SF_SMALL).drop("contact_id", "client_key", "processed_at")
    rep = quality.test_report(raw).collect()
    assert len(rep) == 6


def test_explores_apply_their_mandatory_window(spark):
    from pyspark.sql import functions as F
    from callsheet.operators.segments import segment
    from callsheet.operators.staging import stage
    from callsheet.plans import marts
    from callsheet.plans.tiles import explore
    as_of = dt.date(1998, 6, 10)
    contacts = segment(stage(raw_contacts(spark, SF_SMALL), as_of, with_key=False))
    got = explore("segmented_contacts", contacts, ["created_date"], ["total_contacts"], as_of=as_of)
    days = [r.created_date for r in got.collect()]
    assert days and min(days) >= dt.date(1998, 5, 12) and max(days) <= as_of
    fct = marts.fct_campaigns(contacts, as_of, sort=False)
    tile = explore("campaign_fact", fct, ["campaign_number", "total_conversions"], as_of=as_of)
    want = fct.where(F.col("campaign_date").between(dt.date(1998, 5, 12), as_of)).select(
        "campaign_number", "total_conversions").distinct()
    assert tile.exceptAll(want).count() == 0 and want.exceptAll(tile).count() == 0
