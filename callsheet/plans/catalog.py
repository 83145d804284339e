"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the driver's star tables through ``raw_contacts`` (orders
joined to customer), so its work grows with the data. The report day is
fixed (``AS_OF``) so that "yesterday" and 30-day windows are reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.metrics import yes as _yes
from ..functions.time import on_day
from ..operators import quality
from ..operators.joins import of_batches
from ..operators.segments import risk_rules_v2, segment, segment_rules
from ..operators.staging import stage
from ..schema import DOTTED_NAMES, RAW_SCHEMA_WITH_LINEAGE, RAW_TYPES
from ..sources import files, tables
from ..sources.star import contacts_from_star, raw_contacts, read_table
from ..streaming import gate, ledger
from ..streaming import kpis as skpis
from ..session import materialize, stored
from . import kpis, marts, navigation, pipeline, tiles, views

AS_OF = dt.date(1998, 6, 10)

Query = Callable[[SparkSession, str], DataFrame]


def _int(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    return segment(stage(raw_contacts(spark, sf_dir), AS_OF, with_key=with_key))


def q_raw_contacts(spark, sf_dir):
    return raw_contacts(spark, sf_dir)


def q_stg_contacts(spark, sf_dir):
    return stage(raw_contacts(spark, sf_dir), AS_OF).drop("client_key")


def q_int_segments(spark, sf_dir):
    return _int(spark, sf_dir, with_key=True)


def q_kpi_age_job(spark, sf_dir):
    return kpis.age_job(_int(spark, sf_dir))


def q_segment_metrics(spark, sf_dir):
    return marts.segment_metrics(_int(spark, sf_dir), AS_OF)


def q_dim_segments(spark, sf_dir):
    return marts.dim_segments(_int(spark, sf_dir), AS_OF)


def q_dim_segments_exact(spark, sf_dir):
    return marts.dim_segments_exact(_int(spark, sf_dir), AS_OF)


def q_daily_performance(spark, sf_dir):
    return marts.daily_performance(_int(spark, sf_dir), AS_OF)


def q_fct_campaigns(spark, sf_dir):
    return marts.fct_campaigns(_int(spark, sf_dir), AS_OF)


QUERIES: dict[str, Query] = {
    "raw_contacts": q_raw_contacts,
    "stg_contacts": q_stg_contacts,
    "int_segments": q_int_segments,
    "kpi_age_job": q_kpi_age_job,
    "segment_metrics": q_segment_metrics,
    "dim_segments": q_dim_segments,
    "dim_segments_exact": q_dim_segments_exact,
    "daily_performance": q_daily_performance,
    "fct_campaigns": q_fct_campaigns,
}


# --- quality --------------------------------------------------------------

RAW21 = list(RAW_TYPES)


def _raw21(spark, sf_dir):
    return raw_contacts(spark, sf_dir).select(*[F.col(f"`{c}`") for c in RAW21])


def duplicate_fixture(raw: DataFrame) -> DataFrame:
    """Raw contacts without lineage, with the rows whose duration ends in 07
    present a second time (a known number of exact duplicates). The copies
    come from a narrow generator over one scan, not a union of two scans."""
    copies = F.expr("explode(sequence(1, CASE WHEN duration % 100 = 7 THEN 2 ELSE 1 END)) AS _copy")
    return raw.select(*[F.col(f"`{c}`") for c in RAW21], copies).drop("_copy")


def q_dq_suite(spark, sf_dir):
    raw = _raw21(spark, sf_dir)
    return quality.run_suite(raw, quality.runtime_checks(raw.columns))


def q_dq_schema_tests(spark, sf_dir):
    raw = _raw21(spark, sf_dir)
    return quality.run_suite(raw, quality.schema_checks(raw.columns))


def q_dq_duplicates(spark, sf_dir):
    return quality.duplicates(duplicate_fixture(raw_contacts(spark, sf_dir)))


def q_dq_invalid_values(spark, sf_dir):
    return quality.invalid_values(_raw21(spark, sf_dir))


def q_dq_failing_rows(spark, sf_dir):
    raw = raw_contacts(spark, sf_dir)
    return quality.failing_rows(raw, quality.schema_checks(RAW21), ["contact_id"])


def q_dq_ingest_gate(spark, sf_dir):
    return quality.ingest_gate(_raw21(spark, sf_dir))


def q_dq_report(spark, sf_dir):
    return quality.test_report(duplicate_fixture(raw_contacts(spark, sf_dir)))


def q_dq_score(spark, sf_dir):
    return quality.quality_score(quality.test_report(duplicate_fixture(raw_contacts(spark, sf_dir))))


def dq_history(raw: DataFrame) -> DataFrame:
    """Test-result history: the six tests per contact day, as rows
    ``(test_name, status, failures, execution_time, test_date)``.
    ``execution_time`` is not measured per group and stays NULL."""
    dated = raw.withColumn("test_date", F.to_date("processed_at").cast("timestamp_ntz"))
    rep = quality.test_report(dated, group_by=["test_date"], columns=RAW21)
    return rep.select("test_name", "status", "failures",
                      F.lit(None).cast("double").alias("execution_time"), "test_date")


def q_dq_history_yesterday(spark, sf_dir):
    day = dt.datetime.combine(AS_OF - dt.timedelta(days=1), dt.time())
    raw = raw_contacts(spark, sf_dir)
    # Half-open range on the raw timestamp: reaches the source scan.
    raw = raw.where((F.col("processed_at") >= F.lit(day).cast("timestamp_ntz"))
                    & (F.col("processed_at") < F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")))
    return dq_history(raw).orderBy(F.desc("test_date"), "test_name")


def q_dq_history_scan(spark, sf_dir):
    """Stored test history: the results of every contact day are written in
    ranges of days, then yesterday's are scanned from that table."""
    path = files.scratch_path(spark, "dq_test_history")
    history = dq_history(raw_contacts(spark, sf_dir))
    files.write_table(history.repartitionByRange("test_date"), path, sort_within=["test_date"])
    stored = spark.read.schema(history.schema).parquet(path)
    return stored.where(on_day("test_date", AS_OF - dt.timedelta(days=1))).orderBy(F.desc("test_date"), "test_name")


def q_dq_summary(spark, sf_dir):
    """The report's summary: the score with one decimal."""
    return q_dq_score(spark, sf_dir).withColumn("quality_score", F.round("quality_score", 1))


def q_dq_unparsable(spark, sf_dir):
    """Cells that the loader's types turn into NULL, where durations ending in
    07 carry their unit as text."""
    text = raw_contacts(spark, sf_dir).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in RAW21])
    text = text.withColumn("duration", F.when(F.col("duration").endswith("07"), F.concat("duration", F.lit(" s")))
                           .otherwise(F.col("duration")))
    return files.unparsable(text, RAW_TYPES)


def q_dq_relationships(spark, sf_dir):
    # the orders themselves: the contacts have already lost orders of unknown customers to a join
    return quality.relationships(read_table(spark, sf_dir, "orders"), "o_custkey",
                                 read_table(spark, sf_dir, "customer"), "c_custkey",
                                 "relationships_client_key_customer")


def q_dq_unique_key(spark, sf_dir):
    return quality.unique_key(stage(raw_contacts(spark, sf_dir), AS_OF), "customer_id")


QUERIES.update({
    "dq_suite": q_dq_suite,
    "dq_schema_tests": q_dq_schema_tests,
    "dq_duplicates": q_dq_duplicates,
    "dq_invalid_values": q_dq_invalid_values,
    "dq_failing_rows": q_dq_failing_rows,
    "dq_ingest_gate": q_dq_ingest_gate,
    "dq_report": q_dq_report,
    "dq_score": q_dq_score,
    "dq_history_yesterday": q_dq_history_yesterday,
    "dq_history_scan": q_dq_history_scan,
    "dq_summary": q_dq_summary,
    "dq_unparsable": q_dq_unparsable,
    "dq_relationships": q_dq_relationships,
    "dq_unique_key": q_dq_unique_key,
})


# --- KPI report, alerts -----------------------------------------------------


def q_kpi_daily(spark, sf_dir):
    return kpis.kpi_daily(stage(raw_contacts(spark, sf_dir), AS_OF, with_key=False), AS_OF)


def q_top_segments(spark, sf_dir):
    return kpis.top_segments(_int(spark, sf_dir), AS_OF)


def q_campaign_report(spark, sf_dir):
    return kpis.campaign_report(_int(spark, sf_dir), AS_OF)


def q_kpi_conversion_by_campaign(spark, sf_dir):
    return kpis.conversion_by_campaign(_int(spark, sf_dir))


def q_kpi_successes(spark, sf_dir):
    return kpis.successes(_int(spark, sf_dir))


def q_unique_clients(spark, sf_dir):
    return kpis.unique_clients(_int(spark, sf_dir))


def q_alerts(spark, sf_dir):
    raw = raw_contacts(spark, sf_dir)
    daily = kpis.kpi_daily(stage(raw, AS_OF, with_key=False), AS_OF)
    score = quality.quality_score(quality.test_report(raw.select(*[F.col(f"`{c}`") for c in RAW21])))
    return kpis.alerts(daily, score, AS_OF)


# --- semantic layer and tiles ----------------------------------------------
def q_measure_query(spark, sf_dir):
    return tiles.measure_query(_int(spark, sf_dir), ["age_group", "call_duration_category"],
                               list(tiles.measures()),
                               sorts=[F.desc("total_contacts"), "age_group", "call_duration_category"])


def _with_cube(spark, sf_dir, sketch: bool = False) -> tuple[DataFrame, DataFrame]:
    contacts = _int(spark, sf_dir)
    return contacts, stored(pipeline.contact_cube(contacts, sketch=sketch), "contact_cube")


def q_measure_query_cube(spark, sf_dir):
    """The measure query by week, campaign and segment, answered from the stored cube."""
    contacts, cube = _with_cube(spark, sf_dir)
    return navigation.measure_query(contacts, cube, ["created_week", "campaign_number", "age_group", "call_duration_category"],
                                    list(tiles.measures()), filters={"credit_risk_profile": ["High Risk"], "job_category": []})


def q_explore_from_cube(spark, sf_dir):
    """The segmented explore with its mandatory window, from the stored cube."""
    contacts, cube = _with_cube(spark, sf_dir)
    return navigation.explore("segmented_contacts", contacts, cube, ["created_week", "age_group"],
                              ["total_contacts", "conversion_rate", "professional_conversions"], as_of=AS_OF)


def q_clients_by_axis(spark, sf_dir):
    """Exact distinct clients by label of each axis, and whether the estimate from the cube's sketches is within 5 %."""
    return navigation.clients_by_axis(*_with_cube(spark, sf_dir, sketch=True)).drop("estimated_clients")


def q_explore_sql(spark, sf_dir):
    """The segmented explore as a SQL user asks for it, through the table function that holds the window."""
    views.register_views(raw_contacts(spark, sf_dir), AS_OF, with_key=False)
    views.register_explores(spark)
    return spark.sql(f"""
        SELECT CAST(date_trunc('week', processed_at) AS DATE) AS created_week, age_group, count(*) AS total_contacts,
               count_if(subscribed = 'yes') * 100.0D / count(*) AS conversion_rate,
               count_if(subscribed = 'yes' AND job_category = '{fixed.JOB_PIVOT[0][0]}') AS professional_conversions
        FROM explore_segmented_contacts(DATE'{AS_OF.isoformat()}') GROUP BY 1, 2""")


def q_kpi_by_timeframe(spark, sf_dir):
    return tiles.by_timeframe(_int(spark, sf_dir))


KPI_NAMES = ["total_contacts", "successful_contacts", "conversion_rate", "avg_call_duration"]


def _by_moment(frame: str) -> Query:
    return lambda spark, sf_dir: tiles.measure_query(_int(spark, sf_dir), [f"created_{frame}"], KPI_NAMES)


def q_explore_staged(spark, sf_dir):
    staged = stage(raw_contacts(spark, sf_dir), AS_OF, with_key=False)
    return tiles.explore("staged_contacts", staged, ["created_date", "contact_type"], KPI_NAMES, as_of=AS_OF)


def q_explore_segmented(spark, sf_dir):
    return tiles.explore("segmented_contacts", _int(spark, sf_dir), ["created_week", "age_group"],
                         ["total_contacts", "conversion_rate", "professional_conversions"], as_of=AS_OF)


def q_explore_fact(spark, sf_dir):
    fct = marts.fct_campaigns(_int(spark, sf_dir), AS_OF, sort=False)
    return tiles.explore("campaign_fact", fct, ["campaign_number", "campaign_date", "performance_category",
                                                "total_conversions"], as_of=AS_OF)


def q_explore_dimension(spark, sf_dir):
    return tiles.explore("segment_dimension", q_dim_segments_exact(spark, sf_dir),
                         ["age_group", "job_category", "credit_risk_profile", "segment_size",
                          "segment_performance_category"], as_of=AS_OF)


def _tile(fn):
    return lambda spark, sf_dir: fn(_int(spark, sf_dir), AS_OF)


QUERIES.update({
    "kpi_daily": q_kpi_daily,
    "top_segments": q_top_segments,
    "campaign_report": q_campaign_report,
    "kpi_conversion_by_campaign": q_kpi_conversion_by_campaign,
    "kpi_successes": q_kpi_successes,
    "unique_clients": q_unique_clients,
    "alerts": q_alerts,
    "measure_query": q_measure_query,
    "measure_query_cube": q_measure_query_cube,
    "explore_from_cube": q_explore_from_cube,
    "explore_sql": q_explore_sql,
    "clients_by_axis": q_clients_by_axis,
    "kpi_by_timeframe": q_kpi_by_timeframe,
    "kpi_by_raw": _by_moment("raw"),
    "kpi_by_time": _by_moment("time"),
    "explore_staged_contacts": q_explore_staged,
    "explore_segmented_contacts": q_explore_segmented,
    "explore_campaign_fact": q_explore_fact,
    "explore_segment_dimension": q_explore_dimension,
    "tile_conversion": _tile(tiles.tile_conversion),
    "tile_segmentation": _tile(tiles.tile_segmentation),
    "tile_by_age": _tile(tiles.tile_by_age),
    "tile_by_job": _tile(tiles.tile_by_job),
    "tile_by_risk": _tile(tiles.tile_by_risk),
    "tile_call_duration": _tile(tiles.tile_call_duration),
    "tile_daily_trend": _tile(tiles.tile_daily_trend),
    "tile_summary": _tile(tiles.tile_summary),
    "tile_filtered": _tile(tiles.tile_filtered),
})


# --- sources and sinks ------------------------------------------------------


def q_csv_roundtrip(spark, sf_dir):
    """Write raw contacts as ``;``-separated text with a header and read
    them back with the explicit schema (lossless)."""
    path = files.scratch_path(spark, "csv_roundtrip")
    files.write_contacts_csv(raw_contacts(spark, sf_dir), path)
    return files.read_contacts(spark, path, schema=RAW_SCHEMA_WITH_LINEAGE)


def _mixed_files(spark, sf_dir, path: str) -> str:
    """Raw contacts as delimited files of three layouts: as they are; columns turned round, with dotted names; and
    sorted by name, with a unit after durations that end in 07."""
    raw = raw_contacts(spark, sf_dir)
    dotted = {v: k for k, v in DOTTED_NAMES.items()}
    turned = raw.select(*[F.col(f"`{c}`").alias(dotted.get(c, c)) for c in reversed(raw.columns)])
    text = F.col("duration").cast("string")
    units = raw.withColumn("duration", F.when(text.endswith("07"), F.concat(text, F.lit(" s"))).otherwise(text))
    for n, part in enumerate((raw, turned, units.select(*[F.col(f"`{c}`") for c in sorted(raw.columns)]))):
        files.write_contacts_csv(part.where(F.col("contact_id") % 3 == n), f"{path}/{n}")
    return path


def q_csv_mixed_headers(spark, sf_dir):
    """One load of files in three column orders: every cell in its column, unreadable ones NULL."""
    path = _mixed_files(spark, sf_dir, files.scratch_path(spark, "csv_mixed"))
    return files.read_contacts(spark, path, schema=RAW_SCHEMA_WITH_LINEAGE)


def q_csv_rejected_cells(spark, sf_dir):
    """The cells of that load that their types can't take, counted by column and value."""
    path = _mixed_files(spark, sf_dir, files.scratch_path(spark, "csv_rejected"))
    cells = files.rejected_cells(files.as_read(spark, path))
    return cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cells"))


def q_coerce_schema(spark, sf_dir):
    """Raw contacts as untyped text, coerced by the loader's type-by-name rule."""
    text = raw_contacts(spark, sf_dir).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in RAW21])
    return files.coerce_schema(text)


def q_mart_roundtrip(spark, sf_dir):
    """Truncate-and-load of the campaign fact (rows clustered by day), read back."""
    path = files.scratch_path(spark, "fct_campaigns")
    fct = marts.fct_campaigns(_int(spark, sf_dir), AS_OF, sort=False)
    files.write_table(fct, path, sort_within=["campaign_date"])
    return spark.read.parquet(path)


def q_mart_catalog(spark, sf_dir):
    """The campaign fact as a table of a namespace, loaded twice (the second load takes the first one's place)."""
    place = files.scratch_path(spark, "namespace")
    database = "callsheet_" + place.rsplit("/", 1)[1]
    fct = marts.fct_campaigns(_int(spark, sf_dir), AS_OF, sort=False)
    tables.load_table(fct.limit(0), database, "fct_campaigns", location=place)
    return tables.load_table(fct, database, "fct_campaigns")


# --- streaming ---------------------------------------------------------------


DROPS = 4


def _fed(spark: SparkSession, table: DataFrame, ts: str, feed: str, drain: Callable[[DataFrame], None]) -> None:
    """Bring a whole table into a feed folder in ``DROPS`` drops by time; after each, drain the folder's stream."""
    for part in files.in_time_order(table, ts, DROPS):
        part.write.mode("append").parquet(feed)
        drain(spark.readStream.schema(table.schema).parquet(feed))


def q_stream_kpi_daily(spark, sf_dir):
    """Daily KPIs of staged contacts by a stream over several triggers: orders
    arrive in a feed folder, are joined batch by batch to the static customer table, staged,
    and counted into days that close once event time has passed them."""
    path = files.scratch_path(spark, "stream_kpi_daily")
    customer = of_batches(read_table(spark, sf_dir, "customer"))

    def staged(orders):
        return stage(contacts_from_star(orders, customer), AS_OF, with_key=False)

    def drain(orders):
        ledger.run_daily_kpis(orders, f"{path}/days", f"{path}/checkpoint", "processed_at", _yes(), F.col("call_duration_seconds"),
                              shape=staged)

    _fed(spark, read_table(spark, sf_dir, "orders"), "o_orderdate", f"{path}/feed", drain)
    ledger.close_open_days(spark, f"{path}/days")
    return ledger.closed_days(spark, f"{path}/days").drop("batch_id")


def q_stream_event_kpis(spark, sf_dir):
    """The same KPIs over the event stream (purchase = success)."""
    path = files.scratch_path(spark, "stream_event_kpis")
    _fed(spark, read_table(spark, sf_dir, "events"), "ts", f"{path}/feed", lambda events: ledger.run_daily_kpis(
        events, f"{path}/days", f"{path}/checkpoint", "ts", F.col("event_type") == "purchase", F.col("value")))
    ledger.close_open_days(spark, f"{path}/days")
    # a sum of fractions depends on the order of its parts beyond that place; the first rounding settles an average halfway
    return ledger.closed_days(spark, f"{path}/days").drop("batch_id").withColumn(
        "avg_call_duration", F.round(F.round("avg_call_duration", 9), 6))


def _gated(spark, sf_dir, path: str, onward=None) -> None:
    customer = of_batches(read_table(spark, sf_dir, "customer"))
    _fed(spark, read_table(spark, sf_dir, "orders"), "o_orderdate", f"{path}/feed", lambda orders: gate.run_gate(
        orders, f"{path}/gate", f"{path}/checkpoint", quality.runtime_checks(RAW21), onward,
        shape=lambda batch: contacts_from_star(batch, customer)))


def q_stream_gate(spark, sf_dir):
    """Every contact of the feed with the gate's verdict and reasons, passed and quarantined."""
    path = files.scratch_path(spark, "stream_gate")
    _gated(spark, sf_dir, path)
    schema = "contact_id bigint"
    held = gate.quarantined_rows(spark, f"{path}/gate", schema)
    return (gate.passed_rows(spark, f"{path}/gate", schema)
            .select("contact_id", F.lit(gate.PASSED).alias("verdict"), F.lit("").alias("reasons"))
            .unionByName(held.select("contact_id", F.lit(gate.QUARANTINED).alias("verdict"), F.array_join("reasons", ", ").alias("reasons"))))


def q_stream_gated_kpis(spark, sf_dir):
    """Daily KPIs of the contacts that pass the gate: its batches go on into the days of the ledger."""
    path = files.scratch_path(spark, "stream_gated_kpis")

    def count(passed, batch_id):
        staged = stage(passed, AS_OF, with_key=False)
        ledger.take_batch(staged, batch_id, f"{path}/days", "processed_at", _yes(), F.col("call_duration_seconds"))

    _gated(spark, sf_dir, path, count)
    ledger.close_open_days(spark, f"{path}/days")
    return ledger.closed_days(spark, f"{path}/days").drop("batch_id")


def q_stream_dq(spark, sf_dir):
    """Runtime quality checks per micro-batch of the contact stream."""
    orders_static = read_table(spark, sf_dir, "orders")
    orders = skpis.file_stream(spark, sf_dir, "orders.parquet", orders_static.schema)
    contacts = contacts_from_star(orders, read_table(spark, sf_dir, "customer"))
    sink = files.scratch_path(spark, "stream_dq")
    skpis.quality_stream(contacts.select(*[F.col(f"`{c}`") for c in RAW21]), sink, sink + "_ckpt")
    return skpis.read_quality_sink(spark, sink)


QUERIES.update({
    "csv_roundtrip": q_csv_roundtrip,
    "csv_mixed_headers": q_csv_mixed_headers,
    "csv_rejected_cells": q_csv_rejected_cells,
    "coerce_schema": q_coerce_schema,
    "mart_roundtrip": q_mart_roundtrip,
    "mart_catalog": q_mart_catalog,
    "stream_kpi_daily": q_stream_kpi_daily,
    "stream_event_kpis": q_stream_event_kpis,
    "stream_dq": q_stream_dq,
    "stream_gate": q_stream_gate,
    "stream_gated_kpis": q_stream_gated_kpis,
})


# --- more segment and roll-up queries -----------------------------------------
def q_int_segments_risk_v2(spark, sf_dir):
    return segment(stage(raw_contacts(spark, sf_dir), AS_OF, with_key=False), segment_rules(risk_rules_v2()))


def q_axis_rollups(spark, sf_dir):
    """The four single-axis roll-ups (age, job, risk, engagement), re-aggregated
    from the segment table and stacked with an ``axis`` column."""
    # one pass over the contacts: every axis reads the checkpointed segment table
    sm = materialize(marts.segment_metrics(_int(spark, sf_dir), AS_OF, keep_count=True))
    out = None
    for axis, frame in marts.segment_axes(sm).items():
        frame = frame.withColumn("axis", F.lit(axis))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


QUERIES.update({
    "int_segments_risk_v2": q_int_segments_risk_v2,
    "axis_rollups": q_axis_rollups,
})


def q_fct_campaigns_extended(spark, sf_dir):
    return marts.fct_campaigns_extended(_int(spark, sf_dir), AS_OF)


QUERIES["fct_campaigns_extended"] = q_fct_campaigns_extended
