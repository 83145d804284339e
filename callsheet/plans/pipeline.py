"""End-to-end batch job: raw contacts -> quality -> marts -> report tables.

Both marts come from ONE aggregate over the contacts: a 9-key contact cube
(day x campaign x the seven segment labels) with additive measures only
(counts, conversion counts, duration sums and non-null duration counts).
The 7-key segment table and the 8-key daily table are exact roll-ups of the
cube (an average is a sum over a count), so the large input is scanned once
for both marts. The cube is bounded by days x campaigns x label
combinations and is checkpointed into the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import pct
from ..functions.time import on_day, yesterday
from ..operators import quality
from ..operators.segments import segment
from ..operators.staging import as_of_timestamp, stage
from ..schema import RAW_TYPES
from ..session import materialize
from ..sources.files import read_raw, rejected_cells, typed_columns, write_day, write_raw, write_table
from . import kpis, marts

CUBE_KEYS = ["campaign_date", "campaign_number", *marts.SEGMENT_KEYS]


SKETCH, SKETCH_BITS = "clients", 12


def contact_cube(contacts: DataFrame, sketch: bool = False) -> DataFrame:
    """The cube; with ``sketch`` each cell also keeps a mergeable sketch of its clients (at most 2 ** SKETCH_BITS bytes)."""
    yes = F.col("subscribed") == "yes"
    clients = [F.hll_sketch_agg("client_key", SKETCH_BITS).alias(SKETCH)] if sketch else []
    return (contacts.withColumn("campaign_date", F.to_date("processed_at"))
            .groupBy(*CUBE_KEYS)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(yes).alias("yes"),
                 F.count_if(F.col("subscribed") == "no").alias("no"),
                 F.sum("call_duration_seconds").alias("dur"), F.count("call_duration_seconds").alias("n_dur"), *clients))


def _rollup(cube: DataFrame, keys: list[str], names: dict[str, str], as_of: dt.date | None,
            keep_count: bool = False) -> DataFrame:
    agg = cube.groupBy(*keys).agg(F.sum("n").alias("_n"), F.sum("yes").alias("_y"), F.sum("no").alias("_no"),
                                  F.sum("dur").alias("_d"), F.sum("n_dur").alias("_nd"))
    cols = {
        "size": F.col("_n"), "unique": F.col("_n"), "yes": F.col("_y"), "no": F.col("_no"),
        "rate": pct(F.col("_y"), F.col("_n")),
        "avg": F.col("_d").cast("double") / F.nullif(F.col("_nd"), F.lit(0)).cast("double"),
        "sum": F.col("_d"), "per_minute": pct(F.col("_y"), F.col("_d"), 4), "updated": as_of_timestamp(as_of),
    }
    out = agg.select(*keys, *[cols[role].alias(name) for role, name in names.items()],
                     *([F.col("_nd").alias("_n_duration")] if keep_count else []))
    return out


def marts_from_cube(cube: DataFrame, as_of: dt.date | None) -> dict[str, DataFrame]:
    sm = _rollup(cube, marts.SEGMENT_KEYS, marts.SEGMENT_METRICS, as_of, keep_count=True)
    daily = _rollup(cube, marts.DAILY_KEYS, marts.DAILY_METRICS, as_of)
    return {
        "dim_segments": marts.dimension_from_metrics(sm, exact=False),
        "dim_segments_exact": marts.dimension_from_metrics(sm, exact=True),
        "fct_campaigns": marts.fct_campaigns(None, as_of, daily=daily, sort=False),
    }


def run_pipeline(raw: DataFrame, target: str, as_of: dt.date, as_read: DataFrame | None = None) -> dict[str, str]:
    """Build and write every table under ``target``; returns name -> path.

    The raw table is loaded first (truncate and load), in the only scan of
    the source; every later step reads what has been written. With a contact
    timestamp the raw table is partitioned by contact month and clustered by
    time inside each file, so day queries (``read_raw``) prune folders and row
    groups; marts and reports are small and written whole. Test results and
    failing rows are also kept by run day, which a retry replaces. With the
    source ``as_read`` (before its columns were cast) the type test looks at its
    schema, and the cells that the types can't take are kept by run day too.
    """
    spark = raw.sparkSession
    paths: dict[str, str] = {}
    if dated := "processed_at" in raw.columns:
        paths["raw_contacts"] = write_raw(raw, f"{target}/raw_contacts")
        loaded = read_raw(spark, paths["raw_contacts"])
    else:
        paths["raw_contacts"] = write_table(raw, f"{target}/raw_contacts")
        loaded = spark.read.parquet(paths["raw_contacts"])
    columns = [c for c in RAW_TYPES if c in raw.columns]
    if as_read is not None:
        paths["rejected_cells"] = write_day(rejected_cells(as_read), f"{target}/rejected_cells", as_of, "load_date")
    started = time.monotonic()
    report = quality.test_report(loaded.select(*[F.col(f"`{c}`") for c in columns]),
                                 as_read=typed_columns(as_read))
    paths["dq_test_results"] = write_table(report, f"{target}/dq_test_results")
    seconds = time.monotonic() - started  # one pass computes all tests, so they share its time
    report = spark.read.parquet(paths["dq_test_results"])
    paths["dq_test_history"] = write_day(
        report.select("test_name", "status", "failures", F.lit(seconds).alias("execution_time")),
        f"{target}/dq_test_history", as_of)
    failing = quality.failing_rows(loaded, quality.schema_checks(columns),
                                   [c for c in ("contact_id",) if c in raw.columns])
    paths["dq_failing_rows"] = write_day(failing, f"{target}/dq_failing_rows", as_of)

    contacts = segment(stage(loaded, as_of, with_key=False))
    cube = materialize(contact_cube(contacts))
    for name, df in marts_from_cube(cube, as_of).items():
        paths[name] = write_table(df, f"{target}/{name}")

    day = yesterday(as_of)
    day_rows = read_raw(spark, paths["raw_contacts"], day, day) if dated else loaded
    daily = kpis.kpi_daily(stage(day_rows, as_of, with_key=False), as_of)
    paths["kpi_daily"] = write_table(daily, f"{target}/kpi_daily")
    daily = spark.read.parquet(paths["kpi_daily"])
    paths["alerts"] = write_table(kpis.alerts(daily, quality.quality_score(report), as_of), f"{target}/alerts")
    return paths


def daily_report(raw: DataFrame, as_of: dt.date, history: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables of the daily report for ``as_of - 1``: KPI row, top
    age x job segments, yesterday's campaigns, and the test results of that
    day: scanned from the stored ``history``, or computed from that day's
    contacts where none is given. Each is a DataFrame; delivery (HTML, mail)
    is not built."""
    if "processed_at" not in raw.columns:  # no contact time: load time, as staging uses
        raw = raw.withColumn("processed_at", as_of_timestamp(as_of))
    staged = stage(raw, as_of, with_key=False)
    contacts = segment(staged)
    day = yesterday(as_of)
    if history is not None:
        tests = history.where(F.col("test_date") == F.lit(day)).select(
            "test_name", "status", "failures", "execution_time", F.col("test_date").cast("timestamp_ntz").alias("test_date"))
    else:
        day_raw = raw.where(on_day("processed_at", day))
        dated = day_raw.withColumn("test_date", F.to_date("processed_at").cast("timestamp_ntz"))
        cols = [c for c in RAW_TYPES if c in raw.columns]
        tests = quality.test_report(dated, group_by=["test_date"], columns=cols).select(
            "test_name", "status", "failures", F.lit(None).cast("double").alias("execution_time"), "test_date")
    return {
        "kpis": kpis.kpi_daily(staged, as_of),
        "segments": kpis.top_segments(contacts, as_of),
        "campaigns": kpis.campaign_report(contacts, as_of),
        "tests": tests.orderBy(F.desc("test_date"), "test_name"),
    }
