"""Streaming daily KPIs: equal to batch, and late rows dropped by the watermark."""

import glob
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from callsheet.streaming import kpis as skpis
from tests.conftest import SF_SMALL


def _batch(df, ts, ok, dur):
    n = F.count(F.lit(1))
    return df.groupBy(F.to_date(ts).alias("report_date")).agg(
        n.alias("total_contacts"), F.count_if(ok).alias("successful_contacts"),
        F.round(F.count_if(ok) * F.lit(100.0) / n, 2).alias("conversion_rate"), F.avg(dur).alias("avg_call_duration"))


def _split_events(spark, folder):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    day = F.dayofmonth("ts")
    late = ev.where(day == 1).limit(5)
    parts = [ev.where(day <= 10), ev.where((day > 10) & (day <= 20)), ev.where(day > 20).unionByName(late)]
    for i, p in enumerate(parts):
        tmp = tempfile.mkdtemp(prefix="callsheet-split-")
        p.coalesce(1).write.mode("overwrite").parquet(tmp + "/o")
        src = glob.glob(tmp + "/o/*.parquet")[0]
        dst = os.path.join(folder, f"events_{i}.parquet")
        shutil.copy(src, dst)
        os.utime(dst, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    return ev, late


def test_late_rows_dropped_in_append_mode(spark):
    folder = tempfile.mkdtemp(prefix="callsheet-stream-")
    ev, late = _split_events(spark, folder)
    stream = skpis.file_stream(spark, folder, "events_*.parquet", ev.schema, max_files=1)
    ok = F.col("event_type") == "purchase"
    out = skpis.daily_kpis_stream(stream, "ts", ok, F.col("value"), watermark="1 day")
    sink = tempfile.mkdtemp(prefix="callsheet-sink-")
    skpis.run_to_parquet(out, sink + "/o", sink + "/c", output_mode="append")
    got = spark.read.parquet(sink + "/o")
    want = _batch(ev, "ts", ok, "value")  # original rows only: late copies must not count
    assert got.count() >= 27  # the newest windows stay open until the watermark passes them
    diff = got.join(want, "report_date").where(
        (got.total_contacts != want.total_contacts) | (got.successful_contacts != want.successful_contacts))
    assert diff.count() == 0
    assert late.count() > 0


def test_stream_equals_batch_in_complete_mode(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = skpis.file_stream(spark, SF_SMALL, "events.parquet", ev.schema)
    ok = F.col("event_type") == "purchase"
    out = skpis.daily_kpis_stream(stream, "ts", ok, F.col("value"))
    sink = tempfile.mkdtemp(prefix="callsheet-sink-")
    skpis.run_to_parquet(out, sink + "/o", sink + "/c", output_mode="complete")
    got = spark.read.parquet(sink + "/o")
    want = _batch(ev, "ts", ok, "value")
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert want.count() == got.count()


def test_batch_and_stream_share_the_windowing_code(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ok = F.col("event_type") == "purchase"
    batch = skpis.daily_kpis_stream(ev, "ts", ok, F.col("value"))
    want = _batch(ev, "ts", ok, "value")
    assert batch.exceptAll(want.select(*batch.columns)).count() == 0


def test_stream_reads_a_table_folder(spark):
    from callsheet.plans.catalog import QUERIES
    from callsheet.sources.files import scratch_path
    folder = scratch_path(spark, "folder_tables")
    for t in ("orders", "customer", "events"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(3).write.parquet(f"{folder}/{t}.parquet")

    def rows(source):  # part files add their floats in another order
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in QUERIES["stream_event_kpis"](spark, source).collect())

    assert rows(SF_SMALL) == rows(folder) != []
