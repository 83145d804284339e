"""Structured Streaming: daily KPIs and per-batch quality checks.

``daily_kpis_stream`` is a stateful aggregation over one-day tumbling
event-time windows with a watermark: state for a day is dropped once the
watermark passes its end, and rows arriving later than that are dropped
(append mode emits each day once, when it closes). The quality stream
reuses the batch suite per micro-batch through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import pct
from ..operators.quality import run_suite, runtime_checks
from ..schema import RAW_TYPES


def event_time(ts: str) -> Column:
    """Wall-clock ``timestamp_ntz`` as the instant that reads the same in UTC,
    so day windows start at wall-clock midnight whatever the session time
    zone (``withWatermark`` needs a zoned timestamp)."""
    return F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp")


def window_day(col: str = "window.start") -> Column:
    """The UTC calendar day of an instant, independent of the session zone."""
    days = F.floor(F.unix_seconds(F.col(col)) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def daily_kpis_stream(stream: DataFrame, ts: str, success: Column, duration: Column,
                      watermark: str = "1 day") -> DataFrame:
    """Per-day ``total_contacts``, ``successful_contacts``, ``conversion_rate``,
    ``avg_call_duration`` over a (streaming or batch) frame."""
    timed = stream.select(event_time(ts).alias("_et"), success.alias("_ok"), duration.alias("_dur"))
    n = F.count(F.lit(1))
    agg = (timed.withWatermark("_et", watermark)
           .groupBy(F.window("_et", "1 day"))
           .agg(n.alias("total_contacts"), F.count_if("_ok").alias("successful_contacts"),
                pct(F.count_if("_ok"), n).alias("conversion_rate"),
                F.avg("_dur").alias("avg_call_duration")))
    return agg.select(window_day().alias("report_date"), "total_contacts", "successful_contacts",
                      "conversion_rate", "avg_call_duration")


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str, output_mode: str = "append",
                   max_files_per_trigger: int | None = None) -> None:
    """Drain the available input (``availableNow``) into a Parquet folder.

    Append mode writes through the file sink (exactly-once via its log);
    complete/update mode rewrites the (bounded) result table per batch.
    """
    if output_mode == "append":
        q = (stream.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", checkpoint).option("path", sink)
             .trigger(availableNow=True).start())
    else:
        def write_batch(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(sink)

        q = (stream.writeStream.outputMode(output_mode).foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def quality_stream(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Runtime checks on every micro-batch, one folder per batch id.

    Each batch costs one aggregate over that batch only. A batch that is
    re-run after a failure overwrites its own folder, so the sink stays
    exactly-once although ``foreachBatch`` is at-least-once. Read it back
    with ``read_quality_sink``.
    """
    cols = [c for c in RAW_TYPES if c in stream.columns]

    def check_batch(batch: DataFrame, batch_id: int) -> None:
        res = run_suite(batch, runtime_checks(cols))
        res.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(check_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_quality_sink(spark: SparkSession, sink: str) -> DataFrame:
    df = spark.read.parquet(sink)
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema, max_files: int | None = None) -> DataFrame:
    """A file-source stream over ``folder`` restricted to ``file_glob``.

    A table may be one file or, as Spark writes it, a folder of that name:
    then its part files are streamed.
    """
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{file_glob}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if found and all(f.isDirectory() for f in found):
        return r.parquet(f"{folder}/{file_glob}")
    return r.option("pathGlobFilter", file_glob).parquet(folder)
