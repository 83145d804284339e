"""Daily KPIs of a stream whose days close: each day is given out once, late rows are set aside.

A day is closed when event time has passed its end by ``delay``; until then its
additive totals are kept. All of a batch's effects lie in folders of its number
below ``path``:

* ``open``    totals of the days still open after the batch (the state),
* ``closed``  the KPI rows of the days that the batch closed,
* ``late``    the rows of days closed before the batch, as they came,
* ``ledger``  one row: rows taken, late rows, latest time, first day not closed,
  days open and days closed. Written last: with it the batch is done.

A batch is worked from the state that the batch before left, so working it again
after a failure overwrites its folders with the same rows: the result is exact
although ``foreachBatch`` runs at least once. A day's totals are merged, never
its rows: the state holds one row for each open day and shrinks as days close,
and the shuffle of a batch carries a row for each (task, day).

Rows of one batch are never late to each other, and a batch closes days after
its own rows are counted. Rows without a time are late, with a reason of their
own. ``close_open_days`` ends a feed: the days still open are closed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import pct
from .sinks import Shape, batch_folder, batch_numbers, drop_batches, read_batches, write_batch

TOTALS = "report_date date, n bigint, yes bigint, seconds double, timed bigint, latest timestamp_ntz"
CLOSED = ("report_date date, total_contacts bigint, successful_contacts bigint, conversion_rate double, "
          "avg_call_duration double, batch_id bigint")
LEDGER = ("rows bigint, late_rows bigint, latest timestamp_ntz, closed_before date, open_days bigint, closed_days bigint, "
          "batch_id bigint")


def day_totals(rows: DataFrame, ts: str, success: Column, duration: Column) -> DataFrame:
    """Additive totals per day (combined map-side)."""
    timed = rows.select(F.col(ts).cast("timestamp_ntz").alias("_ts"), success.alias("_ok"), duration.cast("double").alias("_dur"))
    return timed.groupBy(F.to_date("_ts").alias("report_date")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("yes"), F.sum("_dur").alias("seconds"),
        F.count("_dur").alias("timed"), F.max("_ts").alias("latest"))


def kpi_rows(totals: DataFrame) -> DataFrame:
    return totals.select("report_date", F.col("n").alias("total_contacts"), F.col("yes").alias("successful_contacts"),
                         pct(F.col("yes"), F.col("n")).alias("conversion_rate"),
                         (F.col("seconds") / F.nullif(F.col("timed"), F.lit(0))).alias("avg_call_duration"))


def _state(spark: SparkSession, path: str, before: int | None) -> tuple[dict, DataFrame | None]:
    """The ledger row and the open days that the last batch before ``before`` left."""
    earlier = [b for b in batch_numbers(spark, f"{path}/ledger") if before is None or b < before]
    if not earlier:
        return {"batch_id": None, "latest": None, "closed_before": None}, None
    last = max(earlier)
    row = spark.read.schema(LEDGER.rsplit(",", 1)[0]).parquet(batch_folder(f"{path}/ledger", last)).first()
    state = spark.read.schema(TOTALS).parquet(batch_folder(f"{path}/open", last))
    return {"batch_id": last, "latest": row["latest"], "closed_before": row["closed_before"]}, state


def take_batch(batch: DataFrame, batch_id: int, path: str, ts: str, success: Column, duration: Column,
               delay: dt.timedelta = dt.timedelta(days=1)) -> None:
    """Count one batch into the open days, close what is due and write the batch's folders."""
    spark = batch.sparkSession
    state, open_days = _state(spark, path, batch_id)
    time, bound = F.col(ts).cast("timestamp_ntz"), state["closed_before"]
    late, in_time = time.isNull(), time.isNotNull()
    if bound is not None:  # plain ranges on the time: the scan for late rows skips files and row groups
        edge = F.lit(bound).cast("timestamp_ntz")
        late, in_time = late | (time < edge), time >= edge
    set_aside = batch.where(late).withColumn("late_reason", F.when(time.isNull(), "no time").otherwise("day closed"))
    # late rows are counted here too, by their days: only a batch that has some is read again for them
    days = day_totals(batch, ts, F.when(in_time, success), F.when(in_time, duration)).withColumn("fresh", F.col("n"))
    if open_days is not None:
        days = days.unionByName(open_days.withColumn("fresh", F.lit(0).cast("bigint")))
    _give_out(days, batch_id, path, state, lambda latest: (latest - delay).date(), set_aside)
    # of older states only the last is kept: a batch that is worked again starts from it
    for name in ("open", "_days"):
        drop_batches(spark, f"{path}/{name}", [b for b in batch_numbers(spark, f"{path}/{name}")
                                               if b < (batch_id if name == "_days" else state["batch_id"] or 0)])


def _give_out(days: DataFrame, batch_id: int, path: str, state: dict, first_open: Callable,
              set_aside: DataFrame | None = None) -> None:
    """Merge the totals, write late rows, closed and open days and the ledger row.

    All but the late rows come from a table of a row for each open day and each day of late rows.
    """
    spark = days.sparkSession
    total = days.groupBy("report_date").agg(*(F.sum(c).alias(c) for c in ("n", "yes", "seconds", "timed", "fresh")),
                                            F.max("latest").alias("latest"))
    days = spark.read.schema(f"{TOTALS}, fresh bigint").parquet(write_batch(total, f"{path}/_days", batch_id))
    late = F.col("report_date").isNull()
    if state["closed_before"] is not None:
        late = late | (F.col("report_date") < F.lit(state["closed_before"]))
    seen, late_rows = days.agg(F.max(F.when(~late, F.col("latest"))), F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0))).first()
    days = days.where(~late)
    if set_aside is not None:  # none are late: an empty table, for which nothing of the batch is read or joined
        write_batch(set_aside if late_rows else set_aside.limit(0), f"{path}/late", batch_id)
    latest = max((x for x in (seen, state["latest"]) if x is not None), default=None)
    bound = max((x for x in (first_open(latest) if latest else None, state["closed_before"]) if x is not None), default=None)
    due = F.lit(False) if bound is None else F.col("report_date") < F.lit(bound)
    write_batch(kpi_rows(days.where(due)), f"{path}/closed", batch_id)
    write_batch(days.where(~due).drop("fresh"), f"{path}/open", batch_id)
    # an aggregate, not a local row: that would start Python workers on the executors
    time = F.lit(latest.isoformat(" ") if latest else None).cast("timestamp_ntz")
    entry = days.agg((F.coalesce(F.sum("fresh"), F.lit(0)) + F.lit(late_rows)).cast("bigint").alias("rows"),
                     F.lit(late_rows).cast("bigint").alias("late_rows"), time.alias("latest"),
                     F.lit(bound).cast("date").alias("closed_before"), F.count_if(~due).alias("open_days"),
                     F.count_if(due).alias("closed_days"))
    write_batch(entry.coalesce(1), f"{path}/ledger", batch_id)


def close_open_days(spark: SparkSession, path: str) -> None:
    """End of the feed: close all open days, as a batch after the last one. Again, it finds none.

    Nothing may come to the feed after that: the next batch would have this one's number.
    """
    state, days = _state(spark, path, None)
    if days is None or days.isEmpty():
        return
    days = days.withColumn("fresh", F.lit(0).cast("bigint"))
    _give_out(days, state["batch_id"] + 1, path, state, lambda latest: (latest + dt.timedelta(days=1)).date())


def run_daily_kpis(stream: DataFrame, path: str, checkpoint: str, ts: str, success: Column, duration: Column,
                   delay: dt.timedelta = dt.timedelta(days=1), shape: Shape | None = None) -> None:
    """Drain what the stream has (``availableNow``) through ``take_batch``; a later call goes on where this one ends.

    ``shape`` makes the counted rows of a batch's rows: joined there, a dimension is planned for the batch.
    """
    q = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: take_batch(shape(batch) if shape else batch, batch_id, path, ts, success,
                                                          duration, delay)).start())
    q.awaitTermination()


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """The KPI rows of all closed days, with the batch that closed them."""
    return read_batches(spark, f"{path}/closed", CLOSED)


def open_days(spark: SparkSession, path: str) -> DataFrame:
    """The KPI rows of the days still open, as they stand."""
    _, days = _state(spark, path, None)
    return kpi_rows(days if days is not None else spark.createDataFrame([], TOTALS))


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that came after their day was closed, with the reason and the batch."""
    return read_batches(spark, f"{path}/late", schema)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/ledger", LEDGER)
