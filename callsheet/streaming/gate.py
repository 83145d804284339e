"""A quality gate in a stream: rows that fail a check go to quarantine with the reasons, the others go on.

Each batch is read once and written once, passed and quarantined rows side by
side in the batch's folder, which one commit makes visible and a batch that is
worked again replaces. So passed + quarantined is the input, exactly, whatever
was retried. The counts per check come from what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Check, run_suite
from .sinks import Shape, read_batches, write_batch

PASSED, QUARANTINED = "passed", "quarantined"
COUNTS = "suite string, test_name string, column_name string, violations bigint, status string, batch_id bigint"


def reasons(checks: Sequence[Check]) -> Column:
    """The failed checks of a row as ``test: column``, in the order of the checks."""
    failed = ", ".join(f"CASE WHEN {c.violation} THEN '{c.test}: {c.column}' END" for c in checks)
    return F.array_compact(F.expr(f"array({failed})"))


def judged(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows with ``reasons`` and ``verdict``. A projection: nothing moves."""
    return rows.withColumn("reasons", reasons(checks)).withColumn(
        "verdict", F.when(F.size("reasons") == 0, PASSED).otherwise(QUARANTINED))


Onward = Callable[[DataFrame, int], None]


def take_batch(batch: DataFrame, batch_id: int, path: str, checks: Sequence[Check], onward: Onward | None = None) -> None:
    """Judge one batch, write it in two folders, count, and hand the passed rows on under the batch's number."""
    folder = write_batch(judged(batch, checks), f"{path}/rows", batch_id, partition_by=("verdict",))
    written = batch.sparkSession.read.schema(f"{schema_of(batch)}, verdict string").parquet(folder)
    write_batch(run_suite(written, checks), f"{path}/counts", batch_id)
    if onward:
        onward(written.where(F.col("verdict") == PASSED).drop("verdict"), batch_id)


def run_gate(stream: DataFrame, path: str, checkpoint: str, checks: Sequence[Check], onward: Onward | None = None,
             shape: Shape | None = None) -> None:
    """Drain what the stream has (``availableNow``) through the gate.

    ``shape`` makes the judged rows of a batch's rows: joined there, a dimension is planned for the batch.
    ``onward`` gets each batch's passed rows and its number, once or again after
    a failure: a sink that keeps batches by number (``ledger.take_batch``) stays exact.
    """
    q = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: take_batch(shape(batch) if shape else batch, batch_id, path, checks, onward)).start())
    q.awaitTermination()


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _rows(spark: SparkSession, path: str, schema: str, verdict: str) -> DataFrame:
    rows = read_batches(spark, f"{path}/rows", f"{schema}, reasons array<string>, verdict string, batch_id bigint")
    return rows.where(F.col("verdict") == verdict)  # a folder of its own in each batch


def passed_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What goes on, in the columns of the stream."""
    return _rows(spark, path, schema, PASSED).drop("reasons", "verdict", "batch_id")


def quarantined_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What was held back, with reasons and batch_id."""
    return _rows(spark, path, schema, QUARANTINED).drop("verdict")


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Violations per check and batch."""
    return read_batches(spark, f"{path}/counts", COUNTS)
