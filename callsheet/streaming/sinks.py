"""Tables written batch by batch: a folder per batch number, so a batch that is worked again replaces its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Shape = Callable[[DataFrame], DataFrame]

def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> str:
    """Write one batch's rows; what an earlier attempt left is replaced."""
    w = df.write.mode("overwrite")
    folder = batch_folder(path, batch_id)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    return folder


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder was written to its end."""
    files, root = _files(spark, path)
    if not files.exists(root):
        return []
    found = []
    for f in files.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("batch_id=") and files.exists(_files(spark, f"{path}/{name}/_SUCCESS")[1]):
            found.append(int(name.removeprefix("batch_id=")))
    return sorted(found)


def drop_batches(spark: SparkSession, path: str, numbers: list[int]) -> None:
    for n in numbers:
        files, folder = _files(spark, batch_folder(path, n))
        files.delete(folder, True)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a table; ``schema`` names ``batch_id bigint`` last."""
    done = batch_numbers(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    # the folders of unfinished attempts are not named
    return spark.read.schema(schema).option("basePath", path).parquet(*[batch_folder(path, n) for n in done])
