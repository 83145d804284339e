"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the mart relies on: AQE re-plans joins and coalesces small
# shuffles, skew-join splits a hot key's partition, UTC keeps date
# arithmetic stable, and the UI stays off (no server).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # choices rest on a table's statistics where the catalog has them
    "spark.sql.cbo.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture per Column call (three JVM round trips each)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


STATIC_DEFAULTS = {"spark.ui.enabled", "spark.ui.showConsoleProgress", "spark.python.sql.dataFrameDebugging.enabled"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "callsheet", extra: dict | None = None) -> SparkSession:
    """A session with the mart's defaults.

    SQL defaults fill in only what the context's configuration does not
    already hold (``spark-submit --conf``, ``spark-defaults.conf``), so a
    cluster's settings win; explicit ``shuffle_partitions`` and ``extra``
    always apply. Static settings (UI off: no server; no Python call-site
    capture) are set on the builder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k in STATIC_DEFAULTS:
        builder = builder.config(k, SESSION_DEFAULTS[k])
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configured = spark.sparkContext.getConf()
    for k, v in SESSION_DEFAULTS.items():
        if k not in STATIC_DEFAULTS and k not in explicit and not configured.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to shared storage; only a local master that
    leaves it unset gets a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="callsheet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    """Partition count for an explicit repartition: AQE's initial partition
    number when set (a cluster sizes it from the input), else the session's
    shuffle partitions."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions", "200"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written once below the shared folder and read back: columns are pruned, the lineage is cut."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/callsheet/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a reused intermediate once and cut its lineage.

    Used for small tables that several branches of a plan read (a segment
    table bounded by the rule-label domain): without it each branch prunes
    columns differently, exchange reuse does not apply, and every branch
    would re-scan the source. A reliable checkpoint into the shared
    ``spark.checkpoint.dir`` survives executor loss without recomputation.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
