"""What the operators share: scratch tables in the shared folder, worker imports, safe column picks."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# the contract's word: everything between the six ASCII blanks
BLANKS = " \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from its own folder.

    On a cluster the package must be installed or sent with ``--py-files``;
    the folder is only added to what the workers already search.
    """
    env = spark.sparkContext.environment
    # large arrays go back to the system when freed, so a reused worker stays small
    env.setdefault("MALLOC_MMAP_THRESHOLD_", "262144")
    env.setdefault("MALLOC_TRIM_THRESHOLD_", "1048576")
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    if REPO not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)


def cut_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of few bytes, where the session names no size: what executors hold beside
    their heap stays small."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


class Scratch:
    """Intermediate tables of one operator call, written below ``spark.checkpoint.dir``.

    A written table cuts the lineage, outlives executors and is read back with
    column pruning. ``free`` removes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
        self.tables: list[DataFrame] = []
        self.made = 0
        ship(spark)

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.tables.append(out)
        return out

    def free(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(conf).delete(path, True)


_kept: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    """What a Python worker keeps for an operator from task to task. Spark reuses workers in later stages: what another
    operator left there is dropped and given back to the system."""
    if operator not in _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()
        _kept[operator] = {}
    return _kept[operator]


class Memo:
    """A worker's memory of computed values: two generations of at most ``size`` entries each.

    When the young generation is full it becomes the old one; what is met
    again moves back, so frequent entries stay and memory stays bounded.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key, make):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = make(key)
            if len(self.young) >= self.size:
                self.young, self.old = {}, self.young
            self.young[key] = got
        return got


def few(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A narrow table, marked for broadcast if it is counted to be small; else joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, in their usual types, whatever else the table carries."""
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    return docs.select(*(docs[f"`{c}`"].cast(kinds[c]).alias(c) for c in columns))


def one_text_each(rows: DataFrame, label: str) -> DataFrame:
    """doc_id, label and text of one row per doc_id: the one whose text has the lowest hash."""
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("_first")
    return rows.groupBy("doc_id", label).agg(first).select("doc_id", label, F.col("_first.text").alias("text"))


def words(text) -> F.Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
