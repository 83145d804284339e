"""Tables in a namespace of the session's catalog, with statistics.

A load writes a new table beside the old one, analyses it and then takes its
place, so readers see the old rows or the new ones, and a load that failed at
any point is simply done again: what an earlier try left is replaced. Row counts
and column statistics are kept with the table, so the planner's choices (a
broadcast, the order of joins) rest on them and not on file sizes alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOADING = "__loading"


def quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace if missing (catalog metadata only), at ``location`` or in the warehouse."""
    place = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def load_table(df: DataFrame, database: str, name: str, location: str | None = None) -> DataFrame:
    """Truncate-and-load ``df`` as ``database.name``; returns the table. ``location`` is the namespace's, if it is new.

    Not partitioned: a catalog need not move a partition's place with its
    table's name. Rows sorted by what is filtered on let row groups be skipped.
    """
    spark = df.sparkSession
    ensure_database(spark, database, location)
    new, final = quoted(database, name + LOADING), quoted(database, name)
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    df.writeTo(new).using("parquet").create()
    spark.sql(f"ANALYZE TABLE {new} COMPUTE STATISTICS FOR ALL COLUMNS")
    spark.sql(f"DROP TABLE IF EXISTS {final}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {final}")
    return spark.table(final)


def statistics(spark: SparkSession, database: str, name: str) -> dict[str, int]:
    """``rows`` and ``bytes`` that the catalog holds for a table; none if it was not analysed."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(database, name)}").collect():
        if r["col_name"] == "Statistics":
            said = dict(reversed(part.strip().split(" ", 1)) for part in r["data_type"].split(","))
            return {kind: int(said[kind]) for kind in ("rows", "bytes") if kind in said}
    return {}


def publish(paths: dict[str, str], spark: SparkSession, database: str, location: str | None = None) -> dict[str, DataFrame]:
    """The pipeline's Parquet tables as tables of a namespace."""
    return {name: load_table(spark.read.parquet(path), database, name, location=location) for name, path in paths.items()}
