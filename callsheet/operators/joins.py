"""Equi-join of a large fact to a dimension when one key may be hot.

With AQE's skew-join handling on (the default session setting), a plain
join is planned: AQE splits an oversized shuffle partition at run time and
replicates the matching dimension rows. When it is off, the hot keys are
split explicitly: one aggregate over the fact's key column finds keys that
hold more than ``hot_share`` of the rows; there can be at most
``1 / hot_share`` of them, so their dimension rows have a proven size bound
and are broadcast to the hot fact rows. All other rows take the ordinary
shuffle join. Both parts are unioned; no row is dropped or duplicated (the
dimension key is unique). A stream's plan has no AQE: see ``_streamed``. The
batches of a stream are plain frames: joined there (``of_batches``), nothing is
copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aqe_splits_skew(spark) -> bool:
    return (spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"
            and spark.conf.get("spark.sql.adaptive.skewJoin.enabled", "true") == "true")


BROADCAST_ROWS = 200_000  # dimension rows up to which a stream's join broadcasts them
SALTS = 32


def _streamed(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """A stream is planned without AQE and its hot keys are not known ahead.

    A dimension that is counted to be small is broadcast. Else every stream row
    gets one of ``SALTS`` salts from a hash of its other columns and the
    dimension is repeated once per salt, so a key's rows spread over as many tasks.
    The copies are merged, never broadcast: Spark estimates them from the files
    of the dimension, which know nothing of the copies.
    """
    if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key], "inner")
    others = [F.col(f"`{c}`") for c in fact.columns if c != fact_key]
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)))
    copies = dim.withColumn("_salt_d", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    joined = salted.join(copies.hint("merge"), (salted[fact_key] == copies[dim_key]) & (salted["_salt"] == copies["_salt_d"]), "inner")
    return joined.drop("_salt", "_salt_d")


def of_batches(dim: DataFrame) -> DataFrame:
    """A dimension that each batch of a stream joins as a plain frame.

    It is broadcast if it is counted to be small and else merged, whatever Spark
    estimates from its files.
    """
    return F.broadcast(dim) if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else dim.hint("merge")


def skew_safe_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   hot_share: float = 0.001, force_split: bool = False) -> DataFrame:
    """Inner join ``fact.fact_key = dim.dim_key`` (``dim_key`` unique in ``dim``)."""
    if fact.isStreaming:
        return _streamed(fact, dim, fact_key, dim_key)
    if not force_split and aqe_splits_skew(fact.sparkSession):
        return fact.join(dim, fact[fact_key] == dim[dim_key], "inner")
    total = fact.agg(F.count(F.lit(1))).scalar()
    hot = (fact.groupBy(F.col(fact_key).alias("_hk")).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > total * F.lit(hot_share)).select("_hk"))
    # at most 1 / hot_share keys: a proven bound for the broadcasts below
    hot_b = F.broadcast(hot)
    hot_rows = fact.join(hot_b, fact[fact_key] == hot_b["_hk"], "left_semi")
    cold_rows = fact.join(hot_b, fact[fact_key] == hot_b["_hk"], "left_anti")
    hot_dim = dim.join(hot_b, dim[dim_key] == hot_b["_hk"], "left_semi")
    hot_part = hot_rows.join(F.broadcast(hot_dim), hot_rows[fact_key] == hot_dim[dim_key], "inner")
    cold_part = cold_rows.join(dim, cold_rows[fact_key] == dim[dim_key], "inner")
    return hot_part.unionByName(cold_part)
