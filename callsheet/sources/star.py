"""Contacts derived from the star-schema test tables.

One contact per order: ``orders JOIN customer ON o_custkey = c_custkey`` is
projected onto the raw contact schema with a deterministic hash ``h`` so that
every categorical, range and consistency rule of the mart is exercised
(including nulls, out-of-range values, mixed case and weekend days).
The mapping is the fixture contract shared with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed
from ..operators.joins import skew_safe_join
from ..schema import RAW_SCHEMA_WITH_LINEAGE

# Fixture contract constants (hash multipliers, modulus, bases).
H_ORDER_MULT = 7919
H_CUST_MULT = 104729
H_MOD = 1000003
OUTCOMES4 = ["failure", "nonexistent", "success", "other"]


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v + "'" for v in values) + ")"


def _contact_exprs() -> list[str]:
    """The fixture mapping as SQL expressions (one JVM call for the whole
    projection); ``h`` and ``nk`` come from the inner projection."""
    jobs13 = _sql_list(fixed.JOBS + ["executive"])
    yn = _sql_list(fixed.NO_UNKNOWN_YES)
    job = f"{jobs13}[CAST(o_custkey % 13 AS INT)]"
    return [
        "CAST(CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE 16 + (o_custkey * 31 + nk) % 82 END AS BIGINT) AS age",
        f"CASE WHEN o_orderkey % 10 = 0 THEN concat(' ', upper({job}), ' ') ELSE {job} END AS job",
        f"{_sql_list(fixed.MARITAL)}[CAST(nk % 4 AS INT)] AS marital",
        f"CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {_sql_list(fixed.EDUCATION)}[CAST(o_custkey % 8 AS INT)] END"
        " AS education",
        f"{yn}[CAST(h % 3 AS INT)] AS `default`",
        f"{yn}[CAST((h div 3) % 3 AS INT)] AS housing",
        f"{yn}[CAST((h div 9) % 3 AS INT)] AS loan",
        f"{_sql_list(fixed.CONTACT)}[CAST(h % 2 AS INT)] AS contact",
        "lower(date_format(o_orderdate, 'MMM')) AS month",
        "lower(date_format(o_orderdate, 'EEE')) AS day_of_week",
        "CAST(floor(o_totalprice) AS BIGINT) % 1200 - 20 AS duration",
        "CAST(substring(o_orderpriority, 1, 1) AS BIGINT) - CASE WHEN o_orderkey % 151 = 0 THEN 5 ELSE 0 END"
        " AS campaign",
        "CASE WHEN h % 5 < 3 THEN -1 ELSE (h div 5) % 1000 END AS pdays",
        "CASE WHEN h % 5 < 3 THEN (CASE WHEN o_orderkey % 89 = 0 THEN 2 ELSE 0 END) ELSE (h div 7) % 12 END"
        " AS previous",
        f"{_sql_list(OUTCOMES4)}[CAST(h % 4 AS INT)] AS poutcome",
        "CAST(h % 49 - 34 AS DOUBLE) / 1e1 AS emp_var_rate",
        "CAST(92201 + h % 2567 AS DOUBLE) / 1e3 AS cons_price_idx",
        "CAST(h % 240 - 508 AS DOUBLE) / 1e1 AS cons_conf_idx",
        "CAST(634 + h % 4412 AS DOUBLE) / 1e3 AS euribor3m",
        "CAST(49636 + h % 2646 AS DOUBLE) / 1e1 AS nr_employed",
        "CASE WHEN h % 100 < 6 + o_custkey % 13 THEN 'yes' ELSE 'no' END AS y",
        "o_orderkey AS contact_id",
        "o_custkey AS client_key",
        "o_orderdate AS processed_at",
    ]


def contacts_from_star(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Project ``orders ⋈ customer`` onto variant A plus lineage columns.

    Only five order columns and two customer columns are read, so the scan
    prunes the rest; the join is an equi-join on the customer key, left to
    the planner (sort-merge at scale, AQE broadcast when the runtime size of
    the customer side is under the threshold). A customer holding a large
    share of the orders is split by AQE's skew join, or explicitly when that
    is off (``operators.joins.skew_safe_join``).
    """
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.selectExpr("c_custkey", "CAST(c_nationkey AS BIGINT) AS nk")
    j = skew_safe_join(o, c, "o_custkey", "c_custkey").selectExpr(
        "*", f"(o_orderkey * {H_ORDER_MULT} + o_custkey * {H_CUST_MULT}) % {H_MOD} AS h")
    out = j.selectExpr(*_contact_exprs())
    assert out.columns == RAW_SCHEMA_WITH_LINEAGE.fieldNames()
    return out


# Columns read from the star tables, declared so that no footer-inference job
# runs and only these columns are requested from the files.
STAR_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in STAR_SCHEMAS:
        reader = reader.schema(STAR_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw contacts for a directory of star-schema tables."""
    return contacts_from_star(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))
