"""Explicit schemas for the raw contact table and its variants."""

from __future__ import annotations

from pyspark.sql import types as T

from . import fixed

_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "timestamp_ntz": T.TimestampNTZType()}

# Canonical raw contact schema (variant A), never inferred.
RAW_SCHEMA = T.StructType([T.StructField(c, _TYPES[t], True) for c, t in fixed.RAW_COLUMN_TYPES])

# Lineage columns carried next to variant A when the source provides them:
# a contact id (total order tie-break), the real client key and the contact
# timestamp that replaces query time as ``processed_at``.
LINEAGE_COLUMNS = [("contact_id", "bigint"), ("client_key", "bigint"), ("processed_at", "timestamp_ntz")]
RAW_SCHEMA_WITH_LINEAGE = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(c, _TYPES[t], True) for c, t in LINEAGE_COLUMNS])

# Variant C: same columns with dotted indicator names.
DOTTED_NAMES = {
    "emp.var.rate": "emp_var_rate",
    "cons.price.idx": "cons_price_idx",
    "cons.conf.idx": "cons_conf_idx",
    "nr.employed": "nr_employed",
}

# Variant D: type by column name (loader rule).
def loader_type(name: str) -> str:
    if name in fixed.LOADER_INT_COLUMNS:
        return "bigint"
    if name in fixed.LOADER_FLOAT_COLUMNS:
        return "double"
    return "string"


def type_name(dt: T.DataType) -> str:
    return dt.simpleString()


RAW_TYPES = {c: t for c, t in fixed.RAW_COLUMN_TYPES}
