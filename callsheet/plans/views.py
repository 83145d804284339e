"""Named relations for SQL users: every layer as a temp view.

Views are lazy (nothing runs until a query reads them), which is how the
studied mart materializes its staging and intermediate layers; the marts are
views over the same plan here, or tables when written by the pipeline.
SQL over the layer names (``stg_contacts``,
``int_contact_segments``, ``dim_segments``,
``fct_campaigns``) runs unchanged through ``spark.sql``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .. import fixed
from ..operators.segments import segment
from ..operators.staging import stage
from . import marts
from .tiles import EXPLORE_DATE_FIELDS

LAYERS = ["raw_contacts", "stg_contacts", "int_contact_segments", "dim_segments",
          "dim_segments_exact", "fct_campaigns"]


# Explore name -> the layer it reads and the type of its date field.
EXPLORE_LAYERS = {"staged_contacts": "stg_contacts", "segmented_contacts": "int_contact_segments",
                  "campaign_fact": "fct_campaigns", "segment_dimension": "dim_segments_exact"}


def register_explores(spark: SparkSession, as_of: dt.date | None = None) -> list[str]:
    """Temporary SQL table functions over the registered layers, one for each explore: ``explore_<name>(as_of, days)``.

    A layer is reached through its function with the mandatory filter on its
    date field, the last ``days`` days up to ``as_of`` (by default 30, up to the
    given day or today). The filter is a plain range, so it reaches the scan
    as in Python. Call ``register_views`` first.
    """
    day = f"DATE'{as_of.isoformat()}'" if as_of else "current_date()"
    made = []
    for name, layer in EXPLORE_LAYERS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(layer).schema.fields)
        field = f"{layer}.{EXPLORE_DATE_FIELDS[name]}"
        start = f"date_sub(explore_{name}.up_to, explore_{name}.days - 1)"
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION explore_{name}(up_to DATE DEFAULT {day}, days INT DEFAULT {fixed.TILE_WINDOW_DAYS})
            RETURNS TABLE ({columns})
            RETURN SELECT * FROM {layer}
                   WHERE {field} >= CAST({start} AS TIMESTAMP_NTZ)
                     AND {field} < CAST(date_add(explore_{name}.up_to, 1) AS TIMESTAMP_NTZ)""")
        made.append(f"explore_{name}")
    return made


def register_views(raw: DataFrame, as_of: dt.date | None = None, with_key: bool = True) -> dict[str, DataFrame]:
    """Register the layers as temp views of ``raw``'s session; returns them."""
    staged = stage(raw, as_of, with_key=with_key, eager_key=False)
    # the marts don't show the contact key, so their views do without the numbering
    plain = segment(stage(raw, as_of, with_key=False))
    metrics = marts.segment_metrics(plain, as_of, keep_count=True)
    frames = {
        "raw_contacts": raw,
        "stg_contacts": staged,
        "int_contact_segments": segment(staged),
        "dim_segments": marts.dimension_from_metrics(metrics, exact=False),
        "dim_segments_exact": marts.dimension_from_metrics(metrics, exact=True),
        "fct_campaigns": marts.fct_campaigns(plain, as_of),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
