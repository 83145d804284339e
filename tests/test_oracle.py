"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from callsheet.plans import marts
from callsheet.plans.catalog import QUERIES
from tests.conftest import SF_MID, SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.12g}")
        return v

    return sorted(hashlib.md5(repr([norm(r[i]) for i in order]).encode()).hexdigest() for r in rows)


def _connected(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def con():
    return _connected(SF_SMALL)


@pytest.fixture(scope="module")
def mid_con():
    return _connected(SF_MID)


NAMES = sorted(set(QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(queries()) and set(NAMES) <= set(oracle_sql())


def test_entry_smoke(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows, df.columns) == _digest(orows, ocols)


# sorted outputs and their sort columns; a minus marks a descending one, None stands for all columns from the left
SORTED = {
    "dim_segments": ["-segment_conversion_rate", *marts.SEGMENT_KEYS],
    "dim_segments_exact": ["-segment_conversion_rate", *marts.SEGMENT_KEYS],
    "fct_campaigns": ["campaign_number", "campaign_date"],
    "top_segments": ["-segment_conversion_rate", "age_group", "job_category"],
    "campaign_report": ["-overall_conversion_rate", "campaign_number"],
    "tile_segmentation": ["-segment_conversion_rate", "age_group", "job_category", "-segment_size"],
    "tile_conversion": None,
    "tile_daily_trend": None,
}


def _keys(rows, cols, by):
    """The sort columns' values of each row, in the rows' order."""
    at = [cols.index(c.lstrip("-")) for c in by]
    return [tuple(float(f"{r[i]:.12g}") if isinstance(r[i], float) else r[i] for i in at) for r in rows]


@pytest.mark.parametrize("name", sorted(SORTED))
def test_sorted_outputs_come_in_order(spark, mid_con, name):
    df = queries()[name](spark, SF_MID)
    by = SORTED[name] or df.columns
    got = _keys([tuple(r) for r in df.collect()], df.columns, by)
    res = mid_con.execute(oracle_sql()[name])
    want = _keys(res.fetchall(), [d[0] for d in res.description], by)
    for i in reversed(range(len(by))):  # stable sorts from the last column on; nulls are the lowest values
        want.sort(key=lambda k: (False,) if k[i] is None else (True, k[i]), reverse=by[i].startswith("-"))
    assert got == want and len(got) > 1
