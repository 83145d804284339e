"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (all rows produced,
nothing collected to the driver). A few warm-up queries run first (JVM
class loading); then every query is timed twice, from building the
DataFrame to the last row written, with the cache cleared after each: a
cold pass (first run of its generated code) and a steady-state pass, which
is the headline ``value``. Both are printed in one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callsheet.plans.catalog import QUERIES  # noqa: E402
from callsheet.session import build_session  # noqa: E402

HEADLINE = [
    "raw_contacts", "stg_contacts", "int_segments", "segment_metrics", "dim_segments", "dim_segments_exact",
    "fct_campaigns", "kpi_daily", "top_segments", "campaign_report", "dq_suite", "dq_schema_tests",
    "dq_score", "measure_query", "kpi_by_timeframe", "tile_summary",
]


WARM_UP = ["raw_contacts", "segment_metrics", "dq_suite"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus, app_name="callsheet-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    for name in WARM_UP:  # JVM class loading, not timed
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()

    def run_all() -> dict[str, float]:
        out = {}
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t0, 3)
            spark.catalog.clearCache()  # no query may reuse data another one persisted
        return out

    cold = run_all()  # first execution of each query's generated code
    times = run_all()  # steady state (JIT-compiled), the headline
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "cold_total": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
