"""Command line: run the mart's jobs on Spark.

    python -m callsheet pipeline --raw PATH [--format csv|parquet] --target DIR --as-of YYYY-MM-DD
    python -m callsheet check    --raw PATH [--format csv|parquet] --target DIR [--strict]
    python -m callsheet report   --raw PATH [--format csv|parquet] --target DIR --as-of YYYY-MM-DD

``pipeline`` loads, checks and builds every table; ``check`` writes the
ingest gate, the six-test report and the cells that can't be read in their
types (exit status 1 when the gate fails);
``report`` writes the four daily-report tables. Input is raw contacts
(canonical columns, dotted variants or the loader variant are conformed).
The master and all settings come from ``spark-submit`` / the environment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from .operators import quality
from .plans.pipeline import daily_report, run_pipeline
from .session import build_session
from .sources.files import FILE, as_read, conform, rejected_cells, typed, typed_columns, write_table
from .sources.tables import publish


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="callsheet")
    p.add_argument("command", choices=["pipeline", "check", "report"])
    p.add_argument("--raw", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--target", required=True)
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--strict", action="store_true")
    p.add_argument("--namespace", help="also load the pipeline's tables into this namespace of the catalog")
    p.add_argument("--history", help="the pipeline's dq_test_history table, for report")
    a = p.parse_args(argv)

    spark = build_session()
    source = as_read(spark, a.raw, a.format)
    read = typed(source) if a.format == "csv" else source.drop(FILE)
    raw = conform(read, keep_extra=True)
    as_of = a.as_of or dt.date.today()
    if a.command == "pipeline":
        paths = run_pipeline(raw, a.target, as_of, source)
        for name, path in paths.items():
            print(f"{name}\t{path}")
        if a.namespace:
            publish(paths, spark, a.namespace)
        bad = spark.read.parquet(paths["rejected_cells"]).where(F.col("load_date") == F.lit(as_of)).count()
        print(f"{bad} cells could not be read in their types" + (f": see {paths['rejected_cells']}" if bad else ""))
        return 0
    if a.command == "check":
        gate = quality.ingest_gate(read, strict=a.strict)  # the columns as they came, before any is filled in
        write_table(gate, f"{a.target}/ingest_gate")
        write_table(quality.test_report(raw, as_read=typed_columns(source)), f"{a.target}/dq_test_results")
        write_table(rejected_cells(source), f"{a.target}/rejected_cells")
        return 0 if spark.read.parquet(f"{a.target}/ingest_gate").first().passed else 1
    history = spark.read.parquet(a.history) if a.history else None
    for name, df in daily_report(raw, as_of, history).items():
        write_table(df, f"{a.target}/report_{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
