"""The command line runs the jobs end to end on delimited input."""

import datetime as dt

from pyspark.sql import functions as F

from callsheet.__main__ import main
from callsheet.plans.pipeline import daily_report
from callsheet.schema import RAW_SCHEMA_WITH_LINEAGE
from callsheet.sources import files
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL


def test_cli_pipeline_check_and_report(spark):
    src = files.scratch_path(spark, "cli_raw")
    files.write_contacts_csv(raw_contacts(spark, SF_SMALL), src)
    target = files.scratch_path(spark, "cli_out")
    assert main(["pipeline", "--raw", src, "--target", target, "--as-of", "1998-06-10"]) == 0
    assert spark.read.parquet(f"{target}/fct_campaigns").count() > 0
    # the canonical file lacks the loader's balance/day columns: the gate fails
    assert main(["check", "--raw", src, "--target", target + "_chk"]) == 1
    assert spark.read.parquet(f"{target}_chk/dq_test_results").count() == 6
    assert main(["report", "--raw", src, "--target", target + "_rep", "--as-of", "1998-06-10"]) == 0
    assert spark.read.parquet(f"{target}_rep/report_tests").count() in (0, 6)


def test_daily_report_tables(spark):
    raw = files.read_contacts(spark, files.write_contacts_csv(
        raw_contacts(spark, SF_SMALL), files.scratch_path(spark, "rep_raw")), schema=RAW_SCHEMA_WITH_LINEAGE)
    rep = daily_report(raw, dt.date(1998, 6, 10))
    assert set(rep) == {"kpis", "segments", "campaigns", "tests"}
    assert rep["segments"].count() <= 10


def _loader_file(spark, bad=False):
    """Contacts as the loader's file has them: with balance and day, all within the gate's bounds, no row twice."""
    raw = raw_contacts(spark, SF_SMALL).where("age between 18 and 95 and duration > 0 and campaign >= 1")
    frame = raw.withColumn("balance", F.col("contact_id") * F.lit(1.5)).withColumn("day", F.dayofmonth("processed_at").cast("bigint"))
    if bad:
        frame = frame.withColumn("duration", F.when(F.col("contact_id") % 7 == 0, "?").otherwise(F.col("duration").cast("string")))
    src = files.scratch_path(spark, "cli_loader")
    files.write_contacts_csv(frame, src)
    return src, raw


def test_check_passes_a_valid_loader_file(spark):
    src, _ = _loader_file(spark)
    target = files.scratch_path(spark, "cli_valid")
    assert main(["check", "--raw", src, "--target", target]) == 0
    assert main(["check", "--raw", src, "--target", target, "--strict"]) == 0
    assert spark.read.parquet(f"{target}/rejected_cells").count() == 0


def test_strict_check_stops_at_unreadable_cells(spark):
    src, raw = _loader_file(spark, bad=True)
    target = files.scratch_path(spark, "cli_bad")
    assert main(["check", "--raw", src, "--target", target]) == 0
    assert main(["check", "--raw", src, "--target", target, "--strict"]) == 1
    cells = spark.read.parquet(f"{target}/rejected_cells")
    assert cells.where("column_name = 'duration' and value = '?'").count() == raw.where("contact_id % 7 = 0").count() == cells.count()


def test_pipeline_keeps_rejected_cells_by_day(spark, capsys):
    src, raw = _loader_file(spark, bad=True)
    target = files.scratch_path(spark, "cli_rejected")
    for _ in range(2):  # a retry replaces its day
        assert main(["pipeline", "--raw", src, "--target", target, "--as-of", "1998-06-10"]) == 0
    bad = raw.where("contact_id % 7 = 0").count()
    assert spark.read.parquet(f"{target}/rejected_cells").where("load_date = '1998-06-10'").count() == bad
    assert f"{bad} cells could not be read" in capsys.readouterr().out


def test_check_finds_text_in_a_typed_file(spark):
    src, target = files.scratch_path(spark, "cli_text_age"), files.scratch_path(spark, "cli_text_out")
    raw_contacts(spark, SF_SMALL).withColumn("age", F.col("age").cast("string")).write.parquet(src)
    main(["check", "--raw", src, "--format", "parquet", "--target", target])
    (row,) = spark.read.parquet(f"{target}/dq_test_results").where("test_name = 'Data Types Check'").collect()
    assert (row.status, row.failures) == ("FAILED", 1)
