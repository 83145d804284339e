"""Tables of a namespace: loads replace, retries are safe, statistics are kept and used."""

import pytest
from pyspark.sql import functions as F

from callsheet.__main__ import main
from callsheet.sources import files, tables
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL


def _place(spark):
    path = files.scratch_path(spark, "test_namespace")
    return "test_" + path.rsplit("/", 1)[1], path


def test_a_load_replaces_the_table(spark):
    database, place = _place(spark)
    first = tables.load_table(spark.range(10).withColumn("p", F.col("id") % 2), database, "t", location=place)
    assert first.count() == 10 and tables.statistics(spark, database, "t")["rows"] == 10
    second = tables.load_table(spark.range(4).withColumn("q", F.lit("x")), database, "t")
    assert second.columns == ["id", "q"] and second.count() == 4
    assert tables.statistics(spark, database, "t")["rows"] == 4
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.t").collect()}
    assert place.rsplit("/", 1)[1] in described["Location"]


@pytest.mark.parametrize("step", ["ANALYZE", "DROP TABLE IF EXISTS", "ALTER"])
def test_a_load_that_failed_is_done_again(spark, monkeypatch, step):
    """It fails before the new table is analysed, before the old one goes, and between that and the new one's name."""
    database, place = _place(spark)
    tables.load_table(spark.range(3), database, "t", location=place)
    real, seen = type(spark).sql, []

    def failing(self, text, *more, **named):
        if text.startswith(step) and not (step.startswith("DROP") and tables.LOADING in text) and not seen:
            seen.append(text)
            raise RuntimeError("lost")
        return real(self, text, *more, **named)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        tables.load_table(spark.range(7), database, "t")
    again = tables.load_table(spark.range(7), database, "t")
    assert seen and again.count() == 7 and [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_statistics_decide_a_broadcast(spark):
    database, place = _place(spark)
    rows = spark.range(50_000).withColumn("v", F.concat(F.lit("x"), F.col("id").cast("string")))
    for name in ("one", "two"):
        tables.load_table(rows, database, name, location=place)
    assert tables.statistics(spark, database, "one")["rows"] == 50_000 and tables.statistics(spark, database, "one")["bytes"] > 20_000
    found = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        for cbo in ("true", "false"):
            spark.conf.set("spark.sql.cbo.enabled", cbo)
            # few rows are left of the second table, which only its column statistics tell
            joined = spark.table(f"{database}.one").join(spark.table(f"{database}.two").where("id < 50"), "id")
            found[cbo] = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.cbo.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in found["true"] and "SortMergeJoin" in found["false"]


def test_pipeline_loads_a_namespace(spark):
    src, target = files.scratch_path(spark, "ns_raw"), files.scratch_path(spark, "ns_out")
    files.write_contacts_csv(raw_contacts(spark, SF_SMALL), src)
    database, place = _place(spark)
    tables.ensure_database(spark, database, place)
    assert main(["pipeline", "--raw", src, "--target", target, "--as-of", "1998-06-10", "--namespace", database]) == 0
    fact = spark.table(f"{database}.fct_campaigns")
    assert fact.count() == spark.read.parquet(f"{target}/fct_campaigns").count() == tables.statistics(spark, database, "fct_campaigns")["rows"]
    assert {"raw_contacts", "dim_segments", "alerts", "rejected_cells"} <= {t.name for t in spark.catalog.listTables(database)}
