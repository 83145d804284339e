"""Delimited round trip, type coercion and schema variants."""

from pyspark.sql import functions as F

from callsheet.schema import RAW_SCHEMA_WITH_LINEAGE
from callsheet.sources import files
from callsheet.sources.star import raw_contacts
from tests.conftest import SF_SMALL


def test_csv_round_trip_is_lossless(spark):
    raw = raw_contacts(spark, SF_SMALL)
    path = files.scratch_path(spark, "test_csv")
    files.write_contacts_csv(raw, path)
    back = files.read_contacts(spark, path, schema=RAW_SCHEMA_WITH_LINEAGE)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    assert back.where(F.col("job").startswith(" ")).count() > 0  # padded values survive


def test_coerce_by_name(spark):
    df = spark.createDataFrame([("41", "x", "2.5", "12", "abc")], "age string, job string, balance string, "
                                                                  "day string, duration string")
    out = files.coerce_schema(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "double", "bigint",
                                                                      "bigint"]
    r = out.first()
    assert (r.age, r.balance, r.day, r.duration) == (41, 2.5, 12, None)


def test_conform_loader_variant(spark):
    df = spark.createDataFrame([(30, "admin.", 10.0, 5)], "age bigint, job string, balance double, day bigint")
    out = files.conform(df)
    assert out.columns[:3] == ["age", "job", "marital"]
    r = out.first()
    assert r.day_of_week is None and r.emp_var_rate is None and r.job == "admin."
    dotted = spark.createDataFrame([(1.1,)], "`emp.var.rate` double")
    assert files.normalise_names(dotted).columns == ["emp_var_rate"]


def test_table_sink_overwrite(spark):
    path = files.scratch_path(spark, "test_table")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    files.write_table(df, path, partition_by=["p"])
    files.write_table(df.where("id < 4"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 4


def test_header_typed_read_keeps_extra_columns(spark):
    raw = raw_contacts(spark, SF_SMALL)
    path = files.scratch_path(spark, "test_header")
    files.write_contacts_csv(raw, path)
    back = files.read_contacts(spark, path)  # no schema: header names, types by name
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in raw.schema]
    loader = spark.createDataFrame([(30, "admin.", 2.5, 7)], "age bigint, job string, balance double, day bigint")
    p2 = files.scratch_path(spark, "test_loader_csv")
    files.write_contacts_csv(loader, p2)
    assert [f.dataType.simpleString() for f in files.read_contacts(spark, p2).schema] == [
        "bigint", "string", "double", "bigint"]


def test_month_partitioned_raw_prunes_folders(spark):
    import datetime as dt
    raw = raw_contacts(spark, SF_SMALL)
    path = files.scratch_path(spark, "raw_months")
    files.write_raw(raw, path)
    day = dt.date(1998, 6, 9)
    got = files.read_raw(spark, path, day, day)
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    part = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")]
    assert part and "contact_month" in part[0]
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed and "processed_at" in pushed[0]
    want = raw.where((F.col("processed_at") >= F.lit("1998-06-09").cast("timestamp_ntz"))
                     & (F.col("processed_at") < F.lit("1998-06-10").cast("timestamp_ntz")))
    got = got.select(*raw.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert files.read_raw(spark, path).count() == raw.count()


def test_raw_files_are_few_and_sorted(spark):
    raw = raw_contacts(spark, SF_SMALL).repartition(8)
    path = files.scratch_path(spark, "raw_files")
    files.write_raw(raw, path)
    table = spark.read.parquet(path).withColumn("file", F.input_file_name())
    months = table.select("contact_month").distinct().count()
    assert table.select("file").distinct().count() <= months + 8
    for name in [r.file for r in table.select("file").distinct().limit(8).collect()]:
        times = [r[0] for r in spark.read.parquet(name).select("processed_at").collect()]
        assert times == sorted(times)


def test_unparsable_cells_are_counted(spark):
    df = spark.createDataFrame([("41", "x"), ("4o", "y"), (None, "z"), ("", "w")], "age string, job string")
    assert [tuple(r) for r in files.unparsable(df, {"age": "bigint", "job": "string"}).collect()] == [("age", 2)]


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _put(spark, path, name, text, opener=open):
    """A file as a foreign tool would leave it."""
    import os
    folder = path.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with opener(f"{folder}/{name}", "wt", encoding="utf-8") as f:
        f.write(text)


def test_columns_are_bound_by_each_files_header(spark):
    path = files.scratch_path(spark, "test_headers")
    _put(spark, path, "a.csv", "age;job;duration\n41;admin.;90\n")
    _put(spark, path, "b.csv", "job;age;duration\nretired;30;45\n")
    _put(spark, path, "c.csv", "﻿duration;nr.employed;\"job\"\n7;5191.0;student\n")
    _put(spark, path, "_hidden.csv", "x;y\n1;2\n")
    _put(spark, path, "empty.csv", "")
    got = files.read_contacts(spark, path)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "age": "bigint", "job": "string", "duration": "bigint", "nr_employed": "double"}
    assert {tuple(r) for r in got.select("age", "job", "duration", "nr_employed").collect()} == {
        (41, "admin.", 90, None), (30, "retired", 45, None), (None, "student", 7, 5191.0)}
    assert files.rejected_cells(files.as_read(spark, path)).count() == 0


def test_packed_files_have_headers_too(spark):
    import gzip
    path = files.scratch_path(spark, "test_gz")
    _put(spark, path, "a.csv.gz", "age;job\n41;admin.\n", gzip.open)
    _put(spark, path, "b.csv", "job;age\nretired;x\n")
    assert {tuple(r) for r in files.read_contacts(spark, path).select("age", "job").collect()} == {(41, "admin."), (None, "retired")}


def test_every_bad_cell_is_a_row(spark):
    path = files.scratch_path(spark, "test_bad_cells")
    _put(spark, path, "a.csv", "age;job;duration\n4o;admin.;90\n41;;n/a\n;x;\n50;y\n51;z;9;8\n")
    _put(spark, path, "b.csv", "duration;age\n1 s;30\n2;31\n")
    read = files.as_read(spark, path)
    cells = {(r.file.rsplit("/", 1)[1], r.column_name, r.value) for r in files.rejected_cells(read).collect()}
    assert cells == {("a.csv", "age", "4o"), ("a.csv", "duration", "n/a"), ("b.csv", "duration", "1 s"),
                     ("a.csv", "(line)", "50;y"), ("a.csv", "(line)", "51;z;9;8")}
    rows = {tuple(r) for r in files.typed(read).select("age", "job", "duration").collect()}
    assert {(None, "admin.", 90), (41, None, None), (None, "x", None), (50, "y", None), (30, None, None)} <= rows
    assert files.typed(read).count() == 7


def test_twice_named_column_and_no_file_are_errors(spark):
    import pytest
    path = files.scratch_path(spark, "test_twice")
    _put(spark, path, "a.csv", "age;job;age\n1;2;3\n")
    with pytest.raises(ValueError, match="twice"):
        files.as_read(spark, path)
    with pytest.raises(ValueError, match="no file"):
        files.as_read(spark, files.scratch_path(spark, "test_none"))


def test_mixed_files_load_as_one_table(spark):
    raw = raw_contacts(spark, SF_SMALL)
    path = files.scratch_path(spark, "test_mixed")
    parts = [raw.columns, raw.columns[::-1], sorted(raw.columns)]
    for n, names in enumerate(parts):
        files.write_contacts_csv(raw.where(F.col("contact_id") % 3 == n).select(*[F.col(f"`{c}`") for c in names]), f"{path}/{n}")
    assert len(files.header_groups(spark, path)) == 3
    assert _same(files.read_contacts(spark, path, schema=RAW_SCHEMA_WITH_LINEAGE), raw)


def test_type_test_looks_at_the_schema_as_read(spark):
    from callsheet.operators import quality
    raw = raw_contacts(spark, SF_SMALL)
    path = files.scratch_path(spark, "test_types")
    raw.withColumn("age", F.when(F.col("age") == 40, "forty").otherwise(F.col("age").cast("string"))).write.parquet(path)
    source = files.as_read(spark, path, "parquet")
    report = quality.test_report(files.conform(source.drop(files.FILE)), as_read=files.typed_columns(source))
    assert report.where("test_name = 'Data Types Check'").select("status", "failures").first() == ("FAILED", 1)
    cells = files.rejected_cells(source, RAW_SCHEMA_WITH_LINEAGE).select("column_name", "value").distinct().collect()
    assert [tuple(r) for r in cells] == [("age", "forty")]
