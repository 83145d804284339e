"""Streams that close days and gate rows: several triggers, late rows, retries, nothing lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callsheet.operators import quality
from callsheet.schema import RAW_TYPES
from callsheet.sources.files import in_time_order, scratch_path
from callsheet.sources.star import raw_contacts, read_table
from callsheet.streaming import gate, ledger
from callsheet.streaming.sinks import batch_folder, batch_numbers, read_batches
from tests.conftest import SF_SMALL

EVENT = "id int, ts timestamp_ntz, ok boolean, value double"


def day(n, hour=12):
    return dt.datetime(2024, 5, 1) + dt.timedelta(days=n, hours=hour)


def events(spark, rows):
    return spark.createDataFrame([(i, t, i % 3 == 0, float(i % 7) if i % 5 else None) for i, t in rows], EVENT)


def take(spark, path, batch_id, rows, **more):
    ledger.take_batch(events(spark, rows), batch_id, path, "ts", F.col("ok"), F.col("value"), **more)


def kpis(df):
    return sorted(tuple(r) for r in df.select("report_date", "total_contacts", "successful_contacts", "conversion_rate",
                                              "avg_call_duration").collect())


def expected(rows):
    out = {}
    for i, t in rows:
        if t is not None:
            n, yes, values = out.setdefault(t.date(), (0, 0, []))
            out[t.date()] = (n + 1, yes + (i % 3 == 0), values + ([float(i % 7)] if i % 5 else []))
    return sorted((d, n, yes, round(yes * 100 / n, 2), sum(v) / len(v) if v else None) for d, (n, yes, v) in out.items())


BATCHES = [
    [(i, day(i % 3)) for i in range(20)],                                # days 0-2: day 0 closes (latest is day 2, noon)
    [(i, day(2 + i % 3)) for i in range(20, 44)],                        # days 2-4: days 1 and 2 close
    [(50, day(0)), (51, day(2)), (52, None), (53, day(3)), (54, day(9))],  # two late, one without a time; 3 to 7 close
    [],
    [(60, day(9, 1)), (61, day(8)), (62, day(7))],                       # day 7 is closed, 8 and 9 are open
]
LATE = [(50, "day closed"), (51, "day closed"), (52, "no time"), (62, "day closed")]


def check(spark, path):
    late = {i for i, _ in LATE}
    in_time = [r for b in BATCHES for r in b if r[0] not in late]
    assert kpis(ledger.closed_days(spark, path)) == expected(in_time)
    days = [r.report_date for r in ledger.closed_days(spark, path).collect()]
    assert len(days) == len(set(days))
    rows = ledger.late_rows(spark, path, f"{EVENT}, late_reason string, batch_id bigint").collect()
    assert sorted((r.id, r.late_reason) for r in rows) == LATE
    entries = {r.batch_id: r for r in ledger.ledger(spark, path).collect()}
    assert [entries[b].rows for b in range(5)] == [len(b) for b in BATCHES]
    assert [entries[b].late_rows for b in range(5)] == [0, 0, 3, 0, 1]
    assert sum(e.rows for e in entries.values()) == len(in_time) + len(LATE)


def test_each_day_is_given_out_once(spark):
    path = scratch_path(spark, "test_ledger")
    for n, rows in enumerate(BATCHES):
        take(spark, path, n, rows)
    entries = {r.batch_id: r for r in ledger.ledger(spark, path).collect()}
    # the state shrinks as days close
    assert [(entries[b].open_days, entries[b].closed_days) for b in range(5)] == [(2, 1), (2, 2), (1, 2), (1, 0), (2, 0)]
    assert [r.report_date for r in ledger.open_days(spark, path).orderBy("report_date").collect()] == [day(8).date(), day(9).date()]
    assert len(batch_numbers(spark, f"{path}/open")) <= 2 and len(batch_numbers(spark, f"{path}/_days")) == 1
    ledger.close_open_days(spark, path)
    ledger.close_open_days(spark, path)
    check(spark, path)


@pytest.mark.parametrize("lost", [["ledger"], ["ledger", "open"], ["ledger", "open", "closed"], ["ledger", "open", "closed", "late"], []])
def test_batches_worked_again_change_nothing(spark, lost):
    """A batch fails before some of its folders are there, or after all of them; then it is worked once more."""
    path = scratch_path(spark, "test_ledger_retry")
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for n, rows in enumerate(BATCHES):
        take(spark, path, n, rows)
        for table in lost:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(batch_folder(f"{path}/{table}", n)), True)
        take(spark, path, n, rows)
    ledger.close_open_days(spark, path)
    check(spark, path)


def test_longer_delay_keeps_days_open(spark):
    path = scratch_path(spark, "test_ledger_delay")
    for n, rows in enumerate(BATCHES[:3]):
        take(spark, path, n, rows, delay=dt.timedelta(days=30))
    assert ledger.closed_days(spark, path).count() == 0
    rows = ledger.late_rows(spark, path, f"{EVENT}, late_reason string, batch_id bigint").collect()
    assert [(r.id, r.late_reason) for r in rows] == [(52, "no time")]


def test_ledger_rows_start_no_python_on_executors(spark, monkeypatch):
    """The row of a batch is an aggregate of its days: local rows would start a Python worker on the executors for each batch."""
    path = scratch_path(spark, "ledger_row")
    zone = spark.conf.get("spark.sql.session.timeZone")
    batches = [events(spark, b) for b in BATCHES[:4]] + [events(spark, [(70, day(9).replace(microsecond=5))])]

    def local_rows(*_, **__):
        raise AssertionError("rows of the driver")

    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        with monkeypatch.context() as m:
            m.setattr(type(spark), "createDataFrame", local_rows)
            for n, batch in enumerate(batches):
                ledger.take_batch(batch, n, path, "ts", F.col("ok"), F.col("value"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    rows = [tuple(r) for r in ledger.ledger(spark, path).orderBy("batch_id").drop("batch_id").collect()]
    assert rows == [(20, 0, day(2), day(1).date(), 2, 1), (24, 0, day(4), day(3).date(), 2, 2), (5, 3, day(9), day(8).date(), 1, 2),
                    (0, 0, day(9), day(8).date(), 1, 0), (1, 0, day(9).replace(microsecond=5), day(8).date(), 1, 0)]


def test_a_batch_is_read_again_only_for_late_rows(spark, monkeypatch):
    """Its rows are joined once where none are late; rows that are late are not counted, whatever they hold."""
    from callsheet.plans.catalog import QUERIES
    joined, real = [], ledger.write_batch

    def write(df, path, batch_id, *more):
        if "Join " in df._jdf.queryExecution().optimizedPlan().toString():
            joined.append((path.rsplit("/", 1)[1], batch_id))
        return real(df, path, batch_id, *more)

    monkeypatch.setattr(ledger, "write_batch", write)
    assert QUERIES["stream_kpi_daily"](spark, SF_SMALL).count() and joined == [("_days", n) for n in range(4)]
    joined.clear()
    path, other = scratch_path(spark, "test_ledger_joined"), spark.range(100).withColumnRenamed("id", "key")
    for n, rows in enumerate(BATCHES):
        batch = events(spark, rows).join(other.hint("merge"), F.col("id") == F.col("key")).drop("key")
        ledger.take_batch(batch, n, path, "ts", F.when(F.col("id").isin([i for i, _ in LATE]), F.raise_error(F.lit("late")).cast("boolean"))
                          .otherwise(F.col("ok")), F.col("value"))
    assert [j for j in joined if j[0] != "_days"] == [("late", 2), ("late", 4)]
    ledger.close_open_days(spark, path)
    check(spark, path)


def test_stream_goes_on_from_its_checkpoint(spark):
    path = scratch_path(spark, "test_ledger_stream")
    table = read_table(spark, SF_SMALL, "events")
    ok, seen = F.col("event_type") == "purchase", []
    parts = in_time_order(table, "ts", 3)
    assert sum(p.count() for p in parts) == table.count() and len(parts) == 3
    late = table.where(F.to_date("ts") == table.agg(F.min(F.to_date("ts"))).scalar()).limit(5)
    for part in (*parts, late):  # the last drop holds rows of the first day again
        part.write.mode("append").parquet(f"{path}/feed")
        stream = spark.readStream.schema(table.schema).parquet(f"{path}/feed")
        ledger.run_daily_kpis(stream, f"{path}/days", f"{path}/checkpoint", "ts", ok, F.col("value"))
        seen.append(ledger.closed_days(spark, f"{path}/days").count())
    assert 0 < seen[0] < seen[1] < seen[2] == seen[3]
    ledger.close_open_days(spark, f"{path}/days")
    got = ledger.closed_days(spark, f"{path}/days")
    want = table.groupBy(F.to_date("ts").alias("report_date")).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("y"))
    assert {tuple(r) for r in got.select("report_date", "total_contacts", "successful_contacts").collect()} == {tuple(r) for r in want.collect()}
    assert ledger.ledger(spark, f"{path}/days").agg(F.sum("late_rows")).first()[0] == 5
    schema = f"{gate.schema_of(table)}, late_reason string, batch_id bigint"
    assert ledger.late_rows(spark, f"{path}/days", schema).select(*table.columns).exceptAll(late).count() == 0


CHECKS = quality.runtime_checks(list(RAW_TYPES))


def test_gate_parts_rows_and_a_retry_changes_nothing(spark):
    path, taken = scratch_path(spark, "test_gate"), {}
    raw = raw_contacts(spark, SF_SMALL)
    schema = gate.schema_of(raw)
    parts = in_time_order(raw, "processed_at", 3)

    def onward(passed, batch_id):
        taken[batch_id] = passed.count()

    for n, part in enumerate(parts):
        gate.take_batch(part, n, path, CHECKS, onward)
        gate.take_batch(part.repartition(3), n, path, CHECKS, onward)  # worked again, in other files
    good, held = gate.passed_rows(spark, path, schema), gate.quarantined_rows(spark, path, schema)
    assert good.count() + held.count() == raw.count() and good.count() and held.count()
    both = good.unionByName(held.drop("reasons", "batch_id"))
    assert both.exceptAll(raw).count() == 0 and raw.exceptAll(both).count() == 0
    assert sum(taken.values()) == good.count()
    # the verdicts are those of the batch checks, check by check
    assert quality.run_suite(good, CHECKS).where("violations > 0").count() == 0
    failing = quality.failing_rows(raw, CHECKS, ["contact_id"]).select("contact_id", F.concat_ws(": ", "test_name", "column_name").alias("r"))
    listed = held.select("contact_id", F.explode("reasons").alias("r"))
    assert listed.exceptAll(failing).count() == 0 and failing.exceptAll(listed).count() == 0
    counted = gate.counts(spark, path).groupBy("test_name", "column_name").agg(F.sum("violations").alias("violations"))
    whole = quality.run_suite(raw, CHECKS).select("test_name", "column_name", "violations")
    assert counted.exceptAll(whole).count() == 0


def test_gate_survives_a_batch_that_failed_halfway(spark):
    """The stream's first try of a batch fails after the rows are written; the restarted stream works it again."""
    path = scratch_path(spark, "test_gate_fail")
    raw = raw_contacts(spark, SF_SMALL)
    raw.write.parquet(f"{path}/feed")
    broken = [True]

    def onward(passed, batch_id):
        if broken.pop():
            broken.append(False)
            raise RuntimeError("lost")

    for attempt in range(2):
        stream = spark.readStream.schema(raw.schema).parquet(f"{path}/feed")
        if attempt == 0:
            with pytest.raises(Exception, match="lost"):
                gate.run_gate(stream, f"{path}/gate", f"{path}/checkpoint", CHECKS, onward)
        else:
            gate.run_gate(stream, f"{path}/gate", f"{path}/checkpoint", CHECKS)
    schema = gate.schema_of(raw)
    assert batch_numbers(spark, f"{path}/gate/rows") == [0]
    n = gate.passed_rows(spark, f"{path}/gate", schema).count() + gate.quarantined_rows(spark, f"{path}/gate", schema).count()
    assert n == raw.count()


def test_null_values_and_empty_batches_pass_the_gate_whole(spark):
    path = scratch_path(spark, "test_gate_null")
    raw = raw_contacts(spark, SF_SMALL)
    nothing = raw.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema.fields])
    gate.take_batch(raw.limit(0), 0, path, CHECKS)
    gate.take_batch(nothing, 1, path, CHECKS)
    schema = gate.schema_of(raw)
    assert gate.passed_rows(spark, path, schema).count() == 0
    (row,) = gate.quarantined_rows(spark, path, schema).collect()
    assert row.batch_id == 1 and "Null Values Check: age" in row.reasons
    assert read_batches(spark, f"{path}/none", "a int, batch_id bigint").count() == 0
