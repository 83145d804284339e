"""Data-quality operators: declarative checks evaluated in one distributed pass.

A check is ``(suite, test, column, violation)`` where ``violation`` is a
boolean SQL predicate that is true on a violating row. ``run_suite`` turns any
number of checks into *one* aggregate (a ``count_if`` per check, partial
aggregation on every task) and unpivots the single result row, so a suite
costs one scan however many checks it holds. Only the duplicate check needs
a shuffle (group by all columns, with map-side combine).

Two suites keep their own NULL semantics:
* ``runtime``: NULL fails an accepted-values or consistency check
  (``~coalesce(isin, false)``, ``~eqNullSafe``), and passes a range check.
* ``schema``: NULL passes accepted values and ranges (three-valued logic);
  only ``not_null`` catches it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..schema import RAW_TYPES

PASSED, FAILED = "PASSED", "FAILED"


@dataclass(frozen=True)
class Check:
    suite: str
    test: str
    column: str
    violation: str  # SQL predicate


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _n(name: str) -> str:
    return "`" + name + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        return f"{v!r}D"
    return str(v)


def _in(name: str, values) -> str:
    return f"{_n(name)} IN ({', '.join(_lit(v) for v in values)})"


RUNTIME_ACCEPTED = [
    ("job", fixed.JOBS), ("marital", fixed.MARITAL), ("education", fixed.EDUCATION),
    ("default", fixed.NO_UNKNOWN_YES), ("housing", fixed.NO_UNKNOWN_YES), ("loan", fixed.NO_UNKNOWN_YES),
    ("contact", fixed.CONTACT), ("month", fixed.MONTHS), ("day_of_week", fixed.WEEKDAYS),
    ("poutcome", fixed.POUTCOME), ("y", fixed.YES_NO),
]

CONSISTENCY_RULES = ["pdays=-1 implies previous=0", "previous=0 implies poutcome=nonexistent",
                     "duration>0"]


def runtime_checks(columns: Sequence[str]) -> list[Check]:
    """Nulls, ranges, accepted values and consistency rules, for the columns present."""
    have = set(columns)
    out = [Check("runtime", fixed.TEST_NULLS, c, f"{_n(c)} IS NULL") for c in fixed.RUNTIME_REQUIRED if c in have]
    out += [Check("runtime", fixed.TEST_RANGES, c, f"{_n(c)} < {_lit(lo)} OR {_n(c)} > {_lit(hi)}")
            for c, lo, hi in fixed.RUNTIME_RANGES if c in have]
    out += [Check("runtime", fixed.TEST_ACCEPTED, c, f"NOT coalesce({_in(c, vals)}, false)")
            for c, vals in RUNTIME_ACCEPTED if c in have]
    if {"pdays", "previous"} <= have:
        out.append(Check("runtime", fixed.TEST_CONSISTENCY, CONSISTENCY_RULES[0], "pdays = -1 AND previous > 0"))
    if {"previous", "poutcome"} <= have:
        out.append(Check("runtime", fixed.TEST_CONSISTENCY, CONSISTENCY_RULES[1],
                         "previous = 0 AND NOT (poutcome <=> 'nonexistent')"))
    if "duration" in have:
        out.append(Check("runtime", fixed.TEST_CONSISTENCY, CONSISTENCY_RULES[2], "duration <= 0"))
    return out


def schema_checks(columns: Sequence[str]) -> list[Check]:
    """not_null on every declared column, accepted_values (age as the list
    18..95), accepted_range; NULL passes the last two."""
    have = set(columns)
    out = [Check("schema", "not_null", c, f"{_n(c)} IS NULL") for c, _ in fixed.RAW_COLUMN_TYPES if c in have]
    lo, hi = fixed.SCHEMA_AGE_VALUES
    accepted = [("age", list(range(lo, hi + 1)))] + RUNTIME_ACCEPTED
    out += [Check("schema", "accepted_values", c, f"NOT ({_in(c, vals)})") for c, vals in accepted if c in have]
    out += [Check("schema", "accepted_range", c, f"NOT ({_n(c)} >= {_lit(lo)} AND {_n(c)} <= {_lit(hi)})")
            for c, lo, hi in fixed.SCHEMA_RANGES if c in have]
    return out


def _status(violations: Column) -> Column:
    return F.when(violations == 0, F.lit(PASSED)).otherwise(F.lit(FAILED))


STATUS_SQL = f"CASE WHEN {{v}} = 0 THEN '{PASSED}' ELSE '{FAILED}' END"


def _check_counts(checks: Sequence[Check]) -> list[Column]:
    return [F.expr(f"count_if({c.violation}) AS _v{i}") for i, c in enumerate(checks)]


def _counted(df: DataFrame, columns: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """Distinct rows with their number ``_n``."""
    cols = [c for c in columns if c not in group_by]
    return df.groupBy(*group_by, *[_c(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))


DUPLICATE_SQL = "coalesce(sum(_n), 0) - count(1)"


def _weighted(violation: str) -> str:
    """Violating rows, over rows counted by ``_counted``."""
    return f"coalesce(sum(CASE WHEN {violation} THEN _n END), 0)"


def _weighted_counts(checks: Sequence[Check]) -> list[Column]:
    return [F.expr(f"{_weighted(c.violation)} AS _v{i}") for i, c in enumerate(checks)]


def _unpivot_checks(checks: Sequence[Check]) -> Column:
    rows = ", ".join(f"named_struct('suite', {_lit(c.suite)}, 'test_name', {_lit(c.test)}, "
                     f"'column_name', {_lit(c.column)}, 'violations', _v{i})" for i, c in enumerate(checks))
    return F.expr(f"inline(array({rows}))")


def run_suite(df: DataFrame, checks: Sequence[Check], group_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per check (and group): ``(*groups, suite, test_name,
    column_name, violations, status)`` from a single aggregate."""
    agg = df.groupBy(*group_by).agg(*_check_counts(checks))
    groups = [c for c in agg.columns if not c.startswith("_v")]
    out = agg.select(*groups, _unpivot_checks(checks))
    return out.select("*", F.expr(STATUS_SQL.format(v="violations") + " AS status"))


def duplicates(df: DataFrame, columns: Sequence[str] | None = None,
               group_by: Sequence[str] = ()) -> DataFrame:
    """``total_rows``, ``distinct_rows``, ``duplicate_rows`` (= total - distinct),
    per group. Rows are compared on ``columns`` (default: all, NULL equal to
    NULL). Identical rows are combined map-side, so a hot duplicate group
    does not reach one reducer whole."""
    out = _counted(df, columns or df.columns, group_by).groupBy(*group_by).agg(F.sum("_n").alias("total_rows"),
                                         F.count(F.lit(1)).alias("distinct_rows"))
    return out.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def type_mismatches(df: DataFrame, expected: dict[str, str] | None = None) -> list[str]:
    """Declared-type check on the schema (driver metadata only, no data)."""
    expected = expected or RAW_TYPES
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{c}: expected {t}, got {actual[c]}" for c, t in expected.items()
            if c in actual and actual[c] != t]


def test_report(df: DataFrame, group_by: Sequence[str] = (), columns: Sequence[str] | None = None,
                as_read: DataFrame | None = None) -> DataFrame:
    """The six runtime tests as rows ``(*groups, test_name, status, failures)``.

    Every row is checked.

    ``failures`` is the number of violations summed over a test's checks
    (for the type test: the number of mismatching columns, from the schema; of
    ``as_read``, the source before its columns were cast, where it is given).
    One pass: equal rows are counted first (combined map-side, which the
    duplicate test needs anyway), and every other check weighs a distinct row
    by its count.
    """
    cols = list(columns or [c for c, _ in fixed.RAW_COLUMN_TYPES if c in df.columns])
    checks = runtime_checks(cols)
    counted = _counted(df, cols, group_by)
    agg = counted.groupBy(*group_by).agg(*_weighted_counts(checks), F.expr(f"{DUPLICATE_SQL} AS _dup"))
    n_type = len(type_mismatches(as_read if as_read is not None else df.select(*[_c(c) for c in cols])))
    entries = [f"named_struct('test_name', {_lit(fixed.TEST_DATA_TYPES)}, 'failures', CAST({n_type} AS BIGINT))"]
    for t in [fixed.TEST_NULLS, fixed.TEST_RANGES, fixed.TEST_ACCEPTED, fixed.TEST_CONSISTENCY]:
        parts = [f"_v{i}" for i, c in enumerate(checks) if c.test == t]
        total = " + ".join(parts) if parts else "CAST(0 AS BIGINT)"
        entries.append(f"named_struct('test_name', {_lit(t)}, 'failures', {total})")
    entries.append(f"named_struct('test_name', {_lit(fixed.TEST_DUPLICATES)}, 'failures', _dup)")
    report = agg.select(*group_by, F.expr(f"inline(array({', '.join(entries)}))"))
    return report.select("*", F.expr(STATUS_SQL.format(v="failures") + " AS status"))


def quality_score(report: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """``total_tests``, ``passed_tests``, ``failed_tests``, ``quality_score`` (percent)."""
    passed = f"count_if(status = '{PASSED}')"
    return report.groupBy(*group_by).agg(
        F.expr("count(1) AS total_tests"), F.expr(f"{passed} AS passed_tests"),
        F.expr(f"count_if(status != '{PASSED}') AS failed_tests"),
        F.expr(f"{passed} * 100.0D / count(1) AS quality_score"))


def failing_rows(df: DataFrame, checks: Sequence[Check], key: Sequence[str]) -> DataFrame:
    """Store-failures sink: one row per (violating row, check):
    ``(*key, suite, test_name, column_name, value)``. A narrow generator over
    only the failing checks of each row; no shuffle."""
    entries = ", ".join(
        f"CASE WHEN {c.violation} THEN named_struct('suite', {_lit(c.suite)}, 'test_name', {_lit(c.test)}, "
        f"'column_name', {_lit(c.column)}, 'value', "
        f"{'CAST(' + _n(c.column) + ' AS STRING)' if c.column in df.columns else 'CAST(NULL AS STRING)'}) END"
        for c in checks)
    return df.select(*key, F.expr(f"inline(filter(array({entries}), e -> e IS NOT NULL))"))


def invalid_values(df: DataFrame, accepted: Sequence[tuple[str, Sequence[str]]] = RUNTIME_ACCEPTED) -> DataFrame:
    """Distinct invalid values per field with their counts:
    ``(column_name, invalid_value, occurrences)`` (NULL is invalid, as in the
    runtime suite). Partially aggregated right after the generator."""
    present = [(c, v) for c, v in accepted if c in df.columns]
    entries = ", ".join(
        f"CASE WHEN NOT coalesce({_in(c, v)}, false) THEN named_struct('column_name', {_lit(c)}, "
        f"'invalid_value', CAST({_n(c)} AS STRING)) END" for c, v in present)
    exploded = df.select(F.expr(f"inline(filter(array({entries}), e -> e IS NOT NULL))"))
    return exploded.groupBy("column_name", "invalid_value").agg(F.expr("count(1) AS occurrences"))


def ingest_gate(df: DataFrame, strict: bool = False) -> DataFrame:
    """Loader validation as one row: ``total_rows``, ``failed_critical``,
    ``failed_optional`` (comma-separated check names) and ``passed``.

    Critical: non-empty and every required column present (schema metadata).
    Optional (warn only unless ``strict``): ages all within range, no
    negative duration, campaign >= 1, no duplicate rows; a NULL value fails
    them, as an element-wise ``all()`` over missing values does.
    """
    have = set(df.columns)
    missing = [f"has_{c}" for c in fixed.LOADER_REQUIRED_COLUMNS if c not in have]
    lo, hi = fixed.LOADER_AGE_RANGE

    def bad(col: str, ok: str) -> str:
        return _weighted(f"NOT coalesce({_n(col)} {ok}, false)") if col in have else "CAST(0 AS BIGINT)"

    stats = _counted(df, df.columns).agg(*[F.expr(f"{sql} AS {name}") for name, sql in {
        "total_rows": "coalesce(sum(_n), 0)",
        "_age": bad("age", f"BETWEEN {lo} AND {hi}"),
        "_dur": bad("duration", f">= {fixed.LOADER_MIN_DURATION}"),
        "_camp": bad("campaign", f">= {fixed.LOADER_MIN_CAMPAIGN}"),
        "_dup": DUPLICATE_SQL}.items()])
    critical = F.array_compact(F.array(F.when(F.col("total_rows") == 0, F.lit("total_rows")),
                                       *[F.lit(m) for m in missing]))
    optional = F.array_compact(F.array(*[F.when(F.col(src) > 0, F.lit(name)) for src, name in
                                         [("_age", "age_range"), ("_dur", "duration_positive"),
                                          ("_camp", "campaign_positive"), ("_dup", "no_duplicates")]]))
    passed = F.size(critical) == 0
    if strict:
        passed = passed & (F.size(optional) == 0)
    return stats.select("total_rows", F.array_join(critical, ",").alias("failed_critical"),
                        F.array_join(optional, ",").alias("failed_optional"), passed.alias("passed"))


def relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                  name: str | None = None) -> DataFrame:
    """Referential integrity: child rows whose non-null key has no parent row.

    Child keys are counted first (combined map-side, so a key holding a
    third of all rows arrives as one row), parent keys are de-duplicated the
    same way, and only then are the two key sets anti-joined; the violation
    count sums the orphan keys' row counts, so it is exact.
    """
    keys = (child.where(F.col(child_col).isNotNull()).groupBy(F.col(child_col).alias("_k"))
            .agg(F.expr("count(1) AS _rows")))
    parents = parent.select(F.col(parent_col).alias("_k")).distinct()
    orphans = keys.join(parents, "_k", "left_anti")
    return orphans.agg(F.expr("coalesce(sum(_rows), 0) AS violations")).select(
        F.lit(name or f"relationships_{child_col}_{parent_col}").alias("test_name"),
        "violations", _status(F.col("violations")).alias("status"))


def unique_key(df: DataFrame, column: str) -> DataFrame:
    """``unique`` test: number of key values that occur more than once."""
    dup = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicated_keys")).select(
        F.lit(f"unique_{column}").alias("test_name"), "duplicated_keys",
        _status(F.col("duplicated_keys")).alias("status"))
