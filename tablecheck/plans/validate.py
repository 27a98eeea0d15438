"""Validation of one pair: counts, duplicates, schema, column metrics and rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import literal
from ..operators.columns import Aligned, align, schema_diff
from ..operators.grouped import grouped_drilldown
from ..operators.metrics import column_comparison, count_check
from ..operators.rowdiff import (
    N_SOURCE,
    N_TARGET,
    SAME,
    compared,
    with_details,
    with_light_details,
)
from ..operators.sampling import sampled, sampled_spec
from ..session import Scratch
from ..sinks import write_audit, write_results
from ..sources import load_query
from ..spec import (
    AUDIT_SCHEMA,
    ERROR,
    FAIL,
    HASH_MISMATCH,
    MISSING_IN_SOURCE,
    MISSING_IN_TARGET,
    PASS,
    RESULT_SCHEMA,
    SKIPPED,
    PairSpec,
    Run,
    ValidationResult,
)

ALL_CHECKS = ("count", "row", "schema", "column", "custom")
ROW_CLASSES = (HASH_MISMATCH, MISSING_IN_SOURCE, MISSING_IN_TARGET)


def stamp(df: DataFrame, spec: PairSpec, run: Run) -> DataFrame:
    """Complete check rows to the result schema; columns a check lacks become null."""
    own, present = run.columns(spec.name), set(df.columns)
    out = []
    for f in RESULT_SCHEMA.fields:
        value = own.get(f.name, f.name if f.name in present else "null")
        out.append(f"cast({value} as {f.dataType.simpleString()}) as {f.name}")
    return df.selectExpr(*out)


def note(spark: SparkSession, check: str, status: str, message: str | None = None) -> DataFrame:
    """A single result row without values."""
    return spark.range(1).selectExpr(
        f"{literal(check)} as check", f"{literal(status)} as status", f"{literal(message)} as message"
    )


def _metric_row(metric: str, check: str, source: str, target: str, ok: str) -> str:
    """SQL for a result row with a value per side."""
    return (
        f"struct('{check}' as check, '{metric}' as metric, "
        f"cast({source} as string) as source_value, cast({target} as string) as target_value, "
        f"cast({source} - {target} as double) as difference, "
        f"if({ok}, '{PASS}', '{FAIL}') as status)"
    )


def _class_row(name: str) -> str:
    """SQL for a result row of a row class: a count without sides, given as the difference."""
    return (
        f"struct('row' as check, '{name}' as metric, cast(null as string) as source_value, "
        f"cast(null as string) as target_value, cast({name} as double) as difference, "
        f"if({name} = 0, '{PASS}', '{FAIL}') as status)"
    )


def _key_rows(counted: DataFrame, diff: DataFrame, counts: bool) -> DataFrame:
    """Count, duplicate and row results from the row counts by key and the differences."""
    names = ["s", "t", "ds", "dt", *ROW_CLASSES]
    sums = {
        "s": f"sum({N_SOURCE})",
        "t": f"sum({N_TARGET})",
        "ds": f"sum(greatest({N_SOURCE} - 1, 0L))",
        "dt": f"sum(greatest({N_TARGET} - 1, 0L))",
    }
    n_rows = "n_rows" if "n_rows" in diff.columns else "1L"
    classes = {c: f"sum(if(mismatch_type = '{c}', {n_rows}, 0L))" for c in ROW_CLASSES}

    def one(df: DataFrame, values: dict[str, str]) -> DataFrame:
        return df.selectExpr(*[f"coalesce({values.get(n, '0L')}, 0L) as {n}" for n in names])

    both = one(counted.agg(*[F.expr(f"{v} as {n}") for n, v in sums.items()]), {n: n for n in sums}).unionAll(
        one(diff.agg(*[F.expr(f"{v} as {n}") for n, v in classes.items()]), {n: n for n in classes})
    )
    totals = both.agg(*[F.expr(f"sum({n}) as {n}") for n in names])
    rows = [_metric_row("ROW_COUNT", "count", "s", "t", "s = t")] if counts else []
    rows.append(_metric_row("DUPLICATE_ROWS", "duplicates", "ds", "dt", "ds = 0 and dt = 0"))
    rows += [_class_row(name) for name in ROW_CLASSES]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def _count_rows(pair: Aligned) -> DataFrame:
    row = _metric_row("ROW_COUNT", "count", "source_count", "target_count", "difference = 0")
    return count_check(pair.source, pair.target).selectExpr(f"inline(array({row}))")


def _alike(spec: PairSpec) -> PairSpec:
    """The pair as its schema is compared: under the source's names, or in lower case where case does
    not matter."""
    spec = spec.named_alike()
    if spec.match != "name":
        return spec
    source, target = (df.toDF(*[c.lower() for c in df.columns]) for df in (spec.source, spec.target))
    return replace(spec, source=source, target=target)


def _schema_rows(spec: PairSpec) -> DataFrame:
    spec = _alike(spec)
    if dict(spec.source.dtypes) == dict(spec.target.dtypes):
        return note(spec.source.sparkSession, "schema", PASS)
    return schema_table(spec).select(
        F.lit("schema").alias("check"),
        "column_name",
        F.col("status").alias("metric"),
        F.col("source_type").alias("source_value"),
        F.col("target_type").alias("target_value"),
        F.lit(FAIL).alias("status"),
    )


def _column_rows(pair: Aligned, spec: PairSpec) -> DataFrame:
    if not pair.columns:
        return note(pair.source.sparkSession, "column", SKIPPED, "no shared columns")
    found = column_comparison(
        pair, spec.abs_tol, spec.rel_tol, columns_per_pass=spec.columns_per_pass
    )
    found = found.withColumn("check", F.lit("column"))
    spec = spec.named_alike()
    source, target = dict(spec.source.dtypes), dict(spec.target.dtypes)
    for name in source:
        if name in target and source[name] != target[name] and spec.match == "strict" and name not in pair.keys:
            # A column that both sides have but that is not compared must not go unseen.
            left_out = note(pair.source.sparkSession, "column", SKIPPED, f"types differ: {source[name]}, {target[name]}")
            found = found.unionByName(left_out.withColumn("column_name", F.lit(name)), allowMissingColumns=True)
    return found


def _drift(results: DataFrame) -> DataFrame:
    failed = results.filter((F.col("check") == "column") & (F.col("status") == FAIL))
    return failed.select("pair", "column_name", "metric", "source_value", "target_value")


def _guarded(spec: PairSpec, check: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A check that cannot be set up becomes an ERROR row; the others go on."""
    try:
        return build()
    except (PySparkException, ValueError) as problem:
        return note(spec.source.sparkSession, check, ERROR, str(problem))


def schema_table(spec: PairSpec) -> DataFrame:
    spec = _alike(spec)
    return schema_diff([(spec.name, spec.source, spec.target)])


def audit_rows(rows: DataFrame, spec: PairSpec, run: Run) -> DataFrame:
    """Mismatch rows under the run's identity."""
    own = run.columns(spec.name)
    return rows.selectExpr(
        f"{own['run_id']} as run_id",
        f"{own['pair']} as pair",
        f"{own['run_ts']} as validation_time",
        *AUDIT_SCHEMA.names[3:],
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_results(*parts: DataFrame) -> DataFrame:
    """Results of several checks, pairs or levels in one table."""
    return _union(parts)


def validate_pair(
    spec: PairSpec, run: Run, extra_checks: Sequence[Callable[[PairSpec], DataFrame]] = ()
) -> ValidationResult:
    """All checks of one pair as lazy tables.

    The whole result table is one Spark job with a pass over each side for keys and hashes of
    values (counts, duplicates, and which keys differ), one for the digests of the differing
    keys and one for the column metrics.  To keep the mismatches as well, use ``run_pair``, which
    computes the first two once for both.
    """
    parts, mismatches, drift = [], None, None
    try:
        pair = align(spec)
    except (PySparkException, ValueError) as problem:
        spark = spec.source.sparkSession
        parts.append(note(spark, "setup", ERROR, str(problem)))
        parts.append(_guarded(spec, "schema", lambda: _schema_rows(spec)))
    else:
        if pair.keys:
            counted, diff = compared(pair)
            parts.append(_key_rows(counted, diff, counts=True))
            mismatches = audit_rows(with_light_details(pair, diff), spec, run)
        else:
            parts.append(_count_rows(pair))
        parts.append(_guarded(spec, "schema", lambda: _schema_rows(spec)))
        columns = _guarded(spec, "column", lambda: _column_rows(pair, spec))
        parts.append(columns)
        drift = _drift(stamp(columns, spec, run))
    for check in (*spec.extra_checks, *extra_checks):
        name = getattr(check, "__name__", "custom")
        parts.append(_guarded(spec, name, lambda check=check: check(spec)))
    results = _union([stamp(p, spec, run) for p in parts])
    return ValidationResult(results, mismatches, drift, schema_table(spec))


def validate_row(
    spec: PairSpec, run: Run, sample: int | None = None, seed: int = 42
) -> ValidationResult:
    """Rows only: count, duplicates and row classes, optionally for a sample of the keys."""
    if not spec.keys:
        raise ValueError("a row check needs a key")
    pair = align(spec)
    if sample is not None:
        pair = sampled(pair, sample, seed)
    counted, diff = compared(pair)
    results = stamp(_key_rows(counted, diff, counts=True), spec, run)
    return ValidationResult(results, audit_rows(with_light_details(pair, diff), spec, run))


def validate_column(
    spec: PairSpec, run: Run, sample: int | None = None, seed: int = 42
) -> ValidationResult:
    """Row count and column metrics; keys are compared like any other column.

    Only a sample needs keys, to draw from.
    """
    if sample is not None:
        spec = sampled_spec(spec, sample, seed)
    pair = align(replace(spec.named_alike(), keys=()))
    columns = _column_rows(pair, spec)
    results = stamp(_count_rows(pair), spec, run).unionByName(stamp(columns, spec, run))
    return ValidationResult(results, drift=_drift(stamp(columns, spec, run)))


def validate_schema(spec: PairSpec, run: Run) -> ValidationResult:
    """Structure only."""
    return ValidationResult(stamp(_schema_rows(spec), spec, run), schema=schema_table(spec))


def validate_custom(
    spark: SparkSession,
    name: str,
    source_sql: str,
    target_sql: str,
    kind: str,
    run: Run,
    keys: Sequence[str] = (),
    sample: int | None = None,
    options: Mapping[str, Any] | None = None,
    **views: DataFrame,
) -> ValidationResult:
    """Two queries in place of two tables, compared by ``column`` or by ``row``.

    ``options`` are those of ``PairSpec``, such as the hash mode.
    """
    spec = PairSpec(
        name,
        load_query(spark, source_sql, **views),
        load_query(spark, target_sql, **views),
        keys,
        **(options or {}),
    )
    if kind == "row":
        return validate_row(spec, run, sample)
    if kind == "column":
        return validate_column(spec, run, sample)
    raise ValueError(f"unknown kind of custom check {kind!r}")


def validate_grouped(
    spec: PairSpec, run: Run, group_cols: Sequence[str]
) -> ValidationResult:
    """Drill down by group, then match the rows of the groups that still differ.

    The metric rows of the final groups, failing ones included, are the results, and a row for
    each group says whether it passes.  The mismatches name their group in ``details``.
    """
    if not spec.keys and not group_cols:
        raise ValueError("a grouped check needs group columns or a key")
    if not group_cols:
        return validate_row(spec, run)
    found = grouped_drilldown(align(spec), group_cols, spec.abs_tol, spec.rel_tol)
    verdicts = found.groups.selectExpr("'group' as check", "'*' as column_name", "'GROUP' as metric", "group_key", "outcome as status")
    results = found.metrics.selectExpr("'group' as check", "*").drop("level", "outcome")
    results = results.unionByName(verdicts, allowMissingColumns=True)
    mismatches = None
    if found.rows is not None:
        rows = found.rows.withColumnRenamed("group_key", "details")
        mismatches = audit_rows(rows, spec, run)
    return ValidationResult(stamp(results, spec, run), mismatches)


def run_pair(
    spec: PairSpec,
    run: Run,
    results_target: str,
    audit_target: str | None = None,
    checks: Sequence[str] = ALL_CHECKS,
    details: str = "full",
    mode: str = "append",
) -> None:
    """Validate one pair and write its results and mismatches.

    The keys that differ or repeat are materialised once; duplicates, row classes and audit
    rows all come from that small table, and its known size lets Catalyst choose how to fetch
    the full records.  A check that fails writes an ERROR row and the next one runs.
    """
    with Scratch(spec.source.sparkSession) as scratch:
        parts = _checked_parts(spec, run, audit_target, checks, details, mode, scratch)
        write_results(_union(parts), results_target, mode)


def _checked_parts(
    spec: PairSpec,
    run: Run,
    audit_target: str | None,
    checks: Sequence[str],
    details: str,
    mode: str,
    scratch: Scratch,
) -> list[DataFrame]:
    def rows() -> DataFrame:
        pair = align(spec)
        if not pair.keys:
            return note(scratch.spark, "row", SKIPPED, "no key")
        repeats = (F.col(N_SOURCE) > 1) | (F.col(N_TARGET) > 1)
        flagged, diff = compared(pair, lambda df: scratch.keep(df.filter(~F.col(SAME) | repeats), "flagged"))
        diff = scratch.keep(diff, "differing")
        if audit_target is not None:
            found = with_details if details == "full" else with_light_details
            write_audit(audit_rows(found(pair, diff), spec, run), audit_target, mode, (run.run_id, spec.name))
        return _key_rows(flagged, diff, counts=False)

    builders: list[tuple[str, Callable[[], DataFrame]]] = [
        ("count", lambda: _count_rows(align(spec))),
        ("row", rows),
        ("schema", lambda: _schema_rows(spec)),
        ("column", lambda: _column_rows(align(spec), spec)),
    ]
    builders = [(name, build) for name, build in builders if name in checks]
    if "custom" in checks:
        builders += [
            (getattr(check, "__name__", "custom"), lambda check=check: check(spec))
            for check in spec.extra_checks
        ]
    out = []
    for name, build in builders:
        try:
            # Kept first: a check that breaks half-way leaves no partial rows.
            out.append(scratch.keep(stamp(build(), spec, run), "results"))
        except Exception as problem:  # noqa: BLE001 - any failure is a result row
            out.append(stamp(note(scratch.spark, name, ERROR, str(problem)), spec, run))
    return out
