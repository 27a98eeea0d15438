"""Column metrics and their comparison.

A metric value travels as three fields: ``number`` for values compared with a tolerance,
``text`` for values compared exactly, and ``exact`` that says which applies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import literal, quoted
from ..functions.hashing import value_sql
from ..functions.sums import (
    GRID_PIECES,
    decimal_sum_sql,
    exact_sum_sql,
    float_pieces_sql,
    float_total_sql,
    grid_steps,
    grid_total_sql,
    on_grid_sql,
)
from ..spec import FAIL, PASS
from .columns import Aligned

# The width of the integer types.
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_FLOATS = (T.FloatType, T.DoubleType)
_ORDERED = (T.StringType, T.DateType, T.TimeType, T.TimestampType, T.TimestampNTZType)

METRIC_ID = "__tc_metric"


@dataclass(frozen=True)
class Metric:
    """One aggregate of one column, as SQL."""

    position: int
    column: str
    name: str
    value: str
    result_type: T.DataType

    @property
    def slot(self) -> str:
        """The column it is computed into."""
        return f"__tc_m{self.position}"

    @property
    def as_text(self) -> bool:
        """Whether it is a sum that is written out as text, as it may outgrow any number type."""
        return self.name == "SUM" and isinstance(self.result_type, T.StringType)

    @property
    def exact(self) -> bool:
        return not isinstance(self.result_type, _FLOATS)


def metrics_of(schema: T.StructType, columns: Sequence[str], rows: bool = False) -> list[Metric]:
    """The metrics in reporting order; which ones follow from the column's type class."""
    found = [("*", "COUNT", "count(*)", T.LongType())] if rows else []
    for name in columns:
        dtype, value = schema[name].dataType, quoted(name)
        found.append((name, "NULL_COUNT", f"count_if({value} is null)", T.LongType()))
        if isinstance(dtype, T.NumericType):
            total, total_type, mean_type = f"sum({value})", T.DoubleType(), T.DoubleType()
            bits = _INTEGER_BITS.get(type(dtype))
            if bits:
                total = exact_sum_sql(f"cast({value} as bigint)", bits)
                total_type = T.DecimalType(38, 0)
            mean = f"avg({value})"
            if isinstance(dtype, T.DecimalType):
                total, total_type = decimal_sum_sql(value, dtype.precision, dtype.scale), T.StringType()
                mean_type = dtype
                if dtype.precision > 28:
                    # A mean of so many digits would overflow on the way.
                    mean, mean_type = f"avg(cast({value} as double))", T.DoubleType()
            found.append((name, "SUM", total, total_type))
            found.append((name, "AVG", mean, mean_type))
        if isinstance(dtype, (T.NumericType, *_ORDERED)):
            found.append((name, "MIN", f"min({value})", dtype))
            found.append((name, "MAX", f"max({value})", dtype))
    return [Metric(i, *parts) for i, parts in enumerate(found)]


def group_names(group_by: Sequence[str]) -> list[str]:
    """Group columns go by number inside, as their names may be those of the result."""
    return [f"__tc_g{i}" for i in range(len(group_by))]


def group_columns(group_by: Sequence[str]) -> list[Column]:
    return [F.expr(f"{quoted(g)} as {n}") for g, n in zip(group_by, group_names(group_by))]


def group_json(group_by: Sequence[str]) -> Column:
    """The group as a JSON object, nulls kept."""
    parts = [f"{n} as {quoted(g)}" for g, n in zip(group_by, group_names(group_by))]
    return F.expr(f"to_json(struct({', '.join(parts)}), map('ignoreNullFields', 'false'))")


def aggregated(
    df: DataFrame, group_by: Sequence[Column | str], named: dict[str, str]
) -> DataFrame:
    """Grouped aggregates given as SQL by name."""
    parts = ", ".join(f"{value} as {name}" for name, value in named.items())
    grouped = df.groupBy(*group_by).agg(F.expr(f"struct({parts}) as __tc_all"))
    return grouped.select("*", "__tc_all.*").drop("__tc_all")


def unpivot(wide: DataFrame, metrics: Sequence[Metric], lead: Sequence[str]) -> DataFrame:
    """One row per metric from one column per metric."""
    rows = []
    for m in metrics:
        number = "cast(null as double)" if m.exact else f"cast({m.slot} as double)"
        rows.append(
            f"struct({m.position} as {METRIC_ID}, {literal(m.column)} as column_name, "
            f"{literal(m.name)} as metric, {str(m.exact).lower()} as exact, "
            f"{number} as number, {value_sql(m.slot, m.result_type)} as text)"
        )
    return wide.selectExpr(*lead, f"inline(array({', '.join(rows)}))")


def _passes(
    schema: T.StructType, metrics: Sequence[Metric], size: int | None
) -> list[list[Metric]]:
    """The metrics by pass: one for all, or passes of ``size`` columns, text kept apart."""
    if size is None:
        return [list(metrics)]
    columns = list(dict.fromkeys(m.column for m in metrics))
    text = [c for c in columns if c != "*" and isinstance(schema[c].dataType, T.StringType)]
    rest = [c for c in columns if c not in text]
    parts = [kind[i : i + size] for kind in (rest, text) for i in range(0, len(kind), size)]
    return [[m for m in metrics if m.column in part] for part in parts]


# Floating point columns whose fixed pieces are summed side by side; of more, each value is a row of its own.
_ON_GRID_COLUMNS = 32


def _float_sums(df: DataFrame, metrics: Sequence[Metric], group_by: Sequence[str]) -> DataFrame:
    """Metric rows of the sums and means of floating point columns.

    Each value is cut into integers, these are summed as longs, and the sums are put together in a fixed
    order: the result is the same however the rows lie.  Values of common size and precision are cut
    at fixed places, all columns of a row side by side; any other value becomes a row of its own and
    is cut by its exponent.  A pass of its own over these columns; a task hands on one row per
    group, and one per group, column and exponent of the other values.
    """
    columns = list(dict.fromkeys(m.column for m in metrics))
    names, n = group_names(group_by), len(columns)
    fixed = range(n) if n <= _ON_GRID_COLUMNS else ()
    values = [f"cast({quoted(c)} as double) as v{i}" for i, c in enumerate(columns)]
    rows = df.select(*group_columns(group_by), *map(F.expr, values))
    rows = rows.selectExpr("*", *[f"coalesce({on_grid_sql(f'v{i}')}, true) as g{i}" for i in fixed])
    # Number -1 stands for the row with the values at their fixed places.  The others are cut inside the lambda:
    # the generated code of the rows stays small enough to be compiled.
    none_left = "cast(null as int) as e, " + ", ".join(f"cast(null as bigint) as {p}" for p in ("hi", "mid", "lo"))
    whole = f"array(struct(-1 as c, cast(null as double) as v, {none_left}))"
    finite = "abs(v) < double('infinity')"
    own_pieces = ", ".join(f"if({finite}, {x}, null) as {p}" for p, x in float_pieces_sql("v").items())
    apart = ", ".join(f"struct({f'if(g{i}, -1, {i})' if fixed else i} as c, v{i} as v)" for i in range(n))
    apart = f"transform(filter(array({apart}), x -> x.c >= 0), x -> transform(array(x.v), v -> struct(x.c as c, v as v, {own_pieces}))[0])"
    apart = f"concat({whole}, {apart})"
    if fixed:
        apart = f"if({' and '.join(f'g{i}' for i in fixed)}, {whole}, {apart})"
    rows = rows.selectExpr(*names, *[x for i in fixed for x in (f"v{i}", f"g{i}")], f"inline({apart})")
    cut = rows.selectExpr(*names, "c", "v", "e", "hi", "mid", "lo", *[f"if(c = -1 and g{i}, v{i}, null) as v{i}" for i in fixed])
    for step in zip(*[grid_steps(f"v{i}", f"v{i}") for i in fixed]):
        cut = cut.withColumns({k: F.expr(x) for part in step for k, x in part.items()})
    pieces = [[f"v{i}p{j}" for j in range(GRID_PIECES)] for i in range(n)]
    sums = cut.groupBy(*names, "c", "e").agg(
        *[F.sum(p).alias(p) for p in ("hi", "mid", "lo")],
        F.count("v").alias("n"),
        F.sum(F.when(~F.expr(f"coalesce({finite}, true)"), F.col("v"))).alias("beyond"),
        *[F.sum(p).alias(p) for i in fixed for p in pieces[i]],
        *[F.count(f"v{i}").alias(f"n{i}") for i in fixed],
    )

    def part(column: int | str, count: str, others: Sequence[str], places: Sequence[str]) -> str:
        own = ", ".join(f"{x} as {p}" for p, x in zip(("e", "hi", "mid", "lo", "beyond"), others))
        at = ", ".join(f"{x} as m{j}" for j, x in enumerate(places))
        return f"struct({column} as c, {count} as n, {own}, {at})"

    no_others = ["cast(null as int)", *["cast(null as bigint)"] * 3, "cast(null as double)"]
    no_places = ["cast(null as bigint)"] * GRID_PIECES
    none = ", ".join(part(i, "0L", no_others, no_places) for i in range(n))
    single = part("c", "n", ("e", "hi", "mid", "lo", "beyond"), no_places)
    beside = ", ".join(part(i, f"n{i}", no_others, pieces[i]) for i in fixed) or none
    told = sums.selectExpr(*names, f"inline(if(c = -1, array({beside}), array({single})))")
    if not group_by:
        # Without groups there is a result without rows as well.
        told = told.unionAll(df.sparkSession.range(1).selectExpr(f"inline(array({none}))"))
    totals = told.groupBy(*names, "c").agg(
        F.expr("collect_list(if(e is null, null, struct(e, hi, mid, lo)))").alias("parts"),
        F.sum("n").alias("n"),
        F.sum("beyond").alias("beyond"),
        *[F.max(f"m{j}").alias(f"m{j}") for j in range(GRID_PIECES)],
    )
    start = f"coalesce({grid_total_sql([f'm{j}' for j in range(GRID_PIECES)])}, 0D)"
    totals = totals.selectExpr(*names, "c", "n", f"if(n = 0, null, coalesce(beyond, {float_total_sql('parts', start)})) as total")
    found = {"SUM": "total", "AVG": "total / nullif(n, 0L)"}
    parts = ", ".join(
        f"struct({columns.index(m.column)} as of, {m.position} as {METRIC_ID}, {literal(m.column)} as column_name, "
        f"{literal(m.name)} as metric, false as exact, {found[m.name]} as number)"
        for m in metrics
    )
    shown = totals.selectExpr(*names, "c", f"inline(array({parts}))").filter("of = c")
    return shown.selectExpr(*names, METRIC_ID, "column_name", "metric", "exact", "number", "cast(number as string) as text")


def _numbered_metrics(
    df: DataFrame,
    columns: Sequence[str],
    group_by: Sequence[str],
    rows: bool,
    columns_per_pass: int | None = None,
) -> DataFrame:
    metrics = metrics_of(df.schema, columns, rows)
    if not metrics:
        raise ValueError("no columns to aggregate")
    out = []
    summed = [m for m in metrics if m.name in ("SUM", "AVG") and isinstance(df.schema[m.column].dataType, _FLOATS)]
    if summed:
        out.append(_float_sums(df, summed, group_by))
        metrics = [m for m in metrics if m not in summed]
    for part in _passes(df.schema, metrics, columns_per_pass):
        named = {m.slot: m.value for m in part}
        wide = aggregated(df, group_columns(group_by), named)
        out.append(unpivot(wide, part, group_names(group_by)))
    return reduce(DataFrame.unionAll, out)


def column_metrics(
    df: DataFrame,
    columns: Sequence[str],
    group_by: Sequence[str] = (),
    rows: bool = False,
    columns_per_pass: int | None = None,
) -> DataFrame:
    """All metrics of all columns, one row per group, column and metric.

    The group is given as a JSON object in ``group_key``.  By default there is one pass over
    the table.  A wide table in a columnar format is better read in several, each of its own
    columns: the bytes read are the same, while several hundred aggregates in one pass make
    code too large to be compiled well.
    """
    found = _numbered_metrics(df, columns, group_by, rows, columns_per_pass)
    lead = [group_json(group_by).alias("group_key")] if group_by else []
    return found.select(*lead, METRIC_ID, "column_name", "metric", "exact", "number", "text")


def match_sql(s: str, t: str, abs_tol: float = 1e-6, rel_tol: float | None = 1e-10) -> str:
    """SQL for whether two metric values, structs of the three fields, agree.

    Two nulls agree and a null agrees with nothing else.  Floating point values agree within
    either tolerance, the relative one because sums of many values depend on their order;
    equal infinities agree, and not-a-number agrees with itself.
    """
    difference = f"abs({s}.number - {t}.number)"
    close = f"{difference} < {abs_tol!r}D"
    if rel_tol is not None:
        scale = f"greatest(abs({s}.number), abs({t}.number))"
        close = (
            f"({close} or ({difference} <= {scale} * {rel_tol!r}D"
            f" and {difference} < double('infinity')))"
        )
    return (
        f"case when {s}.text is null or {t}.text is null "
        f"then {s}.text is null and {t}.text is null "
        f"when {s}.exact or {s}.text = {t}.text then {s}.text = {t}.text else {close} end"
    )


def metrics_match(
    source: str, target: str, abs_tol: float = 1e-6, rel_tol: float | None = 1e-10
) -> Column:
    """Whether the metric values in two struct columns agree."""
    return F.expr(match_sql(quoted(source), quoted(target), abs_tol, rel_tol))


_VALUE = "struct(exact, number, text)"


def _compared(both: DataFrame, lead: Sequence[str], abs_tol: float, rel_tol: float | None) -> DataFrame:
    def number(side: str) -> str:
        return f"coalesce({side}.number, try_cast({side}.text as double))"

    match = match_sql("__tc_s", "__tc_t", abs_tol, rel_tol)
    return both.selectExpr(
        *lead,
        METRIC_ID,
        "column_name",
        "metric",
        "__tc_s.text as source_value",
        "__tc_t.text as target_value",
        f"{number('__tc_s')} - {number('__tc_t')} as difference",
        f"if({match}, '{PASS}', '{FAIL}') as status",
    )


def column_comparison(
    pair: Aligned,
    abs_tol: float = 1e-6,
    rel_tol: float | None = 1e-10,
    rows: bool = False,
    columns_per_pass: int | None = None,
) -> DataFrame:
    """Every metric of both sides with its verdict.

    The metrics of a side are one row per column and metric, a number fixed by the schema, so
    one of the two may always be broadcast.
    """
    source, target = (
        _numbered_metrics(df, pair.columns, (), rows, columns_per_pass)
        for df in (pair.source, pair.target)
    )
    both = source.selectExpr(METRIC_ID, "column_name", "metric", f"{_VALUE} as __tc_s").join(
        F.broadcast(target.selectExpr(METRIC_ID, f"{_VALUE} as __tc_t")), METRIC_ID
    )
    return _compared(both, [], abs_tol, rel_tol)


def column_diff(pair: Aligned, abs_tol: float = 1e-6, rel_tol: float | None = 1e-10) -> DataFrame:
    """The metrics that disagree."""
    failed = column_comparison(pair, abs_tol, rel_tol).filter(f"status = '{FAIL}'")
    return failed.drop("status", METRIC_ID)


def pair_metrics(
    source: DataFrame,
    target: DataFrame,
    lead: Sequence[str],
    abs_tol: float = 1e-6,
    rel_tol: float | None = 1e-10,
) -> DataFrame:
    """Put the metric rows of two sides beside one another, group by group.

    A group missing on one side has no values there, and a null group equals a null group.
    """
    keys = [*lead, METRIC_ID, "column_name", "metric"]
    none = "cast(null as struct<exact: boolean, number: double, text: string>)"
    both = (
        source.selectExpr(*keys, f"{_VALUE} as __tc_s", f"{none} as __tc_t")
        .unionAll(target.selectExpr(*keys, f"{none} as __tc_s", f"{_VALUE} as __tc_t"))
        .groupBy(*keys)
        .agg(F.expr("first(__tc_s, true) as __tc_s"), F.expr("first(__tc_t, true) as __tc_t"))
    )
    return _compared(both, lead, abs_tol, rel_tol)


def grouped_column_diff(
    pair: Aligned,
    group_by: Sequence[str],
    abs_tol: float = 1e-6,
    rel_tol: float | None = 1e-10,
) -> DataFrame:
    """The metrics that disagree, per group."""
    columns = [c for c in pair.columns if c not in group_by]
    checked = pair_metrics(
        _numbered_metrics(pair.source, columns, group_by, rows=True),
        _numbered_metrics(pair.target, columns, group_by, rows=True),
        group_names(group_by),
        abs_tol,
        rel_tol,
    )
    return checked.filter(f"status = '{FAIL}'").select(
        group_json(group_by).alias("group_key"),
        "column_name",
        "metric",
        "source_value",
        "target_value",
        "difference",
    )


def count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides and their difference, in one row."""
    counts = source.selectExpr("count(*) as s", "0L as t").unionAll(
        target.selectExpr("0L as s", "count(*) as t")
    )
    return counts.selectExpr(
        "sum(s) as source_count", "sum(t) as target_count", "sum(s) - sum(t) as difference"
    )
