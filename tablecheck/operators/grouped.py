"""Grouped drill-down: compare aggregates by group, look closer only where they differ."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import key_json, quoted
from ..session import materialise
from ..spec import FAIL, PASS
from .columns import Aligned
from .filters import filter_groups
from .metrics import (
    Metric,
    aggregated,
    group_columns,
    group_json,
    group_names,
    metrics_of,
    pair_metrics,
    unpivot,
)
from .rowdiff import IN_SOURCE, row_diff


@dataclass(frozen=True)
class GroupedResult:
    """Final groups, their metric rows, and the differing rows of the groups drilled into.

    A final group passes, or fails at the last level.  ``metrics`` has one row per final group,
    column and metric; ``rows`` one per differing key of the failing groups, or is ``None``
    without keys.
    """

    groups: DataFrame
    metrics: DataFrame
    rows: DataFrame | None


def _partials(df: DataFrame, metrics: Sequence[Metric], group_by: Sequence[str]) -> DataFrame:
    """One pass over a side: the aggregates of the finest groups, in mergeable form.

    The partial result of a mean is its number of values; the sum is a metric of its own.
    """
    named = {}
    for m in metrics:
        plain = {"AVG": "count", "SUM": "sum"}.get(m.name if m.name == "AVG" or m.as_text else "")
        named[m.slot] = f"{plain}({quoted(m.column)})" if plain else m.value
    return aggregated(df, group_columns(group_by), named)


def _merged(partials: DataFrame, metrics: Sequence[Metric], lead: Sequence[str]) -> DataFrame:
    """The metrics of coarser groups from the partials of the finest ones."""
    merge = {"MIN": "min", "MAX": "max"}
    sums = {m.column: m.slot for m in metrics if m.name == "SUM"}
    named = {}
    for m in metrics:
        value = f"{merge.get(m.name, 'sum')}({m.slot})"
        if m.name == "AVG":
            total = f"sum({sums[m.column]})"
            if not m.exact:
                total = f"cast({total} as double)"
            value = f"if({value} > 0, {total} / {value}, null)"
        elif m.as_text:
            value = f"cast({value} as string)"
        named[m.slot] = value
    return unpivot(aggregated(partials, lead, named), metrics, lead)


def grouped_drilldown(
    pair: Aligned,
    group_cols: Sequence[str],
    abs_tol: float = 1e-6,
    rel_tol: float | None = 1e-10,
) -> GroupedResult:
    """Compare level by level and match the rows of the groups that still differ at the end.

    Each side is scanned once for the aggregates of the finest groups; coarser levels are
    merged from those, all groups of a level together.  A passing group is final; a failing
    one is split by the next column.  At the last level failing groups are final as well, and
    their rows are matched inside their group, whatever its size.
    """
    group_cols = list(group_cols)
    unknown = [c for c in group_cols if c not in pair.keys + pair.columns]
    if not group_cols or unknown:
        raise ValueError(f"group columns must be shared by both sides: {unknown or group_cols}")
    metrics = metrics_of(pair.schema, pair.columns, rows=True)
    finest = materialise(
        _partials(pair.source, metrics, group_cols)
        .withColumn(IN_SOURCE, F.lit(True))
        .unionAll(_partials(pair.target, metrics, group_cols).withColumn(IN_SOURCE, F.lit(False))),
        "groups",
    )
    source, target = finest.filter(IN_SOURCE), finest.filter(f"not {IN_SOURCE}")

    names = group_names(group_cols)
    groups: list[DataFrame] = []
    reported: list[DataFrame] = []
    failing = None
    for level in range(1, len(names) + 1):
        by, last = names[:level], level == len(names)
        # The columns of later levels are compared like any other until their level comes.
        own = [m for m in metrics if m.column not in group_cols[:level]]
        s, t = _merged(source, own, by), _merged(target, own, by)
        if failing is not None:
            s, t = filter_groups(s, failing, by[:-1]), filter_groups(t, failing, by[:-1])
        checked = materialise(pair_metrics(s, t, by, abs_tol, rel_tol), f"level{level}")
        outcome = F.when(F.expr(f"bool_and(status = '{PASS}')"), PASS).otherwise(FAIL)
        verdict = checked.groupBy(*by).agg(outcome.alias("__tc_outcome"))
        final = verdict if last else verdict.filter(F.col("__tc_outcome") != FAIL)
        failing = verdict.filter(F.col("__tc_outcome") == FAIL).select(*by)
        place = [F.lit(level).alias("level"), group_json(group_cols[:level]).alias("group_key")]
        groups.append(final.select(*place, F.col("__tc_outcome").alias("outcome")))
        same = reduce(
            lambda x, y: x & y, [F.col(f"c.{n}").eqNullSafe(F.col(f"f.{n}")) for n in by]
        )
        reported.append(
            checked.alias("c")
            .join(final.alias("f"), same)
            .select("c.*", "__tc_outcome")
            .select(
                *place,
                "column_name",
                "metric",
                "source_value",
                "target_value",
                "difference",
                "status",
                F.col("__tc_outcome").alias("outcome"),
            )
        )
    rows = _rows_of(pair, failing, group_cols) if pair.keys else None
    return GroupedResult(
        reduce(DataFrame.unionByName, groups), reduce(DataFrame.unionByName, reported), rows
    )


def _rows_of(pair: Aligned, failing: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The differing rows of the failing groups, each matched inside its group."""
    failing = materialise(failing, "failing-groups")
    on = dict(zip(group_names(group_cols), group_cols))
    limited = pair.with_rows(
        filter_groups(pair.source, failing, on), filter_groups(pair.target, failing, on)
    )
    # Group columns that are keys already need no second place in the comparison.
    diff = row_diff(limited, within=[c for c in group_cols if c not in pair.keys])
    return diff.select(
        key_json(group_cols).alias("group_key"),
        key_json(pair.keys).alias("primary_key_value"),
        "mismatch_type",
        "source_row_hash",
        "target_row_hash",
    )
