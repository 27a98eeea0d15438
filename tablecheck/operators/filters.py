"""Row filters applied to both sides of a pair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import field

# Predicates that keep every row.
KEEP_ALL = ("", "1=1")


def apply_filter(df: DataFrame, expr: str | None) -> DataFrame:
    """Keep the rows that satisfy a predicate text; Catalyst pushes it to the scan."""
    if expr is None or expr.replace(" ", "") in KEEP_ALL:
        return df
    return df.filter(F.expr(expr))


def _semi(df: DataFrame, wanted: DataFrame, names: Mapping[str, str], null_safe: bool) -> DataFrame:
    renamed = wanted.select(
        *[field(c).alias(f"__tc_w{i}") for i, c in enumerate(names)]
    )
    condition = None
    for i, column in enumerate(names.values()):
        left, right = field(column), F.col(f"__tc_w{i}")
        same = left.eqNullSafe(right) if null_safe else left == right
        condition = same if condition is None else condition & same
    return df.join(renamed, condition, "left_semi")


def filter_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Keep the rows whose key is listed.

    ``on`` maps the column of ``keys`` to the column of ``df`` where the names differ.  No
    hint is given: Catalyst broadcasts the list when it is under the session's size limit and
    shuffles otherwise.
    """
    names = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    return _semi(df, keys, names, null_safe=False)


def filter_groups(df: DataFrame, groups: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Keep the rows of the listed groups; a null group value equals a null."""
    names = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    return _semi(df, groups, names, null_safe=True)
