"""Column references and SQL text that survive blanks, dots and quotes in names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str | None) -> str:
    """A text as a Spark SQL literal."""
    if text is None:
        return "cast(null as string)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def field(name: str) -> Column:
    return F.col(quoted(name))


def fields(names: Iterable[str]) -> list[Column]:
    return [field(name) for name in names]
