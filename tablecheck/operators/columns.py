"""Which columns of two tables can be compared, and how their schemas differ."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import quoted
from ..sources.tables import CATALOG_SCHEMA, catalog_rows
from ..spec import (
    SCHEMA_MISSING_IN_SOURCE,
    SCHEMA_MISSING_IN_TARGET,
    SCHEMA_TYPE_MISMATCH,
    PairSpec,
)

RESERVED = "__tc_"
_TEXT = (T.StringType, T.CharType, T.VarcharType)


@dataclass(frozen=True)
class Aligned:
    """Two tables cut down to their keys and shared columns, equal in name, type and order."""

    source: DataFrame
    target: DataFrame
    keys: list[str]
    columns: list[str]
    hash_mode: str = "compat"
    hash_algo: str = "sha256"
    screen: bool = True
    repeats: str = "smallest"

    @property
    def schema(self) -> T.StructType:
        return self.source.schema

    def with_rows(self, source: DataFrame, target: DataFrame) -> Aligned:
        return replace(self, source=source, target=target)


def _check_names(df: DataFrame, side: str) -> None:
    reserved = [c for c in df.columns if c.startswith(RESERVED)]
    if reserved:
        raise ValueError(f"{side} column names may not start with {RESERVED}: {reserved}")
    clashes = [c for c, n in Counter(c.lower() for c in df.columns).items() if n > 1]
    if clashes:
        raise ValueError(f"{side} column names differ only in case: {clashes}")


def common_columns(
    source: DataFrame, target: DataFrame, keys: Iterable[str] = (), match: str = "strict"
) -> list[str]:
    """Names of the shared columns in source order, keys left out.

    ``strict`` asks for the same name, case included, and the same type; ``name`` only for
    the same name ignoring case, and gives the names in lower case.
    """
    if match == "strict":
        skip = set(keys)
        types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
        return [
            f.name
            for f in source.schema.fields
            if f.name not in skip and types.get(f.name) == f.dataType.simpleString()
        ]
    if match == "name":
        skip = {k.lower() for k in keys}
        names = {c.lower() for c in target.columns}
        return [c.lower() for c in source.columns if c.lower() in names and c.lower() not in skip]
    raise ValueError(f"unknown match {match!r}")


def shared_type(spark: SparkSession, left: T.DataType, right: T.DataType) -> T.DataType:
    """The type in which values of two different types are compared; text if nothing fits."""
    if left.simpleString() == right.simpleString():
        return left
    numeric = isinstance(left, T.NumericType) and isinstance(right, T.NumericType)
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    temporal = isinstance(left, dates) and isinstance(right, dates)
    if not (numeric or temporal):
        return T.StringType()
    floating, whole = (T.FloatType, T.DoubleType), (T.IntegralType, T.DecimalType)
    if any(isinstance(a, floating) and isinstance(b, whole) for a, b in ((left, right), (right, left))):
        # No numeric type holds all values of both, so they are compared by ``number_text``.
        return T.StringType()
    widened = spark.range(0).select(
        F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right)).alias("v")
    )
    return widened.schema["v"].dataType


def number_text(value: str, dtype: T.DataType) -> str:
    """SQL for one text of a number whatever its type: ``100``, ``-0.25``, ``1.0E30``, ``NaN``.

    Whole numbers below 2**63 are written in full, other floating point values in the shortest form
    that stands for them and for no other; where that fits a decimal it is written without an
    exponent, as decimals are.  Trailing zeros and the sign of zero are left out.
    """
    def plain(text: str) -> str:
        return f"regexp_replace(regexp_replace({text}, '([.][0-9]*[1-9])0+$|[.]0+$', '$1'), '^-0$', '0')"

    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return plain(f"cast({value} as string)")
    text = f"cast({value} as string)"
    whole = f"{value} = floor({value}) and abs({value}) < 9.2E18D"
    decimals = [f"try_cast({text} as decimal(38,{s}))" for s in (0, 18, 30, 38)]
    fitting = " ".join(f"when cast({d} as double) = cast({text} as double) then {plain(f'cast({d} as string)')}" for d in decimals)
    return f"case when {whole} then cast(cast({value} as bigint) as string) {fitting} else {text} end"


def align(spec: PairSpec) -> Aligned:
    """Filter both sides, then keep keys and shared columns under one name and type."""
    from .filters import apply_filter

    _check_names(spec.source, "source")
    _check_names(spec.target, "target")
    spec = spec.named_alike()
    _check_names(spec.target, "target")
    target_filter = spec.filter if spec.target_filter is None else spec.target_filter
    source, target = apply_filter(spec.source, spec.filter), apply_filter(spec.target, target_filter)
    keys = list(spec.keys)
    columns = common_columns(source, target, keys, spec.match)
    if spec.match == "name":
        source = source.toDF(*[c.lower() for c in source.columns])
        target = target.toDF(*[c.lower() for c in target.columns])
        keys = [k.lower() for k in keys]
    for side, df in (("source", source), ("target", target)):
        absent = [k for k in keys if k not in df.columns]
        if absent:
            raise ValueError(f"{side} has no key column {absent}")

    spark = source.sparkSession
    wanted = {
        c: shared_type(spark, source.schema[c].dataType, target.schema[c].dataType)
        for c in keys + columns
    }

    numbers = {c for c in wanted if all(isinstance(df.schema[c].dataType, T.NumericType) for df in (source, target))}

    def cut(df: DataFrame) -> DataFrame:
        def one(c: str) -> str:
            name, dtype = quoted(c), wanted[c]
            if isinstance(dtype, T.StringType) and isinstance(df.schema[c].dataType, T.NumericType) and c in numbers:
                return f"{number_text(name, df.schema[c].dataType)} as {name}"
            same = df.schema[c].dataType.simpleString() == dtype.simpleString()
            return name if same else f"cast({name} as {dtype.simpleString()}) as {name}"

        return df.selectExpr(*[one(c) for c in keys + columns])

    return Aligned(
        cut(source), cut(target), keys, columns, spec.hash_mode, spec.hash_algo, spec.screen, spec.repeats
    )


def schema_diff(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Columns that are missing on one side or differ in type, for all pairs at once.

    Names are compared as they are; ``PairSpec.named_alike`` gives both sides the same ones first.
    """
    spark = pairs[0][1].sparkSession
    s = spark.createDataFrame(
        [row for name, df, _ in pairs for row in catalog_rows(df, name)], CATALOG_SCHEMA
    ).alias("s")
    t = spark.createDataFrame(
        [row for name, _, df in pairs for row in catalog_rows(df, name)], CATALOG_SCHEMA
    ).alias("t")
    same = (F.col("s.pair") == F.col("t.pair")) & (F.col("s.column_name") == F.col("t.column_name"))
    status = (
        F.when(F.col("s.column_name").isNull(), SCHEMA_MISSING_IN_SOURCE)
        .when(F.col("t.column_name").isNull(), SCHEMA_MISSING_IN_TARGET)
        .when(F.col("s.data_type") != F.col("t.data_type"), SCHEMA_TYPE_MISMATCH)
    )
    return (
        s.join(t, same, "full_outer")
        .select(
            F.coalesce("s.pair", "t.pair").alias("pair"),
            F.coalesce("s.column_name", "t.column_name").alias("column_name"),
            F.col("s.data_type").alias("source_type"),
            F.col("t.data_type").alias("target_type"),
            status.alias("status"),
        )
        .filter("status is not null")
    )

