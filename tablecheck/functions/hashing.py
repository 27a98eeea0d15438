"""Row fingerprints.

The expressions are put together as SQL text and parsed once: a table of several hundred
columns would otherwise need thousands of calls into the JVM to describe a single hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from .names import literal, quoted

# The separator and the null marker of the compatible row text.
SEPARATOR = "||"
NULL_TEXT = "NULL"

# Nulls are kept, and times with all their digits.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def _ordered_maps(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """Replace every map inside ``value`` by its entries in key order: maps have no order."""
    if not _has_map(dtype):
        return value
    item = f"x{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({value}, {item} -> {_ordered_maps(item, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.StructType):
        parts = ", ".join(
            f"{literal(f.name)}, {_ordered_maps(f'{value}.{quoted(f.name)}', f.dataType, depth)}"
            for f in dtype.fields
        )
        return f"if({value} is null, null, named_struct({parts}))"
    inner = _ordered_maps(f"{item}.value", dtype.valueType, depth + 1)
    entries = f"transform(map_entries({value}), {item} -> struct({item}.key as key, {inner} as value))"
    return f"array_sort({entries})"


def value_sql(value: str, dtype: T.DataType) -> str:
    """SQL for the text of a value, null for a null."""
    if isinstance(dtype, T.BinaryType):
        text = f"hex({value})"
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        options = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in JSON_OPTIONS.items())
        text = f"to_json({_ordered_maps(value, dtype)}, map({options}))"
    elif isinstance(dtype, T.StringType):
        text = value
    else:
        text = f"cast({value} as string)"
    return text


def row_sql(
    schema: T.StructType,
    columns: Sequence[str],
    mode: str = "compat",
) -> str:
    """SQL for one text of the row, columns in the given order.

    ``compat`` joins the value texts with a separator and writes a null as a word, so a null
    equals that word and a value may imitate the separator.  ``strict`` puts a null flag and
    the length before each value and has neither ambiguity.
    """
    texts = [value_sql(quoted(c), schema[c].dataType) for c in columns]
    if mode == "compat":
        separator, parts = SEPARATOR, [f"coalesce({t}, {literal(NULL_TEXT)})" for t in texts]
    elif mode == "strict":
        separator = ""
        parts = [f"coalesce(concat('V', length({t}), ':', {t}), 'N')" for t in texts]
    else:
        raise ValueError(f"unknown hash mode {mode!r}")
    return f"concat_ws({', '.join([literal(separator), *parts])})"


def fast_hash_sql(
    schema: T.StructType, columns: Sequence[str], salt: int = 0
) -> str:
    """SQL for xxHash64 over the values themselves.

    The hash function skips nulls and takes both zeros for one; a flag beside each value
    keeps apart what the texts keep apart.
    """
    parts = [str(salt)]
    for c in columns:
        dtype, value = schema[c].dataType, quoted(c)
        # Inside arrays and structs the hash function would skip nulls as well.
        nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
        parts.append(value_sql(value, dtype) if nested else value)
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            negative_zero = f"{value} = 0 and cast({value} as string) = '-0.0'"
            parts.append(f"if({value} is null, 2, if({negative_zero}, 1, 0))")
        else:
            parts.append(f"{value} is null")
    return f"xxhash64({', '.join(parts)})"


def hash_sql(
    schema: T.StructType,
    columns: Sequence[str],
    mode: str = "compat",
    algo: str = "sha256",
) -> str:
    if algo == "sha256":
        return f"sha2({row_sql(schema, columns, mode)}, 256)"
    if algo == "xxhash64":
        return fast_hash_sql(schema, columns)
    raise ValueError(f"unknown hash algorithm {algo!r}")


def value_text(value: str, dtype: T.DataType) -> Column:
    """The text of the column named ``value``, null for a null."""
    return F.expr(value_sql(quoted(value), dtype))


def row_text(
    schema: T.StructType,
    columns: Sequence[str],
    mode: str = "compat",
) -> Column:
    """One text for the row, columns in the given order."""
    return F.expr(row_sql(schema, columns, mode))


def row_hash(
    schema: T.StructType,
    columns: Sequence[str],
    mode: str = "compat",
    algo: str = "sha256",
) -> Column:
    """Hash of the listed columns: 64 hex digits for SHA-256, a long for xxHash64.

    With no columns it is the hash of the empty text, so a row check compares presence only.
    """
    return F.expr(hash_sql(schema, columns, mode, algo))


def key_text(schema: T.StructType, keys: Sequence[str]) -> Column:
    return row_text(schema, keys)
