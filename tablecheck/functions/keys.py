"""Key forms that make padded and binary keys comparable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from .names import field


def normalise_keys(
    df: DataFrame, keys: Sequence[str], pad_to: Mapping[str, int] | None = None
) -> DataFrame:
    """Bring key columns to a common form.

    Text keys lose trailing blanks, or are padded to the width in ``pad_to`` where the other
    side keeps fixed-width text.  Binary keys become hex text.
    """
    pad_to = pad_to or {}
    changed = {}
    for key in keys:
        dtype = df.schema[key].dataType
        if isinstance(dtype, T.BinaryType):
            changed[key] = F.hex(field(key))
        elif isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
            text = F.rtrim(field(key))
            if key in pad_to:
                short = F.length(text) < pad_to[key]
                text = F.when(short, F.rpad(text, pad_to[key], " ")).otherwise(text)
            changed[key] = text
    return df.withColumns(changed) if changed else df


def restore_binary_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Turn hex text keys back into binary, to filter a table that holds them as binary."""
    return df.withColumns({key: F.unhex(field(key)) for key in keys})
