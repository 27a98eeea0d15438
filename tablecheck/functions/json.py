"""JSON forms of keys and records, nulls kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .hashing import JSON_OPTIONS
from .names import field


def key_json(keys: Sequence[str]) -> Column:
    """``{"k1":v1,...}`` with the native type of each key."""
    return F.to_json(F.struct(*[field(k).alias(k) for k in keys]), JSON_OPTIONS)


def details_json(source_record: Column, target_record: Column) -> Column:
    """Both records; an absent side is a JSON null."""
    both = F.struct(source_record.alias("source_record"), target_record.alias("target_record"))
    return F.to_json(both, JSON_OPTIONS)


def light_details(keys: Sequence[str], status: Column) -> Column:
    """The key and the class only, where the payload is not wanted."""
    pk = F.struct(*[field(k).alias(k) for k in keys])
    return F.to_json(F.struct(pk.alias("pk"), status.alias("status")), JSON_OPTIONS)
