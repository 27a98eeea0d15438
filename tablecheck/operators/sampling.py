"""Repeatable random samples of keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import fields, key_text
from ..session import materialise
from ..spec import PairSpec
from .buckets import hex_long_sql
from .columns import Aligned, align
from .filters import filter_keys

def _order_digest(schema: T.StructType, keys: Sequence[str], seed: int) -> Column:
    return F.sha2(F.concat(key_text(schema, keys), F.lit(f":{seed}")), 256)


def sample_keys(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` distinct keys, the first in the order of a seeded hash of the key.

    Sorting or de-duplicating all keys would shuffle them all.  One aggregate lists the parts of the
    hash range that hold a key; parts are narrower the smaller the hash, four or more to each wanted
    key between a number and its double.  As every listed part holds a key at least, the ``n``
    first parts hold ``n`` keys at least, and few more; only these are de-duplicated and sorted.  A
    key that is repeated any number of times is one part, combined before the shuffle.  That is
    two scans; the answer is the exact one.  Null keys are never drawn.
    """
    if not keys:
        raise ValueError("a key is required to sample rows")
    usable = df.filter(reduce(lambda a, b: a & b, [k.isNotNull() for k in fields(keys)]))
    digest = _order_digest(df.schema, keys, seed)
    fineness = 2 ** max((4 * n).bit_length(), 8)
    part = f"cast(floor(log2(1D + {hex_long_sql('__tc_order')}) * {fineness}D) as bigint)"
    drawn = usable.select(*fields(keys), digest.alias("__tc_order"))
    filled = drawn.selectExpr(f"{part} as part").groupBy("part").agg(F.lit(1).alias("one"))
    last = filled.select("part").orderBy("part").limit(n).agg(F.max("part")).first()[0]
    below = drawn.filter(f"{part} <= {-1 if last is None else last}L")
    return below.dropDuplicates([*keys]).orderBy("__tc_order").limit(n).select(*fields(keys))


def sampled(pair: Aligned, n: int, seed: int = 42) -> Aligned:
    """Both sides limited to ``n`` random source keys; a sample of nothing compares nothing."""
    chosen = materialise(sample_keys(pair.source, pair.keys, n, seed), "sample")
    return pair.with_rows(
        filter_keys(pair.source, chosen, pair.keys), filter_keys(pair.target, chosen, pair.keys)
    )


def sampled_spec(spec: PairSpec, n: int, seed: int = 42) -> PairSpec:
    """The same limit on the tables themselves, for checks that need more than the keys."""
    spec = spec.named_alike()
    pair = align(spec)
    chosen = materialise(sample_keys(pair.source, pair.keys, n, seed), "sample")
    names = dict(zip(pair.keys, spec.keys))
    source, target = (filter_keys(df, chosen, names) for df in (spec.source, spec.target))
    return replace(spec, source=source, target=target)
