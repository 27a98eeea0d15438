"""Bucket fingerprints: find the part of a large pair that differs before matching rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import quoted
from ..functions.hashing import fast_hash_sql, hash_sql, row_sql
from ..functions.sums import exact_sum_sql
from .columns import Aligned
from .rowdiff import IN_SOURCE, both_sides, row_diff

BUCKET = "__tc_bucket"


def hex_long_sql(digest: str, start: int = 1) -> str:
    """15 hex digits of a digest as a number, 60 bits."""
    return f"cast(conv(substring({digest}, {start}, 15), 16, 10) as bigint)"


def bucket_sql(schema: T.StructType, keys: Sequence[str], n: int, algo: str) -> str:
    """SQL for the bucket of a row, from its key."""
    if algo == "xxhash64":
        value = f"xxhash64({', '.join(map(quoted, keys))})"
    else:
        value = hex_long_sql(f"sha2({row_sql(schema, keys)}, 256)")
    return f"cast(pmod({value}, {n}L) as int)"


def bucket_of(
    schema: T.StructType, keys: Sequence[str], n: int, algo: str = "xxhash64"
) -> Column:
    """The bucket of a row, from its key."""
    return F.expr(bucket_sql(schema, keys, n, algo))


def bucket_fingerprints(pair: Aligned, n: int, algo: str = "sha256") -> DataFrame:
    """Per bucket and side the row count, the xor of the row hashes and their sum.

    Keys take part in the hash: rows that swap keys inside a bucket must show.  The xor alone
    is blind to pairs of equal rows, the count to changed ones; the sum, over other digits or
    another hash, sees both.  Combining before the shuffle leaves at most ``n`` rows per
    task, whatever the size or skew of the tables.

    ``sha256`` gives numbers that other engines reproduce; ``xxhash64`` is for narrowing.
    """
    hashed = [*pair.keys, *pair.columns]
    bucket = f"{bucket_sql(pair.schema, pair.keys, n, algo)} as bucket"
    keyless = f"{' or '.join(f'{quoted(k)} is null' for k in pair.keys)} as keyless"
    if algo == "sha256":
        digest = hash_sql(pair.schema, hashed, pair.hash_mode, algo)
        rows = both_sides(pair, bucket, keyless, f"{digest} as __tc_digest").selectExpr(
            "bucket",
            "keyless",
            IN_SOURCE,
            f"{hex_long_sql('__tc_digest')} as x",
            f"{hex_long_sql('__tc_digest', 16)} as a",
        )
        bits = 60
    else:
        x = fast_hash_sql(pair.schema, hashed)
        a = fast_hash_sql(pair.schema, hashed, salt=1)
        rows = both_sides(pair, bucket, keyless, f"{x} as x", f"{a} as a")
        bits = 64

    def side(flag: str, name: str) -> list[Column]:
        return [
            F.expr(f"count_if({flag}) as {name}_rows"),
            F.expr(f"coalesce(bit_xor(if({flag}, x, null)), 0L) as {name}_xor"),
            F.expr(
                f"coalesce({exact_sum_sql(f'if({flag}, a, null)', bits)}, 0) as {name}_sum"
            ),
        ]

    return rows.groupBy("bucket").agg(
        *side(IN_SOURCE, "source"),
        *side(f"not {IN_SOURCE}", "target"),
        F.expr("count_if(keyless) as keyless_rows"),
    )


def differing_buckets(pair: Aligned, n: int, algo: str = "xxhash64") -> DataFrame:
    """The buckets whose fingerprints differ; at most ``n`` numbers.

    Rows with a null key part match nothing, so a bucket that holds any differs.
    """
    return (
        bucket_fingerprints(pair, n, algo)
        .filter(
            "source_rows <> target_rows or source_xor <> target_xor "
            "or source_sum <> target_sum or keyless_rows > 0"
        )
        .select("bucket")
    )


def narrowed(pair: Aligned, n: int = 4096, algo: str = "xxhash64") -> Aligned:
    """The pair cut down to the buckets that differ.

    The list of buckets has at most ``n`` integers and is broadcast for that reason.
    """
    buckets = F.broadcast(
        differing_buckets(pair, n, algo).withColumnRenamed("bucket", BUCKET)
    )
    own = bucket_of(pair.schema, pair.keys, n, algo)
    return pair.with_rows(
        pair.source.join(buckets, own == F.col(BUCKET), "left_semi"),
        pair.target.join(buckets, own == F.col(BUCKET), "left_semi"),
    )


def narrowed_row_diff(pair: Aligned, n: int = 4096, algo: str = "xxhash64") -> DataFrame:
    """The same rows as ``row_diff``, shuffling only the buckets that differ.

    Worth its second scan where few keys differ: then next to nothing is shuffled.
    """
    return row_diff(narrowed(pair, n, algo))
