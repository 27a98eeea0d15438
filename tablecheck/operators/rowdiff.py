"""Row comparison by key.

Both sides are put under one another with a side flag and aggregated by key, in place of a
full outer join.  Copies of a key are combined before the shuffle, so a key that holds a large
part of the rows costs one row per task; and no side has to be sorted into a join.

With SHA-256 the comparison has two steps.  The first, ``screened``, counts the rows of each key and
adds up two 64-bit hashes of the values themselves, with a plus for the source and a minus for the
target: sums of zero mean that the key has the same rows on both sides, each as often.  It makes
no text, no digest and no sort, and its shuffle carries keys and six longs.  The second makes
texts and digests of the other keys only.  Where nearly all keys differ, the first step is lost;
``screen=False`` leaves it out, as for sources that are costly to read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    details_json,
    field,
    fields,
    key_json,
    light_details,
    literal,
    quoted,
    row_hash,
)
from ..functions.hashing import fast_hash_sql, hash_sql, value_sql
from ..session import materialise
from ..spec import HASH_MISMATCH, MISSING_IN_SOURCE, MISSING_IN_TARGET
from .columns import Aligned

IN_SOURCE = "__tc_in_source"
HASH = "__tc_hash"
N_SOURCE, N_TARGET, N_SAME = "__tc_n_source", "__tc_n_target", "__tc_n_same"
SOURCE_HASH, TARGET_HASH = "__tc_source_hash", "__tc_target_hash"
# A row with a null key part matches nothing on the other side: the side joins its group key.
APART = "__tc_apart"


# The only column beside the keys is the digest of the row, made before.
STORED = "stored"
# Whether the rows of a key agree, each as often as on the other side.
SAME = "__tc_same"
# Longs that hold a digest, and the SQL that gives their order that of the hex digits.
_WORDS = 4
_FLIP = "-9223372036854775808L"


def _hash_sql(pair: Aligned) -> str:
    if pair.hash_algo == STORED:
        return quoted(pair.columns[0])
    return hash_sql(pair.schema, pair.columns, pair.hash_mode, pair.hash_algo)


def both_sides(pair: Aligned, *columns: str) -> DataFrame:
    """Both tables under one another, flagged by side; the columns are SQL."""
    source = pair.source.selectExpr(*columns, f"true as {IN_SOURCE}")
    return source.unionAll(pair.target.selectExpr(*columns, f"false as {IN_SOURCE}"))


def _flagged(pair: Aligned, within: Sequence[str], source: Sequence[str], target: Sequence[str]) -> DataFrame:
    """Both tables under one another: keys, the side of rows without a whole key, and what is
    given for each side as SQL.
    """
    lead = [quoted(c) for c in (*pair.keys, *within)]
    any_null = " or ".join(f"{quoted(k)} is null" for k in pair.keys)
    one = pair.source.selectExpr(*lead, f"if({any_null}, true, null) as {APART}", *source)
    return one.unionAll(pair.target.selectExpr(*lead, f"if({any_null}, false, null) as {APART}", *target))


def _beside(pair: Aligned, value: str, value_type: str, within: Sequence[str] = ()) -> DataFrame:
    """Both tables under one another with ``value`` in a column of its own for each side."""
    none = f"cast(null as {value_type})"
    return _flagged(
        pair,
        within,
        [f"{value} as {SOURCE_HASH}", f"{none} as {TARGET_HASH}"],
        [f"{none} as {SOURCE_HASH}", f"{value} as {TARGET_HASH}"],
    )


def _hashes_beside(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    value_type = "bigint" if pair.hash_algo == "xxhash64" else "string"
    return _beside(pair, _hash_sql(pair), value_type, within)


def _group(pair: Aligned, within: Sequence[str] = ()) -> list[Column | str]:
    return [*fields(pair.keys), *fields(within), APART]


def screened(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    """Per key the number of rows of each side, and whether these are the same rows.

    Sums are taken over the halves of two hashes, so that they cannot overflow before a key has
    2**31 rows.  Different rows agree in both with a chance of one in 2**128.
    """
    hashes = [fast_hash_sql(pair.schema, pair.columns, salt) for salt in (0, 1)]

    def side(sign: str, counts: str) -> list[str]:
        halves = [f"{sign}{half.format(h)}" for h in hashes for half in ("shiftright({}, 32)", "(({}) & 4294967295L)")]
        return [counts, *[f"{x} as __tc_x{i}" for i, x in enumerate(halves)]]

    rows = _flagged(
        pair,
        within,
        side("", f"1L as {N_SOURCE}") + [f"0L as {N_TARGET}"],
        side("-", f"0L as {N_SOURCE}") + [f"1L as {N_TARGET}"],
    )
    sums = [F.sum(f"__tc_x{i}").alias(f"__tc_x{i}") for i in range(2 * len(hashes))]
    totals = rows.groupBy(*_group(pair, within)).agg(F.sum(N_SOURCE).alias(N_SOURCE), F.sum(N_TARGET).alias(N_TARGET), *sums)
    zero = " and ".join(f"__tc_x{i} = 0L" for i in range(2 * len(hashes)))
    return totals.select(*_group(pair, within), N_SOURCE, N_TARGET, F.expr(f"{N_SOURCE} = {N_TARGET} and {zero}").alias(SAME))


def keyed_hashes(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    """Per key the number of rows and the smallest row hash of each side.

    The smallest hash stands for the key where it has several rows on a side.  ``within``
    names further columns that must agree, with null equal to null.

    A digest travels as four longs, since a text or binary buffer would make the aggregate sort
    its input.  Copies of a key are ordered by the first long; two that agree in it and differ
    behind it, one in 2**64, are taken in any order.
    """
    rows = _hashes_beside(pair, within)
    sides = ((SOURCE_HASH, N_SOURCE), (TARGET_HASH, N_TARGET))
    counts = [F.count(h).alias(n) for h, n in sides]
    if pair.hash_algo == "xxhash64":
        return rows.groupBy(*_group(pair, within)).agg(*counts, *[F.min(h).alias(h) for h, _ in sides])
    words, smallest = [], []
    for h, _ in sides:
        parts = [f"{h}{i}" for i in range(_WORDS)]
        digits = [f"cast(conv(substring({h}, {1 + 16 * i}, 16), 16, -10) as bigint)" for i in range(_WORDS)]
        words += [f"{digits[0]} ^ {_FLIP} as {parts[0]}", *[f"{d} as {p}" for d, p in zip(digits[1:], parts[1:])]]
        smallest += [F.min(parts[0]).alias(parts[0]), *[F.min_by(p, parts[0]).alias(p) for p in parts[1:]]]
    lead = [quoted(c) for c in (*pair.keys, *within)]
    split = rows.selectExpr(*lead, APART, SOURCE_HASH, TARGET_HASH, *words)
    found = split.groupBy(*_group(pair, within)).agg(*counts, *smallest)

    def text(h: str) -> str:
        first = f"lpad(hex({h}0 ^ {_FLIP}), 16, '0')"
        rest = [f"lpad(hex({h}{i}), 16, '0')" for i in range(1, _WORDS)]
        return f"lower(concat({', '.join([first, *rest])})) as {h}"

    return found.selectExpr(*lead, APART, N_SOURCE, N_TARGET, *[text(h) for h, _ in sides])


def only_keys(pair: Aligned, keys: DataFrame, within: Sequence[str] = (), sided: bool = True) -> Aligned:
    """The pair cut down to the rows of some keys, given as ``screened`` gives them.

    Null equals null; a row without a whole key belongs to the keys of its own side, or to those of
    both if not ``sided``.  Both sides read the same keys, without a filter of their own, so that
    Spark finds them once.  No hint is given: Catalyst broadcasts the keys when they are under the
    session's size limit.
    """
    names = [*pair.keys, *within]
    wanted = keys.select(*[field(c).alias(f"__tc_w{i}") for i, c in enumerate(names)], F.col(APART).alias("__tc_apart_of"))
    any_null = reduce(lambda a, b: a | b, [field(k).isNull() for k in pair.keys])

    def cut(df: DataFrame, own: bool) -> DataFrame:
        same = [field(c).eqNullSafe(F.col(f"__tc_w{i}")) for i, c in enumerate(names)]
        if sided:
            same.append(F.when(any_null, F.lit(own)).eqNullSafe(F.col("__tc_apart_of")))
        return df.join(wanted, reduce(lambda a, b: a & b, same), "left_semi")

    return pair.with_rows(cut(pair.source, True), cut(pair.target, False))


def open_keys(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    """The keys of ``screened`` whose rows are not the same."""
    return screened(pair, within).filter(~F.col(SAME)).select(*_group(pair, within))


def differing_hashes(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    """Rows of ``keyed_hashes`` for all keys whose rows are not the same, and perhaps more."""
    if pair.hash_algo != "sha256" or not pair.screen:
        return keyed_hashes(pair, within)
    return keyed_hashes(only_keys(pair, open_keys(pair, within), within), within)


def mismatch_class() -> Column:
    """The class of a row of ``keyed_hashes``, null where the sides agree."""
    return (
        F.when(F.col(N_SOURCE) == 0, MISSING_IN_SOURCE)
        .when(F.col(N_TARGET) == 0, MISSING_IN_TARGET)
        .when(F.col(SOURCE_HASH) != F.col(TARGET_HASH), HASH_MISMATCH)
    )


def classified(pair: Aligned, keyed: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The differing keys with their class and printable hashes."""
    return keyed.select(
        *fields(pair.keys),
        *fields(within),
        mismatch_class().alias("mismatch_type"),
        F.col(SOURCE_HASH).cast("string").alias("source_row_hash"),
        F.col(TARGET_HASH).cast("string").alias("target_row_hash"),
    ).filter("mismatch_type is not null")


def row_diff(pair: Aligned, within: Sequence[str] = ()) -> DataFrame:
    """The keys whose rows are missing on one side or differ, one row per key."""
    return classified(pair, differing_hashes(pair, within), within)


def hash_mismatch(pair: Aligned) -> DataFrame:
    """Keys on both sides whose rows differ."""
    return row_diff(pair).filter(F.col("mismatch_type") == HASH_MISMATCH)


def key_presence(pair: Aligned) -> DataFrame:
    """Per key the number of rows of each side; reads the key columns only."""
    return (
        _beside(pair, "true", "boolean")
        .groupBy(*fields(pair.keys), APART)
        .agg(F.count(SOURCE_HASH).alias(N_SOURCE), F.count(TARGET_HASH).alias(N_TARGET))
    )


def missing_in_source(pair: Aligned) -> DataFrame:
    """Target keys without a source key, with their number of rows."""
    found = key_presence(pair).filter(F.col(N_SOURCE) == 0)
    return found.select(*fields(pair.keys), F.col(N_TARGET).alias("n_rows"))


def missing_in_target(pair: Aligned) -> DataFrame:
    """Source keys without a target key, with their number of rows."""
    found = key_presence(pair).filter(F.col(N_TARGET) == 0)
    return found.select(*fields(pair.keys), F.col(N_SOURCE).alias("n_rows"))


def _hash_counts(pair: Aligned) -> DataFrame:
    return (
        _hashes_beside(pair)
        .groupBy(*fields(pair.keys), APART, F.coalesce(SOURCE_HASH, TARGET_HASH).alias(HASH))
        .agg(F.count(SOURCE_HASH).alias(N_SOURCE), F.count(TARGET_HASH).alias(N_TARGET))
    )


def hash_groups(pair: Aligned) -> DataFrame:
    """Per key and row hash the number of rows of each side."""
    return _hash_counts(pair).select(
        *fields(pair.keys),
        F.col(HASH).cast("string").alias("row_hash"),
        F.col(N_SOURCE).alias("n_source"),
        F.col(N_TARGET).alias("n_target"),
    )


def row_diff_all(pair: Aligned) -> DataFrame:
    """The comparison without de-duplication: every row against every row of its key.

    A key with m and n rows stands for m x n comparisons.  They are counted, not listed:
    ``n_pairs`` is the number of comparisons that the class would list, taken from the row
    counts per hash, so a key with very many copies costs no more than its rows.
    ``hash_groups`` tells which hashes take part.
    """

    def product() -> Column:
        return F.col(N_SOURCE).cast("decimal(19,0)") * F.col(N_TARGET).cast("decimal(19,0)")

    totals = (
        _hash_counts(pair)
        .groupBy(*fields(pair.keys), APART)
        .agg(
            F.sum(product()).cast("decimal(38,0)").alias(N_SAME),
            F.sum(N_SOURCE).alias(N_SOURCE),
            F.sum(N_TARGET).alias(N_TARGET),
        )
    )
    no_source, no_target = F.col(N_SOURCE) == 0, F.col(N_TARGET) == 0
    return totals.select(
        *fields(pair.keys),
        F.when(no_source, MISSING_IN_SOURCE)
        .when(no_target, MISSING_IN_TARGET)
        .otherwise(HASH_MISMATCH)
        .alias("mismatch_type"),
        F.when(no_source | no_target, (F.col(N_SOURCE) + F.col(N_TARGET)).cast("decimal(38,0)"))
        .otherwise((product() - F.col(N_SAME)).cast("decimal(38,0)"))
        .alias("n_pairs"),
    ).filter("n_pairs > 0")


def _surplus(pair: Aligned) -> DataFrame:
    counts = _hash_counts(pair).filter(F.col(N_SOURCE) != F.col(N_TARGET))
    more = counts.select(
        *_group(pair), HASH, *[F.greatest(a - b, F.lit(0)).alias(n) for n, a, b in (
            (N_SOURCE, F.col(N_SOURCE), F.col(N_TARGET)), (N_TARGET, F.col(N_TARGET), F.col(N_SOURCE)))]
    )
    # The sides that a key has rows left on decide its class.
    names = [*pair.keys, APART]
    left = more.groupBy(*_group(pair)).agg(F.max(N_SOURCE).alias("__tc_s"), F.max(N_TARGET).alias("__tc_t"))
    left = left.select(*[field(c).alias(f"__tc_w{i}") for i, c in enumerate(names)], "__tc_s", "__tc_t")
    same = [field(c).eqNullSafe(F.col(f"__tc_w{i}")) for i, c in enumerate(names)]
    kind = F.when(F.col("__tc_s") == 0, MISSING_IN_SOURCE).when(F.col("__tc_t") == 0, MISSING_IN_TARGET).otherwise(HASH_MISMATCH)
    here = F.col(N_SOURCE) > 0
    return more.join(left, reduce(lambda a, b: a & b, same)).select(
        *fields(pair.keys),
        kind.alias("mismatch_type"),
        F.when(here, F.col(HASH)).cast("string").alias("source_row_hash"),
        F.when(~here, F.col(HASH)).cast("string").alias("target_row_hash"),
        (F.col(N_SOURCE) + F.col(N_TARGET)).alias("n_rows"),
    )


def row_surplus(pair: Aligned) -> DataFrame:
    """The rows of each key that find no equal row on the other side, each row used once.

    One row per key and hash, with the number of rows left over.  A key with rows left over on
    both sides is a ``HASH_MISMATCH``, and its rows are listed on their own sides; one that has
    them on one side only lacks them on the other.
    """
    return compared(replace(pair, repeats="all"))[1]


def compared(pair: Aligned, keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Row counts by key, and the differing keys (or rows, where ``repeats`` is ``"all"``).

    ``keep`` cuts down and materialises the counts; it must leave the keys that are not the
    same, and what the reader of the counts needs.  Without it the keys that are not the same are
    materialised alone: only a known size spares the tables a shuffle in the second read.
    """
    if pair.repeats not in ("smallest", "all"):
        raise ValueError(f"unknown treatment of repeated keys {pair.repeats!r}")
    every, cut = pair.repeats == "all", pair
    alone, keep = keep is None, keep or (lambda df: df)
    if pair.screen and pair.hash_algo == "sha256":
        found = keep(screened(pair))
        differing = found.filter(~F.col(SAME)).select(*_group(pair))
        cut = only_keys(pair, materialise(differing, "open") if alone else differing)
    elif every:
        found = keep(key_presence(pair).withColumn(SAME, F.lit(False)))
    else:
        found = keep(keyed_hashes(pair).withColumn(SAME, mismatch_class().isNull()))
        return found, classified(pair, found)
    return found, _surplus(cut) if every else classified(pair, keyed_hashes(cut))


def mismatch_summary(diff: DataFrame) -> DataFrame:
    """Number of differing keys per class."""
    return diff.groupBy("mismatch_type").agg(F.count("*").alias("n_keys"))


def dedupe(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest row hash over ``columns``.

    In two steps: keys alone tell which are repeated; rows of all others pass as they are, without a
    hash and, where the list of repeated keys is small enough to be broadcast, without a shuffle.  Only
    the rows of repeated keys are hashed and aggregated.  A null key equals a null.
    """
    compared = [c for c in df.columns if c not in keys] if columns is None else list(columns)
    names = [f"__tc_w{i}" for i in range(len(keys))]
    repeated = duplicate_groups(df, keys).select(*[field(k).alias(n) for k, n in zip(keys, names)])
    same = reduce(lambda a, b: a & b, [field(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    named = ", ".join(f"{quoted(c)} as c{i}" for i, c in enumerate(df.columns))
    kept = (
        df.join(repeated, same, "left_semi")
        .groupBy(*fields(keys))
        .agg(F.min_by(F.expr(f"struct({named})"), row_hash(df.schema, compared)).alias("__tc_row"))
    )
    first = kept.selectExpr(*[f"__tc_row.c{i} as {quoted(c)}" for i, c in enumerate(df.columns)])
    return df.join(repeated, same, "left_anti").unionAll(first)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row; null keys form a group like any other."""
    return df.groupBy(*fields(keys)).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows beyond the first of each key, in one row."""
    extra = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))
    return duplicate_groups(df, keys).agg(extra.cast("bigint").alias("n_duplicates"))


def _records(pair: Aligned, diff: DataFrame, record: Column) -> DataFrame:
    """Per differing key the record of each side whose hash is the one reported.

    The rows of the listed keys are cut out first and only these are hashed; then they meet the
    list by key, side and hash, so that a key with very many different rows is spread by hash and
    never crossed with its own list.  Give a materialised difference: its size then decides
    between a broadcast and a shuffle.
    """
    names = [f"__tc_k{i}" for i in range(len(pair.keys))]
    listed = diff.select(*fields(pair.keys), F.lit(None).cast("boolean").alias(APART)).distinct()
    near = only_keys(pair, listed, sided=False)
    rows = both_sides(near, *map(quoted, pair.keys + pair.columns), f"cast({_hash_sql(pair)} as string) as {HASH}")
    wanted = diff.select(
        *[field(k).alias(n) for k, n in zip(pair.keys, names)],
        F.col("mismatch_type").alias("__tc_type"),
        F.col("source_row_hash").alias("__tc_source"),
        F.col("target_row_hash").alias("__tc_target"),
        F.expr(
            "inline(array(struct(true as __tc_side, source_row_hash as __tc_wanted),"
            " struct(false as __tc_side, target_row_hash as __tc_wanted)))"
        ),
    ).filter("__tc_wanted is not null")
    same = [field(k).eqNullSafe(F.col(n)) for k, n in zip(pair.keys, names)]
    same += [F.col(IN_SOURCE) == F.col("__tc_side"), F.col(HASH) == F.col("__tc_wanted")]
    kept = rows.join(wanted, reduce(lambda a, b: a & b, same))
    # A null key is listed once per side, each time with the hash of that side only.
    here = F.col(IN_SOURCE)
    return (
        kept.groupBy(*names, "__tc_type", "__tc_source", "__tc_target")
        .agg(
            F.first(F.when(here, record), ignorenulls=True).alias("__tc_source_record"),
            F.first(F.when(~here, record), ignorenulls=True).alias("__tc_target_record"),
        )
        .select(
            *[F.col(n).alias(k) for k, n in zip(pair.keys, names)],
            F.col("__tc_type").alias("mismatch_type"),
            F.col("__tc_source").alias("source_row_hash"),
            F.col("__tc_target").alias("target_row_hash"),
            F.col("__tc_source_record"),
            F.col("__tc_target_record"),
        )
    )


def with_details(pair: Aligned, diff: DataFrame) -> DataFrame:
    """Differing keys as audit rows with the full record of both sides."""
    record = F.expr(f"struct({', '.join(map(quoted, pair.columns))})")
    return _records(pair, diff, record).select(
        key_json(pair.keys).alias("primary_key_value"),
        "mismatch_type",
        "source_row_hash",
        "target_row_hash",
        details_json(F.col("__tc_source_record"), F.col("__tc_target_record")).alias("details"),
    )


def with_light_details(pair: Aligned, diff: DataFrame) -> DataFrame:
    """Differing keys as audit rows that hold the key and the class only."""
    return diff.select(
        key_json(pair.keys).alias("primary_key_value"),
        "mismatch_type",
        "source_row_hash",
        "target_row_hash",
        light_details(pair.keys, F.col("mismatch_type")).alias("details"),
    )


def cell_diff(pair: Aligned, diff: DataFrame) -> DataFrame:
    """For keys on both sides whose rows differ, the columns that differ with both values."""
    texts = [value_sql(quoted(c), pair.schema[c].dataType) for c in pair.columns]
    cells = [
        f"struct({literal(c)} as column_name, __tc_source_record[{i}] as source_value, "
        f"__tc_target_record[{i}] as target_value)"
        for i, c in enumerate(pair.columns)
    ]
    changed = diff.filter(F.col("mismatch_type") == HASH_MISMATCH)
    return (
        _records(pair, changed, F.expr(f"array({', '.join(texts)})"))
        .selectExpr(*map(quoted, pair.keys), f"inline(array({', '.join(cells)}))")
        .filter("not (source_value <=> target_value)")
    )


def cells_by_column(cells: DataFrame) -> DataFrame:
    """Number of differing cells per column."""
    return cells.groupBy("column_name").agg(F.count("*").alias("n_cells"))
