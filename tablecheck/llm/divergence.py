"""How far apart the vocabularies of the sources of a language are.

**Terms** are runs of letters: everything but ASCII characters that are no letters separates them, and
only A to Z are lower-cased.  Each language keeps the terms that occur in at least ``min_documents`` of
its documents.  A term's share in a group of N kept occurrences is p = 1 + floor(10**9 (count + 5) /
(N + 5 V)), with V kept terms.

**Two passes** over the texts.  The first counts documents by (lang, term) and says which terms stay; the
second counts occurrences by (lang, source, term) of those only, told by a bitmap of fixed size whose
wrong admissions an exact join takes out.  Rare words, the bulk of any vocabulary, are never multiplied
by the sources.

**One-hot products.**  A group's column of counts is split into indicator columns, one for each level
that a count takes (0 included).  For the matrix X of the indicator columns of two tiles of groups, the
product X^T X counts, for every pair of groups and every pair of levels, the terms that have these levels: the
joint table of the two groups.  The sum of |p - q| is the price of the table, as p and q are functions
of the level.  X has one row for each term and is multiplied block by block: terms are dealt to blocks of about
``BLOCK`` terms of like frequency, so that a block has few levels, and groups to tiles of ``TILE``; a task
holds one block of two tiles and gives one partial price for each pair of groups.  The entries of the
product are numbers of terms below 2**24 and hence exact in single precision; prices are longs.  Terms
that both tiles lack need no row: their number times the price of (0, 0) is added at the end.

Odd rows: a missing text, lang or source is the empty one; a group without terms has N = 0 and all its
rows; a language without kept terms has value 0 everywhere; a language of one source has no pairs; an
empty table gives an empty table; repeated rows count as often as they are there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm import bitmaps
from tablecheck.llm.scratch import materialise, release
from tablecheck.llm.words import stretches

SCALE, PRIOR = 10**9, 5

#: Terms of a block and groups of a tile.
BLOCK, TILE = 256, 16

#: Occurrences that a task gathers before it counts them, and terms that it knows at most.
TOKENS, ENTRIES = 6_000_000, 1_000_000

_OTHER = bytes(b for b in range(128) if not chr(b).isalpha())
_SPACED = bytes.maketrans(_OTHER, b" " * len(_OTHER))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a stretch at a time."""
    for part in stretches(text.translate(_SPACED).lower()):
        yield part.split()


def _named(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    def filled(name: str, alias: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)

    return docs.select(filled(lang, "lang"), filled(source, "source"), filled(text, "text"))


def _slots(lang: str, terms: list[bytes]) -> np.ndarray:
    lead = lang.encode() + b"\x00"
    return bitmaps.slots_of(np.fromiter((xxhash.xxh64_intdigest(lead + t) for t in terms), dtype=np.uint64, count=len(terms)))


def _with_slots(terms: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("term").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([int(_slots(lang, [term])[0]) for lang, term in pairs], pa.int64())], names=["slot"])

    return terms.select("lang", "term").mapInArrow(run, "slot long")


class _Terms:
    """Numbers of the terms of one language in the order of their arrival; -1 for those not admitted."""

    def __init__(self, lang: str, kept: np.ndarray | None):
        self.lang, self.kept, self.names = lang, kept, []
        self.table: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.table)

    def numbers(self, words: list[bytes] | set[bytes]) -> np.ndarray:
        new = list((words if isinstance(words, set) else set(words)).difference(self.table))
        on = np.ones(len(new), dtype=bool) if self.kept is None else bitmaps.admits(self.kept, _slots(self.lang, new))
        for term, admitted in zip(new, on.tolist()):
            self.table[term] = len(self.names) if admitted else -1
            if admitted:
                self.names.append(term)
        return np.fromiter(map(self.table.__getitem__, words), dtype=np.int32, count=len(words))


def _counted(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], kept: np.ndarray | None, once: bool) -> Iterator[pa.RecordBatch]:
    """``keys``, ``term`` and ``n``: occurrences of terms by group, or documents that hold them.

    Numbers of terms are gathered and counted when there are many, so that a task hands on few rows
    for the same term; what it holds is bounded by ``TOKENS`` and ``ENTRIES``.
    """
    terms: dict[str, _Terms] = {}
    found: dict[tuple, list[np.ndarray]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        names = {lang: pa.array(t.names, pa.binary()).cast(pa.string()) for lang, t in terms.items()}
        for group, parts in found.items():
            numbers = np.concatenate([*parts, np.zeros(0, dtype=np.int32)])
            n = np.bincount(numbers[numbers >= 0])
            own = np.flatnonzero(n)
            if len(own):
                zeros = pa.array(np.zeros(len(own), dtype=np.int64))
                arrays = [*(pa.array([x], pa.string()).take(zeros) for x in group), names[group[0]].take(pa.array(own)), pa.array(n[own])]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "term", "n"])
        found.clear()
        if sum(map(len, terms.values())) >= ENTRIES:
            terms.clear()

    for batch in batches:
        groups = zip(*(batch.column(k).to_pylist() for k in keys))
        for group, text in zip(groups, batch.column("text").cast(pa.binary())):
            own = terms.setdefault(group[0], _Terms(group[0], kept))
            parts = found.setdefault(group, [])
            lists = terms_of(text.as_py())
            for words in [set().union(*lists)] if once else lists:
                parts.append(own.numbers(words))
                size += len(words)
                if size >= TOKENS or sum(map(len, terms.values())) >= ENTRIES:
                    yield from flush()
                    size, parts = 0, found.setdefault(group, [])
                    own = terms.setdefault(group[0], _Terms(group[0], kept))
    yield from flush()


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``term`` and the number ``df`` of documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, ("lang",), None, once=True)

    return docs.select("lang", "text").mapInArrow(run, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("df"))


def group_counts(docs: DataFrame, kept: np.ndarray) -> DataFrame:
    """``lang``, ``source``, ``term`` and occurrences ``n`` of the terms that the bitmap admits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, ("lang", "source"), kept, once=False)

    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def share_sql(count: str, total: str, terms: str) -> str:
    """SQL for the share of a term, exact."""
    top = f"cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(19,0)) + {PRIOR})"
    return f"(1 + cast(({top}) div (cast({total} as decimal(19,0)) + {PRIOR} * cast({terms} as decimal(19,0))) as bigint))"


def one_hot(levels: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The indicator columns of a matrix of level numbers, and where each of its columns begins."""
    widths = levels.max(axis=0) + 1
    starts = np.concatenate([[0], np.cumsum(widths)])
    found = np.zeros((len(levels), starts[-1]), dtype=np.float32)
    found[np.arange(len(levels))[:, None], levels + starts[:-1]] = 1
    return found, starts.tolist()


def _levels(shares: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Level numbers by column, and the share at each level."""
    numbers, prices = np.empty(shares.shape, dtype=np.int64), []
    for j in range(shares.shape[1]):
        values, numbers[:, j] = np.unique(shares[:, j], return_inverse=True)
        prices.append(values)
    return numbers, prices


def block_prices(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of |p - q| for every column of ``left`` against every column of ``right``.

    The rows are terms and the values shares; the sums are taken from the joint tables.
    """
    (x, x_prices), (y, y_prices) = _levels(left), _levels(right)
    (x_hot, x_starts), (y_hot, y_starts) = one_hot(x), one_hot(y)
    joint = x_hot.T @ y_hot
    out = np.zeros((left.shape[1], right.shape[1]), dtype=np.int64)
    for i, p in enumerate(x_prices):
        for j, q in enumerate(y_prices):
            table = joint[x_starts[i] : x_starts[i + 1], y_starts[j] : y_starts[j + 1]].astype(np.int64)
            out[i, j] = (table * np.abs(p[:, None] - q[None, :])).sum()
    return out


_PARTIAL = "lang string, a int, b int, value long, n_terms long"
_BLOCK_KEY = ["lang", "level_class", "bucket", "tile_a", "tile_b"]


def _partial(entries: pa.Table) -> pa.Table:
    """The partial prices of one block of two tiles.

    An entry without a term tells of a group of the tiles, which may have no entry in this block.
    """
    lang, tile_a, tile_b = (entries.column(c)[0].as_py() for c in ("lang", "tile_a", "tile_b"))
    groups, at = np.unique(np.array(entries.column("number")), return_inverse=True)
    none = np.zeros(len(groups), dtype=np.int64)
    none[at] = np.array(entries.column("none"))
    filled = np.array(entries.column("term").is_valid())
    terms = entries.column("term").filter(pa.array(filled)).combine_chunks().dictionary_encode()
    shares = np.tile(none, (len(terms.dictionary), 1))
    shares[np.array(terms.indices), at[filled]] = np.array(entries.column("share"))[filled]
    left, right = np.flatnonzero(groups // TILE == tile_a), np.flatnonzero(groups // TILE == tile_b)
    i, j = np.nonzero(groups[left][:, None] < groups[right][None, :])
    if not len(shares):
        i = j = np.zeros(0, dtype=np.int64)
    found = block_prices(shares[:, left], shares[:, right]) if len(i) else np.zeros((1, 1), dtype=np.int64)
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()),
            "a": pa.array(groups[left][i].astype(np.int32)),
            "b": pa.array(groups[right][j].astype(np.int32)),
            "value": pa.array(found[i, j]),
            "n_terms": pa.array(np.full(len(i), len(shares), dtype=np.int64)),
        }
    )


def _pair_sums(entries: DataFrame, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """For each two groups of a language with common blocks the price and the number of terms priced."""
    there = terms.select("lang", "level_class", "bucket").distinct()
    told = there.join(groups.select("lang", "number", "none"), "lang").selectExpr(
        "lang", "cast(null as string) as term", "level_class", "bucket", "number", "none", "0L as share"
    )
    rows = entries.select("lang", "term", "level_class", "bucket", "number", "none", "share").union(told)
    tiles = groups.groupBy("lang").agg(F.floor(F.max("number") / TILE).cast("int").alias("last"))
    own = F.floor(F.col("number") / TILE).cast("int")
    rows = rows.join(tiles, "lang").withColumn("tile", own).withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    rows = rows.withColumn("tile_a", F.least("tile", "other")).withColumn("tile_b", F.greatest("tile", "other"))
    priced = rows.select(*_BLOCK_KEY, "term", "number", "none", "share").groupBy(*_BLOCK_KEY).applyInArrow(_partial, _PARTIAL)
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms"))


def _ranked(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= limit) if limit else ranked
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergence(
    docs: DataFrame,
    min_documents: int = 30,
    limit: int = 50,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair``: for each other source of the language the sum of |p - q| over the kept terms.
    Part ``term``: the ``limit`` terms whose share is furthest above that of the whole language.
    """
    docs = _named(docs, text, lang, source)
    kept = materialise(document_counts(docs).where(F.col("df") >= min_documents).select("lang", "term"))
    counts = group_counts(docs, bitmaps.bitmap(_with_slots(kept)))
    counts = materialise(counts.join(kept, ["lang", "term"], "left_semi"))
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(n_terms, "lang", "left")
    groups = groups.na.fill(0, ["size", "v"]).withColumn("number", number)
    # Without kept terms there is no share and nothing to price.
    none = f"if(v = 0, 0L, {share_sql('0', 'size', 'greatest(v, 1L)')})"
    groups = materialise(groups.withColumn("none", F.expr(none)))

    whole = groups.groupBy("lang").agg(F.sum("size").alias("whole"), F.max("v").alias("v"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total")).withColumn("level_class", F.floor(F.log2("total")).cast("int"))
    classes = terms.groupBy("lang", "level_class").agg(F.ceil(F.count("*") / BLOCK).alias("buckets"))
    terms = terms.join(classes, ["lang", "level_class"]).join(whole, "lang")
    terms = terms.selectExpr(
        "lang", "term", "level_class", "cast(pmod(xxhash64(term), buckets) as int) as bucket", f"{share_sql('total', 'whole', 'v')} as usual"
    )
    terms = materialise(terms)
    entries = counts.join(terms, ["lang", "term"]).join(groups, ["lang", "source"])
    entries = materialise(entries.withColumn("share", F.expr(share_sql("n", "size", "v"))).drop("size", "v"))
    release(counts)

    sums = _pair_sums(entries, terms, groups)
    one, other = (groups.select("lang", F.col("source").alias(f"{x}_source"), F.col("number").alias(x), F.col("none").alias(f"{x}_none"), "v") for x in "ab")
    pairs = one.join(other.drop("v"), "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.selectExpr(
        "lang", "a_source", "b_source", "coalesce(value, 0L) + (v - coalesce(n_terms, 0L)) * abs(a_none - b_none) as value"
    )
    pairs = materialise(pairs)
    both = pairs.selectExpr("lang", "a_source as source", "b_source as item", "value").union(
        pairs.selectExpr("lang", "b_source as source", "a_source as item", "value")
    )
    above = entries.where("share > usual").select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
    return _ranked(both, "pair").union(_ranked(above, "term", limit))
