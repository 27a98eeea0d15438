"""Collocations by dynamic itemset counting.

**Counting.**  The documents are dealt to ``shards`` shards by a hash of their content, and the shards
are scanned in a circle.  Words are counted from the first scan on.  A longer phrase is counted from
the first scan that begins after both its subphrases (without its last and without its first word)
have reached the threshold, among the scans so far, and until every shard has been scanned once with
it: lengths overlap, and nothing waits for the end of a pass.  Three words at most need three
circles at most.

Counters are kept for 64-bit hashes of phrases, one table that each scan is added to; a length whose
circle has ended leaves it.  Which phrases have reached the threshold is kept as a bitmap of fixed size, see
``bitmaps``; it only grows.  In scan t a phrase is counted if its subphrases are in the bitmap of scan t
and were not both in it one circle before.  As the same bitmaps decide in both scans of a shard, every
phrase is counted once in each shard, whether the bitmap admits it rightly or wrongly: a wrong
admission costs time only.

A last scan gives the words of the phrases whose counters reached the threshold, with their
occurrences; phrases that share a hash are told apart there.  So only frequent phrases are ever shuffled
as texts, and a common phrase only once for each unit of some MB.

**Scores** are exact: products are ``decimal(38,0)``, which holds them up to 10**15 occurrences of a
phrase.  Only numbers of the phrase itself, its parts and the longer phrases around it enter.

Odd rows: a missing text counts as empty and a missing ``lang`` as ``und``; an empty table gives an empty
table; repeated rows count as often as they are there; other columns are not read.  The table is
read once for each scan, so give one that is cheap to read again and always the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm import bitmaps
from tablecheck.llm.scratch import materialise, release

#: Shards of the circle.
SHARDS = 2

#: Bytes of text whose phrases a task counts at once.
UNIT = 5 << 20

#: Ends a piece; no byte of UTF-8.
_END = b"\xff"

_SAME = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _END * 10 + b" ")

#: The lowest bits of a counter's hash hold the number of words.
_LENGTH = 15

_COUNTERS = "hash long, n long"
_PHRASES = "lang string, length int, phrase string, n long"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in order, an end mark behind each piece."""
    return (text.lower().translate(_SAME) + _END).replace(_END, b" \xff ").split()


def _stretches(text: bytes) -> Iterator[bytes]:
    """The text cut at white space or at ends of pieces, the cut kept; a long word stays whole."""
    marks = text.translate(_SAME).replace(_END, b" ") if len(text) > UNIT else b""
    start = 0
    while len(text) - start > UNIT:
        gap = marks.find(b" ", start + UNIT)
        if gap < 0:
            break
        yield text[start:gap]
        start = gap
    yield text[start:]


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    x = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and where each code went."""
    order = np.argsort(codes)
    ordered = codes[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(codes), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


class Phrases:
    """The phrases in the tokens of one language, by length, and how often each occurs.

    Phrases are those of two phrases one word shorter, a token apart, that ``admitted`` lets pass: a
    function from the slots of these to a boolean array.
    """

    def __init__(self, lang: str, found: list[bytes], carried: int):
        words = pa.array(found, pa.binary()).dictionary_encode()
        ids = np.array(words.indices, dtype=np.int64)
        distinct = words.dictionary.to_pylist()
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        end = np.fromiter((w == _END for w in distinct), dtype=bool, count=len(distinct))
        self.carried, self.length = carried, 1
        self.strings = pc.if_else(pa.array(end), pa.scalar(b"", pa.binary()), words.dictionary).cast(pa.string())
        # Where a phrase starts and its number there; by number its hash, its words and its count.
        self.starts = np.flatnonzero(~end[ids])
        self.number = ids[self.starts]
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(distinct)) ^ seed
        self.words = np.arange(len(distinct))[:, None]
        self._count()

    def _count(self) -> None:
        """Occurrences that end behind the first ``carried`` tokens."""
        own = self.number[self.starts + self.length > self.carried]
        self.n = np.bincount(own, minlength=len(self.hashes))
        self.slots = bitmaps.slots_of(self.hashes)

    def longer(self, admitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on to the phrases one word longer; gives the numbers of the two parts of each."""
        pair = np.flatnonzero(self.starts[1:] == self.starts[:-1] + 1)
        left, right = self.number[pair], self.number[pair + 1]
        passing = admitted[left] & admitted[right]
        left, right, pair = left[passing], right[passing], pair[passing]
        codes, self.number = _distinct(left * max(len(self.hashes), 1) + right)
        left, right = codes // max(len(self.hashes), 1), codes % max(len(self.hashes), 1)
        self.starts, self.length = self.starts[pair], self.length + 1
        self.hashes = _mix(self.hashes[left], self.hashes[right])
        self.words = np.concatenate([self.words[left], self.words[right, -1:]], axis=1)
        self._count()
        return left, right

    def texts(self, numbers: np.ndarray) -> pa.Array:
        parts = [self.strings.take(pa.array(column)) for column in self.words[numbers].T]
        return pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]


def _scanned(lang: str, found: list[bytes], carried: int, length: int, first: bool, active: np.ndarray, before: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """What one scan of a circle adds to the counters."""
    phrases = Phrases(lang, found, carried)
    counted = np.full(len(phrases.hashes), before is not None)
    while True:
        # Words are counted in the first circle, longer ones where they were not a circle before.
        out = np.flatnonzero((phrases.n > 0) & (first if phrases.length == 1 else ~counted))
        if len(out):
            told = phrases.hashes[out].view(np.int64) & ~_LENGTH | phrases.length
            yield pa.RecordBatch.from_arrays([pa.array(told), pa.array(phrases.n[out].astype(np.int64))], names=["hash", "n"])
        if phrases.length == length or not len(phrases.number):
            return
        if before is not None:
            counted = counted & bitmaps.admits(before, phrases.slots)
        left, right = phrases.longer(bitmaps.admits(active, phrases.slots))
        counted = counted[left] & counted[right]


def _named(lang: str, found: list[bytes], carried: int, length: int, often: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts and counts of the phrases in the bitmap; length 0 is for all words together."""
    phrases = Phrases(lang, found, carried)
    yield _text_rows(lang, 0, pa.array([""]), np.array([(phrases.starts >= carried).sum()]))
    while True:
        on = bitmaps.admits(often, phrases.slots)
        out = np.flatnonzero(on & (phrases.n > 0))
        if len(out):
            yield _text_rows(lang, phrases.length, phrases.texts(out), phrases.n[out])
        if phrases.length == length or not len(phrases.number):
            return
        phrases.longer(on)


def _text_rows(lang: str, length: int, texts: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    langs = pa.array([lang]).take(pa.array(np.zeros(len(texts), dtype=np.int64)))
    arrays = [langs, pa.array(np.full(len(texts), length, dtype=np.int32)), texts, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "length", "phrase", "n"])


def _gathered(batches: Iterator[pa.RecordBatch], most: int = 300_000) -> Iterator[pa.RecordBatch]:
    """Rows of the same phrase put together, ``most`` rows at a time: common phrases are in every unit."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def together() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(waiting).group_by(["lang", "length", "phrase"], use_threads=False).aggregate([("n", "sum")])
        for batch in rows.select(["lang", "length", "phrase", "n_sum"]).rename_columns(["lang", "length", "phrase", "n"]).to_batches(100_000):
            yield batch

    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= most:
            yield from together()
            waiting, size = [], 0
    if waiting:
        yield from together()


def _units(docs: DataFrame, length: int, step, schema: str, gather=iter) -> DataFrame:
    """``step(lang, tokens, carried)`` for every unit of text of one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(waiting):
                yield from step(lang, tokens(_END.join(waiting.pop(lang))), 0)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                text = text.as_py()
                if len(text) <= UNIT:
                    waiting.setdefault(lang, []).append(text)
                    size += len(text)
                    if size >= UNIT:
                        yield from flush()
                        size = 0
                    continue
                tail: list[bytes] = []
                for part in _stretches(text):
                    found = tail + tokens(part)[:-1]
                    yield from step(lang, found, len(tail))
                    tail = found[len(found) - min(len(found), length - 1) :]
        yield from flush()

    return docs.select("lang", "text").mapInArrow(lambda batches: gather(run(batches)), schema)


def phrase_counts(docs: DataFrame, max_words: int, threshold: int, text: str = "text", lang: str = "lang", shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The phrases of at least ``threshold`` occurrences (``lang``, ``length``, ``phrase``, ``f``), and
    the number of word occurrences of each ``lang`` (``n``).
    """
    if not 1 <= max_words <= _LENGTH:
        raise ValueError(f"phrases have 1 to {_LENGTH} words")
    own = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    shard = F.pmod(F.xxhash64("lang", "text"), F.lit(shards))
    active, counters = [bitmaps.empty()], None
    for t in range(shards * max_words):
        before = active[t - shards] if t >= shards else None
        if t >= shards and np.array_equal(active[t], before):
            active.append(active[t])  # nothing new to count in this shard
            continue

        def step(lang, found, carried, first=t < shards, now=active[t], before=before):
            return _scanned(lang, found, carried, max_words, first, now, before)

        rows = _units(own.where(shard == t % shards), max_words, step, _COUNTERS)
        if counters is not None:
            # Words end with the first circle, pairs with the second.
            rows = rows.union(counters.where(F.col("hash").bitwiseAND(_LENGTH) > t // shards))
        added = materialise(rows.groupBy("hash").agg(F.sum("n").alias("n")))
        if counters is not None:
            release(counters)
        counters = added
        slot = F.shiftrightunsigned("hash", 64 - bitmaps.BITS).alias("slot")
        active.append(active[t] | bitmaps.bitmap(counters.where(F.col("n") >= threshold).select(slot)))
    release(counters)
    named = _units(own, max_words, lambda lang, found, carried, often=active[-1]: _named(lang, found, carried, max_words, often), _PHRASES, _gathered)
    found = materialise(named.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= threshold) | (F.col("length") == 0)))
    return found.where("length > 0"), found.where("length = 0").select("lang", F.col("f").alias("n"))


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    threshold: int = 10,
    limit: int = 2000,
    covered_percent: int = 50,
    text: str = "text",
    lang: str = "lang",
    shards: int = SHARDS,
) -> DataFrame:
    """The ``limit`` best phrases of each language by the score of their weakest cut.

    A phrase of a occurrences cut into parts of l and r occurrences scores floor(1000000 a a / (l r));
    the lowest cut counts, then the leftmost.  A phrase inside a longer one that has at least
    ``covered_percent`` of its occurrences is left out.
    """
    phrases, totals = phrase_counts(docs, max_words, threshold, text, lang, shards)
    words = F.split("phrase", " ")
    candidates = phrases.where("length > 1").select("lang", "length", "phrase", F.col("f").alias("a"), words.alias("words"))
    cut = candidates.select(
        "lang", "phrase", "a", F.explode(F.expr("sequence(1, length - 1)")).alias("k"), "length", "words"
    ).selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(words, 1, k), ' ') as first", "array_join(slice(words, k + 1, length), ' ') as rest"
    )
    part = phrases.select("lang", "phrase", "f")
    cut = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = "cast((cast(1000000 * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) as decimal(38,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))) as bigint)"
    weakest = cut.selectExpr("lang", "phrase", "a", f"struct({exact} as score, k, l, r) as cut").groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    )
    longer = candidates.where("length > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = weakest.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {covered_percent} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score")
    )
