"""Near duplicates by SimHash fingerprints, found through Golay codewords.

**Fingerprint.**  Texts are lower-cased (A to Z) and split at ASCII white space; every run of three
words, repeats included, is hashed with XXH64 (seed 42), and a bit of the fingerprint is set where
more than half the hashes have it.  Shorter texts hash as a whole; a text without words has the
fingerprint zero.

**Keys.**  A fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to a word of 23
bits.  The binary Golay code of 23 bits is perfect: each word lies within 3 bits of exactly one
codeword.  A word gets the index of every codeword within 4 bits: one, or six where the nearest is
3 away.  Words that differ in at most 2 bits always share an index: the word half-way between them has
a codeword within 3 bits, which is within 4 of both.

**Pigeonhole.**  Two differing bits leave one of three segments untouched and at most one in one of the
others.  Keys are (segment as it is, codeword index of the next one, in a circle); the three
combinations cover every way to deal two bits to three segments, 16 keys a fingerprint on average.

**Joining.**  Rows that share a fingerprint are one node, so copies cost nothing.  Fingerprints that
share a key are compared pair by pair where a key has at most ``BUCKET`` of them.  Those of fuller keys
take an exact way without pairs: each sends itself and its 64 neighbours at one bit, and what meets
there differs in at most 2 bits; a meeting point has at most 65 members.  No link is lost and work
grows with the number of fingerprints.  A fingerprint has at most 2,080 others within two bits, so no
node of the graph is hot.

Odd rows: a missing text counts as empty; an empty table gives an empty table; rows that repeat an id
are compared like all others; a row without an id keeps a null ``doc_id`` and takes part, and
``component_id`` is the smallest id of its class, null only if no row of it has one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices, text_of
from tablecheck.llm.components import components
from tablecheck.llm.scratch import materialise
from tablecheck.llm.words import lowered, spaced_words

WORDS, SEED = 3, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))

#: Fixed values of the binary Golay code: its generator polynomial and lengths.
GENERATOR, LENGTH, CHECK = 0b110001110101, 23, 11

#: Fingerprints under one key that are compared pair by pair; fuller keys take the way without pairs.
BUCKET = 64

#: Parts into which the rows of one fingerprint or key are dealt.
SALTS = 64


def shingle_hashes(text: bytes):
    """The hashes of the shingles of a text, an array for each stretch of it."""
    carried: list[bytes] = []
    n_words = 0
    for words in spaced_words(lowered(text)):
        n_words += len(words)
        words = carried + words
        runs = map(b" ".join, zip(*(words[i:] for i in range(WORDS))))
        found = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in runs), dtype=np.uint64)
        if len(found):
            yield found
        carried = words[-(WORDS - 1) :]
    if 0 < n_words < WORDS:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], dtype=np.uint64)


def _bit_counts(hashes: np.ndarray, starts: list[int]) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """The fingerprints of some texts, as unsigned integers."""
    counts, totals = np.zeros((len(texts), 64), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    parts, owners, size = [], [], 0

    def add() -> None:
        starts = np.cumsum([0, *map(len, parts[:-1])])
        np.add.at(counts, owners, _bit_counts(np.concatenate(parts), starts))
        np.add.at(totals, owners, [len(p) for p in parts])

    for i, text in enumerate(texts):
        for found in shingle_hashes(text):
            parts.append(found)
            owners.append(i)
            size += len(found)
            if size >= 1 << 16:
                add()
                parts, owners, size = [], [], 0
    if parts:
        add()
    bits = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a long of the same 64 bits."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = fingerprints_of(texts).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "fp"])

        return step

    return map_slices(text_of(docs, key, text), make, "doc_id long, fp long")


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder by the generator polynomial."""
    left = words.copy()
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - CHECK), 0)
    return left


def error_table() -> np.ndarray:
    """For each syndrome the error patterns of at most 4 bits: one, or six; the first fills the rest."""
    table = np.full((1 << CHECK, 6), -1, dtype=np.int64)
    used = np.zeros(1 << CHECK, dtype=np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in at) for at in combinations(range(LENGTH), weight)], dtype=np.int64)
        for pattern, s in zip(patterns, syndrome(patterns)):
            table[s, used[s]] = pattern
            used[s] += 1
    return np.where(table < 0, table[:, :1], table)


def codeword_indices(words: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """The 12-bit indices of the codewords within 4 bits, six to a word, repeats where there is one."""
    return (words[:, None] ^ errors[syndrome(words)]) >> CHECK


def keys_of(fps: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row numbers and keys of some fingerprints."""
    parts = [(fps >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
    rows, keys = [], []
    for i, whole in enumerate(parts):
        indices = codeword_indices(parts[(i + 1) % len(parts)], errors)
        once = np.ones(indices.shape, dtype=bool)
        once[:, 1:] = indices[:, 1:] != indices[:, :1]
        at, nth = np.nonzero(once)
        rows.append(at)
        keys.append(((i << 22 | whole[at]) << 12) | indices[at, nth])
    return np.concatenate(rows), np.concatenate(keys)


def _postings(nodes: DataFrame) -> DataFrame:
    """``bucket`` and ``fp`` for every key of every fingerprint."""

    def make():
        errors = error_table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array(batch.column("fp"), dtype=np.int64)
            rows, keys = keys_of(fps.view(np.uint64), errors)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["bucket", "fp"])

        return step

    return map_slices(nodes.select("fp"), make, "bucket long, fp long", rows=8192)


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints ``fp`` within two bits.

    Fingerprints of full keys are linked through a meeting point to the smallest of at most 65, so
    not every close pair is a row; the classes that the links connect are complete.
    """
    postings = materialise(_postings(nodes).withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS))))
    # A key with a great share of all rows is counted, and met again below, in parts.
    parts = postings.groupBy("bucket", "salt").agg(F.count("*").alias("n"))
    shared = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).where("n > 1")
    sized = postings.join(shared.select("bucket", "n", F.explode("salts").alias("salt")), ["bucket", "salt"]).select("bucket", "fp", "n")
    sized = materialise(sized)
    few = sized.where(F.col("n") <= bucket)
    pairs = few.select("bucket", F.col("fp").alias("a")).join(few.select("bucket", F.col("fp").alias("b")), "bucket")
    close = pairs.where("a < b and bit_count(a ^ b) <= 2").select("a", "b")
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    meeting = sized.where(F.col("n") > bucket).select("fp").distinct().select("fp", F.explode(flips).alias("point"))
    met = meeting.groupBy("point").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return close.union(stars).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row."""
    salted = fingerprints(docs, key, text).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    rows = materialise(salted)
    parts = rows.groupBy("fp", "salt").agg(F.min("doc_id").alias("id"))
    nodes = materialise(parts.groupBy("fp").agg(F.min("id").alias("id"), F.collect_list("salt").alias("salts")))
    # A node knows its smallest id, so the smallest node of a class names the class.
    node = F.struct(F.col("id").isNull().alias("none"), "id", "fp")
    known = nodes.select("fp", node.alias("node"))
    edges = (
        links(nodes, bucket)
        .join(known.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a")
        .join(known.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b")
    )
    labels = components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    labels = labels.select(F.col("node.fp").alias("fp"), F.col("label.id").alias("low"), F.lit(True).alias("linked"))
    classes = nodes.join(labels, "fp", "left").select("fp", "salts", F.when(F.col("linked"), F.col("low")).otherwise(F.col("id")).alias("component_id"))
    dealt = classes.select("fp", F.explode("salts").alias("salt"), "component_id")
    return rows.join(dealt, ["fp", "salt"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
