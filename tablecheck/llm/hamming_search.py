"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are rotated and cut to their signs; the rotations are learned on a bounded sample (iterative
quantisation: signs and the rotation that comes closest to them, in turn).  Codes are split into
substrings, each with an index of its own.  Two codes within Hamming radius r agree in some substring
within r / m, so probing every substring index that far finds every code within the radius.  What is
found is ranked by the exact distance of the original vectors.

The radius is learned as well: on the sample it holds nearly all true neighbours, and in a larger
table neighbours are nearer still.  If an index block holds fewer than k codes within it, the radius
grows for that query until it does, so k rows come back wherever there are as many candidates.

Rows are dealt into blocks of bounded size, each indexed by itself; queries are dealt into chunks,
and every chunk meets every block.  A block gives its k nearest for each query; a task keeps the k
nearest of its blocks, and the merge keeps k.  Of the rows that an index finds, a matrix product
leaves out those that rounding cannot have kept from the k nearest; the others get exact distances.

Defined results: vectors that are null, empty, all zero, of another length than most, or hold null or
non-finite components take no part; ties go to the smaller id; equal vectors with different ids are
found like any others; a row does not find itself (rows that repeat an id do not find each other);
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm.sampling import least
from tablecheck.llm.scratch import materialise, release

#: Vectors of the sample on which rotations and radius are learned.
SAMPLE = 2048
BITS = 256
SUBSTRINGS = 16
#: Rows of an index block and queries of a chunk.
BLOCK = 4096
CHUNK = 1024
#: Queries that meet a block at once.
TILE = 64
#: Files of packed blocks at most.
FILES = 256
#: Share of the sample's true neighbours that the radius holds.
HELD = 0.98


class Model(NamedTuple):
    """Rotations (dimensions x bits), the mean that is taken off first, and the radius."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = (vectors - self.mean) @ self.rotations >= 0
        return np.packbits(bits, axis=1).view(np.uint16)


def _rotation(x: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
    r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(x @ r).T @ x)
        r = (left @ right).T
    return r


def _popcount() -> np.ndarray:
    return np.array([bin(i).count("1") for i in range(256)], np.uint8)[np.arange(1 << 16).view(np.uint8).reshape(-1, 8)[:, :2]].sum(axis=1, dtype=np.uint8)


def learn(sample: np.ndarray, k: int, bits: int = BITS, seed: int = 7) -> Model:
    """Rotations and radius from a sample of vectors."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    x = sample - mean
    dim = sample.shape[1]
    turns = [_rotation(x, 20, rng) for _ in range(-(-bits // dim))]
    rotations = np.concatenate(turns, axis=1)[:, :bits]
    model = Model(mean, rotations, bits)
    if len(sample) <= k:
        return model
    count, codes = _popcount(), model.codes(sample)
    asked = np.arange(min(256, len(sample)))
    square = (sample**2).sum(axis=1)
    far = square[asked, None] + square - 2 * sample[asked] @ sample.T
    far[asked, asked] = np.inf
    near = np.argsort(far, axis=1)[:, :k]
    hamming = count[codes[asked, None, :] ^ codes[near]].sum(axis=2, dtype=np.int64)
    return model._replace(radius=int(np.quantile(hamming, HELD)))


class Index:
    """Codes of one block, with an index of its own for each substring: for each value, its rows.

    Radii within which a substring may differ in few bits only are probed: the words so near to the
    query's are looked up.  With more such words than rows, probes would admit nearly every row, and
    the distances of all rows cost less.  Both find the same rows.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes.view(np.uint64).T)
        self.most = 16 * codes.shape[1]
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []

    def probed(self, radius: int) -> bool:
        """Whether the words to look up within the radius are fewer than the rows."""
        reach = radius // self.codes.shape[1]
        return self.codes.shape[1] * sum(math.comb(16, i) for i in range(reach + 1)) < len(self.codes)

    def far(self, codes: np.ndarray) -> np.ndarray:
        """Hamming distances of all rows, a line for each of the codes."""
        asked = codes.view(np.uint64)
        far = np.zeros((len(codes), len(self.codes)), np.uint16)
        differ, bits = np.empty(far.shape, np.uint64), np.empty(far.shape, np.uint8)
        for w, word in enumerate(self.words):
            np.bitwise_xor(asked[:, w : w + 1], word, out=differ)
            far += np.bitwise_count(differ, out=bits)
        return far

    def within(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """Marks of the rows within the radius, a line for each of the codes."""
        if not self.probed(radius):
            return self.far(codes) <= radius
        if not self.tables:
            for column in self.codes.T:
                sizes = np.bincount(column, minlength=1 << 16)
                self.tables.append((np.append(0, np.cumsum(sizes)), np.argsort(column, kind="stable")))
        words = np.arange(1 << 16, dtype=np.uint16)
        near = words[np.bitwise_count(words) <= radius // self.codes.shape[1]]
        found = np.zeros((len(codes), len(self.codes)), bool)
        for s, (begins, order) in enumerate(self.tables):
            values = (near ^ codes[:, s, None]).astype(np.int64)
            sizes = begins[values + 1] - begins[values]
            line, word = np.nonzero(sizes)
            begin, size = begins[values[line, word]], sizes[line, word]
            at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            found[np.repeat(line, size), order[at]] = True
        line, row = np.nonzero(found)
        found[line, row] = np.bitwise_count(self.codes[row] ^ codes[line]).sum(axis=1, dtype=np.uint16) <= radius
        return found

    def nearest(self, codes: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Marks of the rows within the radius, or within the smallest larger one that holds ``least`` rows."""
        found = self.within(codes, radius)
        few = np.flatnonzero(np.count_nonzero(found, axis=1) < least)
        if len(few):
            radii = [radius]
            while radii[-1] < self.most:
                radii.append(min(self.most, radii[-1] + max(8, radii[-1] // 8)))
            far = self.far(codes[few])
            last = np.partition(far, least - 1, axis=1)[:, least - 1] if least <= far.shape[1] else np.full(len(few), self.most)
            found[few] = far <= np.array(radii)[np.searchsorted(radii, last), None]
        return found


class Block:
    """Rows of a block, with their codes; single precision where no square could leave its range."""

    def __init__(self, model: Model, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.index = Index(model.codes(vectors))
        x = vectors - model.mean
        square = (x**2).sum(axis=1)
        self.largest = square.max()
        self.kind = np.float32 if self.largest < 1e30 else np.float64
        self.x = np.concatenate([x, -square[:, None] / 2], axis=1).astype(self.kind).T


class Queries:
    """Queries of a chunk, with the k nearest rows that any block had so far: their ids and distances."""

    def __init__(self, model: Model, k: int, ids: np.ndarray, vectors: np.ndarray):
        self.model, self.k, self.ids, self.vectors = model, k, ids, vectors
        self.codes = model.codes(vectors)
        self.x = np.concatenate([vectors - model.mean, np.ones((len(ids), 1))], axis=1)
        self.square = (self.x[:, :-1] ** 2).sum(axis=1)
        self.best = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        self.worst = np.full(len(ids), np.inf)

    def meet(self, block: Block) -> None:
        """Adds the k nearest of a block, of those that the index finds."""
        for begin in range(0, len(self.ids), TILE):
            part = slice(begin, begin + TILE)
            found = block.index.nearest(self.codes[part], self.model.radius, self.k + 1)
            # (|q|^2 - |q - x|^2) / 2 of all pairs, and how far rounding may have moved it.
            x = self.x[part] if block.kind is np.float64 else np.clip(self.x[part], -1e18, 1e18)
            product = x.astype(block.kind) @ block.x
            slack = (self.x.shape[1] + 32) * np.finfo(block.kind).eps * (block.largest + self.square[part]) + 1e-30
            if block.kind is np.float32:
                slack[self.square[part] >= 1e30] = np.inf
            least = (self.square[part] - self.worst[part] ** 2 * (1 + 1e-12)) / 2 - slack
            found &= ~(product < least[:, None])
            for i in np.flatnonzero(found.any(axis=1)):
                rows = np.flatnonzero(found[i])
                rows = rows[block.ids[rows] != self.ids[begin + i]]
                if len(rows) > 4 * self.k:
                    close = product[i, rows]
                    rows = rows[~(close < np.partition(close, -self.k)[-self.k] - 2 * slack[i])]
                if len(rows):
                    self.add(begin + i, block, rows)

    def add(self, i: int, block: Block, rows: np.ndarray) -> None:
        ids, far = block.ids[rows], np.sqrt(((block.vectors[rows] - self.vectors[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids, far))[: self.k]
        ids, far = (np.concatenate(x) for x in zip(self.best[i], (ids[order], far[order])))
        order = np.lexsort((ids, far))
        ids, far = ids[order], far[order]
        once = np.append(True, (ids[1:] != ids[:-1]) | (far[1:] != far[:-1]))
        ids, far = ids[once][: self.k], far[once][: self.k]
        self.best[i] = ids, far
        if len(far) == self.k:
            self.worst[i] = far[-1]

    def rows(self) -> pa.RecordBatch:
        ids, far = (np.concatenate(x) for x in zip(*self.best))
        queries = np.repeat(self.ids, [len(x) for x, _ in self.best])
        return pa.record_batch([pa.array(queries), pa.array(ids), pa.array(far)], names=["query_id", "vec_id", "score"])


def _packed(rows: DataFrame, parts: int, dim: int) -> DataFrame:
    """Rows ``part``, ``id``, ``v`` as one record for each part: its number, ids and vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        part = None

        def record() -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held))
            held.clear()
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([ids.tobytes()]), pa.array([vectors.tobytes()])], names=["part", "ids", "vectors"])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            vectors = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
            begins = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
            for begin, end in zip(begins, np.append(begins[1:], len(parts))):
                if held and parts[begin] != part:
                    yield record()
                part = int(parts[begin])
                held.append((ids[begin:end].copy(), vectors[begin:end].copy()))
        if held:
            yield record()

    dealt = rows.select("part", "id", "v").repartition(min(parts, FILES), "part").sortWithinPartitions("part")
    return materialise(dealt.mapInArrow(run, "part int, ids binary, vectors binary"))


def _clean(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.where(fine & F.col("id").isNotNull()).distinct()


def nearest(df: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance): for every row whose id is
    divisible by ``every``, its k nearest among all other rows.
    """
    rows = table = materialise(_clean(df, key, vector))
    sample = least(rows, F.xxhash64("id", "v"), SAMPLE).select("v").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        release(table)
        return df.sparkSession.createDataFrame([], schema)
    lengths = [len(r.v) for r in sample]
    dim = max(sorted(set(lengths)), key=lengths.count)
    model = learn(np.array([r.v for r in sample if len(r.v) == dim]), k)
    rows = rows.where(F.size("v") == dim)

    # Dealing by hash alone needs the row count only; blocks and chunks stay near their sizes.
    counts = rows.agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    blocks, chunks = max(1, math.ceil(counts.n / BLOCK)), max(1, math.ceil(counts.q / CHUNK))
    # An id with many vectors must not fill one block: the hash covers the vector as well.
    dealt = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int").alias("part")
    data = _packed(rows.select(dealt(blocks), "id", "v"), blocks, dim)
    asked = _packed(rows.where(F.col("id") % every == 0).select(dealt(chunks), "id", "v"), chunks, dim)
    release(table)

    # A task takes some blocks and some chunks, as written: no copies of queries or blocks are shuffled or
    # broadcast.  It gives k rows for each of its queries, however many blocks it had.
    met = data.hint("shuffle_replicate_nl").crossJoin(asked.toDF("chunk", "query_ids", "query_vectors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Queries] = {}
        part, block = None, None
        unpacked = lambda ids, vectors: (np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(vectors.as_buffer(), np.float64).reshape(-1, dim))
        with np.errstate(all="ignore"):
            for batch in batches:
                for r in range(batch.num_rows):
                    now, ids, vectors, chunk, query_ids, query_vectors = (batch.column(i)[r] for i in range(6))
                    if now.as_py() != part:
                        part, block = now.as_py(), Block(model, *(x.copy() for x in unpacked(ids, vectors)))
                    if chunk.as_py() not in held:
                        held[chunk.as_py()] = Queries(model, k, *(x.copy() for x in unpacked(query_ids, query_vectors)))
                    held[chunk.as_py()].meet(block)
        for queries in held.values():
            yield queries.rows()

    met = met.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = met.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
