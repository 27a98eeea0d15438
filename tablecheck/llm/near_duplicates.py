"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles.  Its sketch has ``REGISTERS`` registers; each holds the
least exponential variate over the elements of the set, truncated to a power of a base close to one.
The sketch of a union is the larger of the registers, so sketches merge; equal registers are as
frequent as the sets are similar, so runs of registers (bands) serve as keys of locality-sensitive
hashing.

1. Documents with the same set are one class, represented by its smallest id.
2. Representatives that share a band meet at the smallest of them.  From both sketches and the sizes
   of the sets the similarity that explains the registers best is estimated jointly; pairs far below
   the threshold go.  Each document first checks its best partner on the full sets, which settles
   groups of thousands of copies with one check for each.
3. Bands whose members are still in more than one component are compared in blocks of bounded
   size, each pair of different components once, so no link between different texts is lost; the
   remaining candidates are all checked on the full sets.
4. Components of the confirmed links give every document the smallest id it reaches.

With 32 bands of 4 registers two documents of similarity 0.8 share no band once in 20 million pairs;
the estimate drops a pair of that similarity once in 300,000.  Elements are 64-bit hashes of
the shingles.

Defined results: a document without text or words has an empty set and is linked with nothing; one
with fewer words than a shingle has its whole sequence as its only element; rows that repeat an id
are compared text by text, equal rows are one document; a row without an id is linked with nothing and kept; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices, text_of
from tablecheck.llm.chunks import Memory
from tablecheck.llm.components import components
from tablecheck.llm.process import kept
from tablecheck.llm.scratch import materialise, release

REGISTERS = 128
BAND = 4
#: Parameters of the sketch: base of the registers' spacing, rate of the exponential variates.
BASE = 1.001
RATE = 20.0
#: Members of a band that one block holds at most; larger bands are compared block by block.
BLOCK = 512
#: Words whose hashes a process remembers at most.  Bounds memory, drops nothing.
WORDS = 200_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _streams(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the registers' hash functions."""
    numbers = _mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * _GOLDEN)
    return numbers[:n] | np.uint64(1), numbers[n:]


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case."""
    return text.encode().lower().split()


def shingle_set(words: list[bytes], size: int, hashes: dict) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        total = _mixed(total * _GOLDEN + w[i : len(w) - k + 1 + i])
    return np.unique(total)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set; all zero for the empty set."""
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    factor, offset = _streams(REGISTERS)
    low = np.full(REGISTERS, np.uint64(2**64 - 1), np.uint64)
    for start in range(0, len(elements), 1024):
        low = np.minimum(low, (elements[start : start + 1024, None] * factor + offset).min(axis=0))
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(least, 1e-300)) / np.log(BASE)), 0, 65535).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of each row of sketches to the other by joint likelihood, given the sizes."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101) * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * grid), p(v - u * grid)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    likelihood = more * log(up) + less * log(down) + same * log(1 - up - down)
    return grid[np.arange(len(grid)), likelihood.argmax(axis=1)]


def _hashes() -> Memory:
    return kept("word hashes", lambda: Memory(xxhash.xxh3_64_intdigest, WORDS))


def sketches(df: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``finger`` (digest of the set) and ``sketch`` of every row."""

    def make():
        hashes = _hashes()

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(words_of(t), shingle, hashes) for t in piece.column(1).to_pylist()]
            return pa.record_batch(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "finger", "sketch"],
            )

        return step

    return map_slices(text_of(df, key, text), make, "doc_id long, n_shingles long, finger binary, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    """``band``, ``key`` and ``id`` for every band of every class."""
    n = REGISTERS // BAND

    def make():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(piece.column(1).to_pylist()), np.uint64).reshape(piece.num_rows, n)
            keys = _mixed(rows ^ _mixed(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN))
            return pa.record_batch(
                [
                    pa.array(np.tile(np.arange(n, dtype=np.int32), piece.num_rows)),
                    pa.array(keys.ravel().view(np.int64)),
                    pa.array(np.repeat(piece.column(0).to_numpy(zero_copy_only=False), n)),
                ],
                names=["band", "key", "id"],
            )

        return step

    return map_slices(classes.select("id", "sketch"), make, "band int, key long, id long", 4096)


def _estimated(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """Pairs ``a``, ``b`` with ``similarity``, those below ``floor`` left out."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def make():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            a, b = (np.frombuffer(b"".join(piece.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
            n_a, n_b = (piece.column(i).to_numpy().astype(np.float64) for i in (2, 3))
            found = estimate(a, b, n_a, n_b)
            keep = pa.array(found >= floor)
            return pa.record_batch([piece.column(0), piece.column(1), pa.array(found)], names=["a", "b", "similarity"]).filter(keep)

        return step

    return map_slices(rows, make, "a long, b long, similarity double", 2048)


def _sets(ids: DataFrame, df: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """``id`` and ``elements`` of the documents in ``ids``; only their texts move."""
    wanted = text_of(df, key, text).join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")

    def make():
        hashes = _hashes()

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(words_of(t), shingle, hashes).tobytes() for t in piece.column(1).to_pylist()]
            return pa.record_batch([piece.column(0), pa.array(sets, pa.binary())], names=["id", "elements"])

        return step

    return map_slices(wanted, make, "id long, elements binary")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, df: DataFrame, shingle: int, percent: int, key: str, text: str) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = materialise(_sets(ids, df, shingle, key, text))
    side = lambda x: sets.select(F.col("id").alias(x), F.col("elements").alias(f"set_{x}"))
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")

    def make():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            pairs_of_sets = zip(piece.column(2).to_pylist(), piece.column(3).to_pylist())
            keep = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in pairs_of_sets]
            return pa.record_batch([piece.column(0), piece.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return step

    found = materialise(map_slices(rows, make, "a long, b long", 256))
    release(sets)
    return found


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, whose columns ``key``, ``i``, ``j`` come first and in order."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (0, 1, 2)], axis=1)
        cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if end == start:
                continue
            now = tuple(keys[start])
            if waiting and now != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(start, end - start))
            last = now
    if waiting:
        yield pa.Table.from_batches(waiting)


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _candidates(members: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """Candidates between different components within the bands of ``members``, in bounded blocks.

    ``members`` has ``band``, ``key``, ``id`` and ``label``.  A pair is taken in the first band that
    it shares.  A band of many members is cut into blocks; every two blocks meet in one group.  The
    result has one row for each member of a group with candidates, and the list of its partners.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    sizes = sizes.where("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(sizes, "key").join(classes.select("id", "n_shingles", "sketch"), "id")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "band", "id", "label", "n_shingles", "sketch", "own",
    )

    def pairs_of(group: pa.Table) -> dict[int, list[int]]:
        ids, label, n, own = (group.column(c).to_numpy() for c in ("id", "label", "n_shingles", "own"))
        registers = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        bands = registers.copy().view(np.uint64)
        band, i, j = (group.column(c)[0].as_py() for c in ("band", "i", "j"))
        found: dict[int, list[int]] = {}
        for at in range(len(ids) - 1):
            rest = np.arange(at + 1, len(ids))
            rest = rest[(label[rest] != label[at]) & (ids[rest] != ids[at])]
            if i != j:
                rest = rest[own[rest] != own[at]]
            rest = rest[np.minimum(n[rest], n[at]) >= floor * np.maximum(n[rest], n[at])]
            if len(rest):
                rest = rest[(bands[rest] == bands[at]).argmax(axis=1) == band]
            if len(rest):
                own_registers = np.broadcast_to(registers[at], (len(rest), REGISTERS))
                near = estimate(registers[rest], own_registers, n[rest].astype(float), np.full(len(rest), float(n[at])))
                partners = ids[rest[near >= floor]].tolist()
                if partners:
                    found.setdefault(int(ids[at]), []).extend(partners)
                    for k in partners:
                        found.setdefault(k, [])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_group(batches):
            found = pairs_of(group)
            if found:
                key, i, j = (group.column(c)[0].as_py() for c in ("key", "i", "j"))
                n = len(found)
                yield pa.record_batch(
                    [
                        pa.array([key] * n, pa.int64()), pa.array([i] * n, pa.int32()), pa.array([j] * n, pa.int32()),
                        pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64())),
                    ],
                    names=["key", "i", "j", "id", "partners"],
                )

    return _grouped(rows).mapInArrow(run, "key long, i int, j int, id long, partners array<long>")


def _remaining(members: DataFrame, classes: DataFrame, floor: float, df: DataFrame, shingle: int, percent: int, key: str, text: str) -> DataFrame:
    """Links between different components, confirmed on full sets.

    The set of a document comes into a group once, however many partners it has there; pairs that
    links of the same group have joined meanwhile need no check.
    """
    rows = materialise(_candidates(members, classes, floor))
    sets = materialise(_sets(rows.select("id").distinct(), df, shingle, key, text))
    rows = rows.join(sets, "id").select("key", "i", "j", "id", "partners", "elements")

    def links_of(group: pa.Table) -> tuple[list[int], list[int]]:
        sets_of: dict[int, list[np.ndarray]] = {}
        for name, elements in zip(group.column("id").to_pylist(), group.column("elements").to_pylist()):
            sets_of.setdefault(name, []).append(np.frombuffer(elements, np.uint64))
        head = {name: name for name in sets_of}

        def top(x: int) -> int:
            while head[x] != x:
                head[x] = head[head[x]]
                x = head[x]
            return x

        a, b = [], []
        for name, partners in zip(group.column("id").to_pylist(), group.column("partners").to_pylist()):
            for other in partners:
                if top(name) != top(other) and any(_linked(x, y, percent) for x in sets_of[name] for y in sets_of[other]):
                    head[top(name)] = top(other)
                    a.append(name)
                    b.append(other)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_group(batches):
            a, b = links_of(group)
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    found = materialise(_grouped(rows).mapInArrow(run, "a long, b long"))
    release(rows)
    release(sets)
    return found


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    floor = percent / 100 - 4.5 * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    documents = materialise(sketches(df, shingle, key, text))
    known = documents.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("finger").agg(F.min("doc_id").alias("id"))
    classes = materialise(classes)
    heads = known.join(classes.withColumnRenamed("id", "doc_id"), ["finger", "doc_id"], "left_semi")
    heads = materialise(heads.select(F.col("doc_id").alias("id"), "n_shingles", "sketch").dropDuplicates(["id", "sketch"]))

    bands = materialise(_bands(heads))
    shared = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("center")).where("n > 1").drop("n")
    members = materialise(bands.join(shared, "key"))
    release(bands)

    star = members.where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    best = _estimated(star, heads, floor).groupBy("a").agg(F.max(F.struct("similarity", (-F.col("b")).alias("minus"))).alias("best"))
    best = materialise(best.select("a", (-F.col("best.minus")).alias("b")))
    links = _confirmed(best, df, shingle, percent, key, text)
    labels = components(links)
    labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "key", "id", F.coalesce("label", "id").alias("label")
    )
    more = _remaining(labelled, heads, floor, df, shingle, percent, key, text)
    labels = components(links.union(more))

    to = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").select("finger", F.coalesce("label", "id").alias("found"))
    out = documents.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("finger")).alias("finger")).join(to, "finger", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
