"""Byte pair encoding of many words at once in numpy matrices.

Words are put into matrices by length, one word a row, one token a cell, short rows padded.  In each
round every row merges its leftmost pair of least rank: a hash table over pairs of ids gives the
ranks, the cells behind the pair move up, and rows without a pair to merge leave the matrix.  Only
the two pairs beside the new token are looked up again.

A few very long words would need as many rounds as they have bytes, each over the whole row; words
beyond ``WIDE`` bytes take their pairs from a heap instead, by the same rule.

Defined results: a null text is empty and gives no ids; a null key stays null; repeated rows are
encoded one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablecheck.llm.batches import map_slices, text_of
from tablecheck.llm.chunks import Memory, missing, spaced
from tablecheck.llm.process import kept

NONE = np.int32(2**31 - 1)
WIDE = 512
#: Cells of one matrix, so that memory is bounded.
CELLS = 1 << 20


class PairTable:
    """Open addressing hash table from a pair of ids to the id of the merged token."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.array([(a << 32) | b for a, b in pairs], np.uint64)
        values = np.array(list(pairs.values()), np.int32)
        self.bits = max(4, int(len(pairs) * 2.5).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1), np.uint64)
        self.values = np.full(size, NONE, np.int32)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == np.uint64(2**64 - 1)
            first = np.unique(np.where(free, at[left], size + np.arange(len(left))), return_index=True)[1]
            put = left[first[free[first]]]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids of the merged tokens; ``NONE`` where the pair does not merge or a cell is padding."""
        keys = (a.astype(np.int64).view(np.uint64) << np.uint64(32)) | b.astype(np.int64).view(np.uint64)
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return np.where((a < 0) | (b < 0), NONE, out)


class Encoder:
    """Encoding and decoding by the ranks of a vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.token = [b""] * (max(self.ranks.values()) + 1)
        pairs: dict[tuple[int, int], int] = {}
        for data, rank in self.ranks.items():
            self.token[rank] = data
            for cut in range(1, len(data)):
                a, b = self.ranks.get(data[:cut]), self.ranks.get(data[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs = PairTable(pairs)
        self.merges = pairs
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.words = Memory(lambda w: self.encode_words([w.encode()])[0])
        self.chunks = Memory(lambda c: b"".join(map(self.words.__getitem__, self.pattern.findall(c))))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        widths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(word) > WIDE:
                out[i] = self._long(word)
            elif word:
                widths.setdefault(-(-len(word) // 4) * 4, []).append(i)
        for width, rows in widths.items():
            step = max(1, CELLS // width)
            for start in range(0, len(rows), step):
                self._matrix(words, rows[start : start + step], width, out)
        return out

    def _matrix(self, words: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        row = np.array(rows)
        size = np.array([len(words[i]) for i in rows])
        data = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        column = np.arange(width)
        ids = np.where(column < size[:, None], self.byte[data], np.int32(-1))
        ids = np.concatenate([ids, np.full((len(ids), 1), -1, np.int32)], axis=1)
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width)
        while len(ids):
            at = rank.argmin(axis=1)
            lowest = rank[np.arange(len(ids)), at]
            done = lowest == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    out[row[r]] = ids[r, : size[r]].astype("<u4").tobytes()
                keep = ~done
                ids, rank, at, lowest, row, size = ids[keep], rank[keep], at[keep], lowest[keep], row[keep], size[keep]
                if not len(ids):
                    return
                most = int(size.max())
                ids, rank = ids[:, : most + 1], rank[:, :most]
            line = np.arange(len(ids))
            ids[line, at] = lowest
            stays = np.ones(ids.shape, bool)
            stays[line, at + 1] = False
            ids = ids[stays].reshape(len(ids), -1)
            rank = rank[stays[:, :-1]].reshape(len(ids), -1)
            size = size - 1
            rank[line, at] = self.pairs(ids[line, at], ids[line, at + 1])
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], ids[left, at[left]])

    def _long(self, word: bytes) -> bytes:
        """One long word by the same rule: a heap of pairs gives the least rank, leftmost first."""
        ids = self.byte[np.frombuffer(word, np.uint8)].tolist()
        merged = self.merges.get
        end = len(ids)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(end - 1) if (m := merged((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < end:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < end:
                    m = merged((ids[left], ids[after[left]]))
                    if m is not None:
                        heapq.heappush(heap, (m, left, ids[left], ids[after[left]]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts.  What the texts hold for the first time is encoded together."""
        cut = [spaced(t) for t in texts]
        pieces = [None if c is not None else self.pattern.findall(t) for c, t in zip(cut, texts)]
        new = {c: self.pattern.findall(c) for c in missing(self.chunks, (x for c in cut if c is not None for x in c))}
        words = missing(self.words, (w for found in [*new.values(), *(p for p in pieces if p is not None)] for w in found))
        ids = dict(zip(words, self.encode_words([w.encode() for w in words])))
        for word, found in ids.items():
            self.words.keep(word, found)
        word, chunk = self.words.__getitem__, self.chunks.__getitem__
        for c, found in new.items():
            self.chunks.keep(c, b"".join(map(word, found)))
        return [b"".join(map(chunk, c)) if c is not None else b"".join(map(word, p)) for c, p in zip(cut, pieces)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encoder(path: str, pattern: str) -> Encoder:
    return kept(("byte pairs", path, pattern), lambda: Encoder(path, pattern))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids`` (array of int) of every row, whole texts."""

    def make():
        encoder = _encoder(path, pattern)

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.frombuffer(x, "<i4") for x in encoder.encode_all(piece.column(1).to_pylist())]
            return pa.record_batch([piece.column(0), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

        return step

    return map_slices(text_of(df, key, text), make, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key and ``data`` (bytes) of every row of ids; null ids decode to nothing."""

    def make():
        encoder = _encoder(path, pattern)

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            data = [encoder.decode(np.array(x or [], "<u4").tobytes()) for x in piece.column(1).to_pylist()]
            return pa.record_batch([piece.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

        return step

    return map_slices(df.selectExpr(f"`{key}` as doc_id", f"`{ids}` as ids"), make, "doc_id long, data binary")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_tokens`` and the SHA-256 of the ids and of the bytes they decode to."""

    def make():
        encoder = _encoder(path, pattern)

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            found = encoder.encode_all(piece.column(1).to_pylist())
            return pa.record_batch(
                [
                    piece.column(0),
                    pa.array([len(x) // 4 for x in found], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()),
                    pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in found], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    return map_slices(text_of(df, key, text), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
