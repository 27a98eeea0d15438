"""Packing of documents into windows with controlled proportions of their sources.

Each source is a queue of documents.  Weighted round-robin serves the tokens of the queues: in every
round each source sends its quantum of tokens, in proportion to its weight, from as many documents as
that takes; long documents go on in the next round.  Quanta of a round sum to one window.  What
rounding leaves over is carried: up to the end of any round a source has sent its exact share to
within half a token.  Where a queue ends, its share goes to the queues that still have tokens.  So
every window has the target proportions to within some tokens a source, whatever the documents'
lengths.  Only the last window is padded.

The schedule has a closed form in the tokens of each queue: tokens sent by all sources before a round
are sums over the sources, and the round of a token follows from its place in its queue.  So each
task places its own documents, no queue and no round comes together anywhere, and ids are read once.
Driver and tasks hold one number for each source.  The place of a document in its queue are tokens of
its queue in earlier parts (one row for each source and part) and in its own part before it.

Defined results: a null text is empty and has the end token only; documents without a source form
one queue; repeated rows are packed one by one; an empty table has no pieces; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Callable, Iterator, Mapping
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices, slices
from tablecheck.llm.byte_bpe import PairTable
from tablecheck.llm.chunks import Memory, missing
from tablecheck.llm.process import kept
from tablecheck.llm.scratch import materialise
from tablecheck.llm.token_counts import byte_of

#: Characters that Python's split takes as white space and the vocabulary's pattern not.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


#: Fixed value: the vocabulary's mark of a piece's last byte.
_LAST = "</w>"

#: UTF-8 bytes of texts that are cut and merged at once; longer texts are encoded word by word.
CHUNK = 1 << 20
#: Bytes of a piece, and pieces, that the table of pieces holds at most.  Bounds memory, drops nothing.
WIDTH, PIECES = 16, 1 << 19

_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
#: More than any rank, with room for a place in a piece beside it.
_NO_RANK = np.int32(1 << 24)


def _kinds() -> np.ndarray:
    """What the vocabulary's pattern takes a byte for; odd ones leave their word to the library."""
    kind = np.full(256, _ODD, np.uint8)
    kind[33:127] = _SIGN
    for chars, x in ((string.ascii_letters, _LETTER), (string.digits, _DIGIT), ("\t\n\v\f\r ", _SPACE), ("'", _ODD)):
        kind[[ord(c) for c in chars]] = x
    return kind


_KIND = _kinds()
_LOWER = np.array([ord(chr(i).lower()) if i < 128 else i for i in range(256)], np.uint8)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class PieceTable:
    """Ids of pieces of at most ``WIDTH`` bytes, none of them zero, by open addressing.

    A piece is two numbers, its first eight bytes and the rest.  When the table is full it starts
    anew.
    """

    def __init__(self, merge: Callable[[np.ndarray], np.ndarray], kind: str):
        self.merge, self.kind, self.bits = merge, kind, PIECES.bit_length()
        self._clear()

    def _clear(self) -> None:
        size = 1 << self.bits
        self.low, self.high, self.entry = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, self.kind)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = (low ^ (high * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries of pieces, -1 for those that have none."""
        at = self._slot(low, high)
        out = self.entry[at]
        left = np.flatnonzero((out >= 0) & ((self.low[at] != low) | (self.high[at] != high)))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.entry) - 1)
            here = at[left]
            out[left] = self.entry[here]
            left = left[(out[left] >= 0) & ((self.low[here] != low[left]) | (self.high[here] != high[left]))]
        return out

    def _add(self, low: np.ndarray, high: np.ndarray) -> None:
        """Merge and keep pieces that have no entry; all of them differ."""
        ids = self.merge(np.stack([low, high], axis=1).astype("<u8").view(np.uint8))
        some = ids >= 0
        entry = np.arange(len(low)) + len(self.begin) - 1
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(some.sum(axis=1))])
        self.ids = np.concatenate([self.ids, ids[some].astype(self.kind)])
        at, left = self._slot(low, high), np.arange(len(low))
        while len(left):
            free = left[self.entry[at[left]] < 0]
            put = free[np.unique(at[free], return_index=True)[1]]
            self.low[at[put]], self.high[at[put]], self.entry[at[put]] = low[put], high[put], entry[put]
            left = left[self.entry[at[left]] != entry[left]]
            at[left] = (at[left] + 1) & (len(self.entry) - 1)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin in ``ids``, and their number."""
        found = self._find(low, high)
        for clear in (False, True):
            new = np.flatnonzero(found < 0)
            if not len(new):
                break
            new = new[np.lexsort((high[new], low[new]))]
            a, b = low[new], high[new]
            new = new[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])]
            if clear or len(self.begin) - 1 + len(new) <= PIECES:
                self._add(low[new], high[new])
                found = self._find(low, high)
                break
            self._clear()
            found[:] = -1
        return self.begin[found], self.begin[found + 1] - self.begin[found]


class WordEncoder:
    """Ids of texts under a vocabulary that drops white space, so that words are encoded apart.

    Words of letters up to U+00FF, digits and signs are cut further, where the vocabulary's pattern
    cuts them, and their new pieces merged in a matrix, many at once.  Other words, which normal forms
    or the pattern's suffixes may concern, go to the library, a special token between each two.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.mark, token = next((i, x) for i, x in self.tokenizer.get_added_tokens_decoder().items() if x.special)
        self.between = token.content
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        shown = {b: c for c, b in byte_of().items()}
        self.inner, self.last = (np.array([vocab[shown[b] + end] for b in range(256)], np.int32) for end in ("", _LAST))
        self.rank = PairTable({(vocab[x], vocab[y]): k for k, (x, y) in enumerate(merges)})
        self.merged = np.array([vocab[x + y] for x, y in merges], np.int32)
        self.pieces = PieceTable(self._merge, self.type)
        self.words = Memory(lambda w: self._encode([w])[0], 100_000)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type).tobytes() for x in found]

    def _apart(self, words: list[str]) -> list[bytes]:
        """Ids of each word; none holds the text of a special token."""
        out: list[bytes] = []
        for start in range(0, len(words), 512):
            joined = self.tokenizer.encode_batch_fast([self.between.join(words[start : start + 512])], add_special_tokens=False)
            ids = np.array(joined[0].ids, self.type)
            data, width = ids.tobytes(), ids.itemsize
            marks = (np.flatnonzero(ids == self.mark) * width).tolist()
            out.extend(data[x:y] for x, y in zip([0, *(m + width for m in marks)], [*marks, len(data)]))
        return out

    def _by_word(self, words: list[str]) -> list[bytes]:
        """Ids of each word by the library; very long ones are not remembered."""
        new = [w for w in missing(self.words, words) if len(w) <= 64]
        self.words.keep_all(dict(zip(new, self._apart(new))))
        return list(map(self.words.__getitem__, words))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(self.rank(a.ravel(), b.ravel()), _NO_RANK).reshape(a.shape)

    def _merge(self, data: np.ndarray) -> np.ndarray:
        """Ids of the pieces in the rows, -1 behind them; zero bytes fill up the rows.

        Pieces are the columns of a matrix here.  Each round merges in every column the pair of least
        rank, the leftmost of equals.
        """
        size = (data != 0).sum(axis=1)
        ids = np.where(data != 0, self.inner[data], np.int32(-1))
        row = np.arange(len(data))
        ids[row, size - 1] = self.last[data[row, size - 1]]
        out = np.full(ids.shape, -1, np.int32)
        ids = np.ascontiguousarray(ids.T)
        rank = self._ranks(ids[:-1], ids[1:])
        while len(row):
            places = np.arange(len(rank), dtype=np.int32)[:, None]
            least = ((rank << 4) | places).min(axis=0, initial=_NO_RANK << 4)
            open_ = least < _NO_RANK << 4
            if not open_.all():
                out[row[~open_], : len(ids)] = ids[:, ~open_].T
                most = max(1, int((ids[:, open_] >= 0).sum(axis=0).max(initial=1)))
                ids, rank, row, least = ids[:most, open_], rank[: most - 1, open_], row[open_], least[open_]
                places = places[: most - 1]
                if not len(row):
                    break
            at, column = least & 15, np.arange(len(row))
            ids = np.where(places > at, ids[1:], ids[:-1])
            ids[at, column] = self.merged[least >> 4]
            rank = np.where(places[:-1] >= at, rank[1:], rank[:-1])
            right, left = np.flatnonzero(at < len(rank)), np.flatnonzero(at)
            rank[at[right], right] = self._ranks(ids[at[right], right], ids[at[right] + 1, right])
            rank[at[left] - 1, left] = self._ranks(ids[at[left] - 1, left], ids[at[left], left])
        return out

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts, all cut at once."""
        raw = b" ".join([*texts, b""])
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = np.frombuffer(raw, np.uint8)
        kind, low = _KIND[data], np.zeros(len(data) + WIDTH, np.uint8)
        low[: len(data)] = _LOWER[data]
        # U+00C0 to U+00FF are letters but for two signs; the capitals lie 32 below.
        lead = np.flatnonzero(data == 0xC3)
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead[data[lead + 1] <= 0x9E] + 1] += 32

        cut = kind == _DIGIT
        cut[0] = True
        cut[1:] |= kind[1:] != kind[:-1]
        begins = np.flatnonzero(cut)
        sizes, some = np.diff(np.append(begins, len(data))), kind[begins] != _SPACE
        begins, sizes = begins[some], sizes[some]
        odd = np.concatenate([np.flatnonzero(kind == _ODD), begins[sizes > WIDTH]])
        if len(odd):
            blank = np.concatenate([[True], kind == _SPACE])
            first, end = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
            word = np.unique(np.searchsorted(first, odd, "right") - 1)
            first, end = first[word], end[word]
            inside = np.zeros(len(data) + 1, np.int8)
            inside[first], inside[end] = 1, -1
            plain = np.cumsum(inside, dtype=np.int8)[begins] == 0
            begins, sizes = begins[plain], sizes[plain]

        eight = np.ndarray(len(low) - 7, "<u8", low.data, strides=(1,))
        at, count = self.pieces(eight[begins] & _FIRST[np.minimum(sizes, 8)], eight[begins + 8] & _FIRST[np.maximum(sizes - 8, 0)])
        ids = self.pieces.ids
        if len(odd):
            words = [raw[x:y].decode().split() for x, y in zip(first.tolist(), end.tolist())]
            found = iter(self._by_word(list(chain.from_iterable(words))))
            each = [b"".join(islice(found, len(w))) for w in words]
            more = np.array([len(x) for x in each]) // ids.itemsize
            order = np.argsort(begins := np.concatenate([begins, first]), kind="stable")
            at = np.concatenate([at, len(ids) + np.cumsum(more) - more])[order]
            begins, count = begins[order], np.concatenate([count, more])[order]
            ids = np.concatenate([ids, np.frombuffer(b"".join(each), self.type)])
        before = np.concatenate([[0], np.cumsum(count)])
        taken = ids[np.repeat(at - before[:-1], count) + np.arange(before[-1])].tobytes()
        cuts = [0, *(before[np.searchsorted(begins, ends)] * ids.itemsize).tolist()]
        return [taken[x:y] for x, y in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out, waiting, held = [b""] * len(texts), [], 0

        def work() -> None:
            for (i, _), ids in zip(waiting, self._together([t for _, t in waiting])):
                out[i] = ids
            waiting.clear()

        for i, text in enumerate(texts):
            if "<|" in text or any(c in text for c in _SEPARATORS):
                out[i] = self._encode([text])[0]
            elif len(data := text.encode()) > CHUNK:
                out[i] = b"".join(self._by_word(text.split()))
            else:
                if waiting and held + len(data) + 1 > CHUNK:
                    work()
                    held = 0
                waiting.append((i, data))
                held += len(data) + 1
        if waiting:
            work()
        return out


def _encoded(df: DataFrame, path: str, end_id: int, key: str, text: str, source: str) -> DataFrame:
    """Ids of every document, with the tokens of its source in the rows that its task read before it."""
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("words", path), lambda: WordEncoder(path))
        end = np.array([end_id], encoder.type).tobytes()
        part, sent = TaskContext.get().partitionId(), {}
        for piece in slices(batches):
            ids = [x + end for x in encoder.encode_all(piece.column(2).to_pylist())]
            counts = [len(x) // len(end) for x in ids]
            before = []
            for queue, n in zip(piece.column(1).to_pylist(), counts):
                before.append(sent.get(queue, 0))
                sent[queue] = before[-1] + n
            n = piece.num_rows
            yield pa.record_batch(
                [
                    pa.array([part] * n, pa.int32()),
                    piece.column(0),
                    piece.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array([len(end)] * n, pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "doc_id", "source", "n", "before", "width", "ids"],
            )

    return rows.mapInArrow(
        run, "part int, doc_id long, source string, n long, before long, width int, ids binary"
    )


class Schedule:
    """Which tokens of which queue lie where, for queues of ``tokens`` served by ``weights``.

    Up to time v a queue has sent min(tokens, weight * v) tokens, rounded.  Round k ends at the time
    by which all queues together have sent k windows.
    """

    def __init__(self, tokens: np.ndarray, weights: np.ndarray, window: int):
        self.tokens, self.window = tokens.astype(np.int64), window
        self.weights = weights * (window / weights.sum())
        ends = self.tokens / self.weights
        self.times = np.concatenate([[0.0], np.sort(ends)])
        order = np.argsort(ends)
        # Rates and exhausted queues at each end; between two of them all is linear.
        rate = np.concatenate([np.cumsum(self.weights[order][::-1])[::-1], [0.0]])
        done = np.concatenate([[0.0], np.cumsum(self.tokens[order])])
        self.sent = done + rate * self.times
        self.sent[-1] = float(self.tokens.sum())
        self.rounds = -(-int(self.tokens.sum()) // window)

    def _by(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that a queue has sent before a round."""
        time = np.interp(rounds * float(self.window), self.sent, self.times)
        sent = np.minimum(self.tokens[queue], np.floor(self.weights[queue] * time + 0.5).astype(np.int64))
        return np.where(rounds >= self.rounds, self.tokens[queue], sent)

    def _round(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        time = (token + 0.5) / self.weights[queue]
        out = np.ceil(np.interp(time, self.times, self.sent) / self.window).astype(np.int64) - 1
        out = np.clip(out, 0, max(0, self.rounds - 1))
        while (late := self._by(queue, out) > token).any():
            out = out - late
        while (early := self._by(queue, out + 1) <= token).any():
            out = out + early
        return out

    def _first(self, queue: np.ndarray, rounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the stream of what a queue sends in a round, and the tokens it sent before."""
        different, which = np.unique(rounds, return_inverse=True)
        every = np.arange(len(self.tokens))
        first, before = np.empty(len(rounds), np.int64), np.empty(len(rounds), np.int64)
        rows = max(1, (1 << 20) // max(1, len(every)))
        order = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[order], np.arange(0, len(different) + rows, rows))
        for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
            now = different[k * rows : (k + 1) * rows, None]
            sent, after = self._by(every, now), self._by(every, now + 1)
            start = sent.sum(axis=1, keepdims=True) + np.cumsum(after - sent, axis=1) - (after - sent)
            at = which[order[x:y]] - k * rows, queue[order[x:y]]
            first[order[x:y]], before[order[x:y]] = start[at], sent[at]
        return first, before

    def pieces(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, first token, length and place in the stream of every piece, none over a window's end.

        Documents are given by their queue, their place there and their tokens, one at least.
        """
        first, last = self._round(queue, start), self._round(queue, start + n - 1)
        # A queue may send nothing in most rounds: then token by token.
        by_token = last - first + 1 > n
        count = np.where(by_token, n, last - first + 1)
        doc = np.repeat(np.arange(len(n)), count)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        own, begin = queue[doc], start[doc]
        rounds = first[doc] + step
        single = by_token[doc]
        rounds[single] = self._round(own[single], begin[single] + step[single])
        low = np.where(single, begin + step, np.maximum(begin, self._by(own, rounds)))
        high = np.where(single, low + 1, np.minimum(begin + n[doc], self._by(own, rounds + 1)))
        some = high > low
        doc, own, begin, rounds, low, high = (x[some] for x in (doc, own, begin, rounds, low, high))
        place, before = self._first(own, rounds)
        place = place + low - before
        # What follows on without a gap is one piece.
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + (high - low)[:-1])
        at = np.flatnonzero(new)
        doc, low, place, length = doc[at], (low - begin)[at], place[at], np.add.reduceat(high - low, at)
        over = (place + length - 1) // self.window - place // self.window + 1
        piece = np.repeat(np.arange(len(doc)), over)
        step = np.arange(len(piece)) - np.repeat(np.cumsum(over) - over, over)
        ends = (place + length)[piece]
        begin = np.where(step == 0, place[piece], (place[piece] // self.window + step) * self.window)
        ends = np.minimum(ends, (begin // self.window + 1) * self.window)
        return doc[piece], low[piece] + begin - place[piece], ends - begin, begin


def schedule(parts: DataFrame, window: int, mixture: Mapping[str, float] | None = None) -> tuple[dict[str, int], Schedule | None]:
    """The number of each source, in order of their names, and the schedule of their queues.

    ``parts`` has ``source`` and ``tokens``.  ``mixture`` gives the weight of each source; without
    it, the weights are the sources' shares of all tokens, so that all queues end together.
    """
    totals = sorted(map(tuple, parts.groupBy("source").agg(F.sum("tokens")).collect()))
    if not totals:
        return {}, None
    tokens = np.array([n for _, n in totals], np.int64)
    weights = tokens.astype(float)
    if mixture:
        least = min(x for x in mixture.values() if x > 0) / 1000
        weights = np.array([float(mixture.get(name) or least) for name, _ in totals])
    return {name: i for i, (name, _) in enumerate(totals)}, Schedule(tokens, weights, window)


def pack(
    df: DataFrame,
    path: str,
    window: int = 2048,
    end_id: int = 1,
    mixture: Mapping[str, float] | None = None,
    with_ids: bool = True,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in which sequence.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and, unless switched off, ``ids``.  Every id of every document lies in one piece.
    """
    documents = materialise(_encoded(df, path, end_id, key, text, source), "zstd")
    parts = materialise(documents.groupBy("source", "part").agg(F.sum("n").alias("tokens")))
    number, queues = schedule(parts, window, mixture)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset"))
    rows = documents.join(materialise(offsets), ["source", "part"])
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def make():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            queue = np.array([number[x] for x in piece.column(1).to_pylist()], np.int64)
            start, n = (piece.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            doc, begin, length, place = queues.pieces(queue, start, n)
            data = piece.column(5).to_pylist()
            ids = [np.frombuffer(x, f"<u{width}").astype("<u4") for x, width in zip(data, piece.column(4).to_pylist())]
            cuts = [ids[d][x : x + k] for d, x, k in zip(doc.tolist(), begin.tolist(), length.tolist())]
            columns = [
                piece.column(0).take(pa.array(doc)), pa.array(begin), pa.array(length),
                pa.array([zlib.crc32(cut) for cut in cuts], pa.int64()),
                pa.array(n[doc]), pa.array(place // window), pa.array(place % window),
            ]
            if with_ids:
                values = [cut.astype(np.int32) for cut in cuts]
                return pa.record_batch([*columns, pa.array(values, pa.list_(pa.int32()))], names=[*names, "ids"])
            return pa.record_batch(columns, names=names)

        return step

    rows = rows.select("doc_id", "source", (F.col("offset") + F.col("before")).alias("first"), "n", "width", "ids")
    return map_slices(rows, make, schema + (", ids array<int>" if with_ids else ""))
