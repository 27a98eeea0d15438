"""Exact token counts by dynamic programming over prefixes.

For byte pair encoding the last token of a prefix determines the rest: without it, the remaining
tokens are the encoding of the shorter prefix.  A sequence is the encoding of its bytes exactly if
every two neighbours, put together, are encoded as these two.  So for each end position there is
one token that ends there and agrees with the last token of the prefix before it, and the count at
that position is the count before plus one.  One pass gives the count of *every* prefix, and with it
all answers about truncation and budgets, without encoding anything again.

A text is cut into words by the vocabulary's pattern first; words repeat, so a task keeps what it
has worked out, within a fixed bound.

Defined results: a null text is empty and has 0 bytes and 0 tokens; a null key stays null; repeated
rows are counted one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablecheck.llm.batches import map_slices, text_of
from tablecheck.llm.chunks import Memory, spaced
from tablecheck.llm.process import kept

#: How a byte is written in the vocabulary file.  Printable ones are themselves, the
#: others follow from code point 256 in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_of() -> dict[str, int]:
    rest = [b for b in range(256) if b not in _PRINTABLE]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and special tokens of a byte-level vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte = byte_of()
        plain = lambda t: bytes(byte[c] for c in t)
        self.pattern = regex.compile(pattern)
        specials = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.tokens = {plain(t) for t in content["model"]["vocab"]} - {s.encode() for s in specials}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((plain(a), plain(b)), rank)
        self.tails = {t[i:] for t in self.tokens for i in range(1, len(t))}
        self.agreed: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The merges applied to a few bytes; only pairs of tokens are ever put in here."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, before: bytes, token: bytes) -> bool:
        """Whether ``token`` may follow ``before``; nothing before the first one."""
        known = self.agreed.get((before, token))
        if known is None:
            if len(self.agreed) > 1_000_000:
                self.agreed.clear()
            known = self.merged(before + token) == ([before, token] if before else [token])
            self.agreed[before, token] = known
        return known

    def prefix_counts(self, word: bytes) -> list[int]:
        """Tokens of ``word[:i]`` for every i from 0 to its length, as one word of the pattern."""
        counts, last = [0], [b""]
        tokens, tails, agreed = self.tokens, self.tails, self.agreed
        for end in range(1, len(word) + 1):
            start = end - 1
            while start >= 0:
                token = word[start:end]
                if token in tokens:
                    fits = agreed.get((last[start], token))
                    if fits is None:
                        fits = self.agree(last[start], token)
                    if fits:
                        counts.append(counts[start] + 1)
                        last.append(token)
                        break
                elif token not in tails:
                    start = -1
                    break
                start -= 1
            if start < 0:
                raise ValueError(f"byte {word[end - 1]} is not in the vocabulary")
        return counts


class Counter:
    """Counts of whole texts and of all their prefixes."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path, pattern)
        self.words = Memory(lambda w: self.vocabulary.prefix_counts(w.encode())[-1], 800_000)
        self.chunks = Memory(self._pieces)

    def _pieces(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.vocabulary.pattern.findall(text)))

    def _chunk(self, text: str) -> int:
        chunks = spaced(text)
        return self._pieces(text) if chunks is None else sum(map(self.chunks.__getitem__, chunks))

    def count(self, text: str) -> int:
        specials = self.vocabulary.specials
        if specials and "<|" in text:
            found = len(specials.findall(text))
            return found + sum(map(self._chunk, specials.split(text)))
        return self._chunk(text)

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of the encoding of ``text[:i]`` for every code point i from 0 to its length.

        Inside a word the table of the word answers.  Where a prefix ends in a run of white space or
        in an apostrophe's suffix, the pattern cuts the prefix elsewhere than the text, and the few
        code points since the last sure cut are counted as the pattern cuts them.
        """
        out = np.zeros(len(text) + 1, np.int64)
        specials, at, done = self.vocabulary.specials, 0, 0
        marks = [m.span() for m in specials.finditer(text)] if specials else []
        for start, end in [*marks, (len(text), len(text))]:
            done = self._plain_prefixes(text, at, start, done, out)
            if end > start:
                for i in range(start + 1, end):
                    out[i] = out[at] + self._pieces(text[at:i]) if i - at < 64 else done + self._pieces(text[start:i])
                done += 1
                out[end] = done
            at = end
        return out

    def _plain_prefixes(self, text: str, at: int, stop: int, done: int, out: np.ndarray) -> int:
        spans = [m.span() for m in self.vocabulary.pattern.finditer(text, at, stop)]
        out[at] = done
        previous = at
        for start, end in spans:
            word = text[start:end]
            blank, quoted = word[-1].isspace(), word[0] == "'" and len(word) > 1
            if blank or quoted or word[0].isspace():
                base, since = self._sure(text, at, start, previous, out)
                for i in range(start + 1, end):
                    out[i] = base + self._pieces(text[since:i])
                if blank or quoted:
                    base_end, since = self._sure(text, at, start, previous, out)
                    out[end] = base_end + self._pieces(text[since:end])
                else:
                    table = self.vocabulary.prefix_counts(word.encode())
                    self._inside(word, start, done, table, out, skip=1)
            else:
                self._inside(word, start, done, self.vocabulary.prefix_counts(word.encode()), out)
            done += self.words[word]
            previous = start
        return done

    def _sure(self, text: str, at: int, start: int, previous: int, out: np.ndarray) -> tuple[int, int]:
        """Tokens before, and begin of, the white space that a prefix ending here may join."""
        since = start
        while since > at and text[since - 1].isspace():
            since -= 1
        return int(out[since]), since

    @staticmethod
    def _inside(word: str, start: int, done: int, table: list[int], out: np.ndarray, skip: int = 0) -> None:
        at = 0
        for i, char in enumerate(word, 1):
            at += len(char.encode())
            if i > skip:
                out[start + i] = done + table[at]


def token_counts(df: DataFrame, path: str, pattern: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row, whole texts."""

    def make():
        counter = kept(("token counts", path, pattern), lambda: Counter(path, pattern))

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            texts = piece.column(1).to_pylist()
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            counts = [counter.count(t) for t in texts]
            return pa.record_batch(
                [piece.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return step

    return map_slices(text_of(df, key, text), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def truncation(df: DataFrame, path: str, pattern: str, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The longest prefix of every text within a budget of tokens: key, ``n_chars``, ``n_tokens``.

    Both come from the table of prefix counts.  A longer prefix can have fewer tokens, so the last
    position within the budget counts, not the first one beyond it.
    """

    def make():
        counter = kept(("token counts", path, pattern), lambda: Counter(path, pattern))

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            tables = [counter.prefixes(t) for t in piece.column(1).to_pylist()]
            ends = [int(np.flatnonzero(t <= budget)[-1]) for t in tables]
            counts = [int(t[e]) for t, e in zip(tables, ends)]
            return pa.record_batch([piece.column(0), pa.array(ends, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_chars", "n_tokens"])

        return step

    return map_slices(text_of(df, key, text), make, "doc_id long, n_chars long, n_tokens long")
