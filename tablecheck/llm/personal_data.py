"""Personal data in texts: exact rules, and a character model for what the rules do not write down.

The rules find emails, IP addresses, card numbers and phone numbers, leftmost and without overlap per
kind.  The model is a bidirectional LSTM over characters whose scores feed a conditional random field
with transitions between tags (outside; begin and inside of each kind).  It is trained in numpy from
labelled spans: texts of a bounded sample of documents with the spans that the rules confirm, and made
sentences with other written forms of the same data (phones without a plus, dotted cards, bracketed
dots, spaced emails) as well as look-alikes that are none (versions, hexadecimal keys, dates).

Every span that counts holds a digit or an at sign, so stretches around these are scored: some
characters to each side and on to the ends of words.  A stretch whose first or last character is in a
span is made wider and decoded again, until none is, so a span may be of any length.  A stretch is cut into overlapping windows; the scores of a character are
averaged over its windows, weighted towards their middles, and one Viterbi path is decoded over the
whole stretch, so no span is cut or counted twice where windows meet.  A span of the model is added
if it overlaps no span of the rules and the digits or parts that its kind demands are there.

Positions are code points.  Defined results: a null or empty text has no spans; null ids stay null;
repeated rows are read one by one; an empty table gives an empty table (and a model trained on made
sentences alone); other columns are ignored by ``spans`` and kept by ``masked``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices, text_of
from tablecheck.llm.process import kept
from tablecheck.llm.sampling import least

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number can only begin where no digit stands before it, which keeps long runs of digits linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EVIDENCE = re.compile(r"[0-9@]+")
_SPACE = re.compile(r"\s")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append((begin, found.end(), "email"))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def _is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the rules by start, then kind."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _is_ip(m[0])] if "." in text else []
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ---------------------------------------------------------------------------------------------
# The model

TAGS = 1 + 2 * len(KINDS)
_ALPHABET = 130  # ASCII, other letters, other characters
HIDDEN = 16
WINDOW, STRIDE = 64, 32
CONTEXT = 20
_FORBIDDEN = -1e4


def characters(text: str) -> np.ndarray:
    """Symbols of a text: the ASCII code, or whether it is a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) and codes.max() < 128:
        return codes.astype(np.int64)
    return np.array([c if c < 128 else 128 + (not chr(c).isalpha()) for c in codes.tolist()], np.int64)


def allowed() -> np.ndarray:
    """Transitions that tags permit: inside of a kind follows its begin or inside only."""
    fixed = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        fixed[:, inside] = _FORBIDDEN
        fixed[[inside - 1, inside], inside] = 0
    return fixed


class Tagger:
    """Bidirectional LSTM and CRF as plain arrays."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts

    @classmethod
    def new(cls, rng: np.random.Generator) -> Tagger:
        w = lambda *s: (rng.standard_normal(s) * (1 / np.sqrt(s[0] if s[0] < 100 else HIDDEN))).astype(np.float32)
        parts: dict[str, np.ndarray] = {"change": np.zeros((TAGS, TAGS), np.float32), "start": np.zeros(TAGS, np.float32)}
        for way in ("ahead", "back"):
            parts |= {f"{way}_in": w(_ALPHABET, 4 * HIDDEN), f"{way}_self": w(HIDDEN, 4 * HIDDEN), f"{way}_out": w(HIDDEN, TAGS)}
            parts[f"{way}_in"][:, HIDDEN : 2 * HIDDEN] += 1  # forget gates open at first
        parts["out_bias"] = np.zeros(TAGS, np.float32)
        return cls(parts)

    def _run(self, symbols: np.ndarray) -> tuple[np.ndarray, list]:
        """States of both directions (time, direction, window), and what the gradient needs."""
        inputs = np.stack([self.parts["ahead_in"][symbols], self.parts["back_in"][symbols[::-1]]], axis=1)
        own = np.stack([self.parts["ahead_self"], self.parts["back_self"]])
        h = c = np.zeros((2, symbols.shape[1], HIDDEN), np.float32)
        states, kept = np.empty((len(symbols), *h.shape), np.float32), []
        for t in range(len(symbols)):
            gates = inputs[t] + h @ own
            # tanh(x) = 2 sigmoid(2x) - 1, so one call serves all gates.
            gates[..., 3 * HIDDEN :] *= 2
            gates = 1 / (1 + np.exp(-gates))
            gates[..., 3 * HIDDEN :] *= 2
            gates[..., 3 * HIDDEN :] -= 1
            before, c_before = h, c
            i, f, o, g = (gates[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            kept.append((before, c_before, gates, squashed))
        return states, kept

    def emissions(self, symbols: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores of ``symbols`` (time, window)."""
        states, kept = self._run(symbols)
        scores = states[:, 0] @ self.parts["ahead_out"] + states[::-1, 1] @ self.parts["back_out"] + self.parts["out_bias"]
        return scores, (states, kept)

    def _run_slopes(self, symbols: np.ndarray, kept: list, dh_all: np.ndarray) -> dict[str, np.ndarray]:
        own = np.stack([self.parts["ahead_self"], self.parts["back_self"]])
        turned = own.transpose(0, 2, 1).copy()
        d_own, d_gates = np.zeros_like(own), np.empty((*dh_all.shape[:-1], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros_like(dh_all[0])
        for t in range(len(symbols) - 1, -1, -1):
            before, c_before, gates, squashed = kept[t]
            i, f, o, g = (gates[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - squashed**2)
            d = d_gates[t]
            d[..., :HIDDEN] = dc * g
            d[..., HIDDEN : 2 * HIDDEN] = dc * c_before
            d[..., 2 * HIDDEN : 3 * HIDDEN] = dh * squashed
            d[..., : 3 * HIDDEN] *= gates[..., : 3 * HIDDEN] * (1 - gates[..., : 3 * HIDDEN])
            d[..., 3 * HIDDEN :] = dc * i * (1 - g**2)
            d_own += before.transpose(0, 2, 1) @ d
            dh, dc = d @ turned, dc * f
        out = {}
        for k, (way, order) in enumerate((("ahead", symbols), ("back", symbols[::-1]))):
            seen = (order.ravel() == np.arange(_ALPHABET)[:, None]).astype(np.float32)
            out |= {f"{way}_in": seen @ d_gates[:, k].reshape(-1, 4 * HIDDEN), f"{way}_self": d_own[k]}
        return out

    def slopes(self, symbols: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log likelihood of the true tags (time, window)."""
        scores, kept = self.emissions(symbols)
        steps, n = symbols.shape
        change = self.parts["change"] + allowed()
        ahead, behind = np.empty((steps, n, TAGS)), np.zeros((steps, n, TAGS))
        total = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
        ahead[0] = self.parts["start"] + scores[0]
        for t in range(1, steps):
            ahead[t] = total(ahead[t - 1][:, :, None] + change, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = total(change + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        norm = total(ahead[-1], 1)
        single = np.exp(ahead + behind - norm[None, :, None])
        pairs = ahead[:-1, :, :, None] + (scores[1:] + behind[1:])[:, :, None, :] + (change - norm[:, None, None])
        double = np.exp(pairs).sum(axis=(0, 1))
        want = np.eye(TAGS)[truth]
        np.subtract.at(double, (truth[:-1].ravel(), truth[1:].ravel()), 1.0)
        d = ((single - want) / n).astype(np.float32)
        states, steps_kept = kept
        d_states = np.stack([d @ self.parts["ahead_out"].T, d[::-1] @ self.parts["back_out"].T], axis=1)
        flat = lambda x: x.reshape(-1, x.shape[-1])
        return {
            "change": double / n, "start": d[0].sum(axis=0), "out_bias": flat(d).sum(axis=0),
            "ahead_out": flat(states[:, 0]).T @ flat(d), "back_out": flat(states[:, 1]).T @ flat(d[::-1]),
            **self._run_slopes(symbols, steps_kept, d_states),
        }

    def paths(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of each stretch of scores; stretches of like length go together."""
        change = self.parts["change"] + allowed()
        start = self.parts["start"] + np.where(np.arange(TAGS) % 2 == 0, _FORBIDDEN, 0) * (np.arange(TAGS) > 0)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
        at = 0
        while at < len(order):
            # Long ones in smaller groups: their scores lie side by side.
            some = order[at : at + 256]
            some = some[: max(1, (1 << 20) // len(scores[some[-1]]))]
            at += len(some)
            sizes = np.array([len(scores[i]) for i in some])
            most = int(sizes.max())
            emit = np.zeros((most, len(some), TAGS))
            for k, i in enumerate(some):
                emit[: len(scores[i]), k] = scores[i]
            best, back = start + emit[0], np.zeros((most, len(some), TAGS), np.int8)
            finals = best.copy()
            for t in range(1, most):
                step = best[:, :, None] + change
                back[t] = step.argmax(axis=1)
                best = np.take_along_axis(step, back[t][:, None, :].astype(np.int64), axis=1)[:, 0] + emit[t]
                finals = np.where((t < sizes)[:, None], best, finals)
            tags = np.zeros((most, len(some)), np.int64)
            now = finals.argmax(axis=1)
            for t in range(most - 1, -1, -1):
                live = t < sizes
                tags[t] = now
                now = np.where(live, back[t][np.arange(len(some)), now], now)
            for k, i in enumerate(some):
                out[i] = tags[: len(scores[i]), k]
        return out

    def stretches(self, texts: list[str]) -> list[tuple[int, int, int]]:
        """Text, start and end of every part around digits and at signs; parts do not overlap and cut no word."""
        out = []
        for i, text in enumerate(texts):
            start = end = -1
            for m in _EVIDENCE.finditer(text):
                if m.end() + CONTEXT <= end:
                    continue
                low = _word_start(text, m.start() - CONTEXT, max(0, end))
                if end < 0 or low > end:
                    if end >= 0:
                        out.append((i, start, end))
                    start = low
                end = _word_end(text, m.end() + CONTEXT)
            if end >= 0:
                out.append((i, start, end))
        return out

    def find(self, texts: list[str]) -> list[list[Span]]:
        """Spans of the model in each text."""
        done: list[list[tuple[int, int, list[Span] | None]]] = [[] for _ in texts]
        parts = self.stretches(texts)
        while parts:
            some, held = [], 0
            for part in parts:
                some.append(part)
                held += part[2] - part[1]
                if len(some) == 2048 or held >= 1 << 20:
                    self._find(texts, some, done)
                    some, held = [], 0
            if some:
                self._find(texts, some, done)
            again = []
            for i in dict.fromkeys(i for i, _, _ in parts):
                merged: list[tuple[int, int, list[Span] | None]] = []
                for a, b, spans in sorted((_wider(texts[i], *part) for part in done[i]), key=lambda x: x[:2]):
                    if merged and a <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], max(b, merged[-1][1]), None)
                    else:
                        merged.append((a, b, spans))
                done[i] = [part for part in merged if part[2] is not None]
                again += [(i, a, b) for a, b, spans in merged if spans is None]
            parts = again
        return [sorted(s for _, _, spans in of_text for s in spans or ()) for of_text in done]

    def _find(self, texts: list[str], parts: list[tuple[int, int, int]], done: list) -> None:
        windows, places = [], []
        symbols = [characters(texts[i][a:b]) for i, a, b in parts]
        for p, s in enumerate(symbols):
            for begin in range(0, max(1, len(s) - WINDOW + STRIDE), STRIDE):
                windows.append(np.pad(s[begin : begin + WINDOW], (0, max(0, WINDOW - len(s) + begin)), constant_values=0))
                places.append((p, begin))
        middle = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)
        sums = [np.zeros((len(s), TAGS), np.float32) for s in symbols]
        weights = [np.zeros(len(s), np.float32) for s in symbols]
        for at in range(0, len(windows), 1024):
            scores, _ = self.emissions(np.array(windows[at : at + 1024]).T)
            for k, (p, begin) in enumerate(places[at : at + 1024]):
                n = min(WINDOW, len(symbols[p]) - begin)
                sums[p][begin : begin + n] += scores[:n, k] * middle[:n, None]
                weights[p][begin : begin + n] += middle[:n]
        for (i, a, b), tags in zip(parts, self.paths([s / w[:, None] for s, w in zip(sums, weights)])):
            spans = []
            for t in np.flatnonzero(tags % 2 == 1).tolist():
                end = t + 1
                while end < len(tags) and tags[end] == tags[t] + 1:
                    end += 1
                spans.append((a + t, a + end, KINDS[tags[t] // 2]))
            done[i].append((a, b, spans))


def _word_start(text: str, at: int, least: int) -> int:
    while at > least and not text[at - 1].isspace():
        at -= 1
    return max(0, at)


def _word_end(text: str, at: int) -> int:
    found = _SPACE.search(text, at)
    return found.start() if found else len(text)


def _wider(text: str, start: int, end: int, spans: list[Span]) -> tuple[int, int, list[Span] | None]:
    """The stretch, or a wider one without spans where a span may go on beyond it."""
    before = bool(spans) and 0 < start == spans[0][0]
    after = bool(spans) and spans[-1][1] == end < len(text)
    if not before and not after:
        return start, end, spans
    more = max(WINDOW, end - start)
    return _word_start(text, start - more, 0) if before else start, _word_end(text, end + more) if after else end, None


def _plausible(kind: str, text: str) -> bool:
    """What the kind demands of a span whatever its form."""
    digits = _digits(text)
    if kind == "email":
        return "@" in text and "." in text.partition("@")[2]
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[A-Za-z]", text)
    return 10 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", text)


def all_spans(texts: list[str], tagger: Tagger) -> tuple[list[list[Span]], list[list[Span]]]:
    """Spans of the rules, and these with the model's added, by start and kind."""
    base = [base_spans(t) for t in texts]
    every = []
    for text, fixed, more in zip(texts, base, tagger.find(texts)):
        added = [s for s in more if _plausible(s[2], text[s[0] : s[1]]) and not any(s[0] < b and a < s[1] for a, b, _ in fixed)]
        every.append(sorted([*fixed, *added], key=lambda s: (s[0], KINDS.index(s[2]))))
    return base, every


# ---------------------------------------------------------------------------------------------
# Training


def made_examples(rng: np.random.Generator, n: int) -> list[tuple[str, list[Span]]]:
    """Sentences with personal data in many written forms, and with look-alikes."""
    digit = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))

    def card() -> str:
        head = digit(15)
        digits = next(head + d for d in "0123456789" if luhn(head + d))
        return pick("", " ", "-", ".", "/").join(digits[i : i + 4] for i in range(0, 16, 4))

    def ip() -> str:
        return pick(".", ".", "[.]", " . ").join(str(x) for x in rng.integers(0, 256, 4))

    def phone() -> str:
        a, b, c = digit(3), digit(3), digit(4)
        return pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digit(2)} {a} {b} {c}", f"{a}.{b}.{c}", f"00{digit(2)} {a} {b}{c}")

    def label() -> str:
        return word() if rng.random() < 0.7 else "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(9, 45)))

    def email() -> str:
        return f"{label()}{pick('.', '_', '')}{pick(word(), digit(2), '')}{pick('@', '@', ' @ ')}{label()}{pick('', digit(1))}.{pick('com', 'org', 'example.net', 'example.com')}"

    def alike() -> str:
        key = "".join("0123456789abcdef"[c] for c in rng.integers(0, 16, 40))
        return pick(f'token = "{key}"', f"version {digit(1)}.{digit(1)}", f"{digit(4)}-{digit(2)}-{digit(2)}", f"{digit(3)} {word()}", f"{digit(5)}", f"CC BY-NC {digit(1)}.0", f"@{word()}", f"${digit(2)}.{digit(2)}")

    out = []
    for _ in range(n):
        text, spans = pick("", "| ", "") + " ".join(word() for _ in range(rng.integers(0, 6))), []
        for _ in range(rng.integers(1, 4)):
            kind = pick(*KINDS, *KINDS, "none", "none", "none")
            item = {"card": card, "ip": ip, "phone": phone, "email": email, "none": alike}[kind]()
            text += pick(" ", " ", "\n", ": ")
            if kind != "none":
                spans.append((len(text), len(text) + len(item), kind))
            text += item + pick(" ", ". ", ", ", "!! ", "*** ", "### ", " | ") + " ".join(word() for _ in range(rng.integers(1, 6)))
        out.append((text, spans))
    return out


def train(examples: list[tuple[str, list[Span]]], steps: int = 300, batch: int = 64, seed: int = 5) -> Tagger:
    """Fit a tagger to labelled spans by Adam; each step draws windows around spans and evidence."""
    rng = np.random.default_rng(seed)
    tagger = Tagger.new(rng)
    windows, truths = [], []
    for text, spans in examples:
        symbols, tags = characters(text), np.zeros(len(text), np.int64)
        for start, end, kind in spans:
            tags[start:end] = 2 + 2 * KINDS.index(kind)
            tags[start] -= 1
        for _, a, b in tagger.stretches([text]):
            for begin in range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE):
                cut = slice(begin, min(b, begin + WINDOW))
                size = cut.stop - cut.start
                mark = tags[cut].copy()
                if mark[0] and mark[0] % 2 == 0:
                    mark[0] -= 1  # a span cut by the window begins with it
                windows.append(np.pad(symbols[cut], (0, WINDOW - size)))
                truths.append(np.pad(mark, (0, WINDOW - size)))
    x, y = np.array(windows), np.array(truths)
    first = {k: np.zeros_like(v) for k, v in tagger.parts.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.parts.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        rate = 0.03 * (1 - step / (steps + 1))
        for name, slope in tagger.slopes(x[rows].T, y[rows].T).items():
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            move = rate * first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
            tagger.parts[name] -= move.astype(np.float32)
    return tagger


#: Documents of the training sample, each with at most so many characters; longer ones train nothing.
SAMPLE, LONGEST = 600, 20_000


def trained(df: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Tagger:
    """A tagger from up to ``sample`` documents with digits or at signs, those of least hash, labelled by
    the rules, and from made sentences.
    """
    rows = text_of(df, key, text).where(F.col("text").rlike("[0-9@]") & (F.length("text") < LONGEST))
    texts = sorted(r.text for r in least(rows, F.xxhash64("doc_id", "text"), sample).collect())
    digest = hashlib.sha256("\0".join(texts).encode()).hexdigest()
    # Training is the same for the same sample; a session that asks again is spared it.
    made = made_examples(np.random.default_rng(17), 1500)
    return kept(("tagger", digest), lambda: train([*((t, base_spans(t)) for t in texts), *made]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def spans(df: DataFrame, tagger: Tagger | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the rules' spans by kind, ``base_sha256``, ``spans`` (all) and ``n_added``."""
    parts = (tagger or trained(df, key=key, text=text)).parts

    def make():
        own = Tagger(parts)

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            base, every = all_spans(piece.column(1).to_pylist(), own)
            counts = [pa.array([sum(s[2] == kind for s in found) for found in base], pa.int64()) for kind in KINDS]
            digest = pa.array([hashlib.sha256(written(found).encode()).hexdigest() for found in base], pa.string())
            added = pa.array([len(e) - len(b) for b, e in zip(base, every)], pa.int64())
            names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]
            return pa.record_batch([piece.column(0), *counts, digest, pa.array(map(written, every), pa.string()), added], names=names)

        return step

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_slices(text_of(df, key, text), make, schema)


def mask(text: str, found: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first span."""
    out, at = [], 0
    merged: list[list] = []
    for start, end, kind in found:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def masked(df: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """All rows and columns, personal data in ``text`` replaced by names of kinds; a null stays null."""
    parts = tagger.parts

    @F.pandas_udf("string")
    def masking(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Tagger(parts)
        for batch in batches:
            texts, done = list(batch), []
            for at in range(0, len(texts), 512):
                some = texts[at : at + 512]
                plain = ["" if t is None else t for t in some]
                done += [None if raw is None else mask(t, every) for raw, t, every in zip(some, plain, all_spans(plain, own)[1])]
            yield pd.Series(done, dtype=object)

    column: Column = F.col(f"`{text}`")
    name = f"_{uuid.uuid4().hex[:8]}"
    rest = [F.col(f"`{name}`").alias(text) if c == text else F.col(f"`{c}`") for c in df.columns]
    return df.withColumn(name, masking(column)).select(*rest)
