"""Quality of documents by attention over their passages.

A document is a bag of passages and has one label.  Every passage is encoded by itself; gated
attention learns which passages tell the label, and the document's score comes from the passage
representations weighted by it (attention-based multiple-instance learning).

A passage is a stretch of ``PASSAGE`` bytes; its features are the frequencies of transitions between
character classes, how many different four-byte sequences it has, and its length.  Encoder, attention
and output are trained together by gradient descent (Adam), on a bounded sample of labelled documents
outside the held-out quarter; the bound is the parameter ``sample``.  Labels, language, source and id
are never inputs.

Defined results: a null or empty text is one empty passage and has a score like any other; a null id
is not held out; labels that are null or repeat for an id with another value train nothing; without
labels of both kinds every score is 0.5; repeated rows are scored one by one; an empty table gives an
empty table; other columns are ignored by ``scores`` and kept by ``accepted``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices, text_of

PASSAGE = 400
ACCEPTED = 0.7
#: Labelled documents of each kind that the model is trained on at most.
SAMPLE = 1500

#: Character classes of bytes; what is in none is "other".
_CLASSES = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?", "\"'()[]{}",
    "#*$%&|<>", "-_/\\=+~^@`",
)
_N = len(_CLASSES) + 3  # and: lead byte, continuation byte, other
_BINS = 256
FEATURES = _N * _N + 3


def _class_table() -> np.ndarray:
    table = np.full(256, _N - 1, np.uint8)
    for i, chars in enumerate(_CLASSES):
        table[[ord(c) for c in chars]] = i
    table[0x80:0xC0], table[0xC0:] = _N - 2, _N - 3
    return table


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text."""
    data = [t.encode() for t in texts]
    counts = np.array([max(1, -(-len(d) // PASSAGE)) for d in data])
    sizes = np.array([len(d) for d in data])
    total = int(counts.sum())
    out = np.zeros((total, FEATURES), np.float32)
    flat = np.frombuffer(b"".join(data), np.uint8)
    if not len(flat):
        return out, counts
    begins = np.cumsum(sizes) - sizes
    within = np.arange(len(flat)) - np.repeat(begins, sizes)
    passage = np.repeat(np.cumsum(counts) - counts, sizes) + within // PASSAGE
    kind = _class_table()[flat].astype(np.int64)
    same = passage[1:] == passage[:-1]
    moves = (passage[1:] * (_N * _N) + kind[:-1] * _N + kind[1:])[same]
    out[:, : _N * _N] = np.bincount(moves, minlength=total * _N * _N).reshape(total, -1)
    length = np.bincount(passage, minlength=total)
    out[:, : _N * _N] = np.sqrt(out[:, : _N * _N] / np.maximum(1, length - 1)[:, None])
    if len(flat) > 3:
        four = flat[:-3].astype(np.uint32) | flat[1:-2].astype(np.uint32) << 8 | flat[2:-1].astype(np.uint32) << 16 | flat[3:].astype(np.uint32) << 24
        whole = passage[3:] == passage[:-3]
        bin_ = ((four * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)
        hits = np.bincount((passage[:-3] * _BINS + bin_)[whole], minlength=total * _BINS).reshape(total, _BINS)
        n = hits.sum(axis=1)
        expected = _BINS * (1 - (1 - 1 / _BINS) ** n)
        out[:, -3] = (hits > 0).sum(axis=1) / np.maximum(expected, 1)
    out[:, -2] = np.log1p(length) / np.log(PASSAGE)
    out[:, -1] = (length == 0)
    return out, counts


class Model:
    """Encoder (tanh), gated attention (tanh times sigmoid) and output, as plain arrays."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts

    @classmethod
    def new(cls, rng: np.random.Generator, hidden: int = 16, gate: int = 8) -> Model:
        w = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        return cls(
            {
                "encode": w(FEATURES, hidden), "encode_bias": np.zeros(hidden, np.float32), "look": w(hidden, gate),
                "open": w(hidden, gate), "weigh": w(gate, 1)[:, 0], "out": w(hidden, 1)[:, 0], "out_bias": np.zeros(1, np.float32),
            }
        )

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        owner, begins = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
        h = np.tanh(x @ p["encode"] + p["encode_bias"])
        look, gate = np.tanh(h @ p["look"]), 1 / (1 + np.exp(-(h @ p["open"])))
        e = (look * gate) @ p["weigh"]
        e = np.exp(e - np.maximum.reduceat(e, begins)[owner])
        a = e / np.add.reduceat(e, begins)[owner]
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["out"] + p["out_bias"])))
        return {"owner": owner, "begins": begins, "h": h, "look": look, "gate": gate, "a": a, "z": z, "score": score}

    def slopes(self, x: np.ndarray, counts: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross entropy."""
        p, f = self.parts, self.forward(x, counts)
        d = (f["score"] - truth) / len(truth)
        dz = d[:, None] * p["out"]
        da = (dz[f["owner"]] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["begins"])[f["owner"]])
        dl = de[:, None] * p["weigh"] * f["gate"] * (1 - f["look"] ** 2)
        dg = de[:, None] * p["weigh"] * f["look"] * f["gate"] * (1 - f["gate"])
        dh = f["a"][:, None] * dz[f["owner"]] + dl @ p["look"].T + dg @ p["open"].T
        du = dh * (1 - f["h"] ** 2)
        return {
            "encode": x.T @ du, "encode_bias": du.sum(axis=0), "look": f["h"].T @ dl, "open": f["h"].T @ dg,
            "weigh": (de[:, None] * f["look"] * f["gate"]).sum(axis=0), "out": f["z"].T @ d, "out_bias": d.sum(keepdims=True),
        }

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x, counts = features(texts)
        return self.forward(x, counts)["score"].astype(np.float64)


def fit(x: np.ndarray, counts: np.ndarray, truth: np.ndarray, steps: int = 400, batch: int = 128, seed: int = 11) -> Model | None:
    """Train on passages of documents; None unless there are labels of both kinds."""
    if len(set(truth.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    model = Model.new(rng)
    begins = np.cumsum(counts) - counts
    kinds = [np.flatnonzero(truth == k) for k in (0, 1)]
    first = {k: np.zeros_like(v) for k, v in model.parts.items()}
    second = {k: np.zeros_like(v) for k, v in model.parts.items()}
    for step in range(1, steps + 1):
        docs = np.concatenate([rng.choice(k, batch // 2) for k in kinds])
        rows = np.concatenate([np.arange(begins[d], begins[d] + counts[d]) for d in docs])
        for name, slope in model.slopes(x[rows], counts[docs], truth[docs]).items():
            slope = slope + 1e-4 * model.parts[name]
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            rate = 0.02 * (1 - step / (steps + 1))
            model.parts[name] -= (rate * first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def remainder(key: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.crc32(key.cast("long").cast("string").cast("binary")) % 4


def trained(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """A model from at most ``sample`` labelled documents of each kind, those of least hash."""
    known = labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where((remainder(F.col("doc_id")) != 2) & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = known.where("label = 0").orderBy(*order).limit(sample).union(known.where("label = 1").orderBy(*order).limit(sample))
    # At most twice ``sample`` rows of two numbers.
    chosen = text_of(df, key, text).join(F.broadcast(some.select("doc_id", "label")), "doc_id")

    def make():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            x, counts = features(piece.column(1).to_pylist())
            ends = np.cumsum(counts)
            found = [x[e - c : e].astype("<f2").tobytes() for e, c in zip(ends, counts)]
            return pa.record_batch([piece.column(0), piece.column(2), pa.array(found, pa.binary())], names=["doc_id", "label", "passages"])

        return step

    rows = map_slices(chosen.select("doc_id", "text", "label"), make, "doc_id long, label int, passages binary").limit(2 * sample).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r.doc_id, bytes(r.passages)))
    bags = [np.frombuffer(r.passages, "<f2").reshape(-1, FEATURES).astype(np.float32) for r in rows]
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([r.label for r in rows], np.float32))


def _score(text: Column, model: Model | None) -> Column:
    if model is None:
        return F.lit(0.5)
    parts = model.parts

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(parts)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            pieces = [own.scores(texts[i : i + 256]) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(pieces) if pieces else np.zeros(0))

    return score(text)


def scores(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    rows = text_of(df, key, text)
    out = rows.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), _score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= ACCEPTED, 1).otherwise(0))


def accepted(df: DataFrame, model: Model | None, text: str = "text", least: float = ACCEPTED) -> DataFrame:
    """The rows whose score reaches ``least``, with all their columns."""
    if model is None:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    mark = f"_{uuid.uuid4().hex[:8]}"
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return df.withColumn(mark, _score(body, model)).where(F.col(mark) >= least).select(*columns)
