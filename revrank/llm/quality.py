"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is described by
the make-up of its bytes and the repetition of its words, and encoded by a small
layer. A gated attention, learned from document labels alone, weighs the passages;
the weighted representation is scored.

Features are computed where the texts are. The model is fitted on a bounded sample
of labelled documents, whose passage features (not their texts) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.common import labelled_sample
from revrank.llm.words import NOT_SPACE, Words, slices
from revrank.session import cut_lineage

PASSAGE = 64
#: Most labelled documents to learn from.
SAMPLE = 8_000
#: A document is taken as good from this score on.
GOOD = 0.3
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 16, 8, 30, 128, 0.01, 1e-4, 5

_MARKS = b"!|*#&%$.,"
_CLASSES = 6 + len(_MARKS)
_CLASS = np.full(256, 4, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3
_CLASS[[32, *range(9, 14)]] = 5
for _i, _mark in enumerate(_MARKS):
    _CLASS[_mark] = 6 + _i
FEATURES = _CLASSES + 6


def passage_features(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and each text's first row in them.

    A text without words has one passage of zeros.
    """
    words = Words(part, NOT_SPACE)
    counts = np.diff(words.first)
    passages = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    total = int(first[-1])
    out = np.zeros((total, FEATURES))
    if not len(words.start):
        return out, first
    number = np.arange(len(words.doc)) - words.first[words.doc]
    own = first[words.doc] + number // PASSAGE
    size = np.bincount(own, minlength=total)
    some = np.maximum(size, 1)

    raw = np.frombuffer(b" ".join([b"", *part, b""]), dtype=np.uint8)
    word_of = np.searchsorted(words.start, np.arange(len(raw)), "right") - 1
    inside = word_of >= 0
    bytes_of = np.bincount(own[word_of[inside]] * _CLASSES + _CLASS[raw[inside]], minlength=total * _CLASSES).reshape(total, _CLASSES)
    length = np.bincount(own, weights=words.end - words.start, minlength=total)
    out[:, :_CLASSES] = bytes_of / np.maximum(bytes_of.sum(axis=1), 1)[:, None]

    hashes = words.hashes()
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])])
    in_passage = np.unique(hashes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]
    in_text = np.unique(hashes + words.doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True)[1]
    out[:, _CLASSES] = np.bincount(own[same], minlength=total) / some
    out[:, _CLASSES + 1] = np.bincount(own[in_passage], minlength=total) / some
    out[:, _CLASSES + 2] = np.bincount(own[in_text], minlength=total) / some
    out[:, _CLASSES + 3] = length / some / 10
    out[:, _CLASSES + 4] = np.log1p(size)
    out[:, _CLASSES + 5] = np.log1p(np.repeat(counts, passages))
    return out, first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """encode: h = tanh(x W + b); weight: softmax of (tanh(h V) * sigmoid(h U)) a; score: sigmoid of the weighted h."""

    mean: np.ndarray
    scale: np.ndarray
    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    LEARNED = ("W", "b", "V", "U", "a", "c", "d")

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ self.W + self.b)
        v, u = np.tanh(h @ self.V), sigmoid(h @ self.U)
        e = (v * u) @ self.a
        bags = np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), bags))
        weight = e / np.repeat(np.add.reduceat(e, first[:-1]), bags)
        z = np.add.reduceat(h * weight[:, None], first[:-1])
        return {"x": x, "h": h, "v": v, "u": u, "weight": weight, "z": z, "score": sigmoid(z @ self.c + self.d)}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        f, bags = self.forward(x, first), np.diff(first)
        out = (f["score"] - y) / len(y)
        dz = np.repeat(out[:, None] * self.c, bags, axis=0)
        dw = (dz * f["h"]).sum(axis=1)
        de = f["weight"] * (dw - np.repeat(np.add.reduceat(f["weight"] * dw, first[:-1]), bags))
        dvu = de[:, None] * self.a
        dv, du = dvu * f["u"] * (1 - f["v"] ** 2), dvu * f["v"] * f["u"] * (1 - f["u"])
        dh = (dz * f["weight"][:, None] + dv @ self.V.T + du @ self.U.T) * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ dh,
            "b": dh.sum(axis=0),
            "V": f["h"].T @ dv,
            "U": f["h"].T @ du,
            "a": (f["v"] * f["u"]).T @ de,
            "c": f["z"].T @ out,
            "d": out.sum(keepdims=True),
        }


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> AttentionModel:
    """Fit by Adam on shuffled batches of bags. Without bags the model scores 0.5."""
    random = np.random.default_rng(seed)
    rows = np.concatenate([*bags, np.zeros((0, FEATURES))])
    mean, scale = (rows.mean(axis=0), rows.std(axis=0) + 1e-3) if len(rows) else (np.zeros(FEATURES), np.ones(FEATURES))

    def start(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    model = AttentionModel(
        mean, scale, start(FEATURES, HIDDEN), np.zeros(HIDDEN), start(HIDDEN, GATE), start(HIDDEN, GATE), np.zeros(GATE), np.zeros(HIDDEN), np.zeros(1)
    )
    moments = {n: [np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))] for n in model.LEARNED}
    step = 0
    for _ in range(epochs if len(bags) else 0):
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            step += 1
            for n, g in model.gradients(x, first, y[chosen]).items():
                old, (m, s) = getattr(model, n), moments[n]
                g = g + DECAY * old
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                setattr(model, n, old - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8))
    return model


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def described(texts: pa.Array) -> pa.Array:
    """Passage features of each text, one passage after another."""
    out = []
    for part in slices(texts.to_pylist()):
        x, first = passage_features(part)
        out += [x[first[i] : first[i + 1]].ravel() for i in range(len(part))]
    return pa.array(out, type=pa.list_(pa.float64()))


def held_out(id_column: Column) -> Column:
    """Ids that labels are never learned from: crc32 of the id as text divides by 5. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> AttentionModel:
    """Learn from about ``sample`` labelled documents that are not held out."""
    chosen = labelled_sample(docs, labels.filter(~held_out(F.col(id_col))), (label,), sample, id_col, text_col)
    rows = cut_lineage(chosen.select("id", F.col(label).alias("y"), described("text").alias("x"))).toPandas().sort_values("id", kind="stable")
    return train([np.asarray(x, dtype=float).reshape(-1, FEATURES) for x in rows["x"]], rows["y"].to_numpy(dtype=float))


def score(text: Column, model: AttentionModel) -> Column:
    """Score of every whole text, 0 to 1; null and empty texts are one empty passage."""
    weights = {f.name: getattr(model, f.name) for f in fields(model)}

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        own, out = AttentionModel(**weights), []
        for part in slices(texts.to_pylist()):
            out.append(own.forward(*passage_features(part))["score"])
        return pa.array(np.concatenate([*out, np.zeros(0)]), type=pa.float64())

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) of each row; repeated rows each get theirs, other columns are not read.

    Without labels every score is 0.5; an empty table gives no rows.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int")
    )
