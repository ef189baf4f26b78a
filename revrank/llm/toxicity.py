"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; the model of each sees the words and
the probabilities of the categories before it. While learning, these are
out-of-fold predictions, so that a later model meets them as it will in use.

Words count as themselves and by their beginnings. The ones that tell a category
apart are found by their document frequencies, counted in Spark; what reaches the
driver is bounded by ``SAMPLE`` documents and ``TERMS`` terms.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.common import labelled_sample
from revrank.llm.quality import sigmoid
from revrank.llm.words import LETTERS, Words, slices
from revrank.session import cut_lineage

#: Most labelled documents to learn from, and most terms of a category to keep.
SAMPLE, TERMS = 6_000, 1_500
#: A term is in at least so many of these documents, and so many standard errors from chance.
LEAST_DOCUMENTS, LEAST_Z = 4, 3.0
BEGINNINGS = (4, 5)
#: Categories in the order of the chain, each a rule on the label table.
CATEGORIES = {"junk": "quality = 0", "toxic_junk": "toxic = 1 AND quality = 0", "toxic": "toxic = 1"}
TOXIC = 0.5
FOLDS, STEPS, RATE, DECAY = 5, 150, 0.1, 0.02
DENSE = 3


def term_hashes(words: Words) -> list[np.ndarray]:
    """Hash of every word, and of its beginnings (other than those of whole words)."""
    out = [words.hashes()]
    for size in BEGINNINGS:
        out.append(words.hashes(size) ^ np.uint64(0xA5A5A5A5 * size))
    return out


def dense_features(words: Words, part: list[bytes]) -> np.ndarray:
    """Share of signs other than letters and spaces, share of distinct words, logarithm of the number of words."""
    n = len(part)
    counts = np.diff(words.first)
    signs = ~words.inside & (words.data != 32) & (words.data != 10)
    per_text = np.add.reduceat(np.append(signs, False), words.text_start[:-1]) if n else np.zeros(0)
    sizes = np.maximum(np.diff(words.text_start) - 1, 1)
    hashes = words.hashes()
    once = np.unique(hashes + words.doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True)[1]
    distinct = np.bincount(words.doc[once], minlength=n) / np.maximum(counts, 1)
    return np.stack([per_text / sizes, distinct, np.log1p(counts) / 10], axis=1)


@F.arrow_udf(T.ArrayType(T.LongType()))
def terms(texts: pa.Array) -> pa.Array:
    """The distinct terms of each text, as hashes."""
    out = []
    for part in slices(texts.to_pylist()):
        words = Words(part, LETTERS)
        kinds = term_hashes(words)
        out += [np.unique(np.concatenate([k[a:b] for k in kinds])).view(np.int64) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return pa.array(out, type=pa.list_(pa.int64()))


def telling_terms(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of at most ``TERMS`` terms a category whose document frequency differs most for it.

    One grouped sum over the terms of all documents serves every category.
    """
    sums = [F.sum(c).alias(c) for c in CATEGORIES]
    total = sample.agg(F.count("*").alias("n"), *sums).first()
    seen = sample.select(*CATEGORIES, F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"), *sums)
    seen = cut_lineage(seen.filter(F.col("df") >= LEAST_DOCUMENTS))
    n, found = total["n"], [np.zeros(0, dtype=np.uint64)]
    for category in CATEGORIES:
        hits = total[category] or 0
        if not 0 < hits < n:
            continue
        rate = hits / n
        z = F.abs((F.col(category) - F.col("df") * rate) / F.sqrt(F.col("df") * rate * (1 - rate) * (n - F.col("df") + 1) / n))
        rows = seen.withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(TERMS).select("term").collect()
        found.append(np.array([r["term"] for r in rows], dtype=np.int64).view(np.uint64))
    return np.unique(np.concatenate(found))


@dataclass
class Sparse:
    """Rows of a few terms each (places in the vocabulary, weights), then dense columns."""

    row: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    dense: np.ndarray
    terms: int

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.weight * w[self.term], len(self.dense)) + self.dense @ w[self.terms :]

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.term, self.weight * g[self.row], self.terms), self.dense.T @ g])

    def only(self, keep: np.ndarray) -> Sparse:
        place = np.cumsum(keep) - 1
        some = keep[self.row]
        return Sparse(place[self.row[some]], self.term[some], self.weight[some], self.dense[keep], self.terms)

    def beside(self, *columns: np.ndarray) -> Sparse:
        return Sparse(self.row, self.term, self.weight, np.column_stack([self.dense, *columns]), self.terms)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def fit_linear(x: Sparse, y: np.ndarray) -> np.ndarray:
    """Weights, then a constant, of a regularised logistic regression (Adam on all rows)."""
    w = np.zeros(x.terms + x.dense.shape[1] + 1)
    if len(y):
        base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        w[-1] = np.log(base / (1 - base))
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1 if len(y) else 1):
        error = (sigmoid(x.times(w[:-1]) + w[-1]) - y) / len(y)
        g = np.append(x.transposed_times(error) + DECAY / len(y) * w[:-1], error.sum())
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    return w


def predict_linear(x: Sparse, w: np.ndarray) -> np.ndarray:
    return sigmoid(x.times(w[:-1]) + w[-1])


@dataclass
class Chain:
    vocabulary: np.ndarray  # sorted hashes
    weights: list[np.ndarray]  # of each category, in order

    def features(self, part: list[bytes]) -> Sparse:
        words = Words(part, LETTERS)
        size, at, place = len(self.vocabulary), [], []
        for hashes in term_hashes(words) if size else []:
            found = np.searchsorted(self.vocabulary, hashes).clip(max=size - 1)
            hit = self.vocabulary[found] == hashes
            at.append(words.doc[hit])
            place.append(found[hit])
        pairs = np.concatenate([a * size + b for a, b in zip(at, place, strict=True)] or [np.zeros(0, dtype=np.int64)])
        pairs, times = np.unique(pairs, return_counts=True)
        return Sparse(pairs // max(size, 1), pairs % max(size, 1), np.log1p(times), dense_features(words, part), size)

    def probabilities(self, x: Sparse) -> np.ndarray:
        """One column for each category; earlier ones feed the later."""
        found: list[np.ndarray] = []
        for w in self.weights:
            found.append(predict_linear(x.beside(*map(logit, found)), w))
        return np.column_stack(found)


def train(vocabulary: np.ndarray, x: Sparse, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """One model for each column of ``labels``; their inputs from earlier ones are out of fold."""
    weights, before = [], []
    for j in range(labels.shape[1]):
        own, y = x.beside(*map(logit, before)), labels[:, j].astype(float)
        weights.append(fit_linear(own, y))
        apart = np.zeros(len(y))
        for k in np.unique(fold):
            test = fold == k
            apart[test] = predict_linear(own.only(test), fit_linear(own.only(~test), y[~test]))
        before.append(apart)
    return Chain(vocabulary, weights)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Learn the chain from about ``sample`` labelled documents."""
    chosen = labelled_sample(docs, labels, ("quality", "toxic"), sample, id_col, text_col)
    ruled = chosen.select("id", "text", terms("text").alias("terms"), *(F.expr(rule).cast("int").alias(c) for c, rule in CATEGORIES.items()))
    ruled = cut_lineage(ruled)
    vocabulary = telling_terms(ruled)
    empty = Chain(vocabulary, [])

    @F.arrow_udf(
        T.StructType().add("term", T.ArrayType(T.LongType())).add("weight", T.ArrayType(T.DoubleType())).add("dense", T.ArrayType(T.DoubleType()))
    )
    def described(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts.to_pylist()):
            x = empty.features(part)
            bounds = np.searchsorted(x.row, np.arange(len(part) + 1))
            out += [{"term": x.term[a:b], "weight": x.weight[a:b], "dense": x.dense[i]} for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
        return pa.array(out, type=pa.struct([("term", pa.list_(pa.int64())), ("weight", pa.list_(pa.float64())), ("dense", pa.list_(pa.float64()))]))

    rows = ruled.select("id", described("text").alias("d"), *CATEGORIES).select("id", "d.*", *CATEGORIES)
    rows = rows.toPandas().sort_values("id", kind="stable")
    sizes = rows["term"].map(len).to_numpy(dtype=np.int64)

    def joined(column: str, kind: type) -> np.ndarray:
        return np.concatenate([*rows[column], np.zeros(0)]).astype(kind)

    x = Sparse(
        np.repeat(np.arange(len(rows)), sizes),
        joined("term", np.int64),
        joined("weight", float),
        joined("dense", float).reshape(-1, DENSE),
        len(vocabulary),
    )
    return train(vocabulary, x, rows[[*CATEGORIES]].to_numpy(dtype=float).reshape(-1, len(CATEGORIES)), rows["id"].to_numpy(dtype=np.int64) % FOLDS)


_RESULT = T.StructType()
for _name in CATEGORIES:
    _RESULT = _RESULT.add(f"p_{_name}", T.DoubleType())


def probabilities(text: Column, chain: Chain) -> Column:
    """Struct of the probability of each category for every whole text; null is the empty text."""

    @F.arrow_udf(_RESULT)
    def chained(texts: pa.Array) -> pa.Array:
        out = [chain.probabilities(chain.features(part)) for part in slices(texts.to_pylist())]
        found = np.concatenate([*out, np.zeros((0, len(CATEGORIES)))])
        return pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(found.T)], names=_RESULT.names)

    return chained(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, p_junk, p_toxic_junk, p_toxic, toxic) of each row; repeated rows each get theirs.

    Without labels nothing is known: every probability is then one half or that of the
    single class seen, and an empty table gives no rows. Very long texts are read whole;
    null texts are empty. Other columns are not read.
    """
    chain = fit(docs, labels, id_col=id_col, text_col=text_col)
    found = docs.select(F.col(id_col), probabilities(F.col(text_col), chain).alias("p")).select(id_col, "p.*")
    return found.withColumn("toxic", F.col("p_toxic") >= TOXIC)
