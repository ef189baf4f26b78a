"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts the hashed 1- to 3-grams of code points per language where the texts
are; the counts of a task are summed by Spark and only the finished matrix, of at most
``MATRIX_CELLS`` numbers, reaches the driver and the tasks. Scoring gathers the rows of
the log-probability matrix for the grams of many texts at once and adds them per text.

Defined results: a null text and a text without a letter get ``und`` and score 0, as does
every text if no language was learned. Very long texts are counted and scored whole, in
parts. Repeated rows count and are scored each. Equal sums go to the smaller language.
A null id counts as the empty text in the hold-out rule. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.common import text_batches
from revrank.llm.quality import held_out

#: Longest gram, in code points.
LONGEST = 3
#: Hash buckets for few languages; halved until languages × buckets is within MATRIX_CELLS.
BUCKETS = 1 << 16
MATRIX_CELLS = 1 << 23
#: Most languages in the model: those with the most documents. Bounds the matrix.
LANGUAGES = 8192
#: Added to every count.
SMOOTHING = 0.1
#: Code points handled at once, and cells of gathered matrix rows.
PART_CHARS = 1 << 18
PART_CELLS = 1 << 21

NONE = "und"
_LETTER = regex.compile(r"\p{L}")
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass
class Model:
    """``languages`` in order, and ``weights``: one row per bucket, one column per language."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def text_parts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lower-case code points of consecutive texts, and where in ``texts`` each one belongs.

    A text is laid between spaces. Long texts go over several parts that overlap by
    ``LONGEST`` - 1 code points, whose own grams are counted once.
    """
    points: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        own = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for first in range(0, len(own), PART_CHARS):
            piece = own[first : first + PART_CHARS + LONGEST - 1]
            points.append(piece)
            owner.append(np.where(np.arange(len(piece)) < PART_CHARS, i, -1))
            size += len(piece)
            if size >= PART_CHARS:
                yield np.concatenate(points), np.concatenate(owner)
                points, owner, size = [], [], 0
    if points:
        yield np.concatenate(points), np.concatenate(owner)


def grams(points: np.ndarray, owner: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every gram, for each length 1 … LONGEST; a gram lies within one piece of text."""
    # Two pieces of one text follow each other only across an overlap, whose places are marked -1.
    place = np.flatnonzero(owner >= 0)
    value = np.zeros(len(points), dtype=np.uint64)
    for length in range(1, LONGEST + 1):
        shifted = points[length - 1 :].astype(np.uint64)
        value[: len(shifted)] = value[: len(shifted)] * _FACTORS[1] + (shifted + np.uint64(length)) * _FACTORS[0]
        inside = place[place + length <= len(points)]
        last = owner[inside + length - 1]
        inside = inside[(last == owner[inside]) | (last < 0)]
        spread = value[inside] ^ (value[inside] >> np.uint64(29))
        spread = (spread * _FACTORS[2]) >> np.uint64(40)
        yield (spread & np.uint64(buckets - 1)).astype(np.int64), owner[inside]


def _counted(buckets: int, languages: list[str]):
    known = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(known), buckets), dtype=np.int64)
        for batch in batches:
            kinds = np.array([known.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            chosen = np.flatnonzero(kinds >= 0)
            kinds = kinds[chosen]
            for points, owner in text_parts(batch.column("text").take(pa.array(chosen)).to_pylist()):
                for bucket, text in grams(points, owner, buckets):
                    np.add.at(table, (kinds[text], bucket), 1)
        at = np.flatnonzero(table)
        for first in range(0, len(at), 1 << 16):
            part = at[first : first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(table.ravel()[part])], names=["cell", "n"])

    return count


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """Learn from all rows that are not held out and have a text and a language.

    At most ``LANGUAGES`` languages are learned, those with the most rows.
    """
    text_batches(docs.sparkSession)
    learned = docs.filter(~held_out(F.col(id_col))).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    found = learned.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()
    rows = sorted((r["lang"], r["n"]) for r in found)
    languages = [r[0] for r in rows]
    while buckets > 256 and buckets * len(languages) > MATRIX_CELLS:
        buckets //= 2
    if not languages:
        return Model([], np.zeros(0), np.zeros((buckets, 0)))
    cells = learned.mapInArrow(_counted(buckets, languages), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(languages) * buckets)
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    table = table.reshape(len(languages), buckets) + SMOOTHING
    prior = np.log([r[1] for r in rows]) - np.log(sum(r[1] for r in rows))
    return Model(languages, prior, np.ascontiguousarray((np.log(table) - np.log(table.sum(axis=1, keepdims=True))).T))


def log_likelihoods(texts: list[str | None], model: Model) -> np.ndarray:
    """Prior plus summed log probabilities of the grams of each text, one column per language."""
    sums = np.tile(model.prior, (len(texts), 1))
    step = max(1, PART_CELLS // max(1, len(model.languages)))
    for points, owner in text_parts(texts):
        for bucket, text in grams(points, owner, len(model.weights)):
            for first in range(0, len(bucket), step):
                own = text[first : first + step]
                turns = np.flatnonzero(np.diff(own, prepend=-1))
                sums[own[turns]] += np.add.reduceat(model.weights[bucket[first : first + step]], turns, axis=0)
    return sums


def predictions(text: Column, model: Model) -> Column:
    """Struct (lang_pred, score) of every whole text; the score is the language's posterior chance."""
    parts = model.languages, model.prior, model.weights
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    def predicted(texts: pa.Array) -> pa.Array:
        own, rows = Model(*parts), texts.to_pylist()
        names, chances = [NONE] * len(rows), np.zeros(len(rows))
        known = [i for i, x in enumerate(rows) if own.languages and x and _LETTER.search(x)]
        if known:
            sums = log_likelihoods([rows[i] for i in known], own)
            best = sums.argmax(axis=1)
            chances[known] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for i, j in zip(known, best):
                names[i] = own.languages[j]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(chances)], names=["lang_pred", "score"])

    return predicted(text)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score) of each row; an empty table gives no rows."""
    model = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), predictions(F.col(text_col), model).alias("_p"))
    return rows.select(id_col, "held_out", "_p.lang_pred", "_p.score")
