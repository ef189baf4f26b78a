"""Phrase collocations from a weighted de Bruijn graph of words, per language.

1. **Edges.** At every word of a piece the longest gram that starts there (four words, fewer
   at the piece's end) is written as four 32-bit numbers of words. Tasks add up equal ones in
   bounded parts of text; one shuffle by the first two words brings equal grams together.
2. **Flow.** A sweep over the sorted grams adds them up: four words are an edge between two
   overlapping nodes of three; a node's count is the flow out of it plus the pieces that end
   with it; counts of two words and of one follow from it in the same way.
3. **Compaction.** Frequent edges joined at nodes with one way in and one way out, both of the
   node's own weight, are contracted to paths by pointer doubling. A node inside a path has a
   longer phrase of the same count around it and is dropped without any search.
4. **Texts.** The corpus is read once more for the words of the grams that counted often
   enough. This is an exact check as well: where two texts share one set of numbers, they are
   counted by text in a third reading. Shared numbers only add up, so no phrase is missed.

Defined results: a null language is ``und``, a null text is empty, repeated rows count each,
very long texts are read whole, in parts within a task. An empty table gives no rows, and so
does a language without candidates. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revrank.llm.common import text_batches
from revrank.llm.words import Words, mix, slices
from revrank.session import cut_lineage

LONGEST = 4
#: Bytes of text whose grams a task adds up at once.
PART_BYTES = 1 << 21
#: Texts a task of the second reading remembers to have written.
KNOWN = 1 << 20
#: Rows of sorted grams handled at once.
SWEEP_ROWS = 1 << 19
#: Bits that mark frequent grams for the second reading: 16 a gram, within these bounds (16 MB).
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 27

NONE = "und"
_SPLITS = np.zeros(256, dtype=bool)
_SPLITS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_SPLITS
_WORD[[0x20, 0x09]] = False


class Grams:
    """The longest gram at every word of some texts: ``numbers`` has a column per word, 0 past the end of its piece."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        words = Words(texts, _WORD)
        self.words, self.langs = words, langs
        splits = np.cumsum(_SPLITS[words.data])[words.start]
        follows = np.zeros(len(words.start), dtype=bool)
        follows[:-1] = (words.doc[1:] == words.doc[:-1]) & (splits[1:] == splits[:-1])
        number = (mix(words.hashes() ^ langs[words.doc]) >> np.uint64(32)).astype(np.uint32)
        number[number == 0] = 1
        self.numbers = np.zeros((len(number), LONGEST), dtype=np.uint32)
        self.numbers[:, 0] = number
        goes_on = np.ones(len(number), dtype=bool)
        for j in range(1, LONGEST):
            goes_on[: len(number) - j + 1] &= follows[j - 1 :]
            goes_on[max(0, len(number) - j) :] = False
            own = np.flatnonzero(goes_on)
            self.numbers[own, j] = number[own + j]

    def keys(self, n_words: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
        """First and second half of the number of the first ``n_words`` words."""
        wide = self.numbers.astype(np.uint64)
        wide[:, n_words:] = 0
        return tuple((wide[:, i] << np.uint64(32) | wide[:, i + 1]).view(np.int64) for i in (0, 2))

    def text(self, at: int, n_words: int) -> str:
        words = self.words
        parts = (words.data[words.start[i] : words.end[i]].tobytes() for i in range(at, at + n_words))
        return b" ".join(parts).decode("utf-8", "surrogatepass")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, list[str]]]:
    """Texts in parts of about PART_BYTES, with each text's language."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0

    def made() -> tuple[Grams, list[str]]:
        known = {x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for x in set(langs)}
        return Grams(texts, np.array([known[x] for x in langs], dtype=np.uint64)), langs

    for batch in batches:
        kinds = iter(batch.column("lang").to_pylist())
        for part in slices(batch.column("text").to_pylist(), PART_BYTES):
            for raw in part:
                kind = next(kinds)
                if raw:
                    texts.append(raw)
                    langs.append(kind)
                    size += len(raw)
                if size >= PART_BYTES:
                    yield made()
                    texts, langs, size = [], [], 0
    if texts:
        yield made()


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for grams, _ in _grams(batches):
        high, low = grams.keys()
        if not len(high):
            continue
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = _runs(high, low)
        amount = np.diff(first, append=len(high))
        for i in range(0, len(first), 1 << 16):
            at = first[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(high[at]), pa.array(low[at]), pa.array(amount[i : i + (1 << 16)])], names=["high", "low", "n"])


class _Level:
    """Sums of runs of equal keys over a sorted stream; the last run stays open."""

    def __init__(self, n_words: int):
        self.n_words = n_words
        self.open: tuple[int, int, int] | None = None

    def add(self, high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Closed runs of this level's grams; rows that are shorter are left out."""
        if self.n_words == 4:
            own = (low & 0xFFFFFFFF) != 0
        elif self.n_words == 3:
            low, own = (low >> 32) << 32, low != 0
        else:
            low, own = np.zeros_like(low), (high & 0xFFFFFFFF) != 0
        high, low, n = high[own], low[own], n[own]
        if self.open:
            high, low, n = (np.concatenate([[x], y]) for x, y in zip(self.open, (high, low, n)))
        if not len(high):
            return high, low, n
        first = _runs(high, low)
        sums = np.add.reduceat(n, first)
        high, low = high[first], low[first]
        self.open = int(high[-1]), int(low[-1]), int(sums[-1])
        return high[:-1], low[:-1], sums[:-1]

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = [self.open] if self.open else []
        self.open = None
        return tuple(np.array([r[i] for r in rows], dtype=np.int64) for i in range(3))


def _swept(least: int):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [_Level(j) for j in range(LONGEST, 1, -1)]

        def frequent(n_words: int, found: tuple) -> Iterator[pa.RecordBatch]:
            high, low, n = found
            keep = n >= least
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(keep.sum(), n_words, dtype=np.int32)), *(pa.array(x[keep]) for x in (high, low, n))], names=["n_words", "high", "low", "n"])

        def handled(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            high, low, n = (np.concatenate([b.column(c).to_numpy() for b in rows]) for c in ("high", "low", "n"))
            for level in levels:
                yield from frequent(level.n_words, level.add(high, low, n))
            word = (high >> 32) << 32
            order = np.argsort(word, kind="stable")
            first = _runs(word[order])
            sums = np.add.reduceat(n[order], first)
            word = word[order][first]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(word), dtype=np.int32)), pa.array(word), pa.array(np.zeros_like(word)), pa.array(sums)], names=["n_words", "high", "low", "n"])

        rows: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            rows.append(batch)
            size += batch.num_rows
            if size >= SWEEP_ROWS:
                yield from handled(rows)
                rows, size = [], 0
        if size:
            yield from handled(rows)
        for level in levels:
            yield from frequent(level.n_words, level.close())

    return sweep


def frequent_grams(texts: DataFrame, least: int) -> DataFrame:
    """(n_words, high, low, n) of all grams of 1 to 4 words that occur ``least`` times or more, by their numbers."""
    edges = texts.mapInArrow(_edges, "high long, low long, n long")
    sorted_edges = edges.repartition("high").sortWithinPartitions("high", "low")
    swept = cut_lineage(sorted_edges.mapInArrow(_swept(least), "n_words int, high long, low long, n long"))
    words = swept.filter("n_words = 1").groupBy("n_words", "high", "low").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return cut_lineage(swept.filter("n_words > 1").unionByName(words))


def _node_after(high: Column, low: Column) -> tuple[Column, Column]:
    """The last three words of four."""
    mask = F.lit(0xFFFFFFFF)
    left = F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(F.shiftrightunsigned(low, 32))
    return left, F.shiftleft(low.bitwiseAND(mask), 32)


def compacted_paths(grams: DataFrame) -> DataFrame:
    """(high, low, path_high, path_low, place): each frequent edge, the first edge of its path and its place there from 0.

    An edge follows another in a path if the node between them has no other frequent edge
    and both carry the node's whole count, so that all occurrences run through. Paths are
    contracted by pointer doubling, in as many rounds as the logarithm of the longest. A
    closed ring of edges keeps going round; its edges stay paths of their own.
    """
    edges = grams.filter("n_words = 4").select("high", "low", "n")
    start = (F.col("high"), F.shiftleft(F.shiftrightunsigned("low", 32), 32))
    end = _node_after(F.col("high"), F.col("low"))
    nodes = grams.filter("n_words = 3").select(F.col("high").alias("v_high"), F.col("low").alias("v_low"), F.col("n").alias("v_n"))
    ways_in = edges.groupBy(end[0].alias("v_high"), end[1].alias("v_low")).agg(F.count("*").alias("n_in"), F.first("high").alias("before_high"), F.first("low").alias("before_low"), F.first("n").alias("in_n"))
    ways_out = edges.groupBy(start[0].alias("v_high"), start[1].alias("v_low")).agg(F.count("*").alias("n_out"), F.first("high").alias("high"), F.first("low").alias("low"), F.first("n").alias("out_n"))
    unary = nodes.join(ways_in, ["v_high", "v_low"]).join(ways_out, ["v_high", "v_low"])
    unary = unary.filter("n_in = 1 AND n_out = 1 AND in_n = v_n AND out_n = v_n AND NOT (high = before_high AND low = before_low)")
    links = edges.select("high", "low").join(unary.select("high", "low", "before_high", "before_low"), ["high", "low"], "left")
    moving = F.col("before_high").isNotNull()
    at = cut_lineage(links.select(
        "high", "low", F.coalesce("before_high", "high").alias("path_high"), F.coalesce("before_low", "low").alias("path_low"),
        F.when(moving, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("place"), moving.alias("open"),
    ))
    n_edges = at.count()
    reach = 1
    while reach < 2 * n_edges and not at.filter("open").isEmpty():
        reach *= 2
        onward = at.select(F.col("high").alias("path_high"), F.col("low").alias("path_low"), F.col("path_high").alias("to_high"), F.col("path_low").alias("to_low"), F.col("place").alias("more"))
        # A path's first edge points to itself with nothing more to go.
        at = cut_lineage(at.join(onward, ["path_high", "path_low"]).select(
            "high", "low", F.col("to_high").alias("path_high"), F.col("to_low").alias("path_low"), (F.col("place") + F.col("more")).alias("place"), (F.col("open") & (F.col("more") > 0)).alias("open")
        ))
    ring = F.col("open")
    return at.select("high", "low", F.when(ring, F.col("high")).otherwise(F.col("path_high")).alias("path_high"), F.when(ring, F.col("low")).otherwise(F.col("path_low")).alias("path_low"), F.when(ring, F.lit(0)).otherwise(F.col("place")).alias("place"))


def _texts(marks: np.ndarray, counted: bool):
    """Grams whose numbers are marked, with their texts, and the number of words of each language.

    With ``counted`` the occurrences in each part of text as ``n``; else a text comes once
    a task (again if the memory of ``KNOWN`` texts is full), with ``n`` 0.
    """
    mask = np.uint64(len(marks) * 8 - 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, dtype=np.uint64)
        for grams, langs in _grams(batches):
            doc = grams.words.doc
            columns: list[list] = [[], [], [], [], [], []]
            total: dict[str, int] = {}
            for lang, amount in zip(langs, np.bincount(doc, minlength=len(langs)).tolist()):
                total[lang] = total.get(lang, 0) + amount
            names = sorted(total)
            for lang in names:
                for c, v in zip(columns, (0, 0, 0, lang, "", total[lang])):
                    c.append(v)
            kind = np.array([names.index(x) for x in langs], dtype=np.int64)[doc]
            full = grams.words.hashes() ^ grams.langs[doc]
            for n_words in range(1, LONGEST + 1):
                high, low = grams.keys(n_words)
                spot = _spot(n_words, high, low) & mask
                hit = (marks[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1
                at = np.flatnonzero((hit == 1) & (grams.numbers[:, n_words - 1] != 0))
                # Grams with equal numbers are told apart by the full hashes of their words.
                key = np.full(len(at), n_words, dtype=np.uint64)
                for j in range(n_words):
                    key = mix(key * np.uint64(3) + full[at + j])
                key, first, amount = np.unique(key, return_index=True, return_counts=True)
                at = at[first]
                if not counted:
                    new = ~np.isin(key, known, assume_unique=True)
                    known = np.concatenate([known, key[new]]) if len(known) < KNOWN else key
                    at, amount = at[new], np.zeros(int(new.sum()), dtype=np.int64)
                for c, v in zip(columns, ([n_words] * len(at), high[at].tolist(), low[at].tolist(), [names[i] for i in kind[at]], [grams.text(i, n_words) for i in at], amount.tolist())):
                    c.extend(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string()), pa.array(columns[5], pa.int64())],
                names=["n_words", "high", "low", "lang", "phrase", "n"],
            )

    return read


def _spot(n_words: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(mix(high.view(np.uint64) + np.uint64(n_words)) ^ low.view(np.uint64))


def _bits(grams: DataFrame) -> np.ndarray:
    """One bit for every gram at its spot, 16 a gram, at most MOST_BITS in all."""
    bits = LEAST_BITS
    wanted = 16 * grams.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    mask = np.uint64(bits - 1)

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            high, low, n_words = (b.column(c).to_numpy() for c in ("high", "low", "n_words"))
            yield pa.RecordBatch.from_arrays([pa.array((_spot(n_words.astype(np.uint64), high, low) & mask).view(np.int64))], names=["spot"])

    found = grams.select("high", "low", "n_words").mapInArrow(spots, "spot long")
    pieces = found.groupBy(F.shiftright("spot", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("spot").bitwiseAND(F.lit(32767))).alias("bits"))
    marks = np.zeros(bits // 8, dtype=np.uint8)
    for r in pieces.collect():
        marks[r["piece"] * 4096 : (r["piece"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return marks


def counted_phrases(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 4 words with ``least`` or more occurrences as (n_words, lang, phrase, n, within),
    where ``within`` marks nodes inside a compacted path, and (lang, n_all): all words of each language."""
    text_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(NONE)).alias("lang"))
    grams = frequent_grams(texts, least)
    paths = compacted_paths(grams)
    # The node before an edge that isn't the first of its path lies within the path.
    inner = paths.filter("place > 0").select(F.lit(3).alias("n_words"), "high", F.shiftleft(F.shiftrightunsigned("low", 32), 32).alias("low"), F.lit(True).alias("within"))
    keys, row = ["n_words", "high", "low"], ["n_words", "high", "low", "lang", "phrase"]
    schema = "n_words int, high long, low long, lang string, phrase string, n long"
    found = texts.mapInArrow(_texts(_bits(grams), counted=False), schema)
    found = cut_lineage(found.groupBy(*row).agg(F.sum("n").alias("n_words_seen")))
    totals = found.filter("n_words = 0").select("lang", F.col("n_words_seen").alias("n_all"))
    real = found.filter("n_words > 0").select(*row).join(grams, keys).join(inner, keys, "left").withColumn("within", F.coalesce("within", F.lit(False)))
    shared = cut_lineage(real.groupBy(*keys).agg(F.count("*").alias("n_texts")).filter("n_texts > 1").select(*keys))
    if not shared.isEmpty():
        recount = texts.mapInArrow(_texts(_bits(shared), counted=True), schema).join(shared, keys, "left_semi")
        recount = recount.groupBy(*row).agg(F.sum("n").alias("n"), F.lit(False).alias("within"))
        real = real.join(shared, keys, "left_anti").unionByName(recount, allowMissingColumns=True)
    counted = real.filter(F.col("n") >= least).select("n_words", "lang", "phrase", "n", "within")
    return cut_lineage(counted), totals


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``most`` best phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    counted, totals = counted_phrases(docs, least, text_col, lang_col)
    phrases = counted.filter("n_words > 1").select("n_words", "lang", "phrase", F.col("n").alias("a"), "within")
    size = F.col("n_words")

    # Drop what a longer phrase explains.
    def inside(n: int) -> DataFrame:
        starts = F.sequence(F.lit(1), size - F.lit(n - 1))
        parts = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(F.split("phrase", " "), i, F.lit(n))))
        return phrases.filter(size > n).select("lang", F.col("a").alias("longer"), F.explode(parts).alias("phrase"))

    above = inside(2).unionByName(inside(3)).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    exact = "decimal(38,0)"
    left = phrases.filter("NOT within").join(above, ["lang", "phrase"], "left")
    left = left.filter(F.col("longer").isNull() | (F.col("longer").cast(exact) * 100 < F.col("a").cast(exact) * 80))

    # Every cut of a phrase, scored.
    cuts = left.select("n_words", "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    words = F.split("phrase", " ")
    cuts = cuts.withColumn("first", F.concat_ws(" ", F.slice(words, 1, F.col("cut")))).withColumn("rest", F.concat_ws(" ", F.slice(words, F.col("cut") + 1, LONGEST)))
    counts = counted.select("lang", "phrase", "n")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("n_all").alias("n"), F.col("score").cast("long").alias("score"))
