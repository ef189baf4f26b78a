"""Best-fit packing of token sequences by a configuration linear program.

Documents are tokenised and cut into pieces of at most ``CAPACITY`` tokens; only
the histogram of piece lengths, at most ``CAPACITY`` numbers, reaches the driver.
There the linear program over configurations (how many pieces of each length
share a sequence) is solved by multiplicative weights: lengths carry prices, which
fall as they are covered; a knapsack over prices finds the next configuration, which
is taken as often as a step allows, until every length is covered. Steps are whole
numbers, so rounding only undoes the least filled configurations, at most the largest of
``UNDONE`` of all sequences or ``FEW``, and packs their pieces best fit.
Every piece then finds its place from its rank among the pieces of its length.

Defined results: a null text is empty and has one piece with the end id; repeated rows and ids
are packed each by themselves; very long texts are encoded whole and cut into pieces; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.pieces import Remembered
from revrank.session import cut_lineage

CAPACITY = 4096
END = 1
_END = struct.pack("<I", END)
#: How fast the price of a token falls with the share of its length that is covered.
RATE = 0.02
#: Share of a length that one step may cover, and lengths that one knapsack chooses from.
STEP, CHOICE = 0.5, 192
#: Phases at most, rounds after which none begins, and how near the bound ends them.
PHASES, ROUNDS, GAP = 24, 12_000, 0.002
#: Shares of the sequences that rounding tries to undo (the fewest sequences win), and how many it may at least.
UNDONE, FEW = (0.0, 0.001, 0.01, 0.02, 0.04), 8
#: Rows that one task numbers within a length.
ROWS_PER_PART = 200_000


_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts that the tokenizer takes apart as ``_RUNS`` does: no apostrophes, no "<", no letters that combine.
_PLAIN = re.compile(rf"[ \n\t\x21-\x26\x28-\x3B\x3D-\x7E{_LATIN}]*")
_RUNS = re.compile(rf"[{_LATIN}]+|[0-9]|[^ \n\t0-9{_LATIN}]+")


class WordIds:
    """Ids of texts, as the tokenizers library gives them for the same file.

    The tokenizer drops white space and joins nothing across it, so a text's ids are
    those of its words; and those of a plain word are those of its runs of letters,
    digits and other signs, which go straight to the tokenizer's BPE model. What
    was in use lately is remembered, in bounded memory.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.signs = Remembered(lambda sign: "".join(part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(sign)))
        self.runs = Remembered(self._run)
        self.words = Remembered(self._word)

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else "".join(map(self.signs.__getitem__, run))
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return self._runs(word)
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _runs(self, text: str) -> bytes:
        return b"".join(map(self.runs.__getitem__, _RUNS.findall(text.lower())))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text (null: empty) and ``END``."""
        if _PLAIN.fullmatch(text := text or ""):
            raw = self._runs(text)
        else:
            raw = b"".join(map(self.words.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))
        return np.frombuffer(raw + _END, dtype="<u4")


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


_PIECE = [("piece", pa.int32(), T.IntegerType()), ("start", pa.int64(), T.LongType()), ("length", pa.int64(), T.LongType()), ("ids_crc32", pa.int64(), T.LongType())]
_PIECES = functools.reduce(lambda s, f: s.add(f[0], f[2]), _PIECE, T.StructType())
_PIECE_TYPE = pa.struct([(name, kind) for name, kind, _ in _PIECE])


def pieces(text: Column, tokenizer_file: str, capacity: int = CAPACITY) -> Column:
    """array<struct> of a text's pieces: number, start, length, CRC-32 of the ids."""

    @F.arrow_udf(T.ArrayType(_PIECES))
    def cut(texts: pa.Array) -> pa.Array:
        encode, out = word_ids(tokenizer_file).encode, []
        for ids in map(encode, texts.to_pylist()):
            own = []
            for number, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                own.append({"piece": number, "start": start, "length": len(part), "ids_crc32": zlib.crc32(part.tobytes())})
            out.append(own)
        return pa.array(out, type=pa.list_(_PIECE_TYPE))

    return cut(text)


def knapsack(prices: np.ndarray, lengths: np.ndarray, copies: np.ndarray, room: int) -> list[int]:
    """Dearest content of ``room``, with at most so many (and three) pieces of each length."""
    sizes, worth = [], []
    for price, length, most in zip(prices.tolist(), lengths.tolist(), np.minimum(copies, 3).tolist()):
        for times in ((1,), (1, 1), (1, 2))[most - 1]:
            if times * length <= room:
                sizes.append(times * length)
                worth.append((times * price, times, length))
    best = np.zeros(room + 1)
    taken = np.zeros((len(sizes), room + 1), dtype=bool)
    for own, size, (value, _, _) in zip(taken, sizes, worth):
        offered = best[: room + 1 - size] + value
        np.greater(offered, best[size:], out=own[size:])
        np.maximum(offered, best[size:], out=best[size:])
    out = []
    for own, size, (_, times, length) in zip(taken[::-1], sizes[::-1], worth[::-1]):
        if own[room]:
            out += [length] * times
            room -= size
    return out


def covering(histogram: np.ndarray, base: np.ndarray, rate: float = RATE, step: float = STEP, choice: int = CHOICE, seed: int = 1) -> list[tuple[tuple, int]]:
    """Configurations and how often, in the order they were taken; together exactly all pieces.

    ``histogram[n]`` is the number of pieces of length n. A piece's price is ``base[n]`` ×
    exp(-``rate`` × the covered share of its length), so lengths are covered evenly. Each
    round the least covered length is put into a sequence and a knapsack over it and the
    ``choice`` next least covered lengths fills the rest; this is taken until one of its lengths is
    used up or a share ``step`` of one is covered. The number of rounds depends on the number of
    lengths, not on the corpus.
    """
    random = np.random.default_rng(seed)
    capacity = len(histogram) - 1
    found = [((capacity,), int(histogram[capacity]))] if histogram[capacity] else []
    lengths = np.flatnonzero(histogram[:capacity])
    wanted = histogram[lengths]
    left = wanted.copy()
    while len(open_ := np.flatnonzero(left)):
        covered = 1.0 - left[open_] / wanted[open_]
        first = open_[np.argmin(covered - lengths[open_] * 1e-9)]
        # One half are the least covered lengths, the other any: short lengths alone would not fill a sequence.
        order = np.where(random.random(len(open_)) < 0.5 * choice / len(open_), -1.0, covered + random.random(len(open_)) * 0.05)
        chosen = open_ if len(open_) <= choice else open_[np.argpartition(order, choice)[:choice]]
        prices = base[lengths[chosen]] * np.exp(-rate * (1.0 - left[chosen] / wanted[chosen]))
        copies = left[chosen] - (chosen == first)
        chosen, prices, copies = chosen[copies > 0], prices[copies > 0], copies[copies > 0]
        group = tuple(sorted([int(lengths[first]), *knapsack(prices, lengths[chosen], copies, capacity - int(lengths[first]))], reverse=True))
        need = Counter(group)
        at, each = np.searchsorted(lengths, list(need)), np.array([*need.values()])
        times = max(1, int((np.minimum(left[at], np.ceil(wanted[at] * step)) // each).min()))
        found.append((group, times))
        left[at] -= times * each
    return found


def solution(histogram: np.ndarray) -> list[tuple[tuple, int]]:
    """The covering with the fewest sequences of a few phases.

    Where sequences can be filled, every token costs the same, and the first phase is near the
    bound that tokens set. Else pieces have to bear the room that stays empty around them: each
    configuration's cost is dealt to its pieces by their prices, and a length's next
    price is multiplied by what it has borne.
    """
    capacity = len(histogram) - 1
    bound = -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
    base = np.arange(capacity + 1) / capacity
    best: list[tuple[tuple, int]] = []
    fewest, rounds = None, 0
    for _ in range(PHASES):
        found = covering(histogram, base)
        n = sum(times for _, times in found)
        if fewest is None or n < fewest:
            best, fewest = found, n
        rounds += len(found)
        if n <= bound * (1 + GAP) + 1 or rounds >= ROUNDS:
            break
        borne = np.zeros(capacity + 1)
        for group, times in found:
            worth = base[list(group)].sum()
            for n in group:
                borne[n] += times / worth
        base = np.where(histogram > 0, base * borne / np.maximum(histogram, 1), base)
    return best


def best_fit(left: np.ndarray) -> Counter:
    """Configurations for the histogram ``left``: longest first, each into the fullest sequence with room.

    Sequences of one content are one entry, so the work depends on the number of lengths.
    """
    capacity = len(left) - 1
    by_room: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            at = np.flatnonzero(filled[length:])
            if len(at):
                room = int(at[0]) + length
                group, times = by_room[room].popitem()
                filled[room] = bool(by_room[room])
                used = min(times, count)
                if times > used:
                    by_room[room][group] = times - used
                    filled[room] = True
                each = 1
            else:
                room, group = capacity, ()
                each = min(capacity // length, count)
                used = count // each
            to = room - each * length
            new = (*group, *[length] * each)
            by_room[to][new] = by_room[to].get(new, 0) + used
            filled[to] = True
            count -= used * each
    return Counter({group: times for rooms in by_room for group, times in rooms.items()})


@dataclass(frozen=True)
class Plan:
    """Whole configurations, and for each length the places they give, by rank.

    Places ``first <= rank < first + each * times`` of a length belong to one
    configuration: ``each`` of them a sequence, from sequence ``base`` on and there
    from ``offset`` on.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks."""
        span = np.int64(1) << 48
        at = np.searchsorted(self.length * span + self.first, length * span + rank, "right") - 1
        nth = rank - self.first[at]
        return self.base[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def rounded(found: list[tuple[tuple, int]], capacity: int, undone: float) -> Counter:
    """Whole configurations: of ``found`` the least filled and then the last ones are undone, a share ``undone``
    of all sequences (and a few at least), and their pieces packed best fit."""
    whole: Counter = Counter()
    left = np.zeros(capacity + 1, dtype=np.int64)
    allowed = max(FEW, int(undone * sum(times for _, times in found))) if undone else 0
    for group, times in sorted(reversed(found), key=lambda x: sum(x[0])):
        loose = min(times, allowed)
        allowed -= loose
        for n in group:
            left[n] += loose
        if times > loose:
            whole[group] += times - loose
    return whole + best_fit(left)


def plan(histogram: np.ndarray) -> Plan:
    """Configurations with exactly the pieces of ``histogram``; of several shares to undo the one with the
    fewest sequences counts, and of those the smallest."""
    found = solution(histogram)
    whole = min((rounded(found, len(histogram) - 1, undone) for undone in UNDONE), key=lambda w: sum(w.values()))
    rows, used, base = [], np.zeros(len(histogram), dtype=np.int64), 0
    for group, times in sorted(whole.items()):
        offset = 0
        for n, k in sorted(Counter(group).items(), reverse=True):
            rows.append((n, used[n], k, base, offset))
            used[n] += k * times
            offset += k * n
        base += times
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=base)


def ranked(cut: DataFrame, parts: int) -> DataFrame:
    """``cut`` with ``rank``, its pieces' number from 0 among those of equal length.

    A length may be that of very many pieces, so each is dealt to ``parts`` parts by
    a hash; parts are numbered by themselves and begin where the ones before end.
    """
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("row", "piece")
    numbered = dealt.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth")).drop("part", "before", "nth")


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and has one piece with the end id. Repeated rows and ids are
    packed each by themselves; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    cut = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), pieces(F.col(text_col), tokenizer_file, capacity).alias("p"))
    cut = cut_lineage(cut.select("id", "row", F.explode("p").alias("p")).select("id", "row", "p.*"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["count"]
    own = plan(histogram)
    parts = 16 + int(histogram.sum() // ROWS_PER_PART)
    shared = spark.sparkContext.broadcast(own)  # a few rows for each length

    @F.arrow_udf(T.StructType().add("sequence_id", T.LongType()).add("offset", T.LongType()))
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = shared.value.place(length.to_numpy(zero_copy_only=False).astype(np.int64), rank.to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.StructArray.from_arrays([pa.array(x, type=pa.int64()) for x in found], names=["sequence_id", "offset"])

    placed = ranked(cut, parts).withColumn("at", place("length", "rank"))
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "at.*")
