"""Near duplicates by word shingles: a multi-index Hamming join of b-bit MinHash signatures.

A signature has ``CHUNKS * CHUNK`` places of ``BITS`` bits. It is split into
chunks; for every chunk each way of leaving out ``ERRORS`` places is a key, so
two signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` places have a
key in common (pigeonhole). With 10 chunks of 4 places and one error that is 19
of 40 places; a pair of similarity 0.75 differs in 10 on average, and misses all
keys with a probability of 1.5e-6. Pairs that share a key are confirmed on
their full shingle sets, however many places differ.

Groups of any size are worked through without listing their pairs:

1. equal sets are one class, and only its representative takes part;
2. every key's documents are compared with one of them, the smallest id, and
   the confirmed links are joined to components;
3. where a key still holds several components, the remaining pairs across
   components are tried, each under the first key it shares only, and only if
   there is room for the similarity: shingles of the key's compared document
   that both have, as bits, and shingles beyond it that are in any other set.

A pair inside one component is never needed, so the components are those of all
links between documents that share a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.common import bounded_broadcast, components
from revrank.llm.words import NOT_SPACE, Words, shingles, slices
from revrank.session import cut_lineage

SHINGLE = 5
CHUNKS, CHUNK, ERRORS, BITS = 10, 4, 1, 16
PLACES = CHUNKS * CHUNK
#: Every pair that differs in at most so many places has a key in common.
REACH = CHUNKS * (ERRORS + 1) - 1
SEED = 7

_random = np.random.Generator(np.random.PCG64(SEED))
_TURN = _random.integers(0, 2**63, PLACES, dtype=np.uint64)
_FACTOR = _random.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SKETCH = T.StructType().add("n_shingles", T.LongType()).add("digest", T.BinaryType()).add("places", T.ArrayType(T.IntegerType()))


def shingle_sets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of ``texts``: hashes of all shingles, and each text's first row in them."""
    for part in slices(texts):
        words = Words(part, NOT_SPACE)
        yield shingles(words, words.hashes(), SHINGLE)


def sketches(texts: list[str | None]) -> list[dict]:
    import hashlib

    out = []
    for values, first in shingle_sets(texts):
        filled = np.flatnonzero(np.diff(first) > 0)
        places = np.zeros((len(first) - 1, PLACES), dtype=np.int32)
        for k in range(PLACES if len(filled) else 0):
            least = np.minimum.reduceat((values ^ _TURN[k]) * _FACTOR[k], first[filled])
            places[filled, k] = (least >> np.uint64(64 - 24 - BITS)).astype(np.uint64) & np.uint64((1 << BITS) - 1)
        for i in range(len(first) - 1):
            own = np.unique(values[first[i] : first[i + 1]])
            out.append(
                {"n_shingles": len(own), "digest": hashlib.blake2b(own.tobytes(), digest_size=16).digest(), "places": places[i]}
                if len(own)
                else {"n_shingles": 0, "digest": None, "places": None}
            )
    return out


_SKETCH_TYPE = pa.struct([("n_shingles", pa.int64()), ("digest", pa.binary()), ("places", pa.list_(pa.int32()))])


@F.arrow_udf(SKETCH)
def sketch(texts: pa.Array) -> pa.Array:
    return pa.array(sketches(texts.to_pylist()), type=_SKETCH_TYPE)


@F.arrow_udf(T.BinaryType())
def shingle_set(texts: pa.Array) -> pa.Array:
    """The distinct shingle hashes, sorted, 8 bytes each."""
    return pa.array(
        [np.unique(v[f[i] : f[i + 1]]).tobytes() for v, f in shingle_sets(texts.to_pylist()) for i in range(len(f) - 1)],
        type=pa.binary(),
    )


@F.arrow_udf(T.ArrayType(T.LongType()))
def unpacked(sets: pa.Array) -> pa.Array:
    return pa.array([np.frombuffer(x, dtype=np.int64) for x in sets.to_pylist()], type=pa.list_(pa.int64()))


@F.arrow_udf(T.LongType())
def common(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(
        [
            len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), assume_unique=True))
            for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)
        ],
        type=pa.int64(),
    )


_OUTLINE = T.StructType().add("bits", T.ArrayType(T.LongType())).add("outside", T.LongType())


@F.arrow_udf(_OUTLINE)
def outline(centers: pa.Array, sets: pa.Array) -> pa.Array:
    """Which of the center's shingles a set has, as bits, and how many others it has."""
    out = []
    for x, y in zip(centers.to_pylist(), sets.to_pylist(), strict=True):
        center, own = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        has = np.isin(center, own, assume_unique=True)
        bits = np.packbits(np.concatenate([has, np.zeros(-len(has) % 64, dtype=bool)])).view(np.int64)
        out.append({"bits": bits, "outside": len(own) - int(has.sum())})
    return pa.array(out, type=pa.struct([("bits", pa.list_(pa.int64())), ("outside", pa.int64())]))


def keys(places: Column) -> Column:
    """One key for each chunk and place left out of it."""
    return F.array(
        *(
            F.xxhash64(F.lit(c * CHUNK + out), *(places[c * CHUNK + i] for i in range(CHUNK) if i != out))
            for c in range(CHUNKS)
            for out in range(CHUNK)
        )
    )


def similar(n_common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * n_common >= percent * (n_a + n_b - n_common)


def confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough."""
    sizes = reps.select("id", "n")
    sized = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    near = cut_lineage(sized.filter(F.least("n_a", "n_b") * 100 >= percent * F.greatest("n_a", "n_b")).select("a", "b").distinct())
    ids = cut_lineage(near.select(F.col("a").alias("id")).union(near.select("b")).distinct())
    sets = cut_lineage(texts.join(bounded_broadcast(ids), "id", "left_semi").select("id", shingle_set("text").alias("set")).distinct())
    both = near.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    ok = similar(common("s_a", "s_b"), F.length("s_a") / 8, F.length("s_b") / 8, percent)
    return both.filter(ok).select("a", "b").distinct()


def linked(reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of ``reps`` (id, n, places) that have the components of all links."""
    posted = cut_lineage(reps.select("id", "n", F.posexplode(keys(F.col("places"))).alias("slot", "key")))
    buckets = posted.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("size"))
    buckets = cut_lineage(buckets.filter("size > 1"))
    members = cut_lineage(posted.join(buckets, "key").select("key", "slot", "id", "n", "center", "size"))
    stars = members.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    links = cut_lineage(confirmed(stars, reps, texts, percent))

    found = cut_lineage(components(links))
    placed = members.filter("size > 2 AND id <> center").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = cut_lineage(placed.select("key", "slot", "id", "center", "component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    rest = cut_lineage(placed.join(mixed.select("key"), "key"))
    if rest.isEmpty():
        return links

    asked = cut_lineage(rest.select("id").union(rest.select("center")).distinct())
    sets = cut_lineage(texts.join(bounded_broadcast(asked), "id", "left_semi").select("id", shingle_set("text").alias("set")).distinct())
    # Shingles that only one of the documents in question has cannot be in common.
    alone = (
        sets.select("id", F.explode(unpacked("set")).alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
        .filter("id = last")
        .groupBy("id")
        .agg(F.count("*").alias("alone"))
    )
    outlined = (
        rest.select("center", "id")
        .distinct()
        .join(sets.toDF("center", "s_c"), "center")
        .join(sets, "id")
        .select("center", "id", outline("s_c", "set").alias("o"))
        .join(alone, "id", "left")
        .select("center", "id", "o.bits", (F.col("o.outside") - F.coalesce("alone", F.lit(0))).alias("free"))
    )
    known = rest.join(cut_lineage(outlined), ["center", "id"]).join(reps.select("id", "n", keys(F.col("places")).alias("keys")), "id")
    left = cut_lineage(known.drop("center"))
    a = left.select("key", *(F.col(c).alias(f"{c}_a") for c in left.columns if c != "key"))
    b = left.select(F.col("key").alias("key_b"), *(F.col(c).alias(f"{c}_b") for c in left.columns if c != "key"))
    inside = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    room = inside + F.least("free_a", "free_b")
    first = F.array_position(F.zip_with("keys_a", "keys_b", lambda x, y: x == y), True) - 1
    tried = a.join(
        b,
        (F.col("key") == F.col("key_b"))
        & (F.col("id_a") < F.col("id_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (F.least("n_a", "n_b") * 100 >= percent * F.greatest("n_a", "n_b"))
        & similar(room, F.col("n_a"), F.col("n_b"), percent)
        & (first == F.col("slot_a")),
    )
    more = confirmed(tried.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), reps, texts, percent)
    return links.union(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are linked from a Jaccard similarity of ``percent`` hundredths of their
    distinct 5-word shingles; a shorter text is one shingle, and a text without
    words, empty or null is linked with nothing and is its own component.
    component_id is the smallest id that links reach. Rows that repeat an id each
    get a row, and several texts of one id count as linked; a row is kept if it
    has its component's id. A row without an id has no component and is not kept.
    An empty table gives none. Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = cut_lineage(docs.select("id", sketch("text").alias("s")).select("id", "s.*"))
    with_set = rows.filter("digest IS NOT NULL AND id IS NOT NULL")
    classes = cut_lineage(
        with_set.groupBy("digest").agg(F.min("id").alias("rep"), F.min("n_shingles").alias("n"), F.min("places").alias("places"), F.count("*").alias("rows"))
    )
    reps = classes.select(F.col("rep").alias("id"), "n", "places")
    links = linked(reps, docs.filter("id IS NOT NULL"), percent)
    copies = with_set.select("digest", "id").join(classes.filter("rows > 1").select("digest", "rep"), "digest")
    found = cut_lineage(components(links.union(copies.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")))))
    component = F.coalesce("component", "id")
    return rows.join(found, "id", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
