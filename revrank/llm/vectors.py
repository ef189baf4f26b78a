"""Near duplicates of vectors by sorted projection passes.

In every pass the vectors of a label are ordered lexicographically by the signs of
random projections, and each is compared with its neighbours: all within a window of
``WINDOW`` places on either side. Pairs similar enough are links; components join the
links of all passes. The first signs make a bucket, whose number follows from the label's
size, and the number of passes follows from the signs: similar vectors have to share a
bucket in at least one pass. A bucket within a window is compared whole by it. One
that is longer, so that windows would be saturated, is compared by pairs of blocks, each
a task; so nothing depends on how many vectors share a bucket.

Equal vectors of a label are one class with a count, so copies of any number cost
nothing. Tasks count links and give spanning links of what is connected, so that links
are never listed; a pair that an earlier pass compared is not counted again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.common import components
from revrank.operators.ranking import BROADCAST_ROWS, global_rank
from revrank.session import cut_lineage

LEAST = 0.98
#: Neighbours on either side (and classes in a bucket if signs halve evenly), and rows of a block; a task compares two.
WINDOW, BLOCK = 512, 1024
SIGNS = 62
#: Share of pairs at the least similarity that all passes together may miss.
MISSED = 1e-4
LEAST_PASSES = 8
SEED = 11

_CLASS = T.StructType().add("size", T.IntegerType()).add("digest", T.BinaryType())


@F.arrow_udf(_CLASS)
def vector_class(vectors: pa.Array) -> pa.Array:
    """Dimension and digest of each usable vector; null for others."""
    out = []
    for row in vectors.to_pylist():
        usable = None
        if row and None not in row:
            x = np.array(row, dtype=np.float64) + 0.0  # one zero
            if np.isfinite(x).all() and x.any() and np.isfinite(norm := np.linalg.norm(x)) and norm > 0:
                usable = {"size": len(x), "digest": hashlib.blake2b(x.tobytes(), digest_size=16).digest()}
        out.append(usable)
    return pa.array(out, type=pa.struct([("size", pa.int32()), ("digest", pa.binary())]))


def pass_keys(passes: int, seed: int = SEED):
    """A function of vectors: one key for every pass."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(vectors: pa.Array) -> pa.Array:
        rows = [np.array(v, dtype=np.float64) for v in vectors.to_pylist()]
        out = np.zeros((len(rows), passes), dtype=np.int64)
        for size in {len(r) for r in rows}:
            at = [i for i, r in enumerate(rows) if len(r) == size]
            x = np.stack([rows[i] for i in at])
            for p in range(passes):
                planes = np.random.default_rng([seed, p, size]).normal(size=(size, SIGNS))
                out[at, p] = ((x @ planes) > 0) @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
        return pa.array(list(out), type=pa.list_(pa.int64()))

    return keys


def passes_for(signs: int, least: float, missed: float) -> int:
    """Passes with so many signs that pairs at ``least`` share a bucket but for a share of ``missed``."""
    if not signs:
        return 1
    agree = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    return max(LEAST_PASSES, math.ceil(math.log(missed) / math.log(1 - min(agree**signs, 1 - 1e-9))))


def linked_within(ok: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row it is connected with."""
    root = np.arange(len(ok))
    waiting = ok.any(axis=1)
    while waiting.any():
        first = int(waiting.argmax())
        front = np.array([first])
        waiting[first] = False
        while len(front):
            root[front] = first
            front = np.flatnonzero(ok[front].any(axis=0) & waiting)
            waiting[front] = False
    return root


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST,
    window: int = WINDOW,
    missed: float = MISSED,
    seed: int = SEED,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``vectors``.

    Rows are compared if labels (and dimensions) are equal and not null; vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing. n_links counts the other rows linked directly; component_id is the
    smallest id that links reach, for the unlinked their own. A row without an id
    takes part, but has a component only through others, and is not kept. Repeated rows count as
    rows of their own; vectors of any length are read whole; an empty table gives no rows; other
    columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    named = cut_lineage(rows.withColumn("c", F.when(F.col("label").isNotNull(), vector_class("vector"))).select("id", "label", "vector", "c.*"))
    usable = named.filter("digest IS NOT NULL")
    classes = usable.groupBy("label", "size", "digest").agg(F.min("id").alias("rep"), F.count("*").alias("rows"), F.min("vector").alias("vector"))
    # The number of a class is its own, since an id may repeat with other vectors.
    classes = cut_lineage(classes.withColumn("node", F.xxhash64("label", "size", "digest")))
    # Labels of more than one window: at most one for each ``window`` classes.
    large = classes.groupBy("label", "size").count().filter(F.col("count") > window)
    large = cut_lineage(large.withColumn("signs", F.ceil(F.log2(F.col("count") / window)).cast("int")).drop("count"))
    told = large.agg(F.count("*"), F.max("signs")).first()
    most = min(SIGNS, told[1] or 0)
    by_signs = [passes_for(k, least, missed) for k in range(most + 1)]

    signs = F.least(F.coalesce("signs", F.lit(0)), F.lit(most))
    signed = classes.join(F.broadcast(large) if told[0] <= BROADCAST_ROWS else large, ["label", "size"], "left").withColumn("signs", signs)
    signed = signed.withColumn("full", F.slice(pass_keys(max(by_signs), seed)("vector"), F.lit(1), F.array(*map(F.lit, by_signs))[F.col("signs")]))
    signed = cut_lineage(signed.withColumn("keys", F.expr(f"transform(full, k -> shiftright(k, {SIGNS} - signs))")))
    keyed = signed.select("label", "size", "node", "signs", F.posexplode("full").alias("pass", "full"))
    keyed = keyed.withColumn("key", F.expr(f"shiftright(full, {SIGNS} - signs)")).drop("signs")
    order = global_rank(keyed, "pass", "label", "size", "full", "node").items.drop("full")
    order = cut_lineage(order.withColumn("block", F.floor(F.col("rank") / BLOCK)))
    # A class has one place for each pass.
    places = order.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pass", "rank")))["rank"].alias("ranks"))
    reach = min(window, BLOCK)

    # Buckets that reach over several blocks: at most one for each end of a block.
    bucket = ["pass", "label", "size", "key"]
    wide = order.groupBy(*bucket).agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
    wide = cut_lineage(wide)
    wide = F.broadcast(wide) if wide.count() <= BROADCAST_ROWS else wide
    spread = order.join(wide, bucket, "left").join(signed.select("node", "rows", "vector", "keys").join(places, "node"), "node")
    place = F.col("rank") % BLOCK
    around = F.array(F.col("block"), F.when(place < reach, F.col("block") - 1), F.when(place >= BLOCK - reach, F.col("block") + 1))
    met = F.array_union(F.sequence(F.coalesce("low", "block"), F.coalesce("high", "block")), F.array_compact(around))
    spread = spread.withColumn("other", F.explode(met))
    spread = spread.select("*", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")).drop("low", "high", "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([*batches]).sort_by("rank").combine_chunks()
        block, node, rows = (table[n].to_numpy() for n in ("block", "node", "rows"))
        number, size = (table[n].to_numpy() for n in ("pass", "size"))
        label = np.array([str(x) for x in table["label"].to_pylist()])
        vectors, keys, ranks = (table[n].combine_chunks() for n in ("vector", "keys", "ranks"))
        across = table["one"][0].as_py() != table["two"][0].as_py()
        cut = np.zeros(len(node), dtype=bool)
        for x in (number, size, label):
            cut[1:] |= x[1:] != x[:-1]
        starts = [0, *np.flatnonzero(cut), len(node)]
        a_out, b_out, n_out = [], [], []
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            if end - start < 2:
                continue
            x = vectors[start:end].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(end - start, -1)
            k, r = (c[start:end].flatten().to_numpy().reshape(end - start, -1) for c in (keys, ranks))
            norm = np.sqrt((x * x).sum(axis=1))
            ok = np.triu((x @ x.T) / norm[:, None] / norm >= least, 1)
            if across:
                ok &= block[start:end][:, None] != block[start:end]
            one, two = np.nonzero(ok)

            def compared(p: int) -> np.ndarray:
                return (np.abs(r[one, p] - r[two, p]) <= reach) | (k[one, p] == k[two, p])

            # A pair that an earlier pass compared is found there.
            here = compared(int(number[start]))
            for p in range(int(number[start])):
                here &= ~compared(p)
            ok[one, two] = here
            ok |= ok.T
            at = np.flatnonzero(ok.any(axis=1))
            a_out.append(node[start:end][at])
            b_out.append(node[start:end][linked_within(ok)[at]])
            n_out.append((ok[at] @ rows[start:end]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*o, np.zeros(0, dtype=np.int64)])) for o in (a_out, b_out, n_out)], names=["a", "b", "n"]
        )

    links = cut_lineage(spread.groupBy("one", "two").applyInArrow(compare, "a long, b long, n long"))
    beyond = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("beyond"))
    found = components(links).toDF("node", "root")
    joined = classes.select("label", "size", "digest", "node", "rep", "rows").join(found, "node", "left").join(beyond, "node", "left")
    joined = cut_lineage(joined.withColumn("root", F.coalesce("root", "node")))
    least_id = joined.groupBy("root").agg(F.min("rep").alias("component"))
    known = joined.join(least_id, "root").select("label", "size", "digest", "component", (F.coalesce("beyond", F.lit(0)) + F.col("rows") - 1).alias("links"))
    out = named.select("id", "label", "size", "digest").join(known, ["label", "size", "digest"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
