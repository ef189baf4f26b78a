"""Prefix trie of conversations, built as a burst trie.

Equal conversations become one sequence with a count first. All sequences start as suffixes
in the container of the root. A container with too many suffixes, or with a very long one
among several, is burst: its suffixes move on by their next turn ids to containers under new
trie heads. Bursts take 1, 2, 4 … turns, so that a long common start costs few rounds. The
remaining containers are dealt to shards, sorted by turn ids and swept once from the first to
the last suffix, which gives their nodes. Sums over subtrees go from containers to the heads
above them. A long suffix that is alone in its container is a plain chain; its nodes are
made row by row and never gathered.

A turn's id is the MD5 of its role and text, a head's that of its path.

Defined results: rows without a conversation id are left out; a null role or text is empty; turns
with the same number (or none) go by their id, and a repeated row is a turn of its own. Very long
texts are only hashed and measured. An empty table gives no rows, not even a root. Further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators.ranking import global_rank, global_running_sum
from revrank.session import cut_lineage

#: Most suffixes in a container that is not burst.
CONTAINER = 4096
#: A container with more turns than this many a suffix allowed is burst as well.
MEAN_TURNS = 16
#: Longest suffix, in turns, of a container that is swept.
LONGEST = 1024
#: Most turns a burst takes at once.
STRIDE = 256
#: Ids written into one piece of the text that is hashed for a sequence's members.
PIECE_IDS = 4096

ROOT = hashlib.md5(b"").hexdigest()
ID = 32  # characters of a turn id
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv, turn, tid, size): the id of each turn and the UTF-8 bytes of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tid = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", tid.alias("tid"), F.octet_length(text).cast("long").alias("size"))
    return rows.filter("conv IS NOT NULL")


def rebuilt(turns: DataFrame, stems: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first h = crc32(c) mod ``most`` turns of c - c mod ``stems`` before its own after the first h.

    Gives (conv, d, tid, size) with places d from 1, and one row per conversation: (conv, n).
    A conversation is numbered by ranks over the sorted table, so one of any length is spread
    over many tasks; only the first ``most`` - 1 turns of a stem are copied.
    """
    ranked = global_rank(turns, "conv", F.col("turn").asc_nulls_first(), "tid").items.select("conv", "tid", "size", "rank")
    sizes = ranked.groupBy("conv").agg(F.min("rank").alias("first"), F.count("*").alias("n_own"))
    sizes = cut_lineage(sizes.select("*", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"), (F.col("conv") - F.col("conv") % stems).alias("stem")))
    stem_sizes = sizes.select(F.col("conv").alias("stem"), F.col("n_own").alias("n_stem"))
    convs = cut_lineage(sizes.join(stem_sizes, "stem", "left").withColumn("taken", F.least("h", F.coalesce("n_stem", F.lit(0)))))
    placed = ranked.join(convs.select("conv", "first", "h", "taken"), "conv").withColumn("pos", F.col("rank") - F.col("first"))
    own = placed.filter("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "tid", "size")
    starts = placed.filter((F.col("conv") % stems == 0) & (F.col("pos") < most - 1)).select(F.col("conv").alias("stem"), "pos", "tid", "size")
    lent = starts.join(convs.select("stem", "conv", "h"), "stem").filter("pos < h").select("conv", (F.col("pos") + 1).alias("d"), "tid", "size")
    length = F.col("taken") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))
    return cut_lineage(own.unionByName(lent)), convs.select("conv", length.alias("n"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members in pieces: ids of one sequence, comma-joined, with the first id."""
    key, ids, done = None, [], []

    def made(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)], names=["n", "x", "y", "conv", "ids"])

    for batch in batches:
        for n, x, y, conv in zip(*(batch.column(c).to_pylist() for c in ("n", "x", "y", "conv"))):
            if (n, x, y) != key or len(ids) == PIECE_IDS:
                if ids:
                    done.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (n, x, y), []
            ids.append(conv)
        if len(done) >= 512:
            yield made(done)
            done = []
    if ids:
        done.append((*key, ids[0], ",".join(map(str, ids))))
    if done:
        yield made(done)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one row per sequence: its first member and the hash of all ids. Pieces stream through the hash."""
    key, first, state, done = None, None, None, []

    def made(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["seq", "ends_sha256"])

    for batch in batches:
        for n, x, y, conv, ids in zip(*(batch.column(c).to_pylist() for c in ("n", "x", "y", "conv", "ids"))):
            if (n, x, y) != key:
                if state:
                    done.append((first, state.hexdigest()))
                key, first, state = (n, x, y), conv, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= 4096:
            yield made(done)
            done = []
    if state:
        done.append((first, state.hexdigest()))
    if done:
        yield made(done)


def sequences(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per distinct sequence: (seq, n, left) with the smallest member, members and turns; and (seq, ends_sha256).

    A conversation's identity is the exclusive or of two 64-bit hashes of its places and turn
    ids, with its length, so that no conversation is gathered. A SHA-256 reads its text
    from front to back; the ids of a sequence with very many members are written in pieces
    by many tasks and only these pieces pass through one.
    """
    marks = turns.groupBy("conv").agg(F.bit_xor(F.xxhash64("d", "tid")).alias("x"), F.bit_xor(F.xxhash64(F.lit("y"), "tid", "d")).alias("y"))
    named = cut_lineage(convs.join(marks, "conv", "left").select("conv", "n", F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y")))
    same = ["n", "x", "y"]
    pieces = named.select(*same, "conv").repartitionByRange(*same, "conv").sortWithinPartitions(*same, "conv")
    pieces = pieces.mapInArrow(_pieces, "n long, x long, y long, conv long, ids string")
    ends = pieces.repartition(*same).sortWithinPartitions(*same, "conv").mapInArrow(_digests, "seq long, ends_sha256 string")
    seqs = named.groupBy(*same).agg(F.min("conv").alias("seq"), F.count("*").alias("members")).select("seq", F.col("members").alias("n"), F.col("n").alias("left"))
    return cut_lineage(seqs), ends


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted suffixes. Only the nodes on the way to the last suffix are kept."""
    names = ["head", "level", "conv_id", "parent", "n", "n_children", "n_leaves", "saved", "seq"]
    kinds = [pa.string()] + [pa.int64()] * 8
    done: list[tuple] = []
    stack: list[list] = []  # smallest member, members, children, leaves, saved, size of the text, sequence that ends here
    head, last = None, ""

    def close(depth: int) -> None:
        while len(stack) > depth:
            conv, n, children, leaves, saved, size, seq = stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * size
            up = stack[-1] if stack else None
            if up:
                up[0], up[1], up[2], up[3], up[4] = min(up[0], conv), up[1] + n, up[2] + 1, up[3] + leaves, up[4] + saved
            done.append([head, len(stack) + 1, conv, None, n, children, leaves, saved, seq])
            # The smallest member of the node above is known when that closes.
            waiting.setdefault(len(stack), []).append(len(done) - 1)
            for child in waiting.pop(len(stack) + 1, ()):
                done[child][3] = conv

    waiting: dict[int, list[int]] = {}

    def made() -> pa.RecordBatch:
        rows = done.copy()
        done.clear()
        waiting.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for own_head, seq, n, ids, sizes in zip(*(batch.column(c).to_pylist() for c in ("head", "seq", "n", "ids", "sizes"))):
            common = 0
            if own_head != head:
                close(0)
                waiting.clear()
                head = own_head
                if len(done) >= 8192:
                    yield made()
            else:
                top = min(len(last), len(ids))
                while common * ID < top and last[common * ID : (common + 1) * ID] == ids[common * ID : (common + 1) * ID]:
                    common += 1
                close(common)
            for size in sizes[common:]:
                stack.append([seq, 0, 0, 0, 0, size, None])
            stack[-1][0], stack[-1][1], stack[-1][6] = min(stack[-1][0], seq), stack[-1][1] + n, seq
            last = ids
    close(0)
    if done:
        yield made()


def _chain(head: Column, steps: Column) -> Column:
    """Ids of the heads on the way from ``head`` by the given steps, ``head`` first."""
    return F.aggregate(steps, F.array(head), lambda way, step: F.concat(way, F.array(F.md5(F.concat(F.element_at(way, -1), step["tid"]).cast("binary")))))


def _gathered(rows: DataFrame, turns: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """``rows`` with ``steps``: their sequence's next turns in order, all or the next ``most`` ones (bounded by the caller)."""
    ahead = rows.join(turns, "seq").filter(F.col("d") > F.col("depth"))
    if most is not None:
        ahead = ahead.filter(F.col("d") <= F.col("depth") + most)
    return ahead.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("d", "tid", "size"))).alias("steps"))


def _burst(rows: DataFrame, heads: DataFrame, turns: DataFrame, stride: int) -> tuple[DataFrame, DataFrame]:
    """The heads made by moving every suffix of ``rows`` on by ``stride`` turns, and the suffixes under them."""
    keys = ["seq", "head", "depth", "n", "left"]
    moved = cut_lineage(_gathered(rows, turns, keys, stride).withColumn("way", _chain(F.col("head"), F.col("steps"))))
    nodes = moved.select("seq", "n", F.col("head").alias("start"), "depth", "way", F.posexplode("steps").alias("i", "step"))
    found = nodes.groupBy(F.col("way")[F.col("i") + 1].alias("head")).agg(
        F.first("start").alias("start"), F.first(F.col("way")[F.col("i")]).alias("parent"), F.first(F.col("depth") + F.col("i") + 1).alias("depth"),
        F.first(F.slice("way", F.lit(2), F.col("i") + 1)).alias("way"), F.min("seq").alias("conv_id"), F.sum("n").alias("n"), F.first("step.size").alias("size"),
    )
    above = heads.select(F.col("head").alias("start"), F.col("path").alias("path_above"))
    made = found.join(above, "start").select("head", "parent", "depth", "conv_id", "n", ((F.col("n") - 1) * F.col("size")).alias("own"), F.concat("path_above", "way").alias("path"))
    went = F.size("steps").cast("long")
    return cut_lineage(made), moved.select("seq", F.element_at("way", -1).alias("head"), (F.col("depth") + went).alias("depth"), "n", (F.col("left") - went).alias("left"))


def nodes(seqs: DataFrame, turns: DataFrame, container: int = CONTAINER, longest: int = LONGEST) -> DataFrame:
    """All nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, seq).

    ``seqs`` as by :func:`sequences`, ``turns`` their (seq, d, tid, size); ``seq`` is the sequence that ends in a node.
    """
    total = seqs.agg(F.min("seq").alias("conv_id"), F.sum("n").alias("n")).filter("n IS NOT NULL")
    heads = [cut_lineage(total.select(
        F.lit(ROOT).alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n", F.lit(0).cast("long").alias("own"), F.array(F.lit(ROOT)).alias("path")
    ))]
    active = seqs.select("seq", F.lit(ROOT).alias("head"), F.lit(0).cast("long").alias("depth"), "n", "left")
    settled, tails, ended = [], [], []
    stride = 1
    while True:
        active = cut_lineage(active)
        ended.append(active.filter("left = 0").select("head", "seq"))
        going = active.filter("left > 0")
        state = going.groupBy("head").agg(F.count("*").alias("n_seqs"), F.max("left").alias("longest"), F.sum("left").alias("turns"))
        alone, short = F.col("n_seqs") == 1, F.col("longest") <= longest
        small = short & (F.col("n_seqs") <= container) & (F.col("turns") <= MEAN_TURNS * container)
        way_on = F.when(alone & ~short, F.lit("chain")).when(alone | small, F.lit("sweep")).otherwise(F.lit("burst"))
        judged = cut_lineage(state.select("head", way_on.alias("way_on")))
        going = going.join(judged, "head")
        settled.append(going.filter("way_on = 'sweep'").drop("way_on"))
        tails.append(going.filter("way_on = 'chain'").drop("way_on"))
        if judged.filter("way_on = 'burst'").isEmpty():
            break
        made, active = _burst(going.filter("way_on = 'burst'").drop("way_on"), heads[-1], turns, stride)
        heads.append(made)
        stride = min(2 * stride, STRIDE)
    heads, settled, tails, ended = (reduce(DataFrame.unionByName, x) for x in (heads, settled, tails, ended))

    # Containers: sorted and swept, shard by shard.
    rows = _gathered(settled, turns, ["seq", "head", "n"])
    rows = rows.select("head", "seq", "n", F.array_join(F.col("steps.tid"), "").alias("ids"), F.col("steps.size").alias("sizes"))
    columns = "head string, level long, conv_id long, parent long, n long, n_children long, n_leaves long, saved long, seq long"
    swept = rows.repartition("head").sortWithinPartitions("head", "ids").mapInArrow(_sweep, columns)

    # Chains: every turn is a node; what lies below it is a difference of running sums.
    chains = cut_lineage(tails)
    if not chains.isEmpty():
        steps = chains.join(turns, "seq").filter("d > depth")
        steps = cut_lineage(global_running_sum(steps, "size", "seq", "d"))
        upto = steps.groupBy("seq").agg(F.max("running").alias("whole"), F.max("d").alias("deepest"))
        steps = steps.join(upto, "seq").withColumn("level", F.col("d") - F.col("depth"))
        end = F.col("d") == F.col("deepest")
        swept = swept.unionByName(steps.select(
            "head", "level", F.col("seq").alias("conv_id"), F.when(F.col("level") > 1, F.col("seq")).alias("parent"), "n",
            F.when(end, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            ((F.col("n") - 1) * (F.col("whole") - F.col("running") + F.col("size"))).alias("saved"), F.when(end, F.col("seq")).alias("seq"),
        ))
    swept = cut_lineage(swept)

    # Heads: what their containers hold goes up their paths.
    tops = swept.filter("level = 1").groupBy("head").agg(F.count("*").alias("c_children"), F.sum("n_leaves").alias("c_leaves"), F.sum("saved").alias("c_saved"))
    below = heads.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("head")).agg(F.count("*").alias("h_children"))
    known = heads.join(tops, "head", "left").join(below, "head", "left").join(ended.withColumnRenamed("seq", "end_seq"), "head", "left").na.fill(0, ["c_children", "c_leaves", "c_saved", "h_children"])
    known = cut_lineage(known.withColumn("n_children", F.col("c_children") + F.col("h_children")))
    leaf = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0))
    sums = known.select(F.explode("path").alias("head"), (leaf + F.col("c_leaves")).alias("leaves"), (F.col("own") + F.col("c_saved")).alias("saved"))
    sums = sums.groupBy("head").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    parents = heads.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    upper = known.join(sums, "head").join(parents, "parent", "left").select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("end_seq").alias("seq"))
    tops_of = heads.select("head", F.col("depth").alias("h_depth"), F.col("conv_id").alias("h_conv"))
    lower = swept.join(tops_of, "head").select(
        "conv_id", (F.col("h_depth") + F.col("level")).alias("depth"), F.coalesce("parent", "h_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "seq"
    )
    return upper.unionByName(lower)


def prefix_trie(conversations: DataFrame, container: int = CONTAINER, longest: int = LONGEST) -> DataFrame:
    """The trie over all rebuilt conversations, one row per node, with the hash of the members that end there."""
    turns, convs = rebuilt(turn_ids(conversations))
    seqs, ends = sequences(turns, convs)
    rows = cut_lineage(turns.withColumnRenamed("conv", "seq").join(seqs.select("seq"), "seq", "left_semi"))
    found = nodes(seqs, rows, container, longest)
    return found.join(ends, "seq", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    )
