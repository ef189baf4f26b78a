"""Interaction matrices, similarities and propagation, in long form.

A matrix is ``user_idx, item_idx, weight``. Products with the similarity matrix
S = D⁻¹ Wᵀ W D⁻¹ are computed as two sparse products with W, so that S, which is
quadratic in a popular key, is not needed for smoothing or scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from revrank.functions import expressions as E
from revrank.operators.profile import item_value_score, lookup_default
from revrank.session import cut_lineage

# Cells of a block whose pairs with another block are made in one task, pairs made at once, and cells
# packed in one task.
# ``BLOCK_SIDE`` was the side of a dense block and has no effect any more.
BLOCK_SIDE = 2048
BLOCK_CELLS = 4_000_000
PAIRS_AT_ONCE = 1_000_000
PACKED_CELLS = 1_000_000
# Numbers in the vectors on one side of a block of a product, cells of a block, and cells whose weighted
# vectors are added up at once.
BLOCK_NUMBERS = 32_000_000
PRODUCT_CELLS = 4_000_000
SUM_CELLS = 32_768
# Cells on one side of a block of affinities, cells for which a further task is worth it, and cells
# of several users that are spread over the users of their items at once.
AFFINITY_CELLS = 8_000_000
AFFINITY_TASK_CELLS = 50_000
SPOKES_AT_ONCE = 1_000_000


def interaction_cells(log: DataFrame, items: DataFrame, weight: str = "price") -> DataFrame:
    """Matrix cells with repeats added up: ``plain``, ``price`` or ``value`` weights."""
    rows = log.select("user_idx", "item_idx", "relevance")
    if weight == "plain":
        value = F.greatest(F.lit(E.CELL_WEIGHT_FLOOR), F.col("relevance"))
    elif weight == "price":
        rows = lookup_default(rows, items.select("item_idx", "price"), "item_idx", {"price": E.DEFAULT_PRICE})
        value = E.price_cell_weight(F.col("relevance"), F.col("price"))
    elif weight == "value":
        scores = item_value_score(log).select("item_idx", "value_score")
        rows = lookup_default(rows, scores, "item_idx", {"value_score": 0.0})
        value = E.value_cell_weight(F.col("relevance"), F.col("value_score"))
    else:
        raise ValueError(f"unknown cell weight {weight!r}")
    return rows.groupBy("user_idx", "item_idx").agg(F.sum(value).alias("weight"))


def matrix_sparsity(log: DataFrame) -> DataFrame:
    """Size and sparsity of the interaction matrix, by log rows and by cells."""
    cells = log.select("user_idx", "item_idx").distinct().agg(F.count("*").alias("v")).scalar()
    sized = log.agg(
        F.count("*").alias("n_rows"), F.countDistinct("user_idx").alias("n_users"), F.countDistinct("item_idx").alias("n_items")
    ).withColumn("n_cells", cells)
    room = F.col("n_users").cast("double") * F.col("n_items")
    return sized.withColumn("sparsity_rows", 1 - F.try_divide(F.col("n_rows").cast("double"), room)).withColumn(
        "sparsity_cells", 1 - F.try_divide(F.col("n_cells").cast("double"), room)
    )


def norms(cells: DataFrame, key: str) -> DataFrame:
    return cells.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def unit_cells(cells: DataFrame, key: str) -> DataFrame:
    """Cells divided by the length of their row (or column) ``key``."""
    return cells.join(norms(cells, key), key).withColumn("weight", F.col("weight") / F.col("norm")).drop("norm")


# ---------------------------------------------------------------- similarity


def _pack(values: np.ndarray) -> bytes:
    """Numbers with their bytes sorted by place, which leaves little of small differences."""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(packed, n * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


#: What is packed of a run of cells: numbers of each id, of each cell, and the different weights in order of appearance.
_OF_IDS = {"o": np.int64, "many": np.int64, "norm": np.float64, "front": np.float64}
_OF_CELLS = {"g": np.int64, "code": np.int64, "indexed": np.uint8}
_RUN = "n_ids int, n int, n_values int, " + ", ".join(f"{c} binary" for c in (*_OF_IDS, *_OF_CELLS, "value"))


def _packed_run(at: int, cells: pa.Table) -> pa.RecordBatch:
    o, g, w, norm, front, indexed = (cells[c].to_numpy() for c in ("o", "g", "w", "norm", "front", "indexed"))
    starts = np.flatnonzero(np.diff(o, prepend=o[0] - 1))
    _, first, turn = np.unique(w, return_index=True, return_inverse=True)
    place = np.empty(len(first), dtype=np.int64)
    place[np.argsort(first)] = np.arange(len(first))
    numbers = {"o": np.diff(o[starts], prepend=0), "many": np.diff(np.append(starts, len(o))), "norm": norm[starts], "front": front[starts]}
    numbers |= {"g": np.diff(g, prepend=0), "code": np.diff(place[turn], prepend=0), "indexed": indexed}
    packed = [_pack(numbers[c].astype(kind)) for c, kind in (_OF_IDS | _OF_CELLS).items()] + [_pack(w[np.sort(first)])]
    row = [pa.array([n], pa.int32()) for n in (at, len(starts), len(o), len(first))] + [pa.array([p], pa.binary()) for p in packed]
    return pa.RecordBatch.from_arrays(row, names=["at", "n_ids", "n", "n_values", *_OF_IDS, *_OF_CELLS, "value"])


def _packed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of cells of one block as one row each, of cells in order of block, id and group. An id is in one run."""
    held: list[pa.RecordBatch] = []

    def runs() -> Iterator[pa.RecordBatch]:
        if held:
            cells = pa.Table.from_batches(held)
            at = cells["at"].to_numpy()
            firsts = np.flatnonzero(np.diff(at, prepend=-1))
            for first, end in zip(firsts, np.append(firsts[1:], len(at))):
                yield _packed_run(int(at[first]), cells.slice(first, end - first))
            held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        o = batch.column("o").to_numpy()
        changes = np.flatnonzero(np.diff(o)) + 1
        cut = int(changes[-1]) if len(changes) else 0  # where the last id begins
        if cut or (held and held[-1].column("o")[-1].as_py() != o[0]):
            held.append(batch.slice(0, cut))
            yield from runs()
        held.append(batch.slice(cut))
    yield from runs()


def _unpacked(run: dict) -> tuple[np.ndarray, ...]:
    """Cells of a run: id, group, weight, front of the id, and whether the cell is indexed."""
    ids = {c: _unpack(run[c], kind, run["n_ids"]) for c, kind in _OF_IDS.items()}
    g, code, indexed = (_unpack(run[c], kind, run["n"]) for c, kind in _OF_CELLS.items())
    o, norm, front = (np.repeat(v, ids["many"]) for v in (np.cumsum(ids["o"]), ids["norm"], ids["front"]))
    return o, np.cumsum(g), _unpack(run["value"], np.float64, run["n_values"])[np.cumsum(code)] / norm, front, indexed.astype(bool)


class _Block:
    """The cells of a block in order of group and id: ``key`` is the place of the group × ids + that of the id."""

    def __init__(self, runs: list[dict], pruned: bool):
        self.ids = np.concatenate([np.cumsum(_unpack(r["o"], np.int64, r["n_ids"])) for r in runs])
        self.front = np.concatenate([_unpack(r["front"], np.float64, r["n_ids"]) for r in runs])
        order = np.argsort(self.ids, kind="stable")
        self.ids, self.front = self.ids[order], self.front[order]
        self.groups = np.unique(np.concatenate([np.unique(np.cumsum(_unpack(r["g"], np.int64, r["n"]))) for r in runs]))
        n = sum(r["n"] for r in runs)
        key, weight, indexed, at = np.empty(n, dtype=np.int64), np.empty(n), np.empty(n, dtype=bool), 0
        for run in runs:
            o, g, w, _, own = _unpacked(run)
            part = slice(at, at := at + len(o))
            key[part], weight[part], indexed[part] = self.keys(g, o)[0], w, own
        order = np.argsort(key, kind="stable")
        self.all_keys, self.all_weights = key[order], weight[order]
        self.key, self.weight = self.all_keys, self.all_weights
        if pruned:
            indexed = indexed[order]
            self.key, self.weight = self.all_keys[indexed], self.all_weights[indexed]

    def keys(self, g: np.ndarray, o: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Key of the first id of each group, or of the given one, and whether the block has the group."""
        group = np.minimum(np.searchsorted(self.groups, g), len(self.groups) - 1)
        return group * len(self.ids) + (0 if o is None else np.searchsorted(self.ids, o)), self.groups[group] == g

    def whole_dots(self, o: np.ndarray, g: np.ndarray, w: np.ndarray, left: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Dots of ids ``left`` of the cells (o, g, w), which are in order, with ids at ``column`` here, over all groups that both have."""
        low, high = np.searchsorted(o, left), np.searchsorted(o, left, "right")
        upto = np.cumsum(high - low)
        out, at = np.zeros(len(left)), 0
        while at < len(out):
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
            many = (high - low)[at:to]
            pair = np.repeat(np.arange(to - at), many)
            cell = np.arange(len(pair)) + np.repeat(low[at:to] - (np.cumsum(many) - many), many)
            key, known = self.keys(g[cell])
            key += column[at:to][pair]
            first, end = np.searchsorted(self.all_keys, key), np.searchsorted(self.all_keys, key, "right")
            turn = 0
            while (held := np.flatnonzero(known & (first + turn < end))).size:  # a group may come more than once
                out[at:to] += np.bincount(pair[held], w[cell[held]] * self.all_weights[first[held] + turn], to - at)
                turn += 1
            at = to
        return out


def _pair_sums(least: float | None):
    """Dots of the ids of two blocks that share a group; of one block, if it meets itself.

    With ``least``, only pairs whose dot over indexed cells and longer front reach it; their dots are then those
    of all cells. One block is held; the other's runs are unpacked one by one, and pairs are made
    for a few of their ids at a time, so a task holds a block and a bounded number of pairs.
    """
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("dot", pa.float64())])

    def met(block: _Block, run: dict, itself: bool) -> Iterator[pa.RecordBatch]:
        o, g, w, front, indexed = every = _unpacked(run)
        if least is not None:
            o, g, w, front = (c[indexed] for c in every[:4])
        key, known = block.keys(g)
        # A block that meets itself pairs an id with greater ones; within a group these come last.
        first = np.searchsorted(block.key, key + np.searchsorted(block.ids, o), "right") if itself else np.searchsorted(block.key, key)
        n = np.where(known, np.searchsorted(block.key, key + len(block.ids)) - first, 0)
        if not n.any():
            return
        starts = np.flatnonzero(np.diff(o, prepend=o[0] - 1))
        upto = np.cumsum(np.add.reduceat(n, starts))
        at = 0
        while at < len(starts):
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
            part = slice(starts[at], starts[to] if to < len(starts) else len(o))
            many = n[part]
            total, at_first = int(many.sum()), at
            at = to
            if not total:
                continue
            cell = np.repeat(np.arange(len(many)), many)
            there = np.arange(total) + np.repeat(first[part] - (np.cumsum(many) - many), many)
            row = (np.searchsorted(starts, np.arange(part.start, part.stop), "right") - 1 - at_first)[cell]
            pair = row * len(block.ids) + block.key[there] % len(block.ids)
            dot = w[part][cell] * block.weight[there]
            del cell, there, row
            room = (to - at_first) * len(block.ids)
            if room <= 4 * total:
                dense = np.bincount(pair, dot, room)
                pair = np.flatnonzero(dense)
                dot = dense[pair]
            else:
                by = np.argsort(pair, kind="stable")
                pair, dot = pair[by], dot[by]
                new = np.flatnonzero(np.diff(pair, prepend=-1))
                pair, dot = pair[new], np.add.reduceat(dot, new)
            row, column = np.divmod(pair, len(block.ids))
            row = starts[at_first + row]
            if least is not None:
                good = dot + np.maximum(front[row], block.front[column]) >= least
                row, column = row[good], column[good]
                dot = block.whole_dots(*every[:3], o[row], column)
            left, right = o[row], block.ids[column]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(dot)], schema=out)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: tuple[list[dict], list[dict]] = ([], [])
        itself = False
        for batch in batches:
            for run in batch.to_pylist():
                itself = run["itself"]
                runs[run["second"]].append(run)
        held, others = (runs[0], runs[0]) if itself else runs
        if not held or not others:
            return
        block = _Block(held, least is not None)
        for run in others:
            yield from met(block, run, itself)

    return sums


def block_dots(cells: DataFrame, least: float | None = None) -> DataFrame:
    """Dots (a, b, dot) with ``a < b`` of all ids ``o`` that share a group ``g``, of cells (o, g, w, front).

    Ids are dealt to blocks, and each pair of blocks meets in one task that has all there is to a
    pair's dot. So cells are shuffled, packed and once for each block, and pairs never are. Cells may have a
    ``norm`` of their id, by which ``w`` is divided (packed apart both are shorter), and with ``least``, for
    which see :func:`_pair_sums`, they may be ``indexed`` or not.
    """
    cells = cells.filter("o IS NOT NULL AND g IS NOT NULL")
    n = cells.count()
    tasks = cells.sparkSession.sparkContext.defaultParallelism
    # At least a task a core, while these have some work, and no block of more than BLOCK_CELLS.
    wanted = min(tasks, -(-n // 20_000))
    blocks = max(1, -(-n // BLOCK_CELLS), int(np.ceil((2 * wanted) ** 0.5)))
    rest = {"norm": F.lit(1.0), "indexed": F.lit(True)}
    placed = cells.select(
        F.pmod(F.xxhash64("o"), F.lit(blocks)).cast("int").alias("at"),
        *(F.col(c).cast("long").alias(c) for c in ("o", "g")),
        *((F.col(c) if c in cells.columns else rest[c]).cast("double").alias(c) for c in ("w", "norm", "front")),
        *((F.col(c) if c in cells.columns else rest[c]).cast("boolean").alias(c) for c in ("indexed",)),
    )
    sorted_ = placed.repartition(min(max(1, wanted, -(-n // PACKED_CELLS)), 4096), "o").sortWithinPartitions("at", "o", "g")
    runs = cut_lineage(sorted_.mapInArrow(_packed_runs, f"at int, {_RUN}"))
    # The lower block of a pair comes first.
    met = runs.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        (F.least("at", "_other") * F.lit(blocks) + F.greatest("at", "_other")).alias("pair"),
        (F.col("at") > F.col("_other")).alias("second"),
        (F.col("at") == F.col("_other")).alias("itself"),
        *(c for c in runs.columns if c != "at"),
    )
    dealt = met.repartition(min(blocks * (blocks + 1), 4096), "pair")
    return dealt.groupBy("pair").applyInArrow(_pair_sums(least), "a long, b long, dot double")


def _with_norms(cells: DataFrame, of: str, via: str) -> DataFrame:
    """Cells (o, g, w, norm), written once; a vector of no length fails."""
    normed = cells.join(norms(cells, of), of).filter((F.col("weight") / F.col("norm")).isNotNull())
    return cut_lineage(normed.select(F.col(of).alias("o"), F.col(via).alias("g"), F.col("weight").alias("w"), "norm"))


def cosine(cells: DataFrame, of: str, via: str, self_join_rows: int | None = None) -> DataFrame:
    """Cosine similarity of all ``of`` ids that share a ``via`` id.

    Upper triangle with the diagonal (``a <= b``); zeros are left out. Groups of any size take the
    same way; ``self_join_rows``, once the limit between two ways, is accepted and not used.
    """
    unit = _with_norms(cells, of, via)
    pairs = block_dots(unit.withColumn("front", F.lit(0.0))).withColumnRenamed("dot", "sim")
    diagonal = unit.select(F.col("o").alias("a")).distinct().select("a", F.col("a").alias("b"), F.lit(1.0).alias("sim"))
    return pairs.unionByName(diagonal)


def item_cosine(cells: DataFrame, **options) -> DataFrame:
    return cosine(cells, "item_idx", "user_idx", **options)


def user_cosine(cells: DataFrame, **options) -> DataFrame:
    return cosine(cells, "user_idx", "item_idx", **options)


def cosine_join(cells: DataFrame, of: str, via: str, least: float) -> DataFrame:
    """Pairs ``a < b`` of ``of`` ids with a cosine (six digits) of ``least`` or more: a, b, sim.

    A prefix-filtered inverted index in the way of Bayardo et al. (2007). All vectors have
    their entries in one order, the ``via`` ids in most vectors first. The entries at the
    front whose length together is below ``least`` are not indexed: if two vectors
    shared none beyond the later of their fronts, that front alone would have to give the
    whole cosine, which it cannot. So similar vectors meet at an indexed entry of both;
    there, what both indexed parts share and the longer front have to reach ``least``, and
    the pairs left are computed from all entries, in the same task. Weights are not negative.
    """
    unit = _with_norms(cells.filter("weight > 0"), of, via)
    held = unit.groupBy("g").agg(F.count("*").alias("n"))
    front = Window.partitionBy("o").orderBy(F.col("n").desc(), "g").rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("w") / F.col("norm")
    placed = unit.join(held, "g").withColumn("length", F.sqrt(F.sum(share * share).over(front)))
    reached = F.col("length") >= F.lit(least - 1e-6)
    own_front = F.max(F.when(~reached, F.col("length"))).over(Window.partitionBy("o"))
    placed = placed.withColumn("front", F.coalesce(own_front, F.lit(0.0)))
    every = cut_lineage(placed.select("o", "g", "w", "norm", "front", reached.alias("indexed")))
    pairs = block_dots(every, least - 1e-6).withColumnRenamed("dot", "sim")
    return pairs.filter(E.shown("sim") >= least)


# ---------------------------------------------------------------- vectors


def pseudo_factors(ids: DataFrame, key: str, size: int) -> DataFrame:
    """Repeatable vectors in [0, 1] made from a hash of the id."""
    parts = [E.unit_hash(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(j)))) for j in range(size)]
    return ids.select(key).distinct().withColumn("vector", F.array(*parts))


def vector_size(vectors: DataFrame) -> int:
    row = vectors.select(F.size("vector").alias("n")).head()
    return row["n"] if row else 0


def matrix_shape(cells: DataFrame) -> dict[str, int]:
    """Numbers that :func:`multiply` plans with: cells, and about how many users and items they name."""
    row = cells.agg(
        F.count("*").alias("cells"), *(F.approx_count_distinct(c).alias(c) for c in ("user_idx", "item_idx"))
    ).first()
    return row.asDict()


def _product_grid(sources: int, targets: int, cells: int, size: int, tasks: int | None = None) -> tuple[int, int]:
    """Source and target blocks of a product, with the fewest vectors shuffled.

    Neither side of a block holds more than about ``BLOCK_NUMBERS`` numbers, nor a block more than about
    ``PRODUCT_CELLS`` cells, however few the cores. A source's vector goes to every target block, and a target
    has a partial sum from every source block.
    """
    least = [max(1, -(-n * size // BLOCK_NUMBERS)) for n in (sources, targets)]
    wanted = max(least[0] * least[1], -(-cells // PRODUCT_CELLS))
    grids = ((s, max(least[1], -(-wanted // s))) for s in range(least[0], max(least[0], wanted) + 1))
    return min(grids, key=lambda g: (g[1] * sources + (g[0] * targets if g[0] > 1 else 0), g))


def _block_sums(size: int):
    """Sums of weight × vector by target, of one block of cells and the vectors of its sources."""

    def sums(cells: pa.Table, vectors: pa.Table) -> pa.Table:
        out = pa.schema([("target", pa.int64()), ("vector", pa.list_(pa.float64()))])
        if not cells.num_rows or not vectors.num_rows:
            return out.empty_table()
        ids, rows = np.unique(vectors["source"].to_numpy(), return_inverse=True)
        values = vectors["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        if len(ids) < len(rows):  # an id that comes more than once counts as often
            total = np.zeros((len(ids), size))
            np.add.at(total, rows, values)
            rows, values = np.arange(len(ids)), total
        at = np.empty(len(ids), dtype=np.int32)
        at[rows] = np.arange(len(rows))
        place = np.minimum(np.searchsorted(ids, cells["source"].to_numpy()), len(ids) - 1).astype(np.int32)
        known = ids[place] == cells["source"].to_numpy()
        if not known.all():
            cells, place = cells.filter(pa.array(known)), place[known]
        del known
        if not len(place):
            return out.empty_table()
        row = at[place]
        del place
        named = cells["target"].combine_chunks().dictionary_encode("encode")
        code, weight = named.indices.to_numpy(), cells["weight"].to_numpy()
        order = np.argsort(code, kind="stable")
        total = np.zeros((len(named.dictionary), size))
        for first in range(0, len(order), SUM_CELLS):
            part = order[first : first + SUM_CELLS]
            here, starts = np.unique(code[part], return_index=True)
            total[here] += np.add.reduceat(values[row[part]] * weight[part, None], starts, axis=0)
        ends = pa.array(np.arange(0, total.size + 1, size, dtype=np.int32))
        return pa.table([named.dictionary, pa.ListArray.from_arrays(ends, pa.array(total.ravel()))], schema=out)

    return sums


def multiply(
    cells: DataFrame, vectors: DataFrame, source: str, target: str, size: int, shape: dict[str, int] | None = None
) -> DataFrame:
    """Sparse matrix × vectors: for every ``target`` the weighted sum of ``source`` vectors.

    The matrix is cut into a grid of blocks. A block meets the vectors of its sources in one task, which
    adds up a vector for each of its targets, so a vector is shuffled once for every row or column
    of the grid and not once for every cell. ``shape`` is :func:`matrix_shape` of the cells, if known.
    """
    shape = shape or matrix_shape(cells)
    n_source, n_target = _product_grid(shape[source], shape[target], shape["cells"], size)

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    placed = cells.filter(F.col(source).isNotNull()).select(
        F.col(source).cast("long").alias("source"), F.col(target).cast("long").alias("target"), F.coalesce("weight", F.lit(0.0)).alias("weight")
    )
    placed = placed.withColumns({"from": block("source", n_source), "to": block("target", n_target)})
    known = vectors.filter(F.col(source).isNotNull()).select(
        F.col(source).cast("long").alias("source"), F.slice("vector", 1, size).alias("vector")
    )
    spread = known.withColumn("from", block("source", n_source)).withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(n_target - 1))))
    key, kernel = ["from", "to"], _block_sums(size)
    left = placed.repartition(n_source * n_target, *key).groupBy(*key)
    right = spread.repartition(n_source * n_target, *key).groupBy(*key)
    sums = left.cogroup(right).applyInArrow(kernel, "target long, vector array<double>").withColumnRenamed("target", target)
    if n_source == 1:
        return sums
    totals = [F.sum(F.col("vector")[j]).alias(f"s{j}") for j in range(size)]
    return sums.groupBy(target).agg(*totals).select(target, F.array(*[F.col(f"s{j}") for j in range(size)]).alias("vector"))


def scale(vectors: DataFrame, by: DataFrame, key: str) -> DataFrame:
    """Divide each vector by the ``norm`` of its id."""
    return vectors.join(by, key).select(key, F.transform("vector", lambda x: x / F.col("norm")).alias("vector"))


def propagate(cells: DataFrame, vectors: DataFrame, key: str, other: str, size: int | None = None) -> DataFrame:
    """Cosine similarity matrix of ``key`` × vectors, diagonal included, S not built."""
    size = size or vector_size(vectors)
    unit = cut_lineage(unit_cells(cells, key).select("user_idx", "item_idx", "weight"))
    shape = matrix_shape(unit)
    return multiply(unit, multiply(unit, vectors, key, other, size, shape), other, key, size, shape)


def graph_smooth(
    cells: DataFrame, vectors: DataFrame, key: str, other: str, share: float = 0.25, size: int | None = None
) -> DataFrame:
    """(1 - share) · vector + share · S · vector."""
    spread = propagate(cells, vectors, key, other, size).withColumnRenamed("vector", "_spread")
    mixed = F.zip_with("vector", "_spread", lambda own, near: own * F.lit(1 - share) + near * F.lit(share))
    return vectors.join(spread, key).select(key, mixed.alias("vector"))


def embedding_dot(pairs: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, first: int | None = None) -> DataFrame:
    """Dot product of the vectors of each given pair, of their first elements only if asked."""
    u, v = F.col("_uv"), F.col("_iv")
    if first:
        u, v = F.slice(u, 1, first), F.slice(v, 1, first)
    joined = pairs.join(user_vectors.withColumnRenamed("vector", "_uv"), "user_idx").join(
        item_vectors.withColumnRenamed("vector", "_iv"), "item_idx"
    )
    return joined.withColumn("dot", E.dot(u, v)).drop("_uv", "_iv")


def _block_affinities(asks: pa.Table, spokes: pa.Table) -> pa.Table:
    """Shares of the spokes of one block in the affinities asked for by one block of users.

    A user's profile lies in one array over the block's peers, which is cleared after its rows.
    """
    out = pa.schema([("user_idx", pa.int64()), ("item_idx", pa.int64()), ("affinity", pa.float64())])
    if not asks.num_rows or not spokes.num_rows:
        return out.empty_table()
    order = np.argsort(spokes["item_idx"].to_numpy(), kind="stable")
    ids, start, degree = np.unique(spokes["item_idx"].to_numpy()[order], return_index=True, return_counts=True)
    peers, peer = np.unique(spokes["peer"].to_numpy(), return_inverse=True)
    peer, spoke = peer[order], spokes["spoke"].to_numpy()[order]
    item = asks["item_idx"].to_numpy()
    place = np.minimum(np.searchsorted(ids, item), len(ids) - 1)
    known = np.flatnonzero(ids[place] == item)
    known = known[np.argsort(asks["user_idx"].to_numpy()[known], kind="stable")]
    if not len(known):
        return out.empty_table()
    user, item, place = asks["user_idx"].to_numpy()[known], item[known], place[known]
    weight, wanted = asks["weight"].to_numpy()[known], asks["wanted"].to_numpy(zero_copy_only=False)[known]
    first, many = start[place], degree[place]
    upto = np.cumsum(many)
    profile, affinity = np.zeros(len(peers)), np.empty(len(known))

    def spread(part: slice):
        """Places of the spokes of a stretch of rows, and the first place of each row among them."""
        n = many[part]
        before = np.cumsum(n) - n
        return np.arange(int(n.sum())) + np.repeat(first[part] - before, n), before

    def stretches(low: int, high: int) -> Iterator[slice]:
        while low < high:
            done = upto[low - 1] if low else 0
            to = min(high, max(low + 1, int(np.searchsorted(upto, done + SPOKES_AT_ONCE, "right"))))
            yield slice(low, to)
            low = to

    def add(part: slice, at: np.ndarray) -> None:
        own = np.repeat(weight[part], many[part])
        np.add.at(profile, peer[at], np.where(own == 0, 0.0, own * spoke[at]))

    def read(part: slice, at: np.ndarray, before: np.ndarray) -> None:
        affinity[part] = np.add.reduceat(profile[peer[at]] * spoke[at], before)

    ends = np.append(np.flatnonzero(np.diff(user)) + 1, len(user))
    row, turn = 0, 0
    while turn < len(ends):
        # Whole users while their spokes fit, or one user who has more.
        done = upto[row - 1] if row else 0
        last = max(turn + 1, int(np.searchsorted(upto[ends - 1], done + SPOKES_AT_ONCE, "right")))
        high = int(ends[last - 1])
        if last > turn + 1 or upto[high - 1] - done <= SPOKES_AT_ONCE:
            at, before = spread(slice(row, high))
            to, value = peer[at], spoke[at]
            own = np.repeat(weight[row:high], many[row:high])
            given = np.where(own == 0, 0.0, own * value)
            cuts = np.append(upto[ends[turn:last] - 1] - done, len(at))
            low = 0
            for cut in cuts[:-1]:
                here = to[low:cut]
                np.add.at(profile, here, given[low:cut])
                value[low:cut] *= profile[here]
                profile[here] = 0.0
                low = cut
            affinity[row:high] = np.add.reduceat(value, before)
        else:
            for part in stretches(row, high):
                add(part, spread(part)[0])
            for part in stretches(row, high):
                read(part, *spread(part))
            profile[:] = 0.0
        row, turn = high, last
    return pa.table([pa.array(user[wanted]), pa.array(item[wanted]), pa.array(affinity[wanted])], schema=out)


def _light_affinity(asks: DataFrame, spokes: DataFrame) -> DataFrame:
    """Σ_p spoke(i, p) Σ_j weight(u, j) · spoke(j, p) for the ``wanted`` rows of ``asks`` (user_idx, item_idx, weight, wanted).

    Users are dealt to blocks and peers p too. A block of users and one of peers meet in one task, which
    gives its part of each affinity, so the profiles over p are never shuffled: rows are, once for each block.
    """
    n_asks, n_spokes = asks.count(), spokes.count()
    wanted = min(asks.sparkSession.sparkContext.defaultParallelism, -(-n_asks // AFFINITY_TASK_CELLS))
    n_peer = max(1, -(-n_spokes // AFFINITY_CELLS))
    n_user = max(1, -(-n_asks // AFFINITY_CELLS), -(-wanted // n_peer))

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asks.withColumn("_at", every(n_peer)).withColumn("_block", block("user_idx", n_user) * F.lit(n_peer) + F.col("_at")).drop("_at")
    right = spokes.withColumn("_at", every(n_user)).withColumn("_block", F.col("_at") * F.lit(n_peer) + block("peer", n_peer)).drop("_at")
    tasks = n_user * n_peer
    parts = (
        left.repartition(tasks, "_block").groupBy("_block").cogroup(right.repartition(tasks, "_block").groupBy("_block"))
        .applyInArrow(lambda a, b: _block_affinities(a, b), "user_idx long, item_idx long, affinity double")
    )
    if n_peer == 1:
        return parts
    return parts.groupBy("user_idx", "item_idx").agg(F.sum("affinity").alias("affinity"))


def graph_affinity(cells: DataFrame, pairs: DataFrame, hot_rows: int = 1_000) -> DataFrame:
    """Σ_j S(i, j) · weight(u, j) for the given pairs (u, i).

    Items are seen as unit vectors over users; a user's interactions sum these to
    one profile vector, and a pair is a sparse dot product. Items with more than
    ``hot_rows`` users would make every profile long; their similarities to all
    items are computed once instead and joined in.
    """
    unit = cut_lineage(unit_cells(cells, "item_idx"))
    degree = cells.groupBy("item_idx").agg(F.count("*").alias("_n"))
    hot = cut_lineage(degree.filter(F.col("_n") > hot_rows).select("item_idx"))
    target = pairs.select("user_idx", "item_idx").distinct()
    has_hot = not hot.isEmpty()
    numbers = [F.col(c).cast("long").alias(c) for c in ("user_idx", "item_idx")]
    own = cells.select(*numbers, F.col("weight").cast("double").alias("weight"), F.lit(False).alias("wanted"))
    asks = own.unionByName(pairs.select(*numbers, F.lit(0.0).alias("weight"), F.lit(True).alias("wanted")))
    spokes = unit.select(numbers[1], F.col("user_idx").cast("long").alias("peer"), F.col("weight").alias("spoke"))
    if has_hot:
        asks, spokes = (rows.join(hot, "item_idx", "left_anti") for rows in (asks, spokes))
    asks = asks.filter("user_idx IS NOT NULL AND item_idx IS NOT NULL").groupBy("user_idx", "item_idx").agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"), F.max("wanted").alias("wanted")
    )
    spokes = spokes.filter("item_idx IS NOT NULL AND peer IS NOT NULL AND spoke IS NOT NULL")
    parts = _light_affinity(cut_lineage(asks), spokes)
    if has_hot:
        light_target = target.join(hot, "item_idx", "left_anti")
        hub = unit.join(hot, "item_idx", "left_semi").select(
            F.col("item_idx").alias("hub"), "user_idx", F.col("weight").alias("hub_weight")
        )
        to_hub = unit.join(hub, "user_idx").groupBy("item_idx", "hub").agg(
            F.sum(F.col("weight") * F.col("hub_weight")).alias("sim")
        )
        hub_cells = cells.join(hot, "item_idx", "left_semi").select(
            "user_idx", F.col("item_idx").alias("hub"), F.col("weight").alias("own")
        )
        from_hubs = light_target.join(hub_cells, "user_idx").join(to_hub, ["item_idx", "hub"]).select(
            "user_idx", "item_idx", (F.col("own") * F.col("sim")).alias("affinity")
        )
        hub_target = target.join(hot, "item_idx", "left_semi").withColumnRenamed("item_idx", "hub")
        at_hubs = hub_target.join(cells, "user_idx").join(to_hub, ["item_idx", "hub"]).select(
            "user_idx", F.col("hub").alias("item_idx"), (F.col("weight") * F.col("sim")).alias("affinity")
        )
        parts = parts.unionByName(from_hubs).unionByName(at_hubs).groupBy("user_idx", "item_idx").agg(
            F.sum("affinity").alias("affinity")
        )
    return target.join(parts, ["user_idx", "item_idx"], "left").withColumn("affinity", F.coalesce("affinity", F.lit(0.0)))


def graph_scores(
    cells: DataFrame, pairs: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, hot_rows: int = 1_000
) -> DataFrame:
    """0.7 · factor dot + 0.3 · graph affinity for the given pairs."""
    dots = embedding_dot(pairs.select("user_idx", "item_idx").distinct(), user_vectors, item_vectors)
    near = graph_affinity(cells, pairs, hot_rows)
    return dots.join(near, ["user_idx", "item_idx"]).withColumn(
        "score", F.lit(0.7) * F.col("dot") + F.lit(0.3) * F.col("affinity")
    )
