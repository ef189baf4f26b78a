import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from revrank.functions import expressions as E
from revrank.operators import factorise, graph as G, knn as N
from revrank.operators.features import shown_values
from revrank.recommenders import graph as RG


def matrix(cells, n_users, n_items):
    out = np.zeros((n_users, n_items))
    for r in cells.collect():
        out[r["user_idx"], r["item_idx"]] = r["weight"]
    return out


@pytest.fixture(scope="module")
def cells(shop):
    _, items, log = shop
    return G.interaction_cells(log, items, "price").cache()


def cosine(m):
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    return unit @ unit.T


@pytest.mark.parametrize("limit", [1000, 4, 0])
def test_cosine_by_join_and_by_blocks(cells, limit):
    want = cosine(matrix(cells, 9, 12).T)
    found = {(r["a"], r["b"]): r["sim"] for r in G.item_cosine(cells, self_join_rows=limit).collect()}
    expected = {(a, b): want[a, b] for a in range(12) for b in range(a, 12) if want[a, b] > 0}
    assert found.keys() == expected.keys()
    assert all(abs(found[key] - expected[key]) < 1e-9 for key in found)


def test_blocks_smaller_than_the_matrix(cells, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_SIDE", 4)
    monkeypatch.setattr(G, "BLOCK_CELLS", 5)
    want = cosine(matrix(cells, 9, 12))
    found = {(r["a"], r["b"]): r["sim"] for r in G.user_cosine(cells, self_join_rows=0).collect()}
    assert all(abs(found.get((a, b), 0.0) - want[a, b]) < 1e-9 for a in range(9) for b in range(a, 9))


def test_smoothing_without_the_similarity_matrix(cells):
    vectors = G.pseudo_factors(cells, "item_idx", 3)
    dense = np.zeros((12, 3))
    for r in vectors.collect():
        dense[r["item_idx"]] = r["vector"]
    want = 0.75 * dense + 0.25 * cosine(matrix(cells, 9, 12).T) @ dense
    for r in G.graph_smooth(cells, vectors, "item_idx", "user_idx", 0.25, 3).collect():
        assert np.allclose(r["vector"], want[r["item_idx"]])


@pytest.mark.parametrize("hot_rows", [1000, 3, 0])
def test_affinity_with_popular_items(cells, hot_rows):
    m = matrix(cells, 9, 12)
    want = m @ cosine(m.T)
    for r in G.graph_affinity(cells, cells, hot_rows).collect():
        assert abs(r["affinity"] - want[r["user_idx"], r["item_idx"]]) < 1e-9


@pytest.mark.parametrize("block, at_once", [(5, 1_000), (7, 1), (1_000, 2)])
def test_affinity_in_blocks_of_users_and_peers(spark, cells, monkeypatch, block, at_once):
    """Profiles stay in a task, whose blocks are bounded; rows without an id, repeats and strange pairs as before."""
    monkeypatch.setattr(G, "AFFINITY_CELLS", block)
    monkeypatch.setattr(G, "SPOKES_AT_ONCE", at_once)
    m = matrix(cells, 9, 12)
    want = m @ cosine(m.T)
    odd = spark.createDataFrame([(None, 1), (2, None), (77, 1), (3, 99), (4, 5), (4, 5)], "user_idx long, item_idx long")
    found = G.graph_affinity(cells, cells.select("user_idx", "item_idx").unionByName(odd), 1000)
    joined = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "peer" in line and "Join" in line]
    assert not joined  # profiles, a row for each user and peer, are not joined
    rows = {(r["user_idx"], r["item_idx"]): r["affinity"] for r in found.collect()}
    assert rows.keys() == {(r["user_idx"], r["item_idx"]) for r in cells.collect()} | {tuple(r) for r in odd.collect()}
    for (u, i), value in rows.items():
        known = u is not None and i is not None and u < 9 and i < 12
        assert abs(value - (want[u, i] if known else 0.0)) < 1e-9


def test_nmf_loss_never_rises(cells):
    losses = []
    users, items = factorise.nmf(cells, size=3, iterations=4, losses=losses)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    assert all(v >= 0 for r in users.union(items).collect() for v in r["vector"])


def test_nmf_held_by_the_driver_equals_products_of_tables(spark, monkeypatch):
    """Rows without an id, an item that only a row without a user names, a target in several packed rows; one job a step."""
    rows = [(u, i, float(1 + u * i % 5) / 4) for u in range(12) for i in range(9) if (u * 7 + i * 5) % 3]
    rows += [(None, 2, 1.0), (3, None, 2.0), (None, 77, 1.0), (88, None, 1.0), (4, 5, None)]
    cells = spark.createDataFrame(rows, "user_idx long, item_idx long, weight double")
    monkeypatch.setattr(factorise, "PACKED_CELLS", 4)
    monkeypatch.setattr(factorise, "HELD_TASK_CELLS", 20)
    asked, multiply = [], factorise.multiply
    monkeypatch.setattr(factorise, "multiply", lambda *a: asked.append(1) or multiply(*a))
    held = factorise.nmf(cells, size=3, iterations=4)
    assert not asked
    monkeypatch.setattr(factorise, "HELD_NUMBERS", 0)
    for own, other, key in zip(held, factorise.nmf(cells, size=3, iterations=4), ("user_idx", "item_idx")):
        own, other = ({r[key]: np.array(r["vector"]) for r in df.collect()} for df in (own, other))
        assert own.keys() == other.keys() and len(own) == (12 if key == "user_idx" else 9)
        assert all(np.allclose(own[x], other[x], rtol=1e-9) for x in own)
    assert len(asked) == 8


def test_svd_reconstructs_a_low_rank_matrix(spark):
    rng = np.random.default_rng(3)
    m = rng.random((15, 2)) @ rng.random((2, 11)) + 0.5
    cells = spark.createDataFrame(
        [(u, i, float(m[u, i])) for u in range(15) for i in range(11)], "user_idx long, item_idx long, weight double"
    )
    users, items = factorise.svd(cells, size=3, iterations=3, shift=0.01)
    left, right = np.zeros((15, 3)), np.zeros((11, 3))
    for r in users.collect():
        left[r["user_idx"]] = r["vector"]
    for r in items.collect():
        right[r["item_idx"]] = r["vector"]
    assert np.allclose(left @ right.T, m + 0.01, atol=1e-6)
    assert np.allclose(np.linalg.norm(left, axis=0), np.linalg.svd(m + 0.01)[1][:3], atol=1e-6)


@pytest.mark.parametrize("metric", N.METRICS)
def test_knn_equals_brute_force(spark, metric):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(c, 0.3, (40, 4)) for c in (0, 2, 5)])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    points = spark.createDataFrame(rows, "point_id long, vector array<double>")
    queries = points.withColumnRenamed("point_id", "query_id")
    found = N.knn_join(queries, points, 4, metric, exclude_same_id=True, pivots=6, block_rows=7).collect()
    if metric == "cosine":
        unit = data / np.linalg.norm(data, axis=1, keepdims=True)
        distance = 1 - unit @ unit.T
    else:
        gap = data[:, None] - data[None]
        distance = np.abs(gap).sum(2) if metric == "manhattan" else np.sqrt((gap**2).sum(2))
    distance = np.round(distance, 6)
    np.fill_diagonal(distance, np.inf)
    order = np.argsort(distance, axis=1, kind="stable")[:, :4]
    assert sorted((r["query_id"], r["neighbour"], r["point_id"]) for r in found) == sorted(
        (q, n + 1, int(p)) for q in range(120) for n, p in enumerate(order[q])
    )


@pytest.mark.parametrize("least", [0.05, 0.6, 0.95])
def test_cosine_join_equals_all_pairs_from_its_threshold_on(spark, least):
    """Sparse vectors with common and rare entries, equal vectors, and a hot entry."""
    draw = np.random.default_rng(int(least * 100))
    rows = [(u, i, float(draw.random() + 0.1)) for u in range(60) for i in range(40) if draw.random() < 3 / (i + 3)]
    rows += [(100 + u, i, w) for u, i, w in rows if u < 5]
    cells = spark.createDataFrame(rows + [(200, 7, 0.0)], "user_idx long, item_idx long, weight double")
    found = {(r.a, r.b): r.sim for r in G.cosine_join(cells, "user_idx", "item_idx", least).collect()}
    want = {(r.a, r.b): r.sim for r in G.user_cosine(cells.filter("weight > 0")).collect() if r.a < r.b and round(r.sim, 6) >= least}
    assert len(want) >= 5 and found.keys() == want.keys()
    assert all(abs(found[key] - want[key]) < 1e-9 for key in want)


def test_cosine_join_meets_few_pairs_at_common_entries(spark):
    """An entry that every vector has in its front is not indexed, so it pairs nobody."""
    rows = [(u, 0, 0.2) for u in range(300)] + [(u, 1 + u, 1.0) for u in range(300)]
    cells = spark.createDataFrame(rows, "user_idx long, item_idx long, weight double")
    assert G.cosine_join(cells, "user_idx", "item_idx", 0.5).count() == 0
    assert G.cosine_join(cells.limit(0), "user_idx", "item_idx", 0.5).count() == 0
    assert G.cosine_join(cells, "user_idx", "item_idx", 0.03).count() == 300 * 299 // 2


def test_a_product_ships_vectors_by_block_and_not_by_cell(spark, monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.random((30, 20)) * (rng.random((30, 20)) < 0.5)
    vectors = rng.normal(size=(30, 3))
    rows = [(u if u < 29 else None, i, float(dense[u, i])) for u in range(30) for i in range(20) if dense[u, i]]
    cells = spark.createDataFrame(rows, "user_idx long, item_idx long, weight double")
    known = spark.createDataFrame([(u, vectors[u].tolist()) for u in range(30)], "user_idx long, vector array<double>")
    expected = dense[:29].T @ vectors[:29]
    for numbers in (32_000_000, 24):
        monkeypatch.setattr(G, "BLOCK_NUMBERS", numbers)
        made = G.multiply(cells, known, "user_idx", "item_idx", 3)
        assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
        found = {r.item_idx: r.vector for r in made.collect()}
        assert sorted(found) == list(range(20))
        assert np.allclose([found[i] for i in range(20)], expected)
    # A null target stays a target, as for any grouping.
    back = G.multiply(cells, spark.createDataFrame([(i, [1.0]) for i in range(20)], "item_idx long, vector array<double>"), "item_idx", "user_idx", 1)
    assert np.allclose({r.user_idx: r.vector[0] for r in back.collect()}[None], dense[29].sum())
    # Far fewer vectors than cells, with a bounded block.
    monkeypatch.setattr(G, "BLOCK_NUMBERS", 32_000_000)
    by_source, by_target = G._product_grid(1_200_000, 900_000, 36_000_000, 72, 12)
    assert 1_200_000 * by_target + 900_000 * by_source < 36_000_000 / 5
    assert 1_200_000 * 72 / by_source <= G.BLOCK_NUMBERS >= 900_000 * 72 / by_target


def test_blocks_of_a_product_are_bounded_in_cells_on_few_cores():
    for size in (4, 72):
        for cells in (3_000_000, 36_000_000, 216_000_000):
            by_source, by_target = G._product_grid(cells // 30, cells // 40, cells, size, 12)
            assert cells / (by_source * by_target) <= G.PRODUCT_CELLS
            assert cells // 30 * size / by_source <= G.BLOCK_NUMBERS >= cells // 40 * size / by_target
    assert G._product_grid(20_000, 15_000, 600_000, 4, 12) == (1, 1)


def test_pairs_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_CELLS", 40)
    rng = np.random.default_rng(8)
    dense = rng.random((25, 9)) * (rng.random((25, 9)) < 0.5) + np.eye(25, 9)
    rows = [(u, i, float(dense[u, i])) for u in range(25) for i in range(9) if dense[u, i]]
    cells = spark.createDataFrame(rows, "user_idx long, item_idx long, weight double")
    dots = G.block_dots(cells.selectExpr("user_idx o", "item_idx g", "weight w", "0D front"))
    plan = dots._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    want = dense @ dense.T
    found = {(r.a, r.b): r.dot for r in dots.collect()}
    assert found.keys() == {(a, b) for a in range(25) for b in range(a + 1, 25) if want[a, b] > 0}
    assert all(abs(found[key] - want[key]) < 1e-9 for key in found)
    some = {(r.a, r.b) for r in G.block_dots(cells.selectExpr("user_idx o", "item_idx g", "weight w", "0D front"), 0.5).collect()}
    assert some == {key for key in found if want[key] >= 0.5}


def test_cells_are_packed_in_whole_ids_and_one_block_is_held(spark):
    """Ids over several batches, ids and groups that repeat; pairs of two blocks and of one with itself as by hand."""
    rng = np.random.default_rng(4)
    rows = sorted((int(a), int(o) * 2 + int(a), int(g) - 20) for a, o, g in zip(rng.integers(0, 2, 400), rng.integers(0, 9, 400) ** 2, rng.integers(0, 40, 400)))
    at, o, g = (np.array(c) for c in zip(*rows))
    numbers = {"at": at.astype(np.int32), "o": o, "g": g, "w": rng.integers(1, 4, 400) / 8.0, "norm": np.full(400, 2.0), "front": o / 10.0, "indexed": rng.random(400) < 0.8}
    whole = pa.table(numbers)
    runs = [r for batch in G._packed_runs(iter(whole.to_batches(max_chunksize=7))) for r in batch.to_pylist()]
    back = [np.concatenate(c) for c in zip(*(G._unpacked(r) for r in runs))]
    for found, name in zip(back, ("o", "g", "w", "front", "indexed")):
        assert np.array_equal(found, numbers[name] / 2 if name == "w" else numbers[name])
    assert len(runs) > 4 and len({(r["at"], x) for r in runs for x in np.cumsum(G._unpack(r["o"], np.int64, r["n_ids"]))}) == sum(r["n_ids"] for r in runs)
    for itself in (True, False):
        asked = [r | {"itself": itself, "second": not itself and r["at"] == 1} for r in runs if not itself or r["at"] == 0]
        batches = [pa.RecordBatch.from_pylist([r]) for r in asked]
        for least in (None, 0.0):
            made = [(a, b, d) for batch in G._pair_sums(least)(iter(batches)) for a, b, d in zip(*(c.to_pylist() for c in batch.columns))]
            want = {}
            used = numbers["indexed"] if least is not None else np.ones(400, dtype=bool)
            for i in range(400):
                for j in range(400):
                    if (o[i] < o[j] and at[i] == at[j] == 0 if itself else at[i] < at[j]) and g[i] == g[j]:
                        dot, met = want.get((min(o[i], o[j]), max(o[i], o[j])), (0.0, False))
                        want[min(o[i], o[j]), max(o[i], o[j])] = dot + numbers["w"][i] * numbers["w"][j] / 4, met or (used[i] and used[j])
            want = {key: dot for key, (dot, met) in want.items() if met}
            assert len(made) == len(want) > 5 and all(abs(want[a, b] - d) < 1e-12 for a, b, d in made)
    # Pairs are checked where they are made: no cells are joined with pairs.
    cells = spark.createDataFrame([(u, i, 1.0) for u in range(6) for i in range(u, 6)], "user_idx long, item_idx long, weight double")
    assert "Join" not in G.cosine_join(cells, "user_idx", "item_idx", 0.1)._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_group_without_an_id_gives_no_pairs(spark):
    rows = [(None, i, 1.0) for i in range(300)] + [(7, 1, 1.0), (7, 2, 1.0)]
    cells = spark.createDataFrame(rows, "user_idx long, item_idx long, weight double")
    pairs = {(r.a, r.b): r.sim for r in G.item_cosine(cells).collect()}
    assert len(pairs) == 301 and abs(pairs[1, 2] - 0.5) < 1e-9


def test_pair_features_by_blocks_equal_those_by_pairs(spark, monkeypatch):
    """Several blocks, an item that comes twice, pairs without a user or item, nulls, halves of the last digit."""
    users = spark.range(30).select(F.col("id").alias("user_idx"), *(F.lit(v).alias(n) for n, v in (("avg_price", 2.5e-7), ("activity", 0.6))))
    users = users.join(G.pseudo_factors(users, "user_idx", RG.WIDTH).withColumnRenamed("vector", "user_vector"), "user_idx")
    items = spark.range(20).selectExpr("id AS item_idx", "id * 0.1D + 0.0000005D AS price", "if(id = 3, double('NaN'), -1.0000025D) AS popularity", "1e17D AS value_score")
    items = items.join(G.pseudo_factors(items, "item_idx", RG.WIDTH).withColumnRenamed("vector", "item_vector"), "item_idx")
    items = items.unionByName(items.filter("item_idx = 5").withColumn("price", F.lit(7.0)))
    cells = spark.range(60).selectExpr("if(id = 0, NULL, id % 33) AS user_idx", "id * 7 % 23 AS item_idx")
    monkeypatch.setattr(RG, "FEATURE_NUMBERS", 200)
    monkeypatch.setattr(RG, "FEATURE_PAIRS", 10)
    found = RG.pair_feature_table(cells, users, items)
    pairs = RG.pair_features(cells.join(users, "user_idx").join(items, "item_idx")).withColumn("v", vector_to_array("features"))
    plain = pairs.select("user_idx", "item_idx", *[E.shown(F.col("v")[j]).alias(f"f{j}") for j in range(2 * RG.WIDTH + 6)])
    assert found.columns == plain.columns and plain.count() > 30
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))


def test_rounding_of_arrays_is_that_of_columns(spark):
    draw = np.random.default_rng(3)
    values = np.concatenate([draw.normal(size=500), draw.integers(-50, 50, 200) / 2e6 - 1e-10, draw.normal(size=200) * 1e10, [0.0, -1e-9, 5e-7, 1e300, np.nan, np.inf, -np.inf]])
    column = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "v double").select(E.shown("v")).collect()]
    assert list(map(repr, column)) == list(map(repr, shown_values(values).tolist()))
