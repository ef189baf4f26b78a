"""Searches by bounds: equal to scoring everything, and far fewer pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.operators import cones, forests
from revrank.operators.cones import cone_index, cone_top_k
from revrank.recommenders.graph import EmbeddingForestRecommender
from revrank.recommenders.simple import ContentBasedRecommender

K = 5


def vectors(n, width, centres, seed, spread=0.15):
    """Unit vectors around a few directions."""
    random = np.random.default_rng(seed)
    axes = np.random.default_rng(5).normal(size=(centres, width))
    rows = axes[random.integers(0, centres, n)] / np.linalg.norm(axes, axis=1).mean() + random.normal(size=(n, width)) * spread / width**0.5
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def tables(spark, n_users, n_items, width=8, centres=12):
    random = np.random.default_rng(1)
    items = [(i, float(p), None, 0.0, v.tolist()) for i, (p, v) in enumerate(zip(random.integers(100, 2000, n_items) / 20, vectors(n_items, width, centres, 2)))]
    items[3] = (3, 90.0, None, None, None)  # without a direction
    users = [(u, v.tolist(), [], []) for u, v in enumerate(vectors(n_users, width, centres, 3))]
    seen = [(u, (u * 7 + j * 13) % n_items) for u in range(n_users) for j in range(u % 9)]
    return (
        spark.createDataFrame(users, "user_idx long, query array<double>, kinds array<string>, weights array<double>"),
        spark.createDataFrame(items, "item_idx long, price double, kind string, unit double, vector array<double>"),
        spark.createDataFrame(seen + seen[:5], "user_idx long, item_idx long"),
    )


def by_hand(users, items, seen, k, chance, above=None):
    """Every pair, scored one by one."""
    hidden = {(r.user_idx, r.item_idx) for r in seen.collect()}
    things = items.collect()
    out = {}
    for u in users.collect():
        rows = []
        weights = dict(zip(u.kinds, u.weights))
        for i in things:
            cosine = weights.get(i.kind, 0.0) * (i.unit or 0.0) + (float(np.dot(u.query, i.vector)) if i.vector else 0.0)
            if (u.user_idx, i.item_idx) not in hidden and (above is None or round(cosine, 9) > above):
                rows.append((round(i.price * float(chance(np.array(cosine))) + 1e-10, 6), i.item_idx))
        for score, item in sorted(rows, key=lambda r: (-r[0], r[1]))[:k]:
            out[u.user_idx, item] = score
    return out


def same(found, want):
    rows = {(r.user_idx, r.item_idx): r.score for r in found.collect()}
    assert len(rows) == found.count() and rows.keys() == want.keys()
    assert all(abs(rows[key] - want[key]) < 2e-6 for key in rows)


# A lambda travels to the tasks by value; this module cannot be imported there.
nearness = lambda cosine: np.exp(cosine - 1.0)


def test_cones_equal_scoring_everything(spark):
    users, items, seen = tables(spark, 40, 700)
    counts = []
    same(cone_top_k(users, cone_index(items, 8), seen, K, nearness, counts=counts), by_hand(users, items, seen, K, nearness))
    assert sum(counts) < 40 * 700
    same(cone_top_k(users, cone_index(items, 8), None, K, nearness), by_hand(users, items, seen.limit(0), K, nearness))


def test_pairs_grow_slower_than_their_product(spark):
    counts = {}
    for times in (1, 2):
        users, items, seen = tables(spark, 60 * times, 3000 * times)
        cone_top_k(users, cone_index(items, 8), seen, K, nearness, counts=counts.setdefault(times, [])).count()
    assert sum(counts[1]) < 0.25 * 60 * 3000
    assert sum(counts[2]) < 3 * sum(counts[1])


def test_cones_split_busy_blocks(spark, monkeypatch):
    monkeypatch.setattr(cones, "BLOCK_USERS", 7)
    users, items, seen = tables(spark, 30, 200)
    same(cone_top_k(users, cone_index(items, 8), seen, 12, nearness), by_hand(users, items, seen, 12, nearness))


def test_cones_of_odd_tables(spark):
    users, items, seen = tables(spark, 6, 50)
    assert cone_top_k(users, cone_index(items.limit(0), 8), seen, K, nearness).count() == 0
    assert cone_top_k(users.limit(0), cone_index(items, 8), seen, K, nearness).count() == 0
    # More asked for than there are items; one price for all; users who have seen everything.
    flat = items.withColumn("price", F.lit(3.0)).withColumn("vector", F.lit(None).cast("array<double>"))
    everything = seen.union(items.select(F.lit(2).cast("long"), "item_idx"))
    same(cone_top_k(users, cone_index(flat, 8), everything, 80, nearness), by_hand(users, flat, everything, 80, nearness))


def test_kinds_need_no_columns(spark):
    """12,000 categories: more than could become columns."""
    random = np.random.default_rng(4)
    items = []
    for i in range(12_000):
        v = random.normal(size=2)
        length = float(np.sqrt(1 + v @ v))
        items.append((i, float(random.integers(1, 100)), f"kind {i}" if i % 50 else None, 1 / length if i % 50 else 0.0, (v / length).tolist()))
    users = []
    for u in range(8):
        kinds = [f"kind {u * 3 + j}" for j in range(1, u + 1)]
        weights = np.full(len(kinds), 1 / max(1, len(kinds)))
        query = random.normal(size=2) * 0.2
        length = float(np.sqrt(weights @ weights + query @ query))
        users.append((u, (query / length).tolist(), kinds, (weights / length).tolist()))
    users = spark.createDataFrame(users, "user_idx long, query array<double>, kinds array<string>, weights array<double>")
    items = spark.createDataFrame(items, "item_idx long, price double, kind string, unit double, vector array<double>")
    seen = spark.createDataFrame([(1, 4)], "user_idx long, item_idx long")
    index = cone_index(items, 2)
    assert len(index.cones.axes) <= cones.MAX_CONES
    same(cone_top_k(users, index, seen, K, lambda c: np.round(c, 9), above=0.0), by_hand(users, items, seen, K, lambda c: np.round(c, 9), above=0.0))


def test_content_serves_users_without_likes(shop):
    users, items, log = shop
    counts = []
    found = ContentBasedRecommender().fit(log, users, items).recommend(log, 3, users, items, counts=counts)
    assert 9 in {r.user_idx for r in found.collect()}  # has no rows at all
    none_liked = log.withColumn("relevance", F.lit(0.0))
    assert ContentBasedRecommender().fit(none_liked, users, items).recommend(log, 3, users, items).count() == 0


def walked(table, row):
    """Each tree followed from its root for one row of features."""
    total = 0.0
    for first in table.tree:
        node = first
        while table.feature[node] >= 0:
            if row[table.feature[node]] <= table.value[node]:
                node += 1
            else:
                left, node = 1, node + 1
                while left:  # skip the left part
                    left += 1 if table.feature[node] >= 0 else -1
                    node += 1
        total += table.value[node]
    return total


@pytest.fixture(scope="module")
def forest(shop):
    users, items, log = shop
    return EmbeddingForestRecommender(embedding_dim=4, revenue_boost=0.6, trees=6, depths=(3, 5), iterations=1).fit(log, users, items)


def test_table_of_trees_predicts_like_the_forest(forest):
    pairs = forest._features(forest.people.crossJoin(forest.things))
    for model in forest.models:
        table = forests.tree_table(model)
        rows = model.transform(pairs).select("features", model.getPredictionCol()).collect()
        points = np.array([r[0].toArray() for r in rows])
        assert np.allclose(forests.largest_values(table, points, points), [r[1] for r in rows])
        assert abs(walked(table, points[0]) - rows[0][1]) < 1e-9


def test_bounds_hold_in_boxes(forest):
    table = forests.tree_table(forest.models[1])
    random = np.random.default_rng(3)
    n = table.feature.max() + 1
    for _ in range(20):
        ends = np.sort(random.normal(size=(2, n)) * 20, axis=0)
        most = forests.largest_values(table, ends[:1], ends[1:])[0]
        inside = random.uniform(ends[0], ends[1], size=(200, n))
        values = forests.largest_values(table, inside, inside)
        assert values.max() <= most + 1e-9


@pytest.mark.parametrize("boost", [0.6, 4.5])
def test_embedding_forest_equals_scoring_everything(shop, forest, boost):
    users, items, log = shop
    forest.revenue_boost = boost
    rows = forest._features(forest.people.crossJoin(forest.things))
    for model in forest.models:
        rows = model.transform(rows)
    mean = (F.col("forest_0") + F.col("forest_1")) / 2
    score = F.greatest(F.col("price") * 0.05, F.least(F.col("price") * 0.9, mean * boost))
    seen = {(r.user_idx, r.item_idx) for r in log.collect()}
    lists = {}
    for r in rows.select("user_idx", "item_idx", score.alias("score")).collect():
        if (r.user_idx, r.item_idx) not in seen:
            lists.setdefault(r.user_idx, []).append((-r.score, r.item_idx))
    want = {(u, i): -s for u, v in lists.items() for s, i in sorted(v)[:3]}
    warm = users.join(log.select("user_idx").distinct(), "user_idx", "left_semi")
    found = {(r.user_idx, r.item_idx): r.score for r in forest.recommend(log, 3, warm, items).collect()}
    assert found.keys() == want.keys() and all(abs(found[x] - want[x]) < 1e-6 for x in found)
    assert forest.statistics().first().n_trees == 12


def test_forest_search_scores_few_pairs(spark):
    users = spark.range(40).select(F.col("id").alias("user_idx"))
    items = spark.range(1200).select(F.col("id").alias("item_idx"), (F.col("id") % 97 + 3.0).alias("price"))
    log = users.join(items, F.abs(F.hash("user_idx", "item_idx")) % 60 == 0).select("user_idx", "item_idx", (F.abs(F.hash("item_idx")) % 2).cast("double").alias("relevance"))
    counts = []
    model = EmbeddingForestRecommender(embedding_dim=4, revenue_boost=0.3, trees=5, depths=(3, 4), iterations=1).fit(log, users, items)
    model.recommend(log, K, users, items, counts=counts).count()
    assert sum(counts) < 0.25 * 40 * 1200


@pytest.mark.parametrize(("groups", "least"), [(1, 1), (2, 3), (128, 32)])
def test_users_are_sent_by_group_of_blocks(spark, monkeypatch, groups, least):
    monkeypatch.setattr(cones, "GROUP_BLOCKS", groups)
    monkeypatch.setattr(cones, "LEAST_GROUPS", least)
    users, items, seen = tables(spark, 30, 400)
    same(cone_top_k(users, cone_index(items, 8), seen, K, nearness), by_hand(users, items, seen, K, nearness))
