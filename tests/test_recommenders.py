import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from revrank.functions import expressions as E
from revrank.operators.features import item_vocabulary
from revrank.operators import knn
from revrank.operators.knn import knn_index, knn_join, knn_search
from revrank.operators.ranking import global_rank, grouped_top_k, top_k_per_user
from revrank.operators.sequences import padded_sequences
from revrank.recommenders import learned
from revrank.recommenders.graph import EmbeddingForestRecommender, GraphRecommender
from revrank.recommenders.learned import BoostedTreesRecommender, ForestRecommender, LinearMarginRecommender, NeighbourRecommender
from revrank.recommenders.sequence import BigramRecommender, ItemVectorRecommender, score_sequences
from revrank.recommenders.simple import ContentBasedRecommender, RandomRecommender

K = 4


def collected(df):
    return {(r["user_idx"], r["item_idx"]): r["score"] for r in df.collect()}


def check_lists(found, log, k, filtered=True):
    """At most k rows per user, no repeats, nothing seen."""
    rows = found.collect()
    pairs = [(r["user_idx"], r["item_idx"]) for r in rows]
    seen = {(r["user_idx"], r["item_idx"]) for r in log.collect()}
    assert rows and len(set(pairs)) == len(pairs)
    counts = defaultdict(int)
    for user, _ in pairs:
        counts[user] += 1
    assert max(counts.values()) <= k
    if filtered:
        assert not seen & set(pairs)
    return counts


def staged_by_hand(users, items, log, k, filter_seen, reach=20):
    """The four stages, one user at a time."""
    price = {r["item_idx"]: r["price"] for r in items.collect()}
    prices = list(price.values())
    p60, p75, p80 = np.percentile(prices, [60, 75, 80])
    mean = np.mean(prices)
    high = {i for i in price if price[i] >= p75}
    rows = defaultdict(list)
    for r in log.collect():
        rows[r["user_idx"]].append((r["__iter"], r["l_orderkey"], r["item_idx"], r["relevance"]))
    last = max(r[0] for h in rows.values() for r in h)
    weight, boost, profile = defaultdict(float), defaultdict(float), {}
    for user, history in rows.items():
        history.sort(key=lambda r: (r[0], r[1], r[2], r[3]))
        for (_, _, a, _), (t, _, b, _) in zip(history, history[1:]):
            w = 1 + t / last * 0.3
            weight[a, b] += w * (1.3 if b in high else 1)
            boost[a] = max(boost[a], w)
        liked = [price[i] for _, _, i, rel in history if rel > 0]
        if liked:
            m = np.mean(liked)
            profile[user] = (m, "p" if m > p80 else "h" if m > p60 else "r" if m > 0.8 * mean else "b")
    kept = {c: w for c, w in weight.items() if w >= 1}
    total, size = defaultdict(float), defaultdict(int)
    for (a, _), w in kept.items():
        total[a] += w
        size[a] += 1
    out = {}
    for user in (r["user_idx"] for r in users.collect()):
        m, tier = profile.get(user, (50.0, "r"))
        recent = [i for *_, i, _ in rows.get(user, [])][-20:]
        seen = recent if reach == 20 else [i for *_, i, _ in rows.get(user, [])]
        scores = {}
        for (a, b), w in kept.items():
            if recent and a == recent[-1]:
                p, match = price[b], 1 - min(0.4, abs(price[b] - m) / (m + 8))
                times = 1.0
                if tier == "p" and b in high:
                    times = 1.8 + 0.7 * match
                elif tier == "h" and b in high:
                    times = 1.6 + 0.6 * match
                elif tier == "r":
                    times = 1.4 + 0.5 * match
                elif tier == "b" and p < m:
                    times = 1.5 + 0.6 * match
                chance = (w + 1) / (total[a] + size[a]) * times * boost[a] * min(1.8, 0.4 * len(recent) + 1) * 2.2
                scores[b] = max(0.05, min(0.85, chance)) * p * (p / mean * (1.2 if b in high else 1)) * 3.5
        blocked = set(seen) if filter_seen else set()
        taste = {}
        for i, p in price.items():
            if i not in scores and i not in blocked:
                near = max(0.3, 1 - abs(p - m) / (m + 5))
                taste[i] = min(0.75, (0.15 + 0.25 * near) * (1.8 if i in high else 1.4)) * p * 1.5
        for i in sorted(taste, key=lambda i: (-round(taste[i], 9), i))[: max(0, k - len(scores))]:
            scores[i] = taste[i]
        for i in sorted(price):
            if len(scores) < k and i not in scores:
                scores[i] = price[i] * (1.1 if i in high else 1) * 0.2
        if filter_seen:
            for i in seen:
                scores.pop(i, None)
            for i in sorted(price):
                if len(scores) < k and i not in scores and i not in seen:
                    scores[i] = price[i] * (1.05 if i in high else 1) * 0.1
        for i in sorted(scores, key=lambda i: (-round(scores[i], 6), i))[:k]:
            out[user, i] = scores[i]
    return out


@pytest.mark.parametrize("filter_seen", [True, False])
def test_bigram_stages(shop, filter_seen):
    users, items, log = shop
    found = collected(BigramRecommender().fit(log, users, items).recommend(log, K, users, items, filter_seen))
    want = staged_by_hand(users, items, log, K, filter_seen)
    assert found.keys() == want.keys()
    assert all(abs(found[key] - want[key]) < 1e-5 for key in found)


def test_bigram_leaves_out_the_whole_log_if_asked(spark, shop):
    users, items, log = shop
    more = spark.range(40).selectExpr("id + 12 AS item_idx", "'x' AS category", "double(id * 7 % 90 + 5) AS price", "0.1D AS item_attr_0", "0.2D AS item_attr_1")
    items = items.unionByName(more)
    long = log.unionByName(spark.range(30).selectExpr("0L AS user_idx", "id + 12 AS item_idx", "1.0D AS relevance", "0 AS __iter", "id - 100 AS l_orderkey"))
    found = collected(BigramRecommender(seen="log").fit(long, users, items).recommend(long, K, users, items))
    want = staged_by_hand(users, items, long, K, True, reach=None)
    assert found.keys() == want.keys() and all(abs(found[key] - want[key]) < 1e-5 for key in found)
    assert not found.keys() & {(r["user_idx"], r["item_idx"]) for r in long.collect()}


def test_graph_scores_when_not_saturated(shop):
    users, items, log = shop
    model = GraphRecommender(n_components=3, max_iter=3, revenue_boost=0.05).fit(log, users, items)
    assert not model.saturated and GraphRecommender().saturated
    found = collected(model.recommend(log, K, users.filter("user_idx < 9"), items))
    m = np.zeros((9, 12))
    for r in model.cells.collect():
        m[r["user_idx"], r["item_idx"]] = r["weight"]
    left, right = np.zeros((9, 3)), np.zeros((12, 3))
    for r in model.factors()[0].collect():
        left[r["user_idx"]] = r["vector"]
    for r in model.factors()[1].collect():
        right[r["item_idx"]] = r["vector"]
    unit = m / np.linalg.norm(m, axis=0)
    mixed = 0.7 * left @ right.T + 0.3 * m @ (unit.T @ unit)
    norm = (mixed - mixed.min(1, keepdims=True)) / np.ptp(mixed, axis=1)[:, None]
    price = {r["item_idx"]: r["price"] for r in items.collect()}
    popularity = {r["item_idx"]: r["popularity"] for r in model.popularity.collect()}
    p60, p80 = np.percentile(list(price.values()), [60, 80])
    liked, seen = defaultdict(list), set()
    for r in log.collect():
        seen.add((r["user_idx"], r["item_idx"]))
        if r["relevance"] > 0:
            liked[r["user_idx"]].append(price[r["item_idx"]])
    want = {}
    for u in range(9):
        mean, sd, tier = 50.0, 15.0, "medium"
        if liked[u]:
            mean = np.mean(liked[u])
            sd = np.std(liked[u]) if len(liked[u]) > 1 else 15.0
            low = np.mean(list(price.values())) * 0.8
            tier = "premium" if mean > p80 else "high" if mean > p60 else "medium" if mean > low else "low"
        activity = min(1.0, m[u].sum() / 10)
        scores = {}
        for i, p in price.items():
            if (u, i) in seen:
                continue
            match = max(0.4, 1 - min(0.6, abs(p - mean) / max(sd, 5)))
            if tier == "premium" and p > 55:
                times = 2.5 + 1.2 * match
            elif tier == "high" and p > 35:
                times = 2.2 + match
            elif tier == "medium":
                times = 2.0 + 0.9 * match if p <= 1.5 * mean else 1.6 + 0.6 * match
            else:
                times = 1.9 + 0.8 * match if p <= 1.2 * mean else 1.4
            chance = max(0.25, min(0.8, 3.2 * norm[u, i])) * times
            chance *= 1.6 + min(1.2, 1.5 * popularity[i] / max(max(popularity.values()), 1))
            chance *= (1.4 + 0.8 * activity) * (1 + 0.5 * activity) * 0.05
            scores[i] = max(0.15, min(0.9, chance)) * p
        for i in sorted(scores, key=lambda i: (-round(scores[i], 6), i))[:K]:
            want[u, i] = scores[i]
    assert found.keys() == want.keys()
    assert all(abs(found[key] - want[key]) < 1e-5 for key in found)


def test_graph_default_ranks_unseen_training_items_by_price(shop):
    users, items, log = shop
    model = GraphRecommender().fit(log, users, items)
    counts = check_lists(model.recommend(log, K, users, items), log, K)
    assert counts[9] == K  # the user without rows is served from the cold-start scores


def test_embedding_forest_stays_between_its_bounds(shop):
    users, items, log = shop
    model = EmbeddingForestRecommender(embedding_dim=4, revenue_boost=1.0, trees=5, depths=(3, 4), iterations=1)
    found = model.fit(log, users, items).recommend(log, K, users, items)
    check_lists(found, log, K)
    warm = found.join(log.select("user_idx").distinct(), "user_idx", "left_semi").join(items, "item_idx")
    assert warm.filter((F.col("score") > F.col("price") * 0.9 + 1e-6) | (F.col("score") < F.col("price") * 0.05)).count() == 0


@pytest.fixture(scope="module")
def planted(spark):
    """Relevance follows from segment and price, so learners can find it."""
    users = spark.range(60).select(
        F.col("id").alias("user_idx"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("segment"),
        (F.col("id") / 60).alias("user_attr_0"),
    )
    items = spark.range(40).select(
        F.col("id").alias("item_idx"), F.lit("x").alias("category"), (F.col("id") * 2.5 + 1).alias("price"),
        (F.col("id") / 40).alias("item_attr_0"),
    )
    liked = ((F.col("segment") == "A") == (F.col("price") > 50)).cast("double")
    log = users.join(items, F.abs(F.hash("user_idx", "item_idx")) % 3 == 0)
    return users, items, log.select("user_idx", "item_idx", liked.alias("relevance"))


@pytest.mark.parametrize(
    "model, floor",
    [
        (ForestRecommender(trees=10, depth=4), 0.95),
        (BoostedTreesRecommender(rounds=10), 0.95),
        (NeighbourRecommender(n=5), 0.8),
    ],
)
def test_learners_find_a_planted_signal(planted, model, floor):
    users, items, log = planted
    model.fit(log, users, items)
    rows = model.probability(model.features(log.join(users, "user_idx").join(items, "item_idx")))
    area = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="relevance").evaluate(rows.select("prob", "relevance"))
    assert area > floor
    check_lists(model.recommend(log, K, users, items), log, K)
    if isinstance(model, ForestRecommender):
        names = [r["feature"] for r in model.feature_importance().collect()]
        assert len(names) == len(set(names)) and "price" in names[:4]


def test_search_keeps_the_best_setting(planted):
    users, items, log = planted
    forest = ForestRecommender(trees=3, depth=1).fit_best(log, users, items, folds=2, grid={"maxDepth": [1, 4], "numTrees": [5]})
    assert (forest.depth, forest.trees) == (4, 5) and forest.model.getNumTrees == 5
    near = NeighbourRecommender(n=50).fit_best(log, users, items, ns=(3, 400), metrics=("euclidean",))
    assert (near.n, near.metric) == (3, "euclidean")
    check_lists(near.recommend(log, K, users, items), log, K)


def test_neighbour_grid_against_all_distances(shop):
    users, items, log = shop
    model = NeighbourRecommender()
    data = model.prepare(log, users, items)
    found = {(s["n"], s["metric"]): right for s, right in model.search(data, ns=(1, 3, 10), folds=3)}
    rows = sorted((r.user_idx, r.item_idx, r.label, tuple(r.features.toArray())) for r in data.collect())
    folds = {(r.user_idx, r.item_idx): r.fold for r in data.select("user_idx", "item_idx", E.hash_bucket(F.concat_ws("-", "user_idx", "item_idx"), 3).alias("fold")).collect()}
    points = np.array([r[3] for r in rows])
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    away = {
        "euclidean": np.sqrt(((points[:, None] - points) ** 2).sum(axis=2)),
        "manhattan": np.abs(points[:, None] - points).sum(axis=2),
        "cosine": 1 - unit @ unit.T,
    }
    for (n, metric), right in found.items():
        shares = []
        for fold in range(3):
            hits = []
            for i, r in enumerate(rows):
                if folds[r[:2]] == fold:
                    others = [j for j, o in enumerate(rows) if folds[o[:2]] != fold]
                    near = sorted(others, key=lambda j: (round(away[metric][i, j], 6), j))[:n]
                    hits.append((sum(rows[j][2] for j in near) / n > 0.5) == (r[2] > 0.5))
            if hits:
                shares.append(sum(hits) / len(hits))
        assert abs(right - sum(shares) / len(shares)) < 1e-9


def test_index_serves_several_searches(spark):
    random = np.random.default_rng(3)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(random.normal(size=(300, 3)))], "point_id long, vector array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(random.normal(size=(20, 3)))], "query_id long, vector array<double>")
    index = knn_index(points, "manhattan", 7, pivots=9, block_rows=11)
    for n in (1, 7):
        one, other = (sorted(map(tuple, f.select("query_id", "neighbour", "point_id", "distance").collect())) for f in (knn_search(asked, index, n), knn_join(asked, points, n, "manhattan")))
        assert one == other and len(one) == 20 * n
    with pytest.raises(ValueError):
        knn_search(asked, index, 8)


def test_training_rows_of_one_file_are_dealt_to_all_cores(spark, monkeypatch):
    data = spark.range(0, 1000, 1, 1).selectExpr("id AS user_idx", "id AS item_idx")
    assert learned.dealt_to_tasks(data).rdd.getNumPartitions() == 1  # too few to be worth it
    monkeypatch.setattr(learned, "TASK_ROWS", 400)
    dealt = learned.dealt_to_tasks(data)
    assert dealt.rdd.getNumPartitions() == 3 and sorted(r["user_idx"] for r in dealt.collect()) == list(range(1000))
    monkeypatch.setattr(learned, "TASK_ROWS", 1)
    assert learned.dealt_to_tasks(data).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_a_query_is_sent_once_to_a_pack_of_cells(spark, monkeypatch, metric):
    """Cells share packs or are cut into several; points that come twice, equal distances and own parts as by brute force."""
    random = np.random.default_rng(5)
    vectors = np.round(random.normal(size=(240, 4)) + 6 * random.integers(0, 3, size=(240, 1)), 1)
    rows = [(i % 200, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    points = spark.createDataFrame(rows, "point_id long, vector array<double>, part int")
    asked = points.filter("point_id >= 60 AND point_id < 180").withColumnRenamed("point_id", "query_id")
    sent, visit = [], knn._visit
    monkeypatch.setattr(knn, "_visit", lambda routed, *rest: sent.append(routed) or visit(routed, *rest))
    monkeypatch.setattr(knn, "TASK_PAIRS", 500)
    index = knn_index(points, metric, 6, pivots=12, block_rows=40)
    found = defaultdict(list)
    for r in knn_search(asked, index, 5, exclude_same_id=True).orderBy("query_id", "neighbour").collect():
        found[r["query_id"]].append((r["distance"], r["point_id"]))
    packs = int((index.first_pack + index.packs).max())
    assert 240 / 40 <= packs < 12 + 240 / 40
    for routed in sent:
        assert all(len(set(r["packs"])) == len(r["packs"]) <= packs for r in routed.collect())
    for name, own, part in rows[60:180]:
        own = np.array(own)
        def far(v):
            if metric == "cosine":
                return 1 - own @ v / np.sqrt((own @ own) * (v @ v))
            return np.abs(own - v).sum() if metric == "manhattan" else np.sqrt(((own - v) ** 2).sum())
        want = sorted((far(np.array(v)), i) for i, v, p in rows if p != part and i != name)[:5]
        assert np.allclose([d for d, _ in found[name]], [d for d, _ in want], atol=2e-6)


def by_every_pair(model, log, k, users, items):
    """Top k by scoring all pairs."""
    pairs = users.crossJoin(items.withColumn("price", E.clean_price("price")))
    rows = model.probability(model.features(pairs)).withColumn("score", E.shown(E.expected_revenue("prob", "price")))
    rows = rows.join(log.select("user_idx", "item_idx").distinct(), ["user_idx", "item_idx"], "left_anti")
    return collected(top_k_per_user(rows, k).select("user_idx", "item_idx", "score"))


@pytest.fixture(scope="module")
def linear(spark):
    """Rows are positive where a user attribute and an item attribute add up to much."""
    users = spark.range(60).selectExpr("id AS user_idx", "if(id % 2 = 0, 'A', 'B') AS segment", "id / 60.0D AS user_attr_0")
    items = spark.range(50).selectExpr("id AS item_idx", "if(id % 3 = 0, 'x', 'y') AS category", "20.0D + id % 7 AS price", "(id * 17 % 50) / 50.0D AS item_attr_0")
    pairs = users.join(items, F.abs(F.hash("user_idx", "item_idx")) % 3 == 0)
    return users, items, pairs.selectExpr("user_idx", "item_idx", "if(user_attr_0 + item_attr_0 > 1.0, 1.0D, 0.0D) AS relevance")


@pytest.mark.parametrize("model", [LinearMarginRecommender(), ForestRecommender(trees=5, depth=3), BoostedTreesRecommender(rounds=5)])
def test_learners_on_a_linear_signal(linear, model):
    users, items, log = linear
    model.fit(log, users, items)

    def area(rows):
        return BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="relevance").evaluate(rows.select("prob", "relevance"))

    assert area(model.probability(model.features(log.join(users, "user_idx").join(items, "item_idx")))) > 0.9
    assert collected(model.recommend(log, K, users, items)) == by_every_pair(model, log, K, users, items)
    shuffled = log.withColumn("relevance", (F.abs(F.hash("user_idx", "item_idx", F.lit(1))) % 2).cast("double"))
    model.fit(shuffled, users, items)
    other = shuffled.withColumn("relevance", (F.abs(F.hash("user_idx", "item_idx", F.lit(2))) % 2).cast("double"))
    assert 0.35 < area(model.probability(model.features(other.join(users, "user_idx").join(items, "item_idx")))) < 0.65


def test_search_by_groups_scores_no_more_for_more_users(spark):
    """With ten kinds of users, twice the users score no pair more; twice the items at most their share."""
    counted = []

    def run(n_users, n_items):
        users = spark.range(n_users).selectExpr("id AS user_idx", "id % 10 AS kind")
        items = spark.range(n_items).selectExpr("id AS item_idx", "double(id % 97) AS price", "double(id % 97) AS bound")
        seen = spark.range(n_users).selectExpr("id AS user_idx", "explode(sequence(90L, 96L)) AS item_idx")
        total = 0

        def score(pairs):
            nonlocal total
            total += pairs.count()
            return pairs.withColumn("score", F.col("price") * (F.lit(0.5) + F.pmod(F.hash("kind", "item_idx"), F.lit(100)) / 200))

        ranked = global_rank(items, F.col("bound").desc(), "item_idx")
        found = collected(grouped_top_k(users, ["kind"], ranked, seen, K, score, ["price"]))
        every = score(users.crossJoin(items)).join(seen, ["user_idx", "item_idx"], "left_anti")
        total -= n_users * n_items
        assert found == collected(top_k_per_user(every, K).select("user_idx", "item_idx", "score"))
        counted.append(total)

    run(100, 400)
    run(200, 400)
    assert counted[1] == counted[0] <= 10 * 400


def test_item_vectors_and_scorer(shop):
    users, items, log = shop
    for attention in (False, True):
        model = ItemVectorRecommender(size=3, iterations=2, attention=attention).fit(log, users, items)
        counts = check_lists(model.recommend(log, K, users, items), log, K)
        # Everyone gets what is left unseen, the user without rows too.
        left = {r["user_idx"]: 12 - r["n"] for r in log.groupBy("user_idx").agg(F.countDistinct("item_idx").alias("n")).collect()}
        assert counts == {u: min(K, left.get(u, 12)) for u in range(10) if left.get(u, 12)}
    padded = padded_sequences(log, items, item_vocabulary(log), 8)
    lengths = score_sequences(padded, lambda batch: pd.Series([float(sum(m)) for m in batch["mask"]])).collect()
    assert len(lengths) == log.select("user_idx").distinct().count() and max(r["score"] for r in lengths) == 8.0


def test_results_do_not_depend_on_partitioning(shop):
    users, items, log = shop
    for make in (RandomRecommender, ContentBasedRecommender):
        one = collected(make().fit(log, users, items).recommend(log, K, users, items))
        other = log.repartition(7, "item_idx")
        two = collected(make().fit(other, users, items.repartition(5)).recommend(other, K, users, items.repartition(3)))
        assert one == two
