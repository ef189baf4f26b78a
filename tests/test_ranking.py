import random

import pytest
from pyspark.sql import functions as F

from revrank.functions import expressions as E
from revrank.operators import ranking as R
from revrank.operators.features import dense_index, minmax_per_user, softmax_per_user


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def world(spark):
    draw = random.Random(1)
    users = list(range(8))
    scores = {i: float(draw.randrange(6)) for i in range(40)}
    seen = {(u, i) for u in users for i in range(40) if draw.random() < (0.95 if u == 0 else 0.2)}
    seen |= {(1, i) for i in range(40)}
    return (
        users,
        scores,
        seen,
        spark.createDataFrame([(u,) for u in users], "user_idx long"),
        spark.createDataFrame(list(scores.items()), "item_idx long, score double"),
        spark.createDataFrame(list(seen) * 2, "user_idx long, item_idx long"),
    )


def brute(users, order, seen, k):
    return sorted((u, i) for u in users for i in [i for i in order if (u, i) not in seen][:k])


def test_global_rank_and_running_sum(world):
    *_, items, _ = world
    ranked = R.global_rank(items, F.col("score").desc(), "item_idx")
    want = sorted(world[1], key=lambda i: (-world[1][i], i))
    assert ranked.size == 40
    assert [i for _, i in rows(ranked.items, "rank", "item_idx")] == want
    summed = R.global_running_sum(items.withColumn("w", F.col("score").cast("int")), "w", "item_idx")
    total, expected = 0, []
    for i in sorted(world[1]):
        total += int(world[1][i])
        expected.append((i, total))
    assert rows(summed, "item_idx", "running") == expected


@pytest.mark.parametrize("broadcast_rows", [1000, 3])
def test_first_unseen_equals_brute_force(world, monkeypatch, broadcast_rows):
    monkeypatch.setattr(R, "BROADCAST_ROWS", broadcast_rows)
    users, scores, seen, u, i, s = world
    ranked = R.global_rank(i, F.col("score").desc(), "item_idx")
    order = sorted(scores, key=lambda x: (-scores[x], x))
    found = R.first_unseen(u, ranked, s, 5)
    assert rows(found, "user_idx", "item_idx") == brute(users, order, seen, 5)
    everyone = R.for_all_users(u, ranked, 3, ["item_idx"])
    assert rows(everyone, "user_idx", "item_idx") == brute(users, order, set(), 3)


def test_first_unseen_joins_the_log_with_the_reachable_head_only(spark, monkeypatch):
    """Items that come twice take two places of a user who has seen them; others see no more than the head."""
    items = spark.range(5_000).selectExpr("id AS item_idx", "-cast(id AS double) AS score")
    twice = items.unionByName(items.filter("item_idx < 4"))
    ranked = R.global_rank(twice, F.col("score").desc(), "item_idx")
    seen = spark.createDataFrame([(0, 0), (0, 1), (0, 3), (1, 4_000), (1, 4_001), (None, 2), (2, None)], "user_idx long, item_idx long")
    users = spark.createDataFrame([(0,), (1,), (2,), (3,)], "user_idx long")
    served, serve = [], R.items_at_rank
    monkeypatch.setattr(R, "items_at_rank", lambda pairs, catalogue, columns: served.append(catalogue.size) or serve(pairs, catalogue, columns))
    found = R.first_unseen(users, ranked, seen, 3)
    want = [(0, 2), (0, 2), (0, 4)] + [(u, i) for u in (1, 2, 3) for i in (0, 0, 1)]
    assert rows(found, "user_idx", "item_idx") == want
    assert served == [9]  # need 3 + 3 rows × 2 places


def test_first_unseen_with_shifted_start(world):
    users, scores, seen, u, i, s = world
    ranked = R.global_rank(i, "item_idx")
    shifted = u.withColumn("start", F.col("user_idx") * 7)
    want = sorted(
        (x, y) for x in users for y in [p for p in [(n + 7 * x) % 40 for n in range(40)] if (x, p) not in seen][:4]
    )
    assert rows(R.first_unseen(shifted, ranked, s, 4, shift="start"), "user_idx", "item_idx") == want


@pytest.mark.parametrize("first", [2, 64])
def test_best_first_equals_scoring_everything(world, first):
    users, scores, seen, u, i, s = world
    catalogue = R.global_rank(i.withColumn("bound", F.col("score")), F.col("bound").desc(), "item_idx")
    share = F.abs(F.hash("user_idx", "item_idx")) % 10 / 10.0

    def score(pairs):
        return pairs.withColumn("score", F.col("bound") * share)

    found = R.best_first_top_k(u, catalogue, s, 3, score, [], first=first, growth=2)
    full = u.join(i.withColumnRenamed("score", "bound"), F.lit(True)).withColumn("score", F.col("bound") * share)
    want = R.top_k_per_user(R.filter_seen(full, s), 3)
    assert rows(found, "user_idx", "item_idx", "score") == rows(want, "user_idx", "item_idx", "score")


def test_ranks_are_generated_in_bounded_arrays(spark):
    made = R.explode_ranks(spark.createDataFrame([(1, 5, 3000), (2, 9, 8)], "u long, a long, b long"), F.col("a"), F.col("b"))
    assert rows(made, "u", "rank") == [(1, n) for n in range(5, 3001)]


def test_index_and_scaling(spark):
    df = spark.createDataFrame([(5, 1, 2.0), (5, 2, 6.0), (3, 1, 4.0)], "user_idx long, item_idx long, v double")
    assert rows(dense_index(df, "user_idx"), "user_idx", "idx") == [(3, 0), (5, 1)]
    assert rows(minmax_per_user(df, "v"), "user_idx", "norm") == [(3, 0.5), (5, 0.0), (5, 1.0)]
    sums = softmax_per_user(df, "v").groupBy("user_idx").agg(F.round(F.sum("prob"), 9).alias("s"))
    assert rows(sums, "s") == [(1.0,), (1.0,)]


def test_margin_search_equals_scoring_everything_and_grows_with_users_only(spark):
    """Prices of both signs, equal items, a user who has seen nearly all; more items score no more pairs."""
    users = spark.range(400).selectExpr("if(id = 0, NULL, id) AS user_idx", "(id * 37 % 400) / 100.0D - 2 AS user_margin")

    def score(pairs):
        return pairs.withColumn("score", E.shown(F.col("price") / (1 + F.exp(-(F.col("user_margin") + F.col("item_margin"))))))

    def run(n_items, copies, low):
        items = spark.range(n_items).selectExpr(
            "id AS item_idx", f"id div {copies} * 7919 % 1000 * 0.1D + {low} AS price", f"id div {copies} * 104729 % 997 / 500.0D - 1 AS item_margin"
        )
        seen = spark.range(1, 400, 3).selectExpr("id AS user_idx", f"explode(sequence(if(id = 1, 0, id % 2), {n_items} - 1, if(id = 1, 1, 7))) AS item_idx")
        counts = []
        found = R.margin_top_k(users, items, seen, 3, score, counts=counts)
        every = users.join(seen.withColumnRenamed("item_idx", "s"), "user_idx", "left").groupBy("user_idx", "user_margin").agg(F.collect_set("s").alias("s"))
        every = score(every.crossJoin(items).filter(~F.array_contains("s", F.col("item_idx"))))
        expected = R.top_k_per_user(every, 3).select("user_idx", "item_idx", "score")
        key = lambda r: (r[0] is None, r[0] or 0, -r[2], r[1])
        assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
        return counts

    few, many = run(1000, 1, 0.0), run(4000, 4, 0.0)
    run(300, 1, -40.0)
    assert run(2, 1, -5.0) and few[0] < 400 * 60 and many[0] < 400 * 60
    assert sum(many) < 2 * sum(few)


def test_alike_items_are_searched_once(spark):
    """Equal items, an id with two prices, an item without id: the rows of every pair, and copies score no more pairs."""
    users = spark.range(12).selectExpr("id AS user_idx", "id % 3 AS kind")
    seen = spark.range(12).selectExpr("id AS user_idx", "explode(sequence(id, 30L, 2L)) AS item_idx")
    scored = []

    def run(copies):
        items = spark.range(40 * copies).selectExpr("nullif(id, 39) AS item_idx", "double(10 + id % 40 div 2) AS price", "id % 40 % 3 AS mark")
        items = items.unionByName(items.filter("item_idx IN (31, 33)").withColumn("price", F.lit(28.0)))
        ranked = R.global_rank(items.withColumn("bound", F.col("price")), F.col("bound").desc(), "item_idx", "price")
        total = 0

        def score(pairs):
            nonlocal total
            total += pairs.count()
            return pairs.withColumn("score", F.col("price") * (F.lit(0.5) + F.pmod(F.hash("kind", "mark"), F.lit(5)) / 10))

        found = R.grouped_top_k(users, ["kind"], ranked, seen, 4, score, ["price", "mark"], first=8, alike=["price", "mark"])
        found = sorted(map(repr, found.select("user_idx", "item_idx", "score").collect()))
        scored.append(total)
        every = score(users.crossJoin(items)).join(seen, ["user_idx", "item_idx"], "left_anti")
        assert found == sorted(map(repr, R.top_k_per_user(every, 4).select("user_idx", "item_idx", "score").collect()))

    run(1)
    run(5)
    assert scored[1] <= 1.2 * scored[0]
