"""Graph recommenders: factors smoothed over the interaction graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.factorise import nmf, svd
from revrank.operators.features import minmax_per_user, shown_values
from revrank.operators.forests import product_range, tree_table, vector_range, with_bound
from revrank.operators.graph import graph_smooth, interaction_cells, unit_cells
from revrank.operators.profile import (
    item_popularity,
    item_value_score,
    lookup_default,
    scalar,
    user_activity_profile,
    user_price_profile,
)
from revrank.operators.ranking import (
    Catalogue,
    best_first_top_k,
    explode_ranks,
    filter_seen,
    first_unseen,
    for_all_users,
    global_rank,
    items_at_rank,
    split_cold_users,
    top_k_per_user,
)
from revrank.recommenders.base import Recommender, by_price, by_score, user_ids
from revrank.session import cut_lineage

# Smallest product of the warm-user factors, and their cap.
SMALLEST_PRODUCT = 0.25 * 1.4 * 1.6 * 1.4
WARM_CAP = 0.9
# Entries of each embedding that the forests see, and of their product.
WIDTH, SHORT = 32, 16
# Numbers of one side of a block of pairs, pairs for which a further task is worth it, and rows made at once.
FEATURE_NUMBERS = 24_000_000
FEATURE_PAIRS = 50_000
ROWS_AT_ONCE = 16_384
# Items of like price in one box of the search.
BOX_ITEMS = 64


def price_moments(items: DataFrame) -> tuple:
    stats = items.agg(F.avg("price").alias("mean"), F.stddev_pop("price").alias("std"))
    return stats.select("mean").scalar(), stats.select("std").scalar()


def with_popularity(items: DataFrame, popularity: DataFrame, default: float = 0.1) -> DataFrame:
    return lookup_default(items, popularity.select("item_idx", "popularity"), "item_idx", {"popularity": default})


def _range_scaled(value, table: DataFrame, column: str):
    """Scaled by the column's range over a table; 0.5 when the range is empty."""
    low, high = scalar(table, F.min(column)), scalar(table, F.max(column))
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.5))


def graph_cold_start(items: DataFrame, catalogue: DataFrame, popularity: DataFrame, boost: float = 4.0) -> DataFrame:
    """Item scores for users without history.

    ``items`` are those to score, ``catalogue`` the whole item table that gives
    mean and deviation of prices.
    """
    mean, std = price_moments(catalogue)
    rows = with_popularity(items.select("item_idx", "price"), popularity)
    price = F.col("price")
    # Weights, price bands and limits of a cold item's chance.
    appeal = F.greatest(F.lit(0.3), F.lit(1.0) - F.abs((price - mean) / F.greatest(std, F.lit(1.0))) * 0.2)
    base = E.clamp(_range_scaled(F.col("popularity"), popularity, "popularity") * 0.8 + appeal * 0.4, 0.15, 0.6)
    lift = F.when(price.between(30, 80), F.lit(1.4)).when(price > 80, F.lit(1.2)).otherwise(F.lit(1.3))
    chance = E.clamp(base * lift * 1.2 * min(1.8, boost), 0.08, 0.7)
    return rows.select("item_idx", "price", E.shown(E.expected_revenue(chance, price)).alias("score"))


def graph_fallback(items: DataFrame, popularity: DataFrame, boost: float = 4.0) -> DataFrame:
    """Item scores used when there is no fitted model; seen items do not matter."""
    mean, std = price_moments(items)
    rows = with_popularity(items.select("item_idx", "price"), popularity)
    price = F.col("price")
    # Weights, price bands and limits of the fallback's chance.
    appeal = F.greatest(F.lit(0.4), F.lit(1.0) - F.abs((price - mean) / F.greatest(std, F.lit(1.0))) * 0.15)
    base = E.clamp(_range_scaled(F.col("popularity"), popularity, "popularity") * 0.7 + appeal * 0.5, 0.2, 0.65)
    lift = F.when(price.between(35, 85), F.lit(1.5)).when(price > 85, F.lit(1.3)).otherwise(F.lit(1.4))
    chance = E.clamp(base * lift * min(2.0, boost), 0.15, 0.75)
    return rows.select("item_idx", "price", E.shown(E.expected_revenue(chance, price)).alias("score"))


def fallback_for_users(users: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """The same best k items for every user."""
    return for_all_users(user_ids(users), by_score(scored), k, ["item_idx", "score"]).select(
        "user_idx", "item_idx", "score"
    )


def warm_probability(norm, price, mean, std, tier, popularity_share, activity, boost: float):
    """Chance of a purchase from the scaled mixed score and the user's profile."""
    base = E.clamp(norm * 3.2, 0.25, 0.8)
    distance = F.abs(price - mean) / F.greatest(std, F.lit(5.0))
    match = F.greatest(F.lit(0.4), F.lit(1.0) - F.least(F.lit(0.6), distance))
    # Base and slope of the tier multipliers.
    multiplier = (
        F.when((tier == "premium") & (price > 55), F.lit(2.5) + match * 1.2)
        .when((tier == "high") & (price > 35), F.lit(2.2) + match * 1.0)
        .when((tier == "medium") & (price <= mean * 1.5), F.lit(2.0) + match * 0.9)
        .when(tier == "medium", F.lit(1.6) + match * 0.6)
        .when(price <= mean * 1.2, F.lit(1.9) + match * 0.8)
        .otherwise(F.lit(1.4))
    )
    popular = F.lit(1.6) + F.least(F.lit(1.2), popularity_share * 1.5)
    strength = F.lit(1.4) + activity * 0.8
    compatible = F.lit(1.0) + activity * 0.5
    return E.clamp(base * multiplier * popular * strength * compatible * min(4.0, boost), 0.15, WARM_CAP)


class GraphRecommender(Recommender):
    """Non-negative factors, smoothed over similar users and items, plus item similarity.

    The factors are fitted on first use: with ``revenue_boost`` at or above about
    1.15 every chance reaches its cap whatever the factors are, and the ranking is
    the unseen training items by price. That case is answered without them, provided
    no relevance is negative, which fitting checks.
    """

    name = "graph"

    def __init__(
        self,
        n_components: int = 32,
        alpha: float = 0.1,
        max_iter: int = 10,
        graph_weight: float = 0.25,
        revenue_boost: float = 4.0,
        seed: int = 42,
    ):
        self.n_components, self.alpha, self.max_iter = n_components, alpha, max_iter
        self.graph_weight, self.revenue_boost, self.seed = graph_weight, revenue_boost, seed
        self.least_relevance = 0.0
        self._factors: tuple[DataFrame, DataFrame] | None = None

    def fit(self, log, users, items):
        self.check(log, items)
        priced = items.withColumn("price", E.clean_price("price"))
        self.log = log.select("user_idx", "item_idx", "relevance")
        self.items = priced.select("item_idx", "price")
        self.popularity = cut_lineage(item_popularity(self.log, self.items).select("item_idx", "popularity"))
        self.least_relevance = self.log.agg(F.min("relevance")).first()[0] or 0.0
        self._factors = None
        return self

    @property
    def saturated(self) -> bool:
        return self.least_relevance >= 0 and SMALLEST_PRODUCT * min(4.0, self.revenue_boost) >= WARM_CAP

    def factors(self) -> tuple[DataFrame, DataFrame]:
        """Smoothed user and item factors, fitted once."""
        if self._factors is None:
            self.cells = cut_lineage(interaction_cells(self.log, self.items, "price"))
            users, items = nmf(self.cells, self.n_components, self.max_iter, self.alpha, self.seed)
            self._factors = (
                cut_lineage(graph_smooth(self.cells, users, "user_idx", "item_idx", self.graph_weight, self.n_components)),
                cut_lineage(graph_smooth(self.cells, items, "item_idx", "user_idx", self.graph_weight, self.n_components)),
            )
        return self._factors

    def statistics(self) -> DataFrame:
        return self.log.agg(
            F.countDistinct("user_idx").alias("n_users"),
            F.countDistinct("item_idx").alias("n_items"),
            F.count("*").alias("n_interactions"),
        )

    def recommend(self, log, k, users, items, filter_seen_items=True):
        train_items = self.items.join(self.log.select("item_idx").distinct(), "item_idx", "left_semi")
        candidates = train_items.join(items.select("item_idx"), "item_idx", "left_semi")
        seen = log if filter_seen_items else None
        warm, cold = split_cold_users(user_ids(users), self.log)
        cold_scores = graph_cold_start(candidates, self.items, self.popularity, self.revenue_boost)
        cold_rows = first_unseen(cold, by_score(cold_scores), seen, k, ["item_idx", "score"])
        if self.saturated:
            ranked = by_price(candidates)
            found = first_unseen(warm, ranked, seen, k, ["item_idx", "price"])
            warm_rows = found.withColumn("score", E.shown(F.lit(WARM_CAP) * F.col("price")))
        else:
            warm_rows = self._recommend_by_scores(warm, candidates, seen, k)
        columns = ["user_idx", "item_idx", "score"]
        return warm_rows.select(*columns).unionByName(cold_rows.select(*columns))

    def mixed_scores(self, warm: DataFrame) -> DataFrame:
        """0.7 · factor dot + 0.3 · graph affinity of warm users and all training items.

        Scaling needs each user's smallest and largest score over all items, so
        this is a full user × item evaluation; it is only reached when the chance
        is not capped.
        """
        users, items = self.factors()
        numbered = global_rank(items, "item_idx")
        people = users.join(warm, "user_idx", "left_semi").withColumnRenamed("vector", "uv")
        dense = items_at_rank(explode_ranks(people, F.lit(1), F.lit(numbered.size)), numbered, ["item_idx", "vector"])
        dots = dense.select("user_idx", "item_idx", E.dot(F.col("uv"), F.col("vector")).alias("dot"))
        unit = unit_cells(self.cells, "item_idx")
        peers = (
            self.cells.join(warm, "user_idx", "left_semi")
            .join(unit.select("item_idx", F.col("user_idx").alias("peer"), F.col("weight").alias("w")), "item_idx")
            .groupBy("user_idx", "peer")
            .agg(F.sum(F.col("weight") * F.col("w")).alias("share"))
        )
        spread = (
            peers.join(unit.select(F.col("user_idx").alias("peer"), "item_idx", "weight"), "peer")
            .groupBy("user_idx", "item_idx")
            .agg(F.sum(F.col("share") * F.col("weight")).alias("near"))
        )
        joined = dots.join(spread, ["user_idx", "item_idx"], "left")
        return joined.select(
            "user_idx", "item_idx", (F.col("dot") * 0.7 + F.coalesce("near", F.lit(0.0)) * 0.3).alias("mixed")
        )

    def _recommend_by_scores(self, warm, candidates, seen, k):
        scaled = minmax_per_user(self.mixed_scores(warm), "mixed", "norm").drop("mixed")
        if seen is not None:
            scaled = filter_seen(scaled, seen)
        profiles = user_price_profile(self.log, self.items).select("user_idx", "mean_price", "std_price", "tier")
        rows = self.cells.groupBy("user_idx").agg(F.least(F.lit(1.0), F.sum("weight") / 10.0).alias("activity"))
        people = rows.join(profiles, "user_idx", "left").select(
            "user_idx",
            "activity",
            F.coalesce("mean_price", F.lit(50.0)).alias("mean_price"),
            F.coalesce("std_price", F.lit(15.0)).alias("std_price"),
            F.coalesce("tier", F.lit("medium")).alias("tier"),
        )
        top = scalar(self.popularity, F.max("popularity"))
        described = with_popularity(candidates, self.popularity).withColumn(
            "popularity_share", F.col("popularity") / F.greatest(top, F.lit(1.0))
        )
        pairs = scaled.join(people, "user_idx").join(described, "item_idx")
        chance = warm_probability(
            F.col("norm"),
            F.col("price"),
            F.col("mean_price"),
            F.col("std_price"),
            F.col("tier"),
            F.col("popularity_share"),
            F.col("activity"),
            self.revenue_boost,
        )
        return top_k_per_user(pairs.withColumn("score", E.shown(chance * F.col("price"))), k)


def embedding_cold_start(items: DataFrame, scores: DataFrame, boost: float = 4.5) -> DataFrame:
    """Item scores for unknown users from positive rate and value score."""
    rows = lookup_default(
        items.select("item_idx", "price"),
        scores.select("item_idx", "popularity", "value_score"),
        "item_idx",
        {"popularity": 0.0, "value_score": 0.0},
    )
    price = F.col("price")
    # Weights and price bands of a cold item's score.
    base = F.col("popularity") * 0.4 + F.least(F.lit(1.0), F.col("value_score")) * 0.1
    lift = F.when(price.between(35, 75), F.lit(1.3)).when(price > 75, F.lit(1.1)).otherwise(F.lit(1.2))
    return rows.select("item_idx", "price", E.shown(base * lift * min(1.5, boost) * price).alias("score"))


class EmbeddingForestRecommender(Recommender):
    """Singular-vector embeddings and profile features into two averaged forests.

    Users and items are searched by branch and bound: what the forests reach at most in a
    box of items orders the boxes, and the items of a box that is reached are bounded alone.
    """

    name = "embedding_forest"

    def __init__(
        self,
        embedding_dim: int = 64,
        revenue_boost: float = 4.5,
        trees: int = 50,
        depths: tuple[int, int] = (10, 15),
        iterations: int = 3,
        seed: int = 42,
    ):
        self.embedding_dim, self.revenue_boost = embedding_dim, revenue_boost
        self.trees, self.depths, self.iterations, self.seed = trees, depths, iterations, seed

    def fit(self, log, users, items):
        self.check(log, items)
        rows = log.select("user_idx", "item_idx", "relevance")
        self.items = items.select("item_idx", E.clean_price("price", nan_too=True).alias("price"))
        self.log = rows
        self.item_scores = cut_lineage(item_value_score(rows).select("item_idx", "popularity", "value_score"))
        cells = cut_lineage(interaction_cells(rows, self.items, "value"))
        user_vectors, item_vectors = svd(cells, self.embedding_dim, self.iterations, self.seed)
        profile = user_activity_profile(rows, self.items).select("user_idx", "avg_price", "activity")
        self.people = cut_lineage(
            lookup_default(
                user_vectors.withColumnRenamed("vector", "user_vector"),
                profile,
                "user_idx",
                {"avg_price": 50.0, "activity": 1.0},
            )
        )
        priced = lookup_default(
            item_vectors.withColumnRenamed("vector", "item_vector"), self.items, "item_idx", {"price": E.DEFAULT_PRICE}
        )
        self.things = cut_lineage(
            lookup_default(priced, self.item_scores, "item_idx", {"popularity": 0.0, "value_score": 0.0})
        )
        frame = rows.join(self.people, "user_idx").join(self.things, "item_idx")
        frame = frame.withColumn("target", E.revenue_target(F.col("relevance"), F.col("price")))
        data = cut_lineage(self._features(frame).select("features", "target"))
        self.models = [
            RandomForestRegressor(
                featuresCol="features",
                labelCol="target",
                predictionCol=f"forest_{i}",
                numTrees=self.trees,
                maxDepth=depth,
                seed=self.seed + i,
            ).fit(data)
            for i, depth in enumerate(self.depths)
        ]
        return self

    def statistics(self) -> DataFrame:
        """One row of model sizes."""
        counts = self.people.agg(F.count("*").alias("n_users")), self.things.agg(F.count("*").alias("n_items"))
        return counts[0].select(
            "n_users", counts[1].select("n_items").scalar().alias("n_items"), F.lit(self.embedding_dim).alias("embedding_dim"),
            F.lit(len(self.models)).alias("n_forests"), F.lit(sum(m.getNumTrees for m in self.models)).alias("n_trees"), F.lit(self.revenue_boost).alias("revenue_boost"),
        )

    def _features(self, pairs: DataFrame) -> DataFrame:
        """First 32 of both vectors, four profile numbers, price, and a short dot.

        Trees do not change under z-scoring of their inputs, so none is done.
        """
        return pair_features(pairs)

    def recommend(self, log, k, users, items, filter_seen_items=True, counts: list[int] | None = None):
        seen = log if filter_seen_items else None
        warm, cold = split_cold_users(user_ids(users), self.log)
        cold_items = self.items.join(items.select("item_idx"), "item_idx", "left_semi")
        cold_scores = embedding_cold_start(cold_items, self.item_scores, self.revenue_boost)
        cold_rows = first_unseen(cold, by_score(cold_scores), seen, k, ["item_idx", "score"])
        things = self.things.join(items.select("item_idx"), "item_idx", "left_semi")
        people = cut_lineage(self.people.join(warm, "user_idx", "left_semi"))
        catalogue, refine = self._bounded(things, people)

        def score(pairs: DataFrame) -> DataFrame:
            rows = self._features(pairs)
            for model in self.models:
                rows = model.transform(rows)
            mean = sum((F.col(m.getPredictionCol()) for m in self.models), F.lit(0.0)) / len(self.models)
            low, high = F.col("price") * 0.05, F.col("price") * 0.9
            return rows.withColumn("score", F.greatest(low, F.least(high, mean * self.revenue_boost)))

        columns = ["price", "item_vector", "popularity", "value_score"]
        warm_rows = best_first_top_k(people, catalogue, seen, k, score, columns, first=16, refine=refine, counts=counts)
        columns = ["user_idx", "item_idx", "score"]
        return warm_rows.select(*columns).unionByName(cold_rows.select(*columns))

    def _bounded(self, things: DataFrame, people: DataFrame) -> tuple[Catalogue, Callable[[DataFrame], DataFrame]]:
        """Items in order of what the forests reach in their box, and how to lower an item's bound.

        Boxes are runs of items of like price. A box is bounded with the box of all users;
        an item of a box that is reached is bounded alone. The forests see the first
        ``WIDTH`` entries of both vectors, four numbers, and a product of ``SHORT`` entries.
        """
        tables = [tree_table(model) for model in self.models]
        ends = people.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("avg_price", "activity") for f in (F.min, F.max))).first()
        user_low, user_high = vector_range(people, "user_vector", min(WIDTH, self.embedding_dim))
        numbers = [(ends[f"min_{c}"] or 0.0, ends[f"max_{c}"] or 0.0) for c in ("avg_price", "activity")]

        def bounded(rows: DataFrame, low, high) -> DataFrame:
            """``low`` and ``high``: columns of a box's ends by name."""
            width = len(user_low)
            vector_low, vector_high = ([side("item_vector")[j] for j in range(width)] for side in (low, high))
            dot_low, dot_high = product_range(vector_low[:SHORT], vector_high[:SHORT], user_low[:SHORT], user_high[:SHORT])
            arrays = []
            for side, own, vector, users_, dot in ((0, low, vector_low, user_low, dot_low), (1, high, vector_high, user_high, dot_high)):
                # A product's sum may round differently in another order.
                slack = F.lit(1e-9 if side else -1e-9)
                arrays.append(F.array(*map(F.lit, users_), *vector, *(F.lit(n[side]) for n in numbers), own("price"), own("popularity"), own("value_score"), dot + slack).cast("array<double>"))
            reached = F.greatest(high("price") * 0.05, F.least(high("price") * 0.9, F.col("most") * self.revenue_boost + 1e-9))
            return with_bound(rows, tables, *arrays).withColumn("bound", reached).drop("most")

        ranked = by_price(things, "item_vector", "popularity", "value_score")
        placed = ranked.items.drop("bound").withColumn("box", F.floor((F.col("rank") - 1) / F.lit(BOX_ITEMS))).drop("rank")
        width = len(user_low)
        sides = placed.groupBy("box").agg(
            *(f(c).alias(f"{c}_{n}") for c in ("price", "popularity", "value_score") for f, n in ((F.min, "low"), (F.max, "high"))),
            *(F.array(*(f(F.col("item_vector")[j]) for j in range(width))).alias(f"item_vector_{n}") for f, n in ((F.min, "low"), (F.max, "high"))),
        )
        boxes = bounded(sides, lambda c: F.col(f"{c}_low"), lambda c: F.col(f"{c}_high")).select("box", "bound")
        catalogue = global_rank(placed.join(boxes, "box").drop("box"), F.col("bound").desc(), "item_idx")
        return catalogue, lambda stretch: bounded(stretch.drop("bound"), F.col, F.col)


def pair_features(pairs: DataFrame, width: int = WIDTH, short: int = SHORT) -> DataFrame:
    """Pair features as one vector column ``features``."""
    dot = E.dot(F.slice("user_vector", 1, short), F.slice("item_vector", 1, short))
    numbers = F.array("avg_price", "activity", "price", "popularity", "value_score", dot)
    joined = F.concat(F.slice("user_vector", 1, width), F.slice("item_vector", 1, width), numbers)
    return pairs.withColumn("features", array_to_vector(joined))


def _block_features(width: int, short: int):
    """Rounded features of the pairs of one block, from the numbers of its users and items."""
    names = ["user_idx", "item_idx", *(f"f{j}" for j in range(2 * width + 6))]

    def side(rows: pa.Table, key: str, size: int):
        """Sorted ids, their first numbers, and all numbers rounded; one row for each number."""
        ids = rows[key].to_numpy()
        order = np.argsort(ids, kind="stable")
        values = rows["numbers"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size).T[:, order]
        return ids[order], values[:short], shown_values(values)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        kind = rows["kind"].to_numpy()
        asked, people, things = (rows.filter(pa.array(kind == n)) for n in range(3))
        del rows
        if not asked.num_rows or not people.num_rows or not things.num_rows:
            return
        user, item = asked["user_idx"].to_numpy(), asked["item_idx"].to_numpy()
        users, user_first, user_shown = side(people, "user_idx", width + 2)
        items, item_first, item_shown = side(things, "item_idx", width + 3)
        del asked, people, things
        for at in range(0, len(user), ROWS_AT_ONCE):
            u, i = user[at : at + ROWS_AT_ONCE], item[at : at + ROWS_AT_ONCE]
            # An id that comes more than once gives a row each time.
            first_u, first_i = np.searchsorted(users, u), np.searchsorted(items, i)
            many_i = np.searchsorted(items, i, "right") - first_i
            many = (np.searchsorted(users, u, "right") - first_u) * many_i
            row = np.repeat(np.arange(len(u)), many)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            for low in range(0, len(row), ROWS_AT_ONCE):
                own, nth = row[low : low + ROWS_AT_ONCE], turn[low : low + ROWS_AT_ONCE]
                left, right = first_u[own] + nth // many_i[own], first_i[own] + nth % many_i[own]
                dot = np.zeros(len(own))
                for a, b in zip(user_first, item_first):
                    dot += a[left] * b[right]
                columns = [*(user_shown[j][left] for j in range(width)), *(item_shown[j][right] for j in range(width))]
                columns += [user_shown[width][left], user_shown[width + 1][left], *(item_shown[width + j][right] for j in range(3)), shown_values(dot)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (u[own], i[own], *columns)], names=names)

    return features


def pair_feature_table(cells: DataFrame, people: DataFrame, things: DataFrame, width: int = WIDTH, short: int = SHORT) -> DataFrame:
    """:func:`pair_features` of many pairs, rounded, one column ``f0`` … for each.

    Users and items are dealt to blocks, and a block of either meets the other's in one task with their
    pairs. So pairs are moved as two ids, vectors once for each block of the other side, and a
    number is rounded once for its user or item, not once for a pair.
    """
    user_numbers = F.concat(F.slice("user_vector", 1, width), F.array("avg_price", "activity"))
    item_numbers = F.concat(F.slice("item_vector", 1, width), F.array("price", "popularity", "value_score"))
    cells = cells.filter("user_idx IS NOT NULL AND item_idx IS NOT NULL").select("user_idx", "item_idx")
    people = cut_lineage(people.filter("user_idx IS NOT NULL").select("user_idx", user_numbers.alias("numbers")))
    things = cut_lineage(things.filter("item_idx IS NOT NULL").select("item_idx", item_numbers.alias("numbers")))
    n_people, n_things = people.count(), things.count()
    least = [-(-n // FEATURE_NUMBERS) or 1 for n in (n_people * (width + 2), n_things * (width + 3))]
    # Several blocks a core, while these have some work, so that cores are evenly busy; the fewest vectors are moved.
    wanted = min(4 * cells.sparkSession.sparkContext.defaultParallelism, -(-cells.count() // FEATURE_PAIRS))
    grids = ((n, max(least[1], -(-wanted // n))) for n in range(least[0], max(least[0], wanted) + 1))
    n_user, n_item = min(grids, key=lambda g: (g[1] * n_people + g[0] * n_things, g))

    def placed(rows: DataFrame, kind: int, user, item) -> DataFrame:
        columns = [F.col(c).cast("long").alias(c) if c in rows.columns else F.lit(None).cast("long").alias(c) for c in ("user_idx", "item_idx")]
        numbers = F.col("numbers") if kind else F.lit(None)
        block = (user * F.lit(n_item) + item).cast("int").alias("block")
        return rows.select(block, F.lit(kind).alias("kind"), *columns, numbers.cast("array<double>").alias("numbers"))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    of_user, of_item = (F.pmod(F.xxhash64(c), F.lit(n)) for c, n in (("user_idx", n_user), ("item_idx", n_item)))
    rows = placed(cells, 0, of_user, of_item)
    rows = rows.unionByName(placed(people.withColumn("_to", every(n_item)), 1, of_user, F.col("_to")))
    rows = rows.unionByName(placed(things.withColumn("_to", every(n_user)), 2, F.col("_to"), of_item))
    schema = "user_idx long, item_idx long, " + ", ".join(f"f{j} double" for j in range(2 * width + 6))
    return rows.repartition(min(2 * n_user * n_item, 4096), "block").groupBy("block").applyInArrow(_block_features(width, short), schema)
