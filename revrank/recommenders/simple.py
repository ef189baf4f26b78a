"""Baselines: random, popularity, content similarity, price."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.cones import cone_index, cone_top_k
from revrank.operators.profile import positive_interactions
from revrank.operators.ranking import first_unseen, global_rank
from revrank.recommenders.base import Recommender, by_score, user_ids
from revrank.session import cut_lineage
from revrank.sources.adapters import attr_columns


class RandomRecommender(Recommender):
    """A random order of the catalogue, entered by each user at a random place.

    Order and place come from hashes, so the result is repeatable. The score
    falls evenly along the user's order.
    """

    name = "random"

    def __init__(self, seed: int = 42):
        self.seed = seed

    def fit(self, log, users, items):
        return self

    def recommend(self, log, k, users, items, filter_seen_items=True):
        key = F.md5(F.concat_ws("-", F.lit(str(self.seed)), F.col("item_idx").cast("string")).cast("binary"))
        shuffled = global_rank(items.select("item_idx").withColumn("_key", key), "_key", "item_idx")
        start = F.concat_ws("-", F.lit(str(self.seed)), F.lit("user"), F.col("user_idx").cast("string"))
        entering = user_ids(users).withColumn("start", F.floor(E.unit_hash(start) * F.lit(shuffled.size)))
        seen = log if filter_seen_items else None
        drawn = first_unseen(entering, shuffled, seen, k, shift="start")
        return drawn.select(
            "user_idx", "item_idx", E.shown(F.lit(1.0) - F.col("slot") / F.lit(float(shuffled.size + 1))).alias("score")
        )


class PopularityRecommender(Recommender):
    """Smoothed share of positive rows; times the price if asked."""

    name = "popularity"

    def __init__(self, alpha: float = 1.0, by_revenue: bool = False):
        self.alpha = alpha
        self.by_revenue = by_revenue

    def fit(self, log, users, items):
        self.check(log, items)
        self.rates = log.groupBy("item_idx").agg(
            F.count("*").alias("n"), F.count_if(F.col("relevance") > 0).alias("n_positive")
        )
        return self

    def item_scores(self, items: DataFrame) -> DataFrame:
        counted = items.select("item_idx", "price").join(self.rates, "item_idx", "left").na.fill(0, ["n", "n_positive"])
        rate = (F.col("n_positive") + F.lit(self.alpha)) / (F.col("n") + F.lit(2 * self.alpha))
        score = E.expected_revenue(rate, E.clean_price("price")) if self.by_revenue else rate
        return counted.select("item_idx", E.shown(score).alias("score"))

    def recommend(self, log, k, users, items, filter_seen_items=True):
        ranked = by_score(self.item_scores(items))
        found = first_unseen(user_ids(users), ranked, log if filter_seen_items else None, k, ["item_idx", "score"])
        return found.select("user_idx", "item_idx", "score")


class PriceRecommender(Recommender):
    """A constant chance times the price: the most expensive unseen items."""

    name = "price"

    def __init__(self, chance: float = 0.6):
        self.chance = chance

    def fit(self, log, users, items):
        return self

    def recommend(self, log, k, users, items, filter_seen_items=True):
        scored = items.select("item_idx", E.shown(E.clean_price("price") * self.chance).alias("score"))
        seen = log if filter_seen_items else None
        found = first_unseen(user_ids(users), by_score(scored), seen, k, ["item_idx", "score"])
        return found.select("user_idx", "item_idx", "score")


class ContentBasedRecommender(Recommender):
    """Cosine of a user's mean liked item to other items, times the price.

    Items are described by their category (one-hot) and z-scored attributes. The one-hot
    part is never spread out: an item has one category and a user the weights of those it
    liked, so any number of categories will do. A user without likes gets the taste of all
    likes together.
    """

    name = "content_based"

    def __init__(self, similarity_threshold: float = 0.0):
        self.similarity_threshold = similarity_threshold

    def _item_vectors(self, items: DataFrame) -> DataFrame:
        parts = [(F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in self.attributes.items()]
        return items.select("item_idx", E.clean_price("price").alias("price"), F.col("category").cast("string").alias("kind"), F.array(*parts).cast("array<double>").alias("vector"))

    def _tastes(self, liked: DataFrame, *key: str) -> DataFrame:
        """(*key, query, kinds, weights): the mean of the liked items' vectors, of length 1."""
        size = len(self.attributes)
        rows = liked.groupBy(*key).agg(F.count("*").alias("n"), *[F.avg(F.col("vector")[j]).alias(f"v{j}") for j in range(size)])
        weights = liked.filter("kind IS NOT NULL").groupBy(*key, "kind").agg(F.count("*").alias("n_kind"))
        weights = weights.join(rows.select(*key, "n"), list(key)) if key else weights.crossJoin(rows.select("n"))
        weights = weights.select(*key, "kind", (F.col("n_kind") / F.col("n")).alias("weight"))
        listed = weights.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("kind", "weight"))).alias("known"))
        joined = rows.join(listed, list(key), "left") if key else rows.crossJoin(listed)
        known = F.coalesce("known", F.array().cast("array<struct<kind:string,weight:double>>"))
        query = F.array(*[f"v{j}" for j in range(size)]).cast("array<double>")
        told = joined.select(*key, query.alias("query"), known["kind"].alias("kinds"), known["weight"].alias("weights"))
        length = F.sqrt(E.dot(F.col("query"), F.col("query")) + E.dot(F.col("weights"), F.col("weights")))
        scaled = told.withColumn("_length", F.when(length > 0, length).otherwise(F.lit(1.0)))
        return scaled.select(*key, *(F.transform(c, lambda x: x / F.col("_length")).alias(c) if c != "kinds" else F.col(c) for c in ("query", "kinds", "weights")))

    def fit(self, log, users, items):
        self.check(log, items)
        names = attr_columns(items, "item_attr_", None)
        stats = items.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.avg, F.stddev_pop)]).head()
        self.attributes = {c: (stats[f"avg_{c}"] or 0.0, stats[f"stddev_pop_{c}"] or 1.0) for c in names}
        liked = cut_lineage(positive_interactions(log).select("user_idx", "item_idx").join(self._item_vectors(items), "item_idx"))
        self.user_vectors = cut_lineage(self._tastes(liked, "user_idx"))
        self.shared_taste = cut_lineage(self._tastes(liked))
        return self

    def recommend(self, log, k, users, items, filter_seen_items=True, counts: list[int] | None = None):
        wanted = user_ids(users)
        known = wanted.join(self.user_vectors, "user_idx")
        unknown = wanted.join(self.user_vectors, "user_idx", "left_anti").crossJoin(F.broadcast(self.shared_taste))
        things = self._item_vectors(items)
        has_kind = F.when(F.col("kind").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))
        length = F.sqrt(has_kind + E.dot(F.col("vector"), F.col("vector")))
        scaled = things.withColumn("_length", F.when(length > 0, length).otherwise(F.lit(1.0)))
        scaled = scaled.select("item_idx", "price", "kind", (has_kind / F.col("_length")).alias("unit"), F.transform("vector", lambda x: x / F.col("_length")).alias("vector"))
        index = cone_index(scaled, len(self.attributes))
        return cone_top_k(
            known.unionByName(unknown), index, log if filter_seen_items else None, k, lambda cosine: np.round(cosine, 9), above=self.similarity_threshold, counts=counts
        )
