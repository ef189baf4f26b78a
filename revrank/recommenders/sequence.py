"""Recommenders on item sequences: bigrams with spending tiers, item vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.cones import cone_index, cone_top_k
from revrank.operators.factorise import svd
from revrank.operators.knn import unit_vectors
from revrank.operators.profile import high_value_items, price_percentiles, user_spending_profile
from revrank.operators.ranking import (
    explode_ranks,
    first_unseen,
    global_rank,
    global_running_sum,
    items_at_rank,
    top_k_per_user,
)
from revrank.operators.sequences import (
    bigram_probs,
    bigram_pruned,
    bigram_weights,
    bigrams,
    recent_history,
)
from revrank.recommenders.base import Recommender, by_price, user_ids
from revrank.session import cut_lineage

RECENT_ROWS = 20


class BigramRecommender(Recommender):
    """Continuations of a user's last item, scored with tier and price closeness.

    Four stages fill the k places: bigram continuations, best prices for the
    user's taste, catalogue order, and catalogue order again for places that
    seen items had taken. With ``seen="recent"`` the last rows of a user count as
    seen, so that an item of long ago may be recommended again; with ``"log"`` all do.
    """

    name = "bigram"

    def __init__(self, alpha: float = 1.0, min_count: float = 1.0, revenue_boost: float = 3.5, seen: str = "recent"):
        if seen not in ("recent", "log"):
            raise ValueError("seen is 'recent' or 'log'")
        self.alpha = alpha
        self.min_count = min_count
        self.revenue_boost = revenue_boost
        self.seen = seen

    def fit(self, log, users, items):
        self.check(log, items)
        priced = items.withColumn("price", E.clean_price("price"))
        mean = price_percentiles(priced).select("mean_price").scalar()
        flagged = high_value_items(priced.select("item_idx", "price"))
        self.item_values = cut_lineage(
            flagged.withColumn("potential", E.revenue_potential(F.col("price"), mean, F.col("is_high_value")))
        )
        self.profiles = cut_lineage(user_spending_profile(log, priced))
        weights = bigram_weights(log, priced)
        self.probs = cut_lineage(bigram_probs(bigram_pruned(weights, self.min_count), self.alpha))
        return self

    def statistics(self) -> DataFrame:
        """One row of model sizes."""
        high = self.item_values.agg(F.count_if("is_high_value").alias("v")).scalar()
        return self.probs.agg(
            F.countDistinct("context").alias("n_contexts"),
            F.count("*").alias("n_bigrams"),
            F.countDistinct("target").alias("n_targets"),
        ).select(
            "*",
            high.alias("n_high_value_items"),
            self.profiles.agg(F.count("*").alias("v")).scalar().alias("n_profiles"),
        )

    def _continuations(self, contexts: DataFrame, known_items: DataFrame) -> DataFrame:
        """Stage 1: targets of the user's last item."""
        rows = (
            contexts.join(self.probs.select("context", "target", "prob", "context_boost"), "context")
            .withColumnRenamed("target", "item_idx")
            .join(known_items, "item_idx")
        )
        price, mean, tier = F.col("price"), F.col("avg_price"), F.col("tier")
        match = E.price_match(price, mean, 0.6, 8.0)
        high = F.col("is_high_value")
        # Base and slope of the tier multipliers.
        multiplier = (
            F.when((tier == "premium_buyer") & high, F.lit(1.8) + match * 0.7)
            .when((tier == "high_buyer") & high, F.lit(1.6) + match * 0.6)
            .when(tier == "regular_buyer", F.lit(1.4) + match * 0.5)
            .when((tier == "budget_buyer") & (price < mean), F.lit(1.5) + match * 0.6)
            .otherwise(F.lit(1.0))
        )
        strength = F.least(F.lit(1.8), F.col("n_recent") * 0.4 + 1.0)
        chance = E.clamp(F.col("prob") * multiplier * F.col("context_boost") * strength * 2.2, 0.05, 0.85)
        score = E.expected_revenue(chance, price) * F.col("potential") * self.revenue_boost
        return rows.select("user_idx", "item_idx", E.shown(score).alias("score"))

    def recommend(self, log, k, users, items, filter_seen_items=True):
        wanted = user_ids(users)
        profiles = self.profiles.select("user_idx", "avg_price", "tier")
        people = wanted.join(profiles, "user_idx", "left").select(
            "user_idx",
            F.coalesce("avg_price", F.lit(E.DEFAULT_PRICE)).alias("avg_price"),
            F.coalesce("tier", F.lit("regular_buyer")).alias("tier"),
        )
        recent = cut_lineage(recent_history(log.join(wanted, "user_idx", "left_semi"), RECENT_ROWS).select("user_idx", "item_idx", "pos"))
        rows = recent if self.seen == "recent" else log.join(wanted, "user_idx", "left_semi")
        seen_pairs = cut_lineage(rows.select("user_idx", "item_idx").distinct())
        contexts = recent.groupBy("user_idx").agg(
            F.count("*").alias("n_recent"), F.max_by("item_idx", "pos").alias("context")
        )
        known_items = self.item_values.join(items.select("item_idx"), "item_idx", "left_semi")

        pairs = ["user_idx", "item_idx", "score"]
        taken = cut_lineage(self._continuations(contexts.join(people, "user_idx"), known_items))
        taken = self._add_by_taste(taken, people, known_items, seen_pairs if filter_seen_items else None, k)
        catalogue = global_rank(known_items.select("item_idx", "price", "is_high_value"), "item_idx")
        taken = cut_lineage(self._add_in_order(taken, people, catalogue, None, k, 1.1, 0.2))
        if filter_seen_items:
            taken = taken.join(seen_pairs, ["user_idx", "item_idx"], "left_anti")
            taken = self._add_in_order(taken, people, catalogue, seen_pairs, k, 1.05, 0.1)
        return top_k_per_user(taken, k).select(*pairs)

    @staticmethod
    def _open_places(taken: DataFrame, people: DataFrame, k: int) -> DataFrame:
        counts = taken.groupBy("user_idx").agg(F.count("*").alias("_n"))
        free = F.lit(k) - F.coalesce("_n", F.lit(0))
        return people.join(counts, "user_idx", "left").withColumn("need", free).filter("need > 0").drop("_n")

    def _add_by_taste(self, taken, people, known_items, seen_pairs, k):
        """Stage 2: unseen items by price and closeness to the user's mean price m.

        The score depends on the item through its price p alone. Below the
        high-value line and above it, it rises in p up to the peak 1.3 m + 4, falls
        until closeness reaches its floor at 1.7 m + 3.5, and rises from there. In
        each such run of prices the best items lie at one end, so a user reads a
        few items at the end of at most six runs, and the result is exact.
        """
        open_users = cut_lineage(self._open_places(taken, people, k).select("user_idx", "avg_price", "need"))
        if open_users.isEmpty():
            return taken
        blocked = taken.select("user_idx", "item_idx")
        if seen_pairs is not None:
            blocked = blocked.unionByName(seen_pairs)
        blocked = cut_lineage(blocked.join(open_users, "user_idx", "left_semi").distinct())
        listed = known_items.select("item_idx", "price", "is_high_value")
        dear_first = global_rank(listed, F.col("price").desc(), "item_idx")
        cheap_first = global_rank(listed, F.col("price").asc(), "item_idx")
        size = F.lit(dear_first.size).cast("long")
        n_low = listed.filter(~F.col("is_high_value")).agg(F.count("*").alias("v")).scalar()

        # Numbers of items priced up to the peak and up to the floor, by mean price.
        means = open_users.select("avg_price").distinct()
        peak = F.col("avg_price") * 1.3 + 4.0
        floor = F.greatest(peak, F.col("avg_price") * 1.7 + 3.5)
        turns = means.select("avg_price", F.inline(F.array(
            F.struct(F.lit("peak").alias("turn"), peak.alias("x")), F.struct(F.lit("floor").alias("turn"), floor.alias("x"))
        )))
        points = turns.withColumn("is_price", F.lit(0)).unionByName(
            listed.select(F.col("price").alias("x"), F.lit(1).alias("is_price")), allowMissingColumns=True
        )
        counted = global_running_sum(points, "is_price", "x", F.col("is_price").desc(), "avg_price", "turn", name="n_upto")
        places = counted.filter("is_price = 0").groupBy("avg_price").agg(
            F.max(F.when(F.col("turn") == "peak", F.col("n_upto"))).alias("n_peak"),
            F.max(F.when(F.col("turn") == "floor", F.col("n_upto"))).alias("n_floor"),
        )
        n_peak, n_floor, none = F.col("n_peak"), F.col("n_floor"), F.lit(0).cast("long")
        runs = [
            F.struct(
                F.greatest(low, start).alias("low"), F.least(high, end).alias("high"), F.lit(rising).alias("rising")
            )
            for low, high, rising in ((none, n_peak, True), (n_peak, n_floor, False), (n_floor, size, True))
            for start, end in ((none, n_low), (n_low, size))
        ]
        extra = blocked.groupBy("user_idx").agg(F.count("*").alias("n_blocked"))
        reading = (
            open_users.join(places, "avg_price")
            .join(extra, "user_idx", "left")
            .withColumn("depth", F.col("need") + F.coalesce("n_blocked", F.lit(0)))
            .select("user_idx", "avg_price", "need", "depth", F.inline(F.array(*runs)))
            .filter(F.col("high") > F.col("low"))
        )
        parts = []
        for order, rising, first, last in (
            (dear_first, True, size - F.col("high") + 1, size - F.col("low")),
            (cheap_first, False, F.col("low") + 1, F.col("high")),
        ):
            run = reading.filter(F.col("rising") == rising)
            ranks = explode_ranks(run, first, F.least(last, first + F.col("depth") - 1))
            parts.append(items_at_rank(ranks, order, ["item_idx", "price", "is_high_value"]))
        pairs = parts[0].unionByName(parts[1]).join(blocked, ["user_idx", "item_idx"], "left_anti")

        # Floor and slack of closeness, the lifts and the cap of the chance.
        closeness = E.price_match(F.col("price"), F.col("avg_price"), 0.3, 5.0)
        lift = F.when(F.col("is_high_value"), F.lit(1.8)).otherwise(F.lit(1.4))
        chance = F.least(F.lit(0.75), (F.lit(0.15) + closeness * 0.25) * lift)
        scored = pairs.withColumn("exact", E.shown(chance * F.col("price") * 1.5, 9))
        added = top_k_per_user(scored, "need", "exact", most=k).select("user_idx", "item_idx", E.shown("exact").alias("score"))
        return cut_lineage(taken.unionByName(added))

    def _add_in_order(self, taken, people, catalogue, seen_pairs, k, lift, share):
        """Stages 3 and 4: items in catalogue order for the places still free."""
        open_users = self._open_places(taken, people, k).select("user_idx", "need")
        blocked = taken.select("user_idx", "item_idx")
        if seen_pairs is not None:
            blocked = blocked.unionByName(seen_pairs)
        found = first_unseen(open_users, catalogue, blocked, "need", ["item_idx", "price", "is_high_value"])
        # Fixed values come with the call: lift of high-value items, and the share of the price.
        boost = F.when(F.col("is_high_value"), F.lit(lift)).otherwise(F.lit(1.0))
        added = found.select("user_idx", "item_idx", E.shown(F.col("price") * boost * share).alias("score"))
        return taken.unionByName(added)


class ItemVectorRecommender(Recommender):
    """Next items by vectors learned from item sequences, times the price.

    Vectors are the leading singular directions of the positive pointwise mutual
    information between an item and the item that follows it, which is what
    skip-gram training approximates (Levy & Goldberg, 2014). They are learned
    with joins and grouped sums; no vocabulary is held by one process. A user's
    query is the mean of the vectors of the last rows or, with ``attention``,
    their softmax-weighted mean by similarity to the last item. The chance is
    exp(cosine − 1): the softmax numerator, whose denominator is the same for all
    items of a user and does not change the order. An item without a vector, and
    every item for a user without rows, has cosine 0.
    """

    name = "item_vectors"

    def __init__(self, size: int = 32, max_len: int = 100, iterations: int = 3, attention: bool = False, seed: int = 42):
        self.size, self.max_len, self.iterations = size, max_len, iterations
        self.attention, self.seed = attention, seed

    def fit(self, log, users, items):
        self.check(log, items)
        counts = bigrams(log).groupBy("context", "target").agg(F.count("*").alias("n"))
        before = counts.groupBy("context").agg(F.sum("n").alias("n_context"))
        after = counts.groupBy("target").agg(F.sum("n").alias("n_target"))
        total = counts.agg(F.sum("n").cast("double").alias("v")).scalar()
        lift = F.ln(F.col("n") * total / F.col("n_context") / F.col("n_target"))
        cells = counts.join(before, "context").join(after, "target").select(
            F.col("context").alias("user_idx"), F.col("target").alias("item_idx"), F.greatest(F.lit(0.0), lift).alias("weight")
        )
        leads, follows = svd(cut_lineage(cells.filter("weight > 0")), self.size, self.iterations, self.seed, shift=0.0)
        self.lead_vectors = cut_lineage(unit_vectors(leads.withColumnRenamed("user_idx", "item_idx")))
        self.item_vectors = cut_lineage(unit_vectors(follows))
        return self

    def user_queries(self, log: DataFrame) -> DataFrame:
        """One unit vector per user from the vectors of the last rows."""
        recent = recent_history(log, self.max_len).select("user_idx", "pos", "item_idx").join(self.lead_vectors, "item_idx")
        if self.attention:
            last = recent.groupBy("user_idx").agg(F.max_by("vector", "pos").alias("last"))
            near = recent.join(last, "user_idx").withColumn("w", F.exp(E.dot(F.col("last"), F.col("vector"))))
        else:
            near = recent.withColumn("w", F.lit(1.0))
        sums = near.groupBy("user_idx").agg(
            *[F.sum(F.col("w") * F.col("vector")[j]).alias(f"v{j}") for j in range(self.size)]
        )
        return unit_vectors(sums.select("user_idx", F.array(*[f"v{j}" for j in range(self.size)]).alias("vector")))

    def recommend(self, log, k, users, items, filter_seen_items=True, counts: list[int] | None = None):
        wanted = user_ids(users)
        queries = cut_lineage(wanted.join(self.user_queries(log).withColumnRenamed("vector", "query"), "user_idx"))
        seen = cut_lineage(log.select("user_idx", "item_idx").distinct()) if filter_seen_items else None
        priced = items.select("item_idx", E.clean_price("price").alias("price")).join(self.item_vectors, "item_idx", "left")
        no_kind = priced.select("item_idx", "price", F.lit(None).cast("string").alias("kind"), F.lit(0.0).alias("unit"), "vector")
        index = cone_index(no_kind, self.size)
        nothing = F.array().cast("array<string>").alias("kinds"), F.array().cast("array<double>").alias("weights")
        found = cone_top_k(queries.select("user_idx", "query", *nothing), index, seen, k, lambda cosine: np.exp(cosine - 1.0), counts=counts)
        # Without a query every item is equally near.
        cold = first_unseen(wanted.join(queries, "user_idx", "left_anti"), by_price(items), seen, k, ["item_idx", "price"])
        by_price_alone = cold.select("user_idx", "item_idx", E.shown(E.expected_revenue(F.exp(F.lit(-1.0)), F.col("price"))).alias("score"))
        return found.unionByName(by_price_alone)


def score_sequences(
    sequences: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], name: str = "score"
) -> DataFrame:
    """Score padded sequences with a user's own model, batch by batch.

    ``scorer`` gets Arrow batches of ``user_idx, item_ids, prices, mask`` as a
    pandas frame and returns one number per row.
    """

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"user_idx": batch["user_idx"], name: scorer(batch).astype(float)})

    columns = sequences.select("user_idx", "item_ids", "prices", "mask")
    return columns.mapInPandas(apply, f"user_idx long, {name} double")
