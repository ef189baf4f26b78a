"""Evaluation: ranking and revenue metrics, hold-outs by time, model comparison."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from revrank.functions import expressions as E
from revrank.operators.profile import correlation, positive_interactions
from revrank.recommenders.base import Recommender
from revrank.session import cut_lineage

METRICS = ("precision_at_k", "ndcg_at_k", "mrr", "hit_rate", "revenue", "discounted_revenue")


def with_rank(recommendations: DataFrame, score: str = "score") -> DataFrame:
    """Rank each user's list by score, ties by item."""
    order = Window.partitionBy("user_idx").orderBy(F.col(score).desc(), "item_idx")
    return recommendations.withColumn("rank", F.row_number().over(order))


def discounted_gain(recommendations: DataFrame, k: int = 5, factor: float = E.RANK_DISCOUNT) -> DataFrame:
    """Mean over users of Σ relevance · factor^(place − 1) over the first k; 0 without users."""
    order = Window.partitionBy("user_idx").orderBy("rank", "item_idx")
    first = recommendations.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    gains = first.groupBy("user_idx").agg(F.sum(F.col("relevance") * E.rank_discount(F.col("place"), factor)).alias("gain"))
    return gains.agg(F.coalesce(F.avg("gain"), F.lit(0.0)).alias("discounted_gain"))


def judged(ranked: DataFrame, held_out: DataFrame, items: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Ranked rows with ``hit`` (the pair is positive in the hold-out) and ``price``.

    With ``by``, hold-out rows only count for lists with the same values there.
    """
    keys = [*(c for c in by if c in held_out.columns), "user_idx", "item_idx"]
    truth = positive_interactions(held_out).select(*keys).distinct().withColumn("hit", F.lit(1))
    return (
        ranked.select(*by, "user_idx", "item_idx", "rank")
        .join(truth, keys, "left")
        .withColumn("hit", F.coalesce("hit", F.lit(0)))
        .join(items.select("item_idx", "price"), "item_idx", "left")
    )


def metrics_per_user(
    ranked: DataFrame, held_out: DataFrame, items: DataFrame, k: int = 5, by: tuple[str, ...] = ()
) -> DataFrame:
    """All metrics for each user who has recommendations.

    Textbook binary definitions; the ideal gain counts at most k positives.
    Discounted revenue uses the rank discount 0.85. ``by`` are columns that tell
    several sets of lists apart.
    """
    rows = judged(ranked.filter(F.col("rank") <= k), held_out, items, by)
    hit = F.col("hit")
    gains = rows.groupBy(*by, "user_idx").agg(
        (F.sum("hit") / F.lit(float(k))).alias("precision_at_k"),
        F.sum(hit / F.log2(F.col("rank") + F.lit(1.0))).alias("dcg"),
        F.coalesce(F.max(F.when(hit == 1, F.lit(1.0) / F.col("rank"))), F.lit(0.0)).alias("mrr"),
        F.max(hit.cast("double")).alias("hit_rate"),
        F.sum(hit * F.coalesce("price", F.lit(0.0))).alias("revenue"),
        F.sum(hit * F.coalesce("price", F.lit(0.0)) * E.rank_discount(F.col("rank"))).alias("discounted_revenue"),
    )
    keys = [*(c for c in by if c in held_out.columns), "user_idx"]
    relevant = positive_interactions(held_out).groupBy(*keys).agg(F.countDistinct("item_idx").alias("n_relevant"))
    # Ideal gain for 0 … k positives: a short fixed list.
    ideal = [0.0]
    for place in range(1, k + 1):
        ideal.append(ideal[-1] + 1.0 / math.log2(place + 1))
    most = F.least(F.coalesce("n_relevant", F.lit(0)), F.lit(k)).cast("int")
    joined = gains.join(relevant, keys, "left").withColumn("_ideal", F.get(F.array(*[F.lit(v) for v in ideal]), most))
    ndcg = F.when(F.col("_ideal") > 0, F.col("dcg") / F.col("_ideal")).otherwise(F.lit(0.0))
    return joined.withColumn("ndcg_at_k", ndcg).select(*by, "user_idx", *METRICS)


def metrics_total(per_user: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Long form ``metric, value``: means over users, sums for the revenues."""
    sums = ("revenue", "discounted_revenue")
    totals = [F.coalesce((F.sum(m) if m in sums else F.avg(m)), F.lit(0.0)).alias(m) for m in METRICS]
    row = per_user.groupBy(*by).agg(*totals) if by else per_user.agg(*totals)
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    return row.select(*by, F.inline(F.array(*cells)))


def evaluate(recommendations: DataFrame, held_out: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """Metrics of one set of lists against one hold-out."""
    return metrics_total(metrics_per_user(with_rank(recommendations), held_out, items, k))


def user_share(users: DataFrame, share: float) -> DataFrame:
    """A repeatable share of the users by a hash of the id; all of them for 1.0."""
    if share >= 1.0:
        return users
    return users.filter(E.unit_hash(F.col("user_idx").cast("string")) < share)


RUN = ("model", "phase", "iteration")


def recommendation_lists(
    make: Callable[[], Recommender],
    log: DataFrame,
    users: DataFrame,
    items: DataFrame,
    train_iterations: list[int],
    test_iterations: list[int],
    k: int = 5,
    user_frac: float = 1.0,
    filter_seen_items: bool = True,
    retrain: bool = True,
) -> DataFrame:
    """Lists for every iteration, made from the rows before it.

    With ``retrain`` every iteration has its own fit on all earlier rows;
    otherwise one fit on the rows before the first iteration serves all of them.
    """
    asked = user_share(users, user_frac)
    steps = [("train", t) for t in train_iterations] + [("test", t) for t in test_iterations]
    groups = [[step] for step in steps] if retrain else [steps]
    parts = []
    for group in groups:
        past = log.filter(F.col("__iter") < group[0][1])
        model = make().fit(past, users, items)
        lists = with_rank(model.recommend(past, k, asked, items, filter_seen_items))
        runs = F.array(*[F.struct(F.lit(p).alias("phase"), F.lit(t).alias("iteration")) for p, t in group])
        parts.append(lists.select(F.lit(model.name).alias("model"), F.inline(runs), "user_idx", "item_idx", "rank"))
    return reduce(DataFrame.unionByName, parts)


def evaluate_lists(lists: DataFrame, log: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """Long-form results ``model, phase, iteration, metric, value`` in one plan."""
    held_out = log.withColumnRenamed("__iter", "iteration")
    return metrics_total(metrics_per_user(lists, held_out, items, k, RUN), RUN)


def evaluate_by_iteration(make, log, users, items, train_iterations, test_iterations, k: int = 5, **options) -> DataFrame:
    """Metrics per phase and iteration: fit on the past, judge on the iteration."""
    return compare_models([make], log, users, items, train_iterations, test_iterations, k, **options)


def compare_models(
    models: list[Callable[[], Recommender]], log, users, items, train_iterations, test_iterations, k: int = 5, **options
) -> DataFrame:
    """Results of several recommenders; the driver's loop only builds plans.

    The log is read for every fit, list and hold-out, so it is written once first.
    """
    log = cut_lineage(log.select("user_idx", "item_idx", "relevance", "__iter"))
    lists = [
        recommendation_lists(make, log, users, items, train_iterations, test_iterations, k, **options) for make in models
    ]
    return evaluate_lists(reduce(DataFrame.unionByName, lists), log, items, k)


# ---------------------------------------------------------------- reports on results


def model_summary(results: DataFrame) -> DataFrame:
    """Mean and total per model and metric for both phases, and the change in percent."""
    train, test = F.col("phase") == "train", F.col("phase") == "test"
    return (
        results.groupBy("model", "metric")
        .agg(
            F.avg(F.when(train, F.col("value"))).alias("train_mean"),
            F.avg(F.when(test, F.col("value"))).alias("test_mean"),
            F.sum(F.when(train, F.col("value"))).alias("train_total"),
            F.sum(F.when(test, F.col("value"))).alias("test_total"),
        )
        .withColumn("change_pct", (F.try_divide("test_mean", "train_mean") - 1) * 100)
    )


def model_leaderboard(results: DataFrame) -> DataFrame:
    """Models by total test revenue, and a flag for the best one."""
    totals = results.filter("metric = 'revenue'").groupBy("model").agg(
        F.sum(F.when(F.col("phase") == "train", F.col("value"))).alias("train_total_revenue"),
        F.sum(F.when(F.col("phase") == "test", F.col("value"))).alias("test_total_revenue"),
    )
    # One row per model, so one window over all of them is small.
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.col("test_total_revenue").desc(), F.col("model").desc())
    placed = totals.withColumn("is_best", F.row_number().over(best_first) == 1)
    return placed.orderBy(F.col("test_total_revenue").desc(), F.col("model").desc())


def metric_trajectory(results: DataFrame) -> DataFrame:
    """One time line over both phases: test steps follow the train steps."""
    n_train = F.countDistinct(F.when(F.col("phase") == "train", F.col("iteration")))
    sizes = results.groupBy("model", "metric").agg(n_train.alias("n_train"))
    steps = Window.partitionBy("model", "metric", "phase").orderBy("iteration")
    numbered = results.withColumn("step", F.row_number().over(steps) - 1).join(sizes, ["model", "metric"])
    shifted = F.col("step") + F.when(F.col("phase") == "test", F.col("n_train")).otherwise(F.lit(0))
    return numbered.select("model", "metric", "phase", shifted.cast("int").alias("step"), "value")


def metric_correlation(results: DataFrame) -> DataFrame:
    """Correlation across models between mean metrics, revenues left out."""
    names = [f"{phase}_{metric}" for phase in ("test", "train") for metric in sorted(METRICS) if not metric.endswith("revenue")]
    wide = (
        results.withColumn("name", F.concat_ws("_", "phase", "metric"))
        .groupBy("model")
        .pivot("name", names)
        .agg(F.avg("value"))
    )
    return correlation(wide, names)
