"""Profiling of users, items and the log: counts, shares, histograms, tiers."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.ranking import global_running_sum


def scalar(df: DataFrame, expression: Column) -> Column:
    """One aggregate over ``df`` as a scalar subquery."""
    return df.agg(expression.alias("v")).scalar()


# ---------------------------------------------------------------- counts


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def interaction_density(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of the log in percent of all user-item pairs."""
    counted = log.agg(F.count("*").alias("n_interactions")).select(
        "n_interactions",
        scalar(users, F.count("*")).alias("n_users"),
        scalar(items, F.count("*")).alias("n_items"),
    )
    pairs = F.col("n_users").cast("double") * F.col("n_items")
    return counted.withColumn("density_pct", F.try_divide(F.col("n_interactions").cast("double"), pairs) * 100)


def coverage(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """Users and items with at least one interaction, and their share in percent."""
    active = log.agg(F.countDistinct("user_idx").alias("users"), F.countDistinct("item_idx").alias("items"))
    counted = active.unpivot([], ["users", "items"], "side", "n_active")
    totals = {"users": scalar(users, F.count("*")), "items": scalar(items, F.count("*"))}
    n_total = F.when(F.col("side") == "users", totals["users"]).otherwise(totals["items"])
    both = counted.withColumn("n_total", n_total)
    return both.withColumn("share_pct", F.try_divide(F.col("n_active").cast("double"), F.col("n_total")) * 100)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, with the share in percent; one pass over the data."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    total = scalar(counted, F.sum("n"))
    return counted.withColumn("share_pct", F.col("n").cast("double") / total * 100)


def segment_distribution(users: DataFrame) -> DataFrame:
    return distribution(users, "segment")


def category_distribution(items: DataFrame) -> DataFrame:
    return distribution(items, "category")


def relevance_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("relevance").agg(F.count("*").alias("n"))


def interactions_per(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy(key).agg(F.count("*").alias("n_interactions"))


# ---------------------------------------------------------------- pivots


def interaction_context(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """The log with the user's segment and the item's category."""
    return (
        log.select("user_idx", "item_idx", "relevance")
        .join(users.select("user_idx", "segment"), "user_idx")
        .join(items.select("item_idx", "category"), "item_idx")
    )


def learn_vocabulary(df: DataFrame, column: str, limit: int = 10_000) -> list[str]:
    """Sorted distinct values of a column that is to become output columns.

    Values turn into columns, so their number has to be small; a larger
    vocabulary is an error, never a cut.
    """
    values = [row[0] for row in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} values; it cannot become columns")
    return sorted(values)


def segment_category_pivot(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """Interactions by segment (rows) and category (columns), gaps as 0."""
    categories = learn_vocabulary(items, "category")
    counted = interaction_context(users, items, log).groupBy("segment").pivot("category", categories)
    return counted.agg(F.count("item_idx")).na.fill(0)


# ---------------------------------------------------------------- correlation


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation, lower triangle without the diagonal, one pass."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "attr_a string, attr_b string, correlation double")
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("attr_a"), F.lit(b).alias("attr_b"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


# ---------------------------------------------------------------- histograms


def histogram(df: DataFrame, value: str, bins: int, group: str | None = None) -> DataFrame:
    """Equal-width histogram over the range of each group; empty bins included.

    The last bin is closed on the right. A group with one distinct value gets
    the range value ± 0.5.
    """
    keys = [group] if group else []
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    extremes = [F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    ranges = (rows.groupBy(*keys).agg(*extremes) if group else rows.agg(*extremes).filter("_min IS NOT NULL")).select(
        *keys,
        F.when(F.col("_min") == F.col("_max"), F.col("_min") - 0.5).otherwise(F.col("_min")).alias("lo"),
        F.when(F.col("_min") == F.col("_max"), F.col("_max") + 0.5).otherwise(F.col("_max")).alias("hi"),
    )
    if group:
        placed = rows.join(ranges, group)
    else:
        placed = rows.withColumn("lo", ranges.select("lo").scalar()).withColumn("hi", ranges.select("hi").scalar())
    raw = F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(bins))
    counted = (
        placed.withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("n"))
    )
    edges = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return edges.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def attr_histograms(df: DataFrame, columns: list[str], bins: int, group: str | None) -> DataFrame:
    """One histogram per attribute column, stacked with the column's name."""
    parts = [histogram(df, name, bins, group).withColumn("attr", F.lit(name)) for name in columns]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- prices


def price_percentiles(items: DataFrame, shares: tuple[float, ...] = (0.6, 0.75, 0.8)) -> DataFrame:
    """Exact interpolated percentiles, mean and population deviation of prices.

    Prices are counted per distinct value first, so the percentile state grows
    with the number of distinct prices, not with the number of items.
    """
    counted = items.groupBy("price").agg(F.count("*").alias("_n"))
    mean = F.sum(F.col("price") * F.col("_n")) / F.sum("_n")
    moments = items.agg(F.stddev_pop("price").alias("v")).scalar()
    return counted.agg(
        *[F.percentile("price", share, F.col("_n")).alias(f"p{round(share * 100)}") for share in shares],
        mean.alias("mean_price"),
    ).withColumn("std_price", moments)


def high_value_items(items: DataFrame, share: float = 0.75) -> DataFrame:
    """Items with a flag: price at or above the given percentile of prices."""
    cut = price_percentiles(items, (share,)).select(f"p{round(share * 100)}").scalar()
    return items.withColumn("is_high_value", F.col("price") >= cut)


def item_popularity(log: DataFrame, items: DataFrame) -> DataFrame:
    """Mean relevance × ln(1 + interactions), ×1.3 for high-value items."""
    cut = price_percentiles(items, (0.75,)).select("p75").scalar()
    counted = log.groupBy("item_idx").agg(
        F.count("*").alias("n_interactions"),
        F.sum("relevance").alias("relevance_sum"),
        F.avg("relevance").alias("relevance_mean"),
    )
    priced = lookup_default(counted, items.select("item_idx", "price"), "item_idx", {"price": E.DEFAULT_PRICE})
    boost = F.when(F.col("price") >= cut, F.lit(1.3)).otherwise(F.lit(1.0))
    return priced.withColumn("popularity", F.col("relevance_mean") * F.log1p("n_interactions") * boost)


def item_value_score(log: DataFrame) -> DataFrame:
    """Positive rate, distinct users and rate × ln(1 + users) per item."""
    counted = log.groupBy("item_idx").agg(
        F.count("*").alias("n_interactions"),
        F.count_if(F.col("relevance") > 0).alias("n_positive"),
        F.countDistinct("user_idx").alias("n_users"),
    )
    rate = F.col("n_positive").cast("double") / F.col("n_interactions")
    return counted.withColumn("popularity", rate).withColumn("value_score", rate * F.log1p("n_users"))


def lookup_default(df: DataFrame, table: DataFrame, key: str, defaults: dict[str, float]) -> DataFrame:
    """Look a key up in a dimension; what is missing takes its default.

    The join strategy is left to Spark, which broadcasts the dimension only when
    its size is known to be small and splits skewed keys otherwise.
    """
    joined = df.join(table.select(key, *defaults), key, "left")
    for name, default in defaults.items():
        joined = joined.withColumn(name, F.coalesce(name, F.lit(default)))
    return joined


def positive_interactions(log: DataFrame) -> DataFrame:
    return log.filter(F.col("relevance") > 0)


def _positive_prices(log: DataFrame, items: DataFrame) -> DataFrame:
    rows = positive_interactions(log).select("user_idx", "item_idx")
    return lookup_default(rows, items.select("item_idx", "price"), "item_idx", {"price": E.DEFAULT_PRICE})


def user_spending_profile(log: DataFrame, items: DataFrame) -> DataFrame:
    """Mean, deviation and spending tier of the positive rows of each user."""
    stats = price_percentiles(items)
    profile = _positive_prices(log, items).groupBy("user_idx").agg(
        F.avg("price").alias("avg_price"), F.stddev_pop("price").alias("price_std")
    )
    tier = E.ar_tier(
        F.col("avg_price"),
        stats.select("p60").scalar(),
        stats.select("p80").scalar(),
        stats.select("mean_price").scalar(),
        ("premium_buyer", "high_buyer", "regular_buyer", "budget_buyer"),
    )
    return profile.withColumn("tier", tier)


def user_price_profile(log: DataFrame, items: DataFrame) -> DataFrame:
    """As the spending profile, with range and count; deviation 15 for one row."""
    stats = price_percentiles(items)
    profile = _positive_prices(log, items).groupBy("user_idx").agg(
        F.avg("price").alias("mean_price"),
        F.when(F.count("*") > 1, F.stddev_pop("price")).otherwise(F.lit(15.0)).alias("std_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("interaction_count"),
    )
    tier = E.ar_tier(
        F.col("mean_price"),
        stats.select("p60").scalar(),
        stats.select("p80").scalar(),
        stats.select("mean_price").scalar(),
        ("premium", "high", "medium", "low"),
    )
    return profile.withColumn("price_range", F.col("max_price") - F.col("min_price")).withColumn("tier", tier)


def user_price_profile_simple(log: DataFrame, items: DataFrame) -> DataFrame:
    """Mean price of the positive rows, tiers cut at 75 and 40."""
    profile = _positive_prices(log, items).groupBy("user_idx").agg(F.avg("price").alias("mean_price"))
    # The cuts of the tiers.
    tier = F.when(F.col("mean_price") > 75, "high").when(F.col("mean_price") > 40, "medium").otherwise("low")
    return profile.withColumn("tier", tier)


def user_activity_profile(log: DataFrame, items: DataFrame) -> DataFrame:
    """Mean positive price, its rank among all prices in percent, and activity.

    Prices and means are sorted together; the running count of prices at a mean
    is the number of prices not above it.
    """
    rows = log.groupBy("user_idx").agg(F.count("*").alias("n_rows"))
    means = _positive_prices(log, items).groupBy("user_idx").agg(F.avg("price").alias("avg_price"))
    # A mean can miss an equal price by its last bit; nine digits settle that.
    points = items.select(
        F.lit(None).cast("long").alias("user_idx"), F.col("price").alias("avg_price"), F.lit(1).alias("is_price")
    ).unionByName(means.select("user_idx", F.round("avg_price", 9).alias("avg_price"), F.lit(0).alias("is_price")))
    placed = global_running_sum(points, "is_price", "avg_price", F.col("is_price").desc(), "user_idx", name="n_upto")
    share = F.col("n_upto").cast("double") / scalar(items, F.count("*")) * 100
    # The cuts of the tiers, the rows of full activity.
    tier = F.when(F.col("percentile") > 75, "premium").when(F.col("percentile") > 50, "regular").otherwise("budget")
    return (
        placed.filter(F.col("is_price") == 0)
        .select("user_idx", "avg_price", share.alias("percentile"))
        .withColumn("tier", tier)
        .join(rows, "user_idx")
        .withColumn("activity", F.least(F.lit(3.0), F.col("n_rows") / F.lit(5.0)))
        .drop("n_rows")
    )
