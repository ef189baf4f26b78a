"""Column expressions: every function takes and returns Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values, needed for equal results.
DEFAULT_PRICE = 50.0
RANK_DISCOUNT = 0.85
TIME_WEIGHT_SPAN = 0.3
CELL_WEIGHT_FLOOR = 0.1

# Display names of the metrics.
METRIC_NAMES = {
    "revenue": "Revenue",
    "discounted_revenue": "Discounted Revenue",
    "precision_at_k": "Precision@K",
    "ndcg_at_k": "NDCG@K",
    "mrr": "MRR",
    "hit_rate": "Hit Rate",
}


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clamp(value: str | Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(value)))


def clean_price(value: str | Column, default: float = DEFAULT_PRICE, nan_too: bool = False) -> Column:
    """Price as a double; what cannot be read becomes ``default``.

    NaN is a readable double and stays, unless ``nan_too`` is set.
    """
    number = col(value).try_cast("double")
    if nan_too:
        number = F.nanvl(number, F.lit(None).cast("double"))
    return F.coalesce(number, F.lit(default))


def expected_revenue(prob: str | Column, price: str | Column) -> Column:
    return col(prob) * col(price)


def price_match(price: Column, mean: Column, floor: float, slack: float) -> Column:
    """Closeness of a price to a user's mean price, at least ``floor``."""
    gap = F.abs(price - mean) / (mean + F.lit(slack))
    return F.greatest(F.lit(floor), F.lit(1.0) - gap)


def revenue_potential(price: Column, mean_price: Column, is_high: Column) -> Column:
    return price / mean_price * F.when(is_high, F.lit(1.2)).otherwise(F.lit(1.0))


def price_cell_weight(relevance: Column, price: Column) -> Column:
    """Weight of one log row in the price-weighted interaction matrix."""
    tilt = clamp(F.lit(1.0) + (price - F.lit(50.0)) / F.lit(200.0), 0.8, 1.5)
    return F.greatest(F.lit(CELL_WEIGHT_FLOOR), relevance) * tilt


def value_cell_weight(relevance: Column, value_score: Column) -> Column:
    """Weight of one log row in the value-weighted interaction matrix."""
    return F.greatest(F.lit(CELL_WEIGHT_FLOOR), relevance) * (F.lit(1.0) + value_score * F.lit(0.1))


def revenue_target(relevance: Column, price: Column) -> Column:
    return clamp((relevance + F.lit(1.0)) / F.lit(2.0), 0.01, 1.0) * price


def rank_discount(rank: Column, factor: float = RANK_DISCOUNT) -> Column:
    return F.pow(F.lit(factor), rank - F.lit(1))


def temporal_weight(iteration: Column, last: Column) -> Column:
    """1.0 for the first iteration, rising to 1.3 for the last."""
    rising = F.lit(1.0) + iteration.cast("double") / last.cast("double") * F.lit(TIME_WEIGHT_SPAN)
    return F.when(last > 0, rising).otherwise(F.lit(1.0))


def ar_tier(mean: Column, p60: Column, p80: Column, avg: Column, names: tuple[str, str, str, str]) -> Column:
    """Spending tier by the catalogue's price percentiles; names from high to low."""
    top, high, middle, low = names
    return (
        F.when(mean > p80, F.lit(top))
        .when(mean > p60, F.lit(high))
        .when(mean > avg * F.lit(0.8), F.lit(middle))
        .otherwise(F.lit(low))
    )


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def unit_hash(text: Column) -> Column:
    """A repeatable number in [0, 1] from text: first 32 bits of its md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def hash_bucket(text: Column, buckets: int) -> Column:
    """A repeatable bucket 0 … buckets-1 from text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def stable_id(value: str | Column) -> Column:
    """An id as a number; text that is no number gets a repeatable 31-bit hash."""
    text = col(value).cast("string")
    hashed = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.coalesce(text.try_cast("bigint"), hashed % F.lit(2147483648))


def metric_label(metric: str | Column) -> Column:
    """Display name of a metric, from the fixed names or by title case."""
    names = F.create_map(*[F.lit(part) for pair in METRIC_NAMES.items() for part in pair])
    return F.coalesce(names[col(metric)], F.initcap(F.replace(col(metric), F.lit("_"), F.lit(" "))))


def shown(value: str | Column, digits: int = 6) -> Column:
    """Round for ranking and output.

    The offset keeps short decimals off the rounding tie, where the last bit of a
    sum would decide.
    """
    return F.round(col(value) + F.lit(1e-10), digits)
