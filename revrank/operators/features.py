"""Feature building: training frames, one-hot columns, z-scores, splits, indexes."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.profile import learn_vocabulary
from revrank.operators.ranking import global_rank


def training_frame(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """The log with user and item columns; only known users and items remain."""
    return log.join(users, "user_idx").join(items, "item_idx")


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    """Keys and bookkeeping columns are no features."""
    return df.drop("user_idx", "item_idx", "__iter", "o_orderdate", "l_orderkey", "l_linenumber")


def user_history(log: DataFrame, items: DataFrame) -> DataFrame:
    return log.join(items, "item_idx").select("user_idx", "item_idx", "price")


def one_hot(df: DataFrame, column: str, vocabulary: list[str] | None = None) -> DataFrame:
    """One 0/1 column per value of a vocabulary learned at fit time."""
    values = vocabulary if vocabulary is not None else learn_vocabulary(df, column)
    encoded = [F.when(F.col(column) == v, F.lit(1)).otherwise(F.lit(0)).alias(f"{column}_{v}") for v in values]
    return df.select(*[c for c in df.columns if c != column], *encoded)


def standardize(df: DataFrame, column: str, fitted_on: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """z-score with the population deviation of ``fitted_on``; deviation 0 counts as 1."""
    base = df if fitted_on is None else fitted_on
    stats = base.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))
    mean, std = stats.select("mean").scalar(), stats.select("std").scalar()
    scale = F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumn(name or f"{column}_z", (F.col(column) - mean) / scale)


def hash_split(df: DataFrame, keys: list[str], share: int = 20, name: str = "is_validation") -> DataFrame:
    """Flag a repeatable ``share`` percent of rows by a hash of their keys."""
    text = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
    return df.withColumn(name, E.hash_bucket(text, 100) < share)


def dense_index(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """0-based position of each distinct key in sorted order."""
    ranked = global_rank(df.select(key).distinct(), key, name=name)
    return ranked.items.withColumn(name, F.col(name) - 1)


def item_vocabulary(log: DataFrame) -> DataFrame:
    """1-based item numbers in item order; 0 is left for padding and unknown items."""
    return global_rank(log.select("item_idx").distinct(), "item_idx", name="item_id").items


def encode_items(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    return df.join(vocabulary, "item_idx", "left").withColumn("item_id", F.coalesce("item_id", F.lit(0)))


def temporal_split(log: DataFrame, cut: int) -> DataFrame:
    """Phase of each row: before the cut is train, from the cut on test."""
    return log.withColumn("phase", F.when(F.col("__iter") < cut, "train").otherwise("test"))


def minmax_per_user(df: DataFrame, value: str, name: str = "norm") -> DataFrame:
    """Scale to [0, 1] over each user's rows; 0.5 where a user's rows are flat.

    Extremes come from a grouped aggregate (combined before the shuffle), not
    from a window over each user's rows.
    """
    ends = df.groupBy("user_idx").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(span > 0, (F.col(value) - F.col("_lo")) / span).otherwise(F.lit(0.5))
    return df.join(ends, "user_idx").withColumn(name, scaled).drop("_lo", "_hi")


def softmax_per_user(df: DataFrame, value: str, name: str = "prob") -> DataFrame:
    """Softmax over each user's rows, shifted by the user's maximum."""
    tops = df.groupBy("user_idx").agg(F.max(value).alias("_top"))
    raised = df.join(tops, "user_idx").withColumn("_e", F.exp(F.col(value) - F.col("_top")))
    totals = raised.groupBy("user_idx").agg(F.sum("_e").alias("_total"))
    return raised.join(totals, "user_idx").withColumn(name, F.col("_e") / F.col("_total")).drop("_top", "_e", "_total")


def shown_values(values: np.ndarray, digits: int = 6) -> np.ndarray:
    """:func:`revrank.functions.expressions.shown` of an array, half up on the decimal form as Spark rounds."""
    moved = values + 1e-10
    unit = 10.0**digits
    with np.errstate(all="ignore"):
        scaled = np.abs(moved) * unit
        gap = np.abs(scaled - np.floor(scaled) - 0.5)
        out = np.copysign(np.floor(scaled + 0.5) / unit, moved) + 0.0
    # Near a half, and where doubles are too coarse for the digit, the decimal form decides.
    close = np.flatnonzero(np.isfinite(moved) & ~(gap > 1e-9 + np.minimum(scaled, 1e300) * 1e-15))
    step = Decimal(1).scaleb(-digits)
    flat, given = out.reshape(-1), moved.reshape(-1)
    for at in close:
        number = Decimal(repr(float(given[at])))
        flat[at] = float(number.quantize(step, ROUND_HALF_UP)) + 0.0 if abs(number) < 10**15 else given[at]
    return np.where(np.isfinite(moved), flat.reshape(values.shape), moved)
