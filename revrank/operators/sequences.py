"""Sequences: recent histories, padding, n-grams, bigram model tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from revrank.functions import expressions as E
from revrank.operators.profile import high_value_items, scalar
from revrank.sources.adapters import TIME_ORDER

# Users with more rows than this are windowed in blocks.
HOT_USER_ROWS = 1_000_000
BLOCK_ROWS = 65_536


def time_order(log: DataFrame) -> list[str]:
    """The order columns that the log has."""
    wanted = ["__iter", *TIME_ORDER] if "o_orderdate" not in log.columns else TIME_ORDER
    return [name for name in wanted if name in log.columns]


def recent_history(log: DataFrame, n: int) -> DataFrame:
    """Each user's last ``n`` rows with ``pos`` 1 … n, the oldest kept row first.

    Only the n newest rows of a user pass the shuffle (WindowGroupLimit).
    """
    newest = Window.partitionBy("user_idx").orderBy(*[F.col(c).desc() for c in time_order(log)])
    kept = log.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n)
    length = F.count("*").over(Window.partitionBy("user_idx"))
    return kept.withColumn("pos", (length - F.col("_back") + 1).cast("int")).drop("_back")


def history_arrays(recent: DataFrame, columns: list[str]) -> DataFrame:
    """One row per user with an array per column, oldest first."""
    rows = F.sort_array(F.collect_list(F.struct("pos", *columns)))  # at most n rows per user
    return recent.groupBy("user_idx").agg(rows.alias("_rows")).select(
        "user_idx", *[F.col(f"_rows.{name}").alias(name) for name in columns]
    )


def pad_left(values: Column, length: int, filler: Column) -> Column:
    """Keep the last ``length`` elements and fill up on the left."""
    kept = F.slice(values, F.greatest(F.lit(1), F.size(values) - F.lit(length - 1)), F.lit(length))
    missing = F.greatest(F.lit(0), F.lit(length) - F.size(values))
    return F.concat(F.array_repeat(filler, missing), kept)


def padded_sequences(log: DataFrame, items: DataFrame, vocabulary: DataFrame, length: int = 100) -> DataFrame:
    """Item numbers and prices of the last rows, padded left with 0, and a mask."""
    recent = recent_history(log, length).select("user_idx", "item_idx", "pos")
    priced = recent.join(items.select("item_idx", "price"), "item_idx", "left").join(vocabulary, "item_idx", "left")
    priced = priced.select(
        "user_idx",
        "pos",
        F.coalesce("item_id", F.lit(0).cast("long")).alias("item_id"),
        F.coalesce("price", F.lit(E.DEFAULT_PRICE)).alias("price"),
    )
    arrays = history_arrays(priced, ["item_id", "price"])
    real = F.array_repeat(F.lit(True), F.size("item_id"))
    return arrays.select(
        "user_idx",
        pad_left(F.col("item_id"), length, F.lit(0).cast("long")).alias("item_ids"),
        pad_left(F.col("price"), length, F.lit(0.0)).alias("prices"),
        pad_left(real, length, F.lit(False)).alias("mask"),
    )


def with_temporal_weight(log: DataFrame) -> DataFrame:
    """Add ``time_weight``; 1.0 everywhere when the log has no iterations."""
    if "__iter" not in log.columns:
        return log.withColumn("time_weight", F.lit(1.0))
    last = scalar(log, F.max("__iter"))
    return log.withColumn("time_weight", E.temporal_weight(F.col("__iter"), last))


def _hot_users(log: DataFrame, limit: int) -> DataFrame:
    """Users with more than ``limit`` rows: at most rows / limit of them."""
    return log.groupBy("user_idx").agg(F.count("*").alias("_n")).filter(F.col("_n") > limit).select("user_idx")


def positioned(log: DataFrame) -> DataFrame:
    """Add ``pos``, the 1-based place of a row in its user's history.

    Works in pieces: rows are numbered within (user, day) and shifted by the
    number of rows on the user's earlier days, so one user's history is sorted by
    many tasks.
    """
    order = time_order(log)
    day = F.to_date(order[0]) if order[0] == "o_orderdate" else F.col(order[0])
    dated = log.withColumn("_day", day)
    per_day = dated.groupBy("user_idx", "_day").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("user_idx").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_day.select("user_idx", "_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    in_day = Window.partitionBy("user_idx", "_day").orderBy(*order)
    numbered = dated.withColumn("_in_day", F.row_number().over(in_day))
    return (
        numbered.join(starts, ["user_idx", "_day"])
        .withColumn("pos", F.col("_in_day") + F.col("_start"))
        .drop("_day", "_in_day", "_start")
    )


def _shingle(rows: DataFrame, window, n: int) -> DataFrame:
    """n-grams ending at each row, where the window holds n - 1 earlier rows."""
    earlier = [F.lag("item_idx", back).over(window) for back in range(n - 1, 0, -1)]
    named = rows.select("*", *[value.alias(f"_c{i}") for i, value in enumerate(earlier)])
    context = F.array(*[F.col(f"_c{i}") for i in range(n - 1)])
    return named.filter(F.col("_c0").isNotNull()).withColumn("context", context)


def ngrams(log: DataFrame, n: int = 2, hot_rows: int = HOT_USER_ROWS, block: int = BLOCK_ROWS) -> DataFrame:
    """Consecutive runs of n rows per user: ``context`` (n - 1 items), ``target``.

    The other columns are those of the target's row. Users with very long
    histories are windowed in blocks of positions that overlap by n - 1 rows.
    """
    keep = [c for c in log.columns if c not in ("user_idx", "item_idx")]
    columns = ["user_idx", "context", F.col("item_idx").alias("target"), *keep]
    plain_window = Window.partitionBy("user_idx").orderBy(*time_order(log))
    hot = _hot_users(log, hot_rows)
    if hot.isEmpty():
        return _shingle(log, plain_window, n).select(*columns)
    regular = _shingle(log.join(hot, "user_idx", "left_anti"), plain_window, n).select(*columns)
    rows = positioned(log.join(F.broadcast(hot), "user_idx", "left_semi"))
    own = F.floor((F.col("pos") - 1) / F.lit(block))
    spill_over = ((F.col("pos") - 1) % F.lit(block)) >= F.lit(block - (n - 1))
    blocks = F.when(spill_over, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    cut = _shingle(spread, Window.partitionBy("user_idx", "_block").orderBy("pos"), n)
    blocked = cut.filter(F.col("_block") == F.col("_own")).select(*columns)
    return regular.unionByName(blocked)


def bigrams(log: DataFrame, hot_rows: int = HOT_USER_ROWS) -> DataFrame:
    """Consecutive pairs per user, with the target row's columns."""
    return ngrams(log, 2, hot_rows).withColumn("context", F.col("context")[0])


def next_item_pairs(log: DataFrame, length: int = 100) -> DataFrame:
    """Training pairs from the last rows: input item, and the item that follows."""
    recent = recent_history(log, length).select("user_idx", "pos", "item_idx")
    following = Window.partitionBy("user_idx").orderBy("pos")
    return recent.select(
        "user_idx", "pos", F.col("item_idx").alias("input_item"), F.lead("item_idx").over(following).alias("target_item")
    ).filter(F.col("target_item").isNotNull())


# ---------------------------------------------------------------- bigram tables


def bigram_weights(log: DataFrame, items: DataFrame, hot_rows: int = HOT_USER_ROWS) -> DataFrame:
    """Weighted count per (context, target), context total and context boost.

    A pair weighs the time weight of its target's row, ×1.3 for a high-value
    target. The boost of a context is its largest time weight.
    """
    rows = with_temporal_weight(log.select("user_idx", "item_idx", *[c for c in (*time_order(log), "__iter") if c in log.columns and c != "item_idx"]))
    pairs = bigrams(rows, hot_rows).select("context", "target", "time_weight")
    flags = high_value_items(items).select(F.col("item_idx").alias("target"), "is_high_value")
    counted = pairs.groupBy("context", "target").agg(
        F.sum("time_weight").alias("_w"), F.max("time_weight").alias("_boost")
    )
    cells = counted.join(flags, "target", "left").select(
        "context",
        "target",
        (F.col("_w") * F.when(F.col("is_high_value"), F.lit(1.3)).otherwise(F.lit(1.0))).alias("weight"),
        "_boost",
    )
    totals = cells.groupBy("context").agg(F.sum("weight").alias("context_total"), F.max("_boost").alias("context_boost"))
    return cells.drop("_boost").join(totals, "context")


def bigram_pruned(weights: DataFrame, min_count: float = 1.0, digits: int = 6) -> DataFrame:
    """Drop light contexts, then light cells; totals are those of the kept cells.

    Weights are compared after rounding: they are sums, and their last digits
    depend on the order of addition.
    """
    heavy = weights.filter(
        (F.round("context_total", digits) >= min_count) & (F.round("weight", digits) >= min_count)
    ).drop("context_total")
    totals = heavy.groupBy("context").agg(
        F.sum("weight").alias("context_total"), F.count("*").alias("context_size")
    )
    return heavy.join(totals, "context")


def bigram_probs(pruned: DataFrame, alpha: float = 1.0) -> DataFrame:
    """Laplace-smoothed probability over the targets kept for a context."""
    total = F.col("context_total") + F.lit(alpha) * F.col("context_size")
    return pruned.withColumn("prob", (F.col("weight") + F.lit(alpha)) / total)


def staged_fill(stages: list[DataFrame], users: DataFrame, k: int) -> DataFrame:
    """Fill each user's k places from stages in order of priority.

    Every stage is ``user_idx, item_idx, score``. A stage gives a user its best
    rows, as many as earlier stages left free. An item already given is skipped.
    """
    taken: DataFrame | None = None
    for number, stage in enumerate(stages, start=1):
        rows = stage.withColumn("stage", F.lit(number))
        if taken is None:
            free = users.select("user_idx", F.lit(k).alias("_free"))
        else:
            used = taken.groupBy("user_idx").agg(F.count("*").alias("_used"))
            free = users.select("user_idx").join(used, "user_idx", "left").select(
                "user_idx", (F.lit(k) - F.coalesce("_used", F.lit(0))).alias("_free")
            )
            rows = rows.join(taken.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")
        order = Window.partitionBy("user_idx").orderBy(F.col("score").desc(), "item_idx")
        ranked = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
        chosen = ranked.join(free, "user_idx").filter(F.col("_n") <= F.col("_free")).drop("_n", "_free")
        taken = chosen if taken is None else taken.unionByName(chosen)
    return taken
