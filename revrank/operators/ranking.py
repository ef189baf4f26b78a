"""Ranking operators: top-k per user, catalogue order, exact best-first search.

The full user × item product is never built. Scores that depend on the item
alone are ranked once for the whole catalogue and each user reads the head of
that order. Scores of the form ``value <= bound(item)`` are searched best-first:
items are visited in order of their bound and a user stops as soon as no later
item can enter the user's top k. Both give the same rows as scoring everything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from revrank.session import cut_lineage

# Largest row count that is ever broadcast by hint. The count is known before
# the hint is given; beyond it the join is shuffled.
BROADCAST_ROWS = 500_000
# Scores are rounded to six digits, so one may lie this much above its bound.
BOUND_SLACK = 1e-6
# Longest array of ranks generated inside one row.
RANKS_PER_ROW = 1024
# Pairs for which a further task is worth it.
TASK_PAIRS = 500_000
# Parts into which a bin of user margins is cut, and an exponent beyond which a chance is nothing.
BIN_PARTS = 16
LARGEST_EXPONENT = 500.0


def top_k_per_user(
    df: DataFrame,
    k: int | str | Column,
    score: str = "score",
    tie: str = "item_idx",
    rank: str | None = None,
    user: str = "user_idx",
    most: int | None = None,
) -> DataFrame:
    """The ``k`` best rows of every user; equal scores go by ``tie`` ascending.

    Spark cuts each map task's groups to the limit before the shuffle
    (WindowGroupLimit), so a user holding much of the input stays cheap. It does
    so for a number only: with a column of limits give the largest as ``most``.
    """
    order = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(tie).asc())
    limit = F.lit(k) if isinstance(k, int) else (F.col(k) if isinstance(k, str) else k)
    name = rank or "_rank"
    kept = df.withColumn(name, F.row_number().over(order))
    kept = (kept if most is None else kept.filter(F.col(name) <= most)).filter(F.col(name) <= limit)
    return kept if rank else kept.drop(name)


@dataclass(frozen=True)
class Catalogue:
    """Items with their 1-based ``rank`` in one order, and how many there are."""

    items: DataFrame
    size: int


def _sorted_in_parts(df: DataFrame, order: tuple, weight: Column) -> tuple[DataFrame, DataFrame, int]:
    """Rows in global order with partition number ``_part`` and position ``_pos``.

    Also the sum of ``weight`` before each partition, and over all of them. The
    sorted rows are written once, so that every reader sees the same partitions.
    """
    rows = cut_lineage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_mid", 33).cast("long")).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    total, starts = 0, []
    # One row per partition of the sort comes to the driver.
    for part, amount in rows.groupBy("_part").agg(F.sum(weight.cast("long"))).orderBy("_part").collect():
        starts.append((part, total))
        total += amount
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    return rows.drop("_mid"), offsets, total


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank") -> Catalogue:
    """Dense 1-based rank over the whole table without a single-task sort.

    A range-partitioned sort numbers the rows of each partition; partition
    offsets turn these into global ranks. ``order`` must be total.
    """
    rows, offsets, total = _sorted_in_parts(df, order, F.lit(1))
    ranked = rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_pos") + F.col("_start") + F.lit(1))
    return Catalogue(ranked.drop("_part", "_pos", "_start"), total)


def global_running_sum(df: DataFrame, weight: str, *order: Column | str, name: str = "running") -> DataFrame:
    """Running sum of an integer column over the whole table, in ``order``."""
    rows, offsets, _ = _sorted_in_parts(df, order, F.col(weight))
    upto = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_sum", F.sum(weight).over(upto)).join(F.broadcast(offsets), "_part")
    return summed.withColumn(name, F.col("_sum") + F.col("_start")).drop("_part", "_pos", "_sum", "_start")


def explode_ranks(df: DataFrame, low: Column, high: Column, name: str = "rank") -> DataFrame:
    """One row per rank in ``low`` … ``high``, generated in bounded arrays."""
    blocks = F.sequence(F.lit(0), F.floor((high - low) / F.lit(RANKS_PER_ROW)))
    started = df.filter(high >= low).withColumn("_block", F.explode(blocks))
    first = low + F.col("_block") * F.lit(RANKS_PER_ROW)
    last = F.least(high, first + F.lit(RANKS_PER_ROW - 1))
    return started.withColumn(name, F.explode(F.sequence(first.cast("long"), last.cast("long")))).drop("_block")


def items_at_rank(pairs: DataFrame, catalogue: Catalogue, columns: list[str]) -> DataFrame:
    """Attach the item at ``rank``.

    Low ranks are asked for by every user. They are served from a broadcast of
    at most ``BROADCAST_ROWS`` items; the tail, where no rank is popular, is a
    shuffled join.
    """
    items = catalogue.items.select("rank", *columns)
    if catalogue.size <= BROADCAST_ROWS:
        return pairs.join(F.broadcast(items), "rank")
    in_head = F.col("rank") <= BROADCAST_ROWS
    head = pairs.filter(in_head).join(F.broadcast(items.filter(in_head)), "rank")
    tail = pairs.filter(~in_head).join(items.filter(~in_head).hint("shuffle_hash"), "rank")
    return head.unionByName(tail)


def first_unseen(
    users: DataFrame,
    catalogue: Catalogue,
    seen: DataFrame | None,
    need: int | str,
    columns: list[str] | None = None,
    shift: str | None = None,
) -> DataFrame:
    """For every user the first ``need`` items of the catalogue order not yet seen.

    A user who has seen s items finds them among the first need + s ranks; with
    s' the seen ones among those, the first need + s' ranks suffice. So a user
    costs need + s' rows, not the catalogue. With ``shift``, a users column, each
    user's order starts that many ranks later and wraps around; ``slot`` is then
    the place in the user's own order.
    """
    columns = columns or ["item_idx"]
    wanted = F.lit(need) if isinstance(need, int) else F.col(need)
    size = F.lit(catalogue.size).cast("long")
    def place(pairs: DataFrame) -> DataFrame:
        if shift is None:
            return items_at_rank(pairs.withColumnRenamed("slot", "rank"), catalogue, columns)
        turned = pairs.withColumn("rank", F.pmod(F.col("slot") - 1 + F.col(shift), size) + 1)
        return items_at_rank(turned, catalogue, columns)

    if seen is None:
        return place(explode_ranks(users, F.lit(1), F.least(size, wanted.cast("long")), "slot"))
    ranks = catalogue.items.select("item_idx", F.col("rank").alias("slot"))
    if shift is None:
        # Nobody reaches further than the largest need and the most places that one user's seen rows can take.
        rows = seen.filter("user_idx IS NOT NULL").groupBy("user_idx").count().agg(F.max("count")).first()[0] or 0
        same = catalogue.items.filter("item_idx IS NOT NULL").groupBy("item_idx").count().agg(F.max("count")).first()[0] or 0
        widest = need if isinstance(need, int) else users.agg(F.max(wanted)).first()[0]
        head = int(min(catalogue.size, (widest or 0) + rows * same))
        ranks = ranks.filter(F.col("slot") <= head)
        ranks = F.broadcast(ranks) if head <= BROADCAST_ROWS else ranks
        catalogue = Catalogue(catalogue.items.filter(F.col("rank") <= head), head)
    seen_slots = seen.select("user_idx", "item_idx").join(ranks, "item_idx").select("user_idx", "slot").distinct()
    totals = seen_slots.groupBy("user_idx").agg(F.count("*").alias("_seen"))
    own = [shift] if shift else []
    reach = users.select("user_idx", wanted.alias("_need"), *own).join(totals, "user_idx")
    placed = seen_slots.join(reach, "user_idx")
    if shift:
        placed = placed.withColumn("slot", F.pmod(F.col("slot") - 1 - F.col(shift), size) + 1)
    near = placed.filter(F.col("slot") <= F.col("_need") + F.col("_seen")).select("user_idx", "slot")
    in_reach = cut_lineage(near)  # few rows: seen items near the head of the order
    depth = in_reach.groupBy("user_idx").agg(F.count("*").alias("_depth"))
    deep = users.join(depth, "user_idx", "left").withColumn("_depth", F.coalesce("_depth", F.lit(0)))
    pairs = explode_ranks(deep, F.lit(1), F.least(size, wanted + F.col("_depth")), "slot")
    unseen = pairs.join(in_reach, ["user_idx", "slot"], "left_anti").drop("_depth")
    order = Window.partitionBy("user_idx").orderBy("slot")
    kept = unseen.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= wanted).drop("_n")
    return place(kept)


def best_first_top_k(
    users: DataFrame,
    catalogue: Catalogue,
    seen: DataFrame | None,
    k: int,
    score: Callable[[DataFrame], DataFrame],
    item_columns: list[str],
    need: str | None = None,
    first: int = 64,
    growth: int = 8,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    counts: list[int] | None = None,
) -> DataFrame:
    """Exact top ``k`` unseen items per user for scores bounded by the item.

    ``catalogue`` is ordered by a column ``bound`` descending, and ``score`` adds
    a column ``score`` that never exceeds it. Round by round the next stretch of
    ranks is scored for the users still open; a user closes when the k-th best
    score beats every bound to come. Stretches grow geometrically, so there are
    at most log(catalogue) rounds, and nobody is left with a partial answer.
    ``need`` names a users column with a smaller, per-user k. ``refine`` may lower the
    bounds of a stretch's items when it is reached; a user does not score items whose bound
    its k-th score already beats. ``counts`` gets the number of scored pairs of each round.
    """
    limit = F.lit(k) if need is None else F.col(need)
    keep = ["user_idx", "item_idx", "score"] + ([need] if need else [])
    closed: list[DataFrame] = []
    best: DataFrame | None = None
    active, low, high = users.withColumn("_least", F.lit(None).cast("double")), 0, min(first, catalogue.size)
    while True:
        own = catalogue.items.filter((F.col("rank") > low) & (F.col("rank") <= high))
        stretch = Catalogue(cut_lineage(refine(own)) if refine else own, high - low)
        pairs = explode_ranks(active, F.lit(low + 1), F.lit(high))
        pairs = items_at_rank(pairs, stretch, ["item_idx", "bound", *item_columns])
        pairs = pairs.filter(F.col("_least").isNull() | (F.col("bound") >= F.col("_least") - F.lit(BOUND_SLACK)))
        if seen is not None:
            # Of the seen pairs only those of this stretch's items are shuffled.
            names = stretch.items.select("item_idx")
            names = F.broadcast(names) if stretch.size <= BROADCAST_ROWS else names
            near = seen.select("user_idx", "item_idx").join(names, "item_idx", "left_semi").distinct()
            pairs = pairs.join(near, ["user_idx", "item_idx"], "left_anti")
        pairs = pairs.drop("_least")
        if counts is not None:
            counts.append(pairs.count())
        scored = score(pairs).select(*keep)
        merged = scored if best is None else scored.unionByName(best)
        if high >= catalogue.size:
            closed.append(top_k_per_user(merged, limit, most=k))
            break
        best = cut_lineage(top_k_per_user(merged, limit, most=k))
        next_bound = catalogue.items.filter(F.col("rank") == high + 1).select("bound").head()["bound"]
        reached = (
            best.groupBy("user_idx")
            .agg(F.count("*").alias("_n"), F.min("score").alias("_last"), F.first(limit).alias("_limit"))
            .filter(F.col("_n") >= F.col("_limit"))
            .select("user_idx", F.col("_last").alias("_least"))
        )
        full = reached.filter(F.col("_least") > F.lit(next_bound)).select("user_idx")
        closed.append(best.join(full, "user_idx", "left_semi"))
        best = best.join(full, "user_idx", "left_anti")
        active = active.drop("_least").join(full, "user_idx", "left_anti").join(reached, "user_idx", "left")
        if active.isEmpty():
            break
        low, high = high, min(high * growth, catalogue.size)
    return reduce(DataFrame.unionByName, closed)


def _one_of_alike(catalogue: Catalogue, alike: list[str], most: int) -> tuple[Catalogue, DataFrame]:
    """The catalogue with one item of those that agree in ``alike``, and the first ``most`` ids of each such group.

    As ``item_idx`` it has a number in order of the groups' first ids, so that equal scores go the same way.
    """
    rows = catalogue.items.drop("rank")
    others = [c for c in rows.columns if c not in ("item_idx", *alike)]
    same = Window.partitionBy(*alike).orderBy("item_idx")
    rows = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= most).drop("_n")
    groups = rows.groupBy(*alike).agg(
        F.min(F.struct("item_idx", *others)).alias("_one"), F.sort_array(F.collect_list(F.struct("item_idx"))).alias("_members")
    )
    groups = global_rank(groups.select(*alike, "_one.*", "_members"), "item_idx", *alike, name="_number").items
    groups = cut_lineage(groups.drop("item_idx").withColumnRenamed("_number", "item_idx"))
    return global_rank(groups.drop("_members"), F.col("bound").desc(), "item_idx"), groups.select("item_idx", "_members")


def grouped_top_k(
    users: DataFrame,
    group_columns: list[str],
    catalogue: Catalogue,
    seen: DataFrame | None,
    k: int,
    score: Callable[[DataFrame], DataFrame],
    item_columns: list[str],
    first: int = 64,
    growth: int = 8,
    alike: list[str] | None = None,
) -> DataFrame:
    """Exact top ``k`` unseen items per user when users that agree in ``group_columns`` score alike.

    The search runs once per group and need: a user who has seen s items finds the
    k best unseen among the group's k + s best, and needs are rounded up to powers of two.
    So a user costs about k + s rows however many items are searched. ``score``
    sees a group as one user with the columns of one of its users. Items that agree in the
    ``alike`` columns score alike too: one of them is searched for all.
    """
    people = users
    if seen is None:
        people = people.withColumn("_seen", F.lit(0))
    else:
        seen = cut_lineage(seen.select("user_idx", "item_idx").distinct())
        people = people.join(seen.groupBy("user_idx").agg(F.count("*").alias("_seen")), "user_idx", "left").na.fill(0, ["_seen"])
    power = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_seen") + F.lit(k)))).cast("long")
    people = people.withColumn("need", F.least(power, F.lit(catalogue.size).cast("long")))
    people = cut_lineage(people.withColumn("_group", F.xxhash64(*group_columns, "need")))
    others = [c for c in users.columns if c != "user_idx"]
    groups = people.groupBy("_group", "need").agg(F.min(F.struct(*others)).alias("_one")).select(F.col("_group").alias("user_idx"), "need", "_one.*")
    largest = groups.agg(F.max("need")).first()[0] or k
    if alike is None:
        lists = best_first_top_k(groups, catalogue, None, int(largest), score, item_columns, "need", first, growth)
    else:
        catalogue, members = _one_of_alike(catalogue, alike, int(largest))
        lists = best_first_top_k(groups, catalogue, None, int(largest), score, item_columns, "need", first, growth).join(members, "item_idx")
        lists = lists.select("user_idx", "need", "score", F.explode(F.slice("_members", 1, F.col("need").cast("int"))).alias("_item"))
        lists = top_k_per_user(lists.select("user_idx", "need", "score", "_item.item_idx"), "need", most=int(largest))
    lists = cut_lineage(lists.select(F.col("user_idx").alias("_group"), "item_idx", "score"))
    own = people.select("user_idx", "_group").join(lists, "_group").drop("_group")
    if seen is not None:
        own = own.join(seen, ["user_idx", "item_idx"], "left_anti")
    return top_k_per_user(own, k)


def _binned(users: DataFrame, low: float, width: float, parts: int) -> DataFrame:
    at = F.floor((F.col("user_margin") - F.lit(low)) / F.lit(width) * F.lit(parts)) if width else F.lit(0)
    return users.withColumn("bin", F.least(at.cast("long"), F.lit(parts - 1)).cast("long"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def margin_lists(users: DataFrame, items: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Users with a ``bin`` of like ``user_margin``, and for each bin all items that may be among a user's ``n`` best.

    A score is price / (1 + exp(-(user_margin + item_margin))), rounded to six digits. Divided by
    what an item of middling margin gets from the same user, it keeps its order among items and
    rises or falls with the user's margin all the way, so its ends in a bin are its extremes there.
    Items that ``n`` others surely beat in the whole bin go, as do those with ``n`` items before them
    that agree in all columns. Bins are cut, and their lists with them, while lists are long.
    Then come the number of rows in the lists, and that of pairs of a user and a row of its list.
    """
    low, high, total = users.agg(F.min("user_margin"), F.max("user_margin"), F.count("*")).first()
    others = [c for c in items.columns if c not in ("item_idx", "item_margin")]
    alike = Window.partitionBy(*others).orderBy("item_idx")
    lists = items.withColumn("_n", F.row_number().over(alike)).filter(F.col("_n") <= n).drop("_n").withColumn("bin", F.lit(0).cast("long"))
    lists, parts, before = cut_lineage(lists), 1, None
    while True:
        binned = _binned(users, low, high - low, parts)
        spans = binned.groupBy("bin").agg(F.min("user_margin").alias("_from"), F.max("user_margin").alias("_to"), F.count("*").alias("_users"))
        spans = spans.withColumn("_parent", F.floor(F.col("bin") / F.lit(BIN_PARTS)).cast("long"))
        middle = lists.agg(F.avg("item_margin")).first()[0]

        def odds(user: Column, item: Column) -> Column:
            return F.lit(1.0) + F.exp(F.least(F.lit(LARGEST_EXPONENT), -(user + item)))

        ends = [F.col("price") * odds(F.col(c), F.lit(middle)) / odds(F.col(c), F.col("item_margin")) for c in ("_from", "_to")]
        met = lists.withColumnRenamed("bin", "_parent").join(_small(spans, parts), "_parent").drop("_parent")
        met = cut_lineage(met.withColumn("_least", F.least(*ends)).withColumn("_most", F.greatest(*ends)))
        order = Window.partitionBy("bin").orderBy(F.col("_least").desc())
        best = met.select("bin", "_least").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n)
        reached = best.groupBy("bin").agg(F.count("*").alias("_n"), F.min("_least").alias("_reached")).filter(F.col("_n") == n).drop("_n")
        # Scores closer than a unit of their last digit may be equal when rounded.
        slack = F.lit(1.1e-6) * odds(F.col("_from"), F.lit(middle)) + F.lit(1e-9) * F.abs("_reached")
        near = met.join(_small(reached, parts), "bin", "left").filter(F.col("_reached").isNull() | (F.col("_most") >= F.col("_reached") - slack))
        lists = cut_lineage(near.select("bin", "_users", *items.columns))
        rows, pairs = lists.agg(F.count("*"), F.sum("_users")).first()
        lists = lists.drop("_users")
        if pairs <= 2 * n * total or parts * BIN_PARTS > total // 4 or (before and pairs > 0.8 * before):
            return binned, lists, rows, pairs
        parts, before = parts * BIN_PARTS, pairs


def margin_top_k(
    users: DataFrame,
    items: DataFrame,
    seen: DataFrame | None,
    k: int,
    score: Callable[[DataFrame], DataFrame],
    first: int = 16,
    growth: int = 4,
    counts: list[int] | None = None,
) -> DataFrame:
    """Exact top ``k`` unseen items per user for a price times the sigmoid of a user's and an item's margin.

    Users of like margin share a list with all that may be among the n best of any of them
    (:func:`margin_lists`). A user who has seen at most n - k rows of it finds the k best unseen
    there; the others go on with a larger n. So a user costs about n pairs however many items
    there are, and only seen rows of listed items are moved. ``score`` adds the score itself;
    ``counts`` gets the number of scored pairs of each round.
    """
    users, items = cut_lineage(users), cut_lineage(items)
    size, n, closed = items.count(), max(first, 2 * k), []
    others = [c for c in items.columns if c != "item_idx"]
    if not size or users.isEmpty():
        return score(users.crossJoin(items)).select("user_idx", "item_idx", "score")
    while True:
        n = min(n, size)
        placed, lists, rows, n_pairs = margin_lists(users, items, n)
        lists = _small(lists, rows)
        if seen is None:
            placed = placed.withColumn("_held", F.lit(0)).withColumn("_seen", F.array().cast("array<long>"))
        else:
            listed = lists.select("item_idx").distinct()
            near = seen.select("user_idx", "item_idx").join(_small(listed, rows), "item_idx", "left_semi").distinct()
            held = near.join(placed.select("user_idx", "bin"), "user_idx").join(lists.select("bin", "item_idx"), ["bin", "item_idx"])
            held = held.groupBy("user_idx").agg(F.count("*").alias("_held"), F.collect_set("item_idx").alias("_seen"))
            placed = cut_lineage(placed.join(held, "user_idx", "left"))
        done = F.coalesce("_held", F.lit(0)) + F.lit(k) <= F.lit(n) if n < size else F.lit(True)
        # Rows that agree in all columns score alike, so one of them is scored for a user.
        alike = lists.groupBy("bin", *others).agg(F.sort_array(F.collect_list(F.struct("item_idx"))).alias("_alike"))
        dealt = placed.filter(done).repartition(min(4096, n_pairs // TASK_PAIRS + 1), "user_idx")
        pairs = dealt.join(_small(alike, rows), "bin").withColumn("item_idx", F.col("_alike")[0]["item_idx"])
        if counts is not None:
            counts.append(pairs.count())
        unseen = F.filter("_alike", lambda item: ~F.coalesce(F.array_contains("_seen", item["item_idx"]), F.lit(False)))
        own = score(pairs).select("user_idx", "score", F.explode(F.slice(unseen, 1, k)).alias("_item"))
        closed.append(top_k_per_user(own.select("user_idx", "_item.item_idx", "score"), k))
        users = placed.filter(~done).select(*users.columns)
        if n >= size or users.isEmpty():
            return reduce(DataFrame.unionByName, closed)
        n *= growth


def for_all_users(users: DataFrame, catalogue: Catalogue, k: int, columns: list[str]) -> DataFrame:
    """The first ``k`` items of the catalogue order, given to every user."""
    return first_unseen(users, catalogue, None, k, columns)


def filter_seen(pairs: DataFrame, log: DataFrame) -> DataFrame:
    """Drop pairs that occur in the log."""
    return pairs.join(log.select("user_idx", "item_idx").distinct(), ["user_idx", "item_idx"], "left_anti")


def split_cold_users(users: DataFrame, train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users with training rows, and users without."""
    known = train.select("user_idx").distinct()
    return users.join(known, "user_idx", "left_semi"), users.join(known, "user_idx", "left_anti")


def candidate_space(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """What each user can be recommended, without listing it.

    The candidates of a user are all items but the seen ones. Their number and
    price sum follow from the catalogue's totals minus the user's own.
    """
    totals = items.agg(F.count("*").alias("n"), F.sum("price").alias("total"))
    seen = (
        log.select("user_idx", "item_idx")
        .distinct()
        .join(items.select("item_idx", "price"), "item_idx")
        .groupBy("user_idx")
        .agg(F.count("*").alias("n_seen"), F.sum("price").alias("seen_price"))
    )
    n_items = totals.select("n").scalar()
    price_total = totals.select("total").scalar()
    return (
        users.select("user_idx")
        .join(seen, "user_idx", "left")
        .select(
            "user_idx",
            n_items.alias("n_pairs"),
            (n_items - F.coalesce("n_seen", F.lit(0))).alias("n_candidates"),
            (price_total - F.coalesce("seen_price", F.lit(0.0))).alias("candidate_price_sum"),
        )
    )
