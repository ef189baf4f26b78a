"""Reference SQL for the registered queries, in DuckDB's dialect.

Written independently of the Spark plans: pairs are really crossed and
similarity matrices really built here, which is fine at checking size.
"""

from __future__ import annotations

from revrank.operators.evaluate import METRICS

K = 5

# Named parts, each a query over the given tables and earlier parts.
PARTS: dict[str, str] = {
    "users": """
        SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal / 10000.0::DOUBLE AS user_attr_0,
               c_nationkey / 24.0::DOUBLE AS user_attr_1 FROM customer""",
    "items": """
        SELECT p_partkey AS item_idx, p_type AS category, round(p_retailprice - 899.9::DOUBLE, 2) AS price,
               p_size / 50.0::DOUBLE AS item_attr_0, length(p_name) / 20.0::DOUBLE AS item_attr_1 FROM part""",
    "log": """
        SELECT o_custkey AS user_idx, l_partkey AS item_idx,
               CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS relevance,
               CAST(year(o_orderdate) - 1995 AS INTEGER) AS __iter, o_orderdate, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "early": "SELECT * FROM log WHERE o_orderdate < TIMESTAMP '1996-01-01'",
    "priced_log": "SELECT log.*, price FROM log JOIN items USING (item_idx)",
    "stats": """
        SELECT quantile_cont(price, 0.6) AS p60, quantile_cont(price, 0.75) AS p75, quantile_cont(price, 0.8) AS p80,
               avg(price) AS mean_price, stddev_pop(price) AS std_price FROM items""",
    "flagged": "SELECT items.*, price >= p75 AS is_high_value FROM items, stats",
    "popularity": """
        SELECT item_idx, count(*) AS n_interactions, sum(relevance) AS relevance_sum, avg(relevance) AS relevance_mean,
               any_value(price) AS price,
               avg(relevance) * ln(1 + count(*)) * CASE WHEN any_value(price) >= any_value(p75) THEN 1.3::DOUBLE ELSE 1.0 END
                 AS popularity
        FROM {log} JOIN items USING (item_idx), stats GROUP BY item_idx""",
    "value_scores": """
        SELECT item_idx, count(*) AS n_interactions, count(*) FILTER (relevance > 0) AS n_positive,
               count(DISTINCT user_idx) AS n_users,
               count(*) FILTER (relevance > 0)::DOUBLE / count(*) AS popularity,
               count(*) FILTER (relevance > 0)::DOUBLE / count(*) * ln(1 + count(DISTINCT user_idx)) AS value_score
        FROM {log} GROUP BY item_idx""",
    "early_profiles": """
        SELECT user_idx, avg(price) AS avg_price, stddev_pop(price) AS price_std, count(*) AS n,
               min(price) AS min_price, max(price) AS max_price
        FROM early JOIN items USING (item_idx) WHERE relevance > 0 GROUP BY user_idx""",
    "full_profiles": """
        SELECT user_idx, avg(price) AS avg_price FROM priced_log WHERE relevance > 0 GROUP BY user_idx""",
    "cells": """
        SELECT user_idx, item_idx, sum(greatest(0.1::DOUBLE, relevance)
                 * greatest(0.8::DOUBLE, least(1.5::DOUBLE, 1 + (price - 50) / 200.0::DOUBLE))) AS weight
        FROM priced_log GROUP BY user_idx, item_idx""",
    "item_norms": "SELECT item_idx, sqrt(sum(weight * weight)) AS norm FROM cells GROUP BY item_idx",
    "user_norms": "SELECT user_idx, sqrt(sum(weight * weight)) AS norm FROM cells GROUP BY user_idx",
    "item_sims": """
        SELECT a.item_idx AS a, b.item_idx AS b, sum(a.weight * b.weight) / any_value(na.norm) / any_value(nb.norm) AS sim
        FROM cells a JOIN cells b USING (user_idx)
        JOIN item_norms na ON na.item_idx = a.item_idx JOIN item_norms nb ON nb.item_idx = b.item_idx
        GROUP BY a.item_idx, b.item_idx""",
    "user_sims": """
        SELECT a.user_idx AS a, b.user_idx AS b, sum(a.weight * b.weight) / any_value(na.norm) / any_value(nb.norm) AS sim
        FROM cells a JOIN cells b USING (item_idx)
        JOIN user_norms na ON na.user_idx = a.user_idx JOIN user_norms nb ON nb.user_idx = b.user_idx
        GROUP BY a.user_idx, b.user_idx""",
}

TIME_ORDER = "o_orderdate, l_orderkey, l_linenumber, item_idx, relevance"
NEWEST = "o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, item_idx DESC, relevance DESC"


def r6(expression: str) -> str:
    return f"round(({expression}) + 1e-10::DOUBLE, 6)"


def unit_hash(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967295.0::DOUBLE)"


def factor(key: str, j: int) -> str:
    return unit_hash(f"{key}::VARCHAR || '-{j}'")


def sql(parts: str, select: str, **extra: str) -> str:
    """A query with the named parts and further ones as common table expressions."""
    named = [(name, PARTS[name]) for name in parts.split()] + list(extra.items())
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in named)
    return f"WITH {ctes}\n{select}" if named else select


#: Queries that learn from the whole log: the part named ``early`` is all of it there.
WHOLE_LOG = (
    "candidate_cross candidates coverage user_spending_profile user_price_profile user_price_profile_simple"
    " user_activity_profile dense_index item_vocabulary padded_sequences global_top_k_for_all staged_fill model_statistics"
    " graph_fallback price_fallback random_recommend popularity_recommend content_based_recommend bigram_recommend_whole_log"
).split()

BASE = "users items log early priced_log stats flagged"


def popularity(log: str) -> str:
    return PARTS["popularity"].format(log=log)


def value_scores(log: str) -> str:
    return PARTS["value_scores"].format(log=log)


def histogram(source: str, value: str, bins: int, group: str | None = None, attr: str | None = None) -> str:
    keys = f"{group}, " if group else ""
    on = f"AND h.{group} = e.{group}" if group else ""
    shown = f"e.{group}, " if group else ""
    label = f"'{attr}' AS attr, " if attr else ""
    by = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON true"
    return f"""
        SELECT {shown}{label}e.bin, {r6('lo + e.bin * ((hi - lo) / ' + str(bins) + ')')} AS bin_lo,
               {r6('lo + (e.bin + 1) * ((hi - lo) / ' + str(bins) + ')')} AS bin_hi, coalesce(h.n, 0) AS n
        FROM (SELECT * FROM (
                SELECT {keys}CASE WHEN min({value}) = max({value}) THEN min({value}) - 0.5 ELSE min({value}) END AS lo,
                       CASE WHEN min({value}) = max({value}) THEN max({value}) + 0.5 ELSE max({value}) END AS hi
                FROM {source} {by}), (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin)) e
        LEFT JOIN (
          SELECT {keys}CAST(least(floor(({value} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
          FROM {source} JOIN (
            SELECT {keys}CASE WHEN min({value}) = max({value}) THEN min({value}) - 0.5 ELSE min({value}) END AS lo,
                   CASE WHEN min({value}) = max({value}) THEN max({value}) + 0.5 ELSE max({value}) END AS hi
            FROM {source} {by}) {join} GROUP BY ALL) h
        ON h.bin = e.bin {on}"""


def top_k(pairs: str, k: int = K) -> str:
    """First k of each user from pairs (user_idx, item_idx, score)."""
    return f"""
        SELECT user_idx, item_idx, score FROM ({pairs})
        QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) <= {k}"""


def unseen(log: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {log} l WHERE l.user_idx = u.user_idx AND l.item_idx = i.item_idx)"


def popular_scores(log: str, by_revenue: bool) -> str:
    price = "* price" if by_revenue else ""
    return f"""
        SELECT item_idx, {r6('(coalesce(p, 0) + 1.0::DOUBLE) / (coalesce(n, 0) + 2.0::DOUBLE) ' + price)} AS score
        FROM items LEFT JOIN (
          SELECT item_idx, count(*) AS n, count(*) FILTER (relevance > 0) AS p FROM {log} GROUP BY item_idx) USING (item_idx)"""


def price_scores() -> str:
    return f"SELECT item_idx, {r6('price * 0.6::DOUBLE')} AS score FROM items"


def item_score_lists(scores: str, log: str | None, k: int = K, users: str = "users") -> str:
    where = f"WHERE {unseen(log)}" if log else ""
    return top_k(f"SELECT u.user_idx, i.item_idx, i.score FROM {users} u, ({scores}) i {where}", k)


def random_lists(log: str, k: int = K) -> str:
    start = unit_hash("'42-user-' || user_idx::VARCHAR")
    return top_k(
        f"""
        SELECT u.user_idx, i.item_idx,
               {r6('1.0::DOUBLE - (((i.pos - 1 - u.start) % i.n + i.n) % i.n + 1) / (i.n + 1)::DOUBLE')} AS score
        FROM (SELECT user_idx, CAST(floor({start} * (SELECT count(*) FROM items)) AS BIGINT) AS start FROM users) u,
             (SELECT item_idx, row_number() OVER (ORDER BY md5('42-' || item_idx::VARCHAR), item_idx) AS pos,
                     count(*) OVER () AS n FROM items) i
        WHERE {unseen(log)}""",
        k,
    )


# ---------------------------------------------------------------- bigram parts


def bigram_parts(log: str, min_count: float = 1.0) -> dict[str, str]:
    return {
        "weighted": f"""
            SELECT *, CASE WHEN (SELECT max(__iter) FROM {log}) > 0
                           THEN 1.0 + __iter::DOUBLE / (SELECT max(__iter) FROM {log})::DOUBLE * 0.3::DOUBLE
                           ELSE 1.0::DOUBLE END AS w FROM {log}""",
        "pairs": f"""
            SELECT user_idx, item_idx AS context, lead(item_idx) OVER h AS target, lead(relevance) OVER h AS target_relevance,
                   lead(__iter) OVER h AS target_iter, lead(w) OVER h AS target_w
            FROM weighted WINDOW h AS (PARTITION BY user_idx ORDER BY {TIME_ORDER})""",
        "weights": """
            SELECT context, target, weight, sum(weight) OVER (PARTITION BY context) AS context_total,
                   max(boost) OVER (PARTITION BY context) AS context_boost
            FROM (SELECT context, target, sum(target_w * CASE WHEN is_high_value THEN 1.3::DOUBLE ELSE 1.0 END) AS weight,
                         max(target_w) AS boost
                  FROM pairs JOIN flagged ON target = item_idx WHERE target IS NOT NULL GROUP BY context, target)""",
        "pruned": f"""
            SELECT context, target, weight, context_boost, sum(weight) OVER (PARTITION BY context) AS context_total,
                   count(*) OVER (PARTITION BY context) AS context_size
            FROM weights WHERE {r6('context_total')} >= {min_count} AND {r6('weight')} >= {min_count}""",
        "probs": """
            SELECT context, target, (weight + 1.0::DOUBLE) / (context_total + 1.0::DOUBLE * context_size) AS prob, context_boost
            FROM pruned""",
    }


def bigram_lists(filter_seen: bool) -> str:
    """The staged bigram recommender on the early log."""
    tier = """CASE WHEN avg_price > p80 THEN 'premium_buyer' WHEN avg_price > p60 THEN 'high_buyer'
                   WHEN avg_price > 0.8::DOUBLE * mean_price THEN 'regular_buyer' ELSE 'budget_buyer' END"""
    match = "(1 - least(0.4::DOUBLE, abs(price - m) / (m + 8)))"
    chance = f"""greatest(0.05::DOUBLE, least(0.85::DOUBLE, prob * context_boost * 2.2::DOUBLE
        * least(1.8::DOUBLE, n_recent * 0.4::DOUBLE + 1)
        * CASE WHEN tier = 'premium_buyer' AND is_high_value THEN 1.8 + {match} * 0.7::DOUBLE
               WHEN tier = 'high_buyer' AND is_high_value THEN 1.6 + {match} * 0.6::DOUBLE
               WHEN tier = 'regular_buyer' THEN 1.4 + {match} * 0.5::DOUBLE
               WHEN tier = 'budget_buyer' AND price < m THEN 1.5 + {match} * 0.6::DOUBLE ELSE 1.0::DOUBLE END))"""
    potential = "price / mean_price * CASE WHEN is_high_value THEN 1.2::DOUBLE ELSE 1.0 END"
    taste = """least(0.75::DOUBLE, (0.15::DOUBLE + 0.25::DOUBLE * greatest(0.3::DOUBLE, 1 - abs(price - m) / (m + 5)))
        * CASE WHEN is_high_value THEN 1.8::DOUBLE ELSE 1.4 END) * price * 1.5::DOUBLE"""
    recent_filter = """AND NOT EXISTS (SELECT 1 FROM recent r WHERE r.user_idx = p.user_idx AND r.item_idx = i.item_idx)"""
    extra = {
        "early_profiles": PARTS["early_profiles"],
        **bigram_parts("early"),
        "people": f"""
            SELECT user_idx, coalesce(avg_price, 50.0::DOUBLE) AS m,
                   CASE WHEN avg_price IS NULL THEN 'regular_buyer' ELSE {tier} END AS tier
            FROM users LEFT JOIN early_profiles USING (user_idx), stats""",
        "recent": f"""
            SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY {NEWEST}) AS back FROM early
            QUALIFY back <= 20""",
        "contexts": """
            SELECT user_idx, count(*) AS n_recent, arg_min(item_idx, back) AS context FROM recent GROUP BY user_idx""",
        "s1": f"""
            SELECT user_idx, item_idx, {r6(f'{chance} * price * ({potential}) * 3.5::DOUBLE')} AS score
            FROM contexts JOIN people USING (user_idx) JOIN probs USING (context)
            JOIN flagged ON target = item_idx, stats""",
        "n1": "SELECT user_idx, count(*) AS n FROM s1 GROUP BY user_idx",
        "s2": f"""
            SELECT user_idx, item_idx, {r6('score')} AS score FROM (
              SELECT p.user_idx, i.item_idx, round(({taste}) + 1e-10::DOUBLE, 9) AS score, coalesce(n, 0) AS n
              FROM people p LEFT JOIN n1 ON n1.user_idx = p.user_idx, flagged i
              WHERE coalesce(n, 0) < {K}
                AND NOT EXISTS (SELECT 1 FROM s1 WHERE s1.user_idx = p.user_idx AND s1.item_idx = i.item_idx)
                {recent_filter if filter_seen else ''})
            QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) <= {K} - n""",
        "s12": "SELECT * FROM s1 UNION ALL SELECT * FROM s2",
        "n2": "SELECT user_idx, count(*) AS n FROM s12 GROUP BY user_idx",
        "s3": f"""
            SELECT user_idx, item_idx, score FROM (
              SELECT p.user_idx, i.item_idx, coalesce(n, 0) AS n,
                     {r6('price * CASE WHEN is_high_value THEN 1.1::DOUBLE ELSE 1.0 END * 0.2::DOUBLE')} AS score
              FROM people p LEFT JOIN n2 ON n2.user_idx = p.user_idx, flagged i
              WHERE coalesce(n, 0) < {K}
                AND NOT EXISTS (SELECT 1 FROM s12 WHERE s12.user_idx = p.user_idx AND s12.item_idx = i.item_idx))
            QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY item_idx) <= {K} - n""",
        "s123": "SELECT * FROM s12 UNION ALL SELECT * FROM s3",
    }
    if not filter_seen:
        return sql(BASE, top_k("SELECT * FROM s123"), **extra)
    extra["kept"] = "SELECT s.* FROM s123 s ANTI JOIN recent r ON r.user_idx = s.user_idx AND r.item_idx = s.item_idx"
    extra["n4"] = "SELECT user_idx, count(*) AS n FROM kept GROUP BY user_idx"
    extra["s4"] = f"""
        SELECT user_idx, item_idx, score FROM (
          SELECT p.user_idx, i.item_idx, coalesce(n, 0) AS n,
                 {r6('price * CASE WHEN is_high_value THEN 1.05::DOUBLE ELSE 1.0 END * 0.1::DOUBLE')} AS score
          FROM people p LEFT JOIN n4 ON n4.user_idx = p.user_idx, flagged i
          WHERE coalesce(n, 0) < {K}
            AND NOT EXISTS (SELECT 1 FROM kept WHERE kept.user_idx = p.user_idx AND kept.item_idx = i.item_idx)
            {recent_filter})
        QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY item_idx) <= {K} - n"""
    return sql(BASE, top_k("SELECT * FROM kept UNION ALL SELECT * FROM s4"), **extra)


# ---------------------------------------------------------------- graph model parts


def range_scaled() -> str:
    return """CASE WHEN hi > lo THEN (coalesce(popularity, 0.1::DOUBLE) - lo) / (hi - lo) ELSE 0.5::DOUBLE END"""


def cold_scores() -> str:
    base = f"""greatest(0.15::DOUBLE, least(0.6::DOUBLE, {range_scaled()} * 0.8::DOUBLE
        + greatest(0.3::DOUBLE, 1 - abs((i.price - mean_price) / greatest(std_price, 1.0)) * 0.2::DOUBLE) * 0.4::DOUBLE))"""
    lift = "CASE WHEN i.price BETWEEN 30 AND 80 THEN 1.4::DOUBLE WHEN i.price > 80 THEN 1.2 ELSE 1.3 END"
    score = f"greatest(0.08::DOUBLE, least(0.7::DOUBLE, {base} * {lift} * 1.2::DOUBLE * 1.8::DOUBLE)) * i.price"
    return f"""
        SELECT i.item_idx, i.price, {r6(score)} AS score
        FROM items i LEFT JOIN pops ON pops.item_idx = i.item_idx,
             (SELECT min(popularity) AS lo, max(popularity) AS hi FROM pops), stats
        WHERE i.item_idx IN (SELECT item_idx FROM early)"""


def fallback_scores() -> str:
    base = f"""greatest(0.2::DOUBLE, least(0.65::DOUBLE, {range_scaled()} * 0.7::DOUBLE
        + greatest(0.4::DOUBLE, 1 - abs((i.price - mean_price) / greatest(std_price, 1.0)) * 0.15::DOUBLE) * 0.5::DOUBLE))"""
    lift = "CASE WHEN i.price BETWEEN 35 AND 85 THEN 1.5::DOUBLE WHEN i.price > 85 THEN 1.3 ELSE 1.4 END"
    score = f"greatest(0.15::DOUBLE, least(0.75::DOUBLE, {base} * {lift} * 2.0::DOUBLE)) * i.price"
    return f"""
        SELECT i.item_idx, {r6(score)} AS score
        FROM items i LEFT JOIN pops ON pops.item_idx = i.item_idx,
             (SELECT min(popularity) AS lo, max(popularity) AS hi FROM pops), stats"""


def embedding_cold_scores() -> str:
    score = """(coalesce(popularity, 0) * 0.4::DOUBLE + least(1.0::DOUBLE, coalesce(value_score, 0)) * 0.1::DOUBLE)
        * CASE WHEN price BETWEEN 35 AND 75 THEN 1.3::DOUBLE WHEN price > 75 THEN 1.1 ELSE 1.2 END * 1.5::DOUBLE * price"""
    return f"SELECT item_idx, {r6(score)} AS score FROM items LEFT JOIN vals USING (item_idx)"


COLD = "(SELECT user_idx FROM users WHERE user_idx NOT IN (SELECT user_idx FROM early))"
WARM = "(SELECT user_idx FROM users WHERE user_idx IN (SELECT user_idx FROM early))"


def graph_lists() -> str:
    warm = item_score_lists(
        f"SELECT item_idx, {r6('0.9::DOUBLE * price')} AS score FROM items WHERE item_idx IN (SELECT item_idx FROM early)",
        "early",
        users=WARM,
    )
    cold = item_score_lists("SELECT item_idx, score FROM cold_scores", "early", users=COLD)
    return sql(BASE, f"SELECT * FROM ({warm}) UNION ALL SELECT * FROM ({cold})", pops=popularity("early"), cold_scores=cold_scores())


def knn(metric: str) -> str:
    a, b = "a.embedding[j]::DOUBLE", "b.embedding[j]::DOUBLE"
    each = "unnest(range(1, 65)) AS j"
    term = {"euclidean": f"sqrt(sum(({a} - {b}) * ({a} - {b})))", "manhattan": f"sum(abs({a} - {b}))"}.get(metric)
    if metric == "cosine":
        term = f"1 - sum({a} * {b}) / (sqrt(sum({a} * {a})) * sqrt(sum({b} * {b})))"
    return f"""
        SELECT query_id, point_id, label, neighbour, distance FROM (
          SELECT query_id, point_id, label, distance,
                 CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, point_id) AS INTEGER) AS neighbour
          FROM (SELECT a.vec_id AS query_id, b.vec_id AS point_id, any_value(b.label) AS label, round({term}, 6) AS distance
                FROM embeddings a, embeddings b, (SELECT {each}) WHERE a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id))
        WHERE neighbour <= {K}"""


def content_lists() -> str:
    categories = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    columns = [f"CASE WHEN category = '{c}' THEN 1.0::DOUBLE ELSE 0.0 END AS v{j}" for j, c in enumerate(categories)]
    for j, name in enumerate(("item_attr_0", "item_attr_1"), start=len(categories)):
        columns.append(f"({name} - avg({name}) OVER ()) / stddev_pop({name}) OVER () AS v{j}")
    size = len(columns)
    length = " + ".join(f"v{j} * v{j}" for j in range(size))
    dot = " + ".join(f"t.v{j} * i.v{j}" for j in range(size))
    cosine = f"round(CASE WHEN t.len * i.len > 0 THEN ({dot}) / (t.len * i.len) ELSE 0 END, 9)"
    means = ", ".join(f"avg(v{j}) AS v{j}" for j in range(size))
    return sql(
        BASE,
        top_k(f"SELECT user_idx, item_idx, {r6('c * price')} AS score FROM near WHERE c > 0"),
        things=f"SELECT *, sqrt({length}) AS len FROM (SELECT item_idx, price, {', '.join(columns)} FROM items)",
        liked="SELECT user_idx, things.* FROM early JOIN things USING (item_idx) WHERE relevance > 0",
        tastes=f"""SELECT *, sqrt({length}) AS len FROM (
            SELECT user_idx, {means} FROM liked GROUP BY user_idx
            UNION ALL
            SELECT u.user_idx, a.* FROM users u, (SELECT {means} FROM liked) a
            WHERE NOT EXISTS (SELECT 1 FROM liked l WHERE l.user_idx = u.user_idx))""",
        near=f"""SELECT t.user_idx, i.item_idx, i.price, {cosine} AS c FROM tastes t, things i
            WHERE NOT EXISTS (SELECT 1 FROM early l WHERE l.user_idx = t.user_idx AND l.item_idx = i.item_idx)""",
    )


# ---------------------------------------------------------------- evaluation parts


def ranked(lists: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM ({lists})"""


def metrics_of(lists: str, held_out: str) -> str:
    """Metrics per user of lists with a rank, against positive hold-out pairs."""
    whens = " ".join(f"WHEN {n} THEN " + " + ".join(f"1 / log2({p + 1})" for p in range(1, n + 1)) for n in range(1, K + 1))
    ideal = f"(CASE least(n_relevant, {K}) {whens} END)"
    return f"""
        SELECT user_idx, precision_at_k, CASE WHEN coalesce(n_relevant, 0) > 0 THEN dcg / {ideal} ELSE 0.0 END AS ndcg_at_k,
               mrr, hit_rate, revenue, discounted_revenue
        FROM (SELECT r.user_idx, sum(hit) / 5.0::DOUBLE AS precision_at_k, sum(hit / log2(rank + 1)) AS dcg,
                     coalesce(max(CASE WHEN hit = 1 THEN 1.0::DOUBLE / rank END), 0.0) AS mrr, max(hit)::DOUBLE AS hit_rate,
                     sum(hit * price) AS revenue, sum(hit * price * pow(0.85::DOUBLE, rank - 1)) AS discounted_revenue
              FROM (SELECT l.*, price, CASE WHEN EXISTS (SELECT 1 FROM {held_out} h
                      WHERE h.user_idx = l.user_idx AND h.item_idx = l.item_idx AND h.relevance > 0) THEN 1 ELSE 0 END AS hit
                    FROM {lists} l JOIN items USING (item_idx)) r GROUP BY r.user_idx) g
        LEFT JOIN (SELECT user_idx, count(DISTINCT item_idx) AS n_relevant FROM {held_out} WHERE relevance > 0
                   GROUP BY user_idx) USING (user_idx)"""


def totals_of(per_user: str, model: str, phase: str, iteration: int) -> str:
    rows = []
    for metric in METRICS:
        fold = "sum" if metric.endswith("revenue") else "avg"
        rows.append(
            f"SELECT '{model}' AS model, '{phase}' AS phase, {iteration} AS iteration, '{metric}' AS metric, "
            f"{fold}({metric}) AS value FROM {per_user}"
        )
    return " UNION ALL ".join(rows)


STEPS = [("train", 3), ("train", 4), ("test", 5), ("test", 6)]


def result_parts() -> dict[str, str]:
    """Results of three models, fitted once on the rows before iteration 3."""
    parts = {"past": "SELECT * FROM log WHERE __iter < 3"}
    lists = {
        "popularity": item_score_lists(popular_scores("past", True), "past"),
        "random": random_lists("past"),
        "price": item_score_lists(price_scores(), "past"),
    }
    selects = []
    for _, t in STEPS:
        parts[f"future_{t}"] = f"SELECT * FROM log WHERE __iter = {t}"
    for model, text in lists.items():
        parts[f"list_{model}"] = ranked(text)
        for phase, t in STEPS:
            parts[f"m_{model}_{t}"] = metrics_of(f"list_{model}", f"future_{t}")
            selects.append(totals_of(f"m_{model}_{t}", model, phase, t))
    parts["results"] = " UNION ALL ".join(selects)
    return parts


def iteration_results() -> str:
    """Popularity refitted before each iteration."""
    parts = {}
    selects = []
    for phase, t in STEPS:
        parts[f"past_{t}"] = f"SELECT * FROM log WHERE __iter < {t}"
        parts[f"future_{t}"] = f"SELECT * FROM log WHERE __iter = {t}"
        parts[f"list_{t}"] = ranked(item_score_lists(popular_scores(f"past_{t}", True), f"past_{t}"))
        parts[f"m_{t}"] = metrics_of(f"list_{t}", f"future_{t}")
        selects.append(totals_of(f"m_{t}", "popularity", phase, t))
    return sql(
        BASE,
        f"SELECT model, phase, iteration, metric, {r6('value')} AS value FROM ({' UNION ALL '.join(selects)})",
        **parts,
    )


def held_out_parts() -> dict[str, str]:
    return {
        "past": "SELECT * FROM log WHERE __iter <= 4",
        "future": "SELECT * FROM log WHERE __iter > 4",
        "lists": ranked(item_score_lists(popular_scores("past", True), "past")),
        "per_user": metrics_of("lists", "future"),
    }


def metric_pairs() -> str:
    names = [f"{p}_{m}" for p in ("test", "train") for m in sorted(METRICS) if not m.endswith("revenue")]
    wide = ", ".join(
        f"avg(value) FILTER (phase = '{n.split('_', 1)[0]}' AND metric = '{n.split('_', 1)[1]}') AS {n}" for n in names
    )
    pairs = [(names[j], names[i]) for i in range(len(names)) for j in range(i + 1, len(names))]
    selects = [f"SELECT '{a}' AS attr_a, '{b}' AS attr_b, {r6(f'corr({a}, {b})')} AS correlation FROM wide" for a, b in pairs]
    return sql(BASE, " UNION ALL ".join(selects), **result_parts(), wide=f"SELECT model, {wide} FROM results GROUP BY model")


# ---------------------------------------------------------------- all of them


def build() -> dict[str, str]:
    S = {}
    S["load_users"] = sql("users", "SELECT * FROM users")
    S["load_items"] = sql("items", "SELECT * FROM items")
    S["load_log"] = sql("log", "SELECT * FROM log")
    S["recommendations_schema"] = sql(
        BASE, "SELECT user_idx, item_idx, CAST(max(relevance * price) AS FLOAT) AS relevance FROM priced_log GROUP BY ALL"
    )
    S["category_distribution"] = S["write_and_read_results"] = sql(
        BASE, f"SELECT category, count(*) AS n, {r6('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS share_pct FROM items GROUP BY category"
    )
    S["segment_distribution"] = sql(
        BASE, f"SELECT segment, count(*) AS n, {r6('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS share_pct FROM users GROUP BY segment"
    )
    S["attr_columns"] = sql("users", "SELECT user_idx, user_attr_0, user_attr_1 FROM users")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    hot = ", ".join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in segments)
    S["one_hot"] = sql("users", f"SELECT user_idx, user_attr_0, user_attr_1, {hot} FROM users")
    S["positive_interactions"] = sql("log", "SELECT user_idx, item_idx, relevance, __iter FROM log WHERE relevance > 0")
    S["expected_revenue"] = sql(
        BASE,
        f"""SELECT item_idx, any_value(price) AS price, {r6('avg(relevance)')} AS prob,
                   {r6('avg(relevance) * any_value(price)')} AS expected_revenue FROM priced_log GROUP BY item_idx""",
    )
    S["clean_price"] = """
        SELECT p_partkey AS item_idx, coalesce(TRY_CAST(p_size::VARCHAR AS DOUBLE), 50.0::DOUBLE) AS from_number,
               coalesce(TRY_CAST(p_brand AS DOUBLE), 50.0::DOUBLE) AS from_text,
               CASE WHEN p_type = 'PROMO' THEN 50.0::DOUBLE ELSE p_size::DOUBLE END AS from_nan FROM part"""
    S["clamp"] = sql("items", "SELECT item_idx, greatest(20.0::DOUBLE, least(80.0::DOUBLE, price)) AS price_clamped FROM items")
    S["price_match"] = sql(
        BASE + " full_profiles",
        f"""SELECT l_orderkey, l_linenumber, user_idx, item_idx,
                   {r6('greatest(0.6::DOUBLE, 1 - abs(price - avg_price) / (avg_price + 8))')} AS price_match
            FROM priced_log JOIN full_profiles USING (user_idx)""",
    )
    S["revenue_potential"] = sql(
        BASE,
        f"SELECT item_idx, {r6('price / mean_price * CASE WHEN is_high_value THEN 1.2::DOUBLE ELSE 1.0 END')} AS potential FROM flagged, stats",
    )
    S["revenue_target"] = sql(
        BASE,
        f"SELECT user_idx, item_idx, {r6('greatest(0.01::DOUBLE, least(1.0::DOUBLE, (relevance + 1) / 2)) * price')} AS target FROM priced_log",
    )
    S["stable_id"] = """
        SELECT c_custkey, c_custkey AS id_from_number, ('0x' || substr(md5(c_name), 1, 8))::BIGINT % 2147483648 AS id_from_text
        FROM customer"""
    S["metric_label"] = """
        SELECT event_type || '_share_at_k' AS metric, count(*) AS n,
               upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' Share At K' AS label FROM events GROUP BY event_type"""
    S["hash_split"] = sql(
        "log",
        """SELECT user_idx, item_idx, ('0x' || substr(md5(user_idx::VARCHAR || '-' || item_idx::VARCHAR), 1, 8))::BIGINT % 100 < 20
                  AS is_validation FROM log""",
    )
    S["training_frame"] = sql(
        "users items log",
        "SELECT user_idx, item_idx, relevance, users.* EXCLUDE (user_idx), items.* EXCLUDE (item_idx) FROM log JOIN users USING (user_idx) JOIN items USING (item_idx)",
    )
    S["training_features"] = sql(
        "users items log",
        "SELECT relevance, users.* EXCLUDE (user_idx), items.* EXCLUDE (item_idx) FROM log JOIN users USING (user_idx) JOIN items USING (item_idx)",
    )
    S["candidate_cross"] = sql(
        BASE,
        f"""SELECT u.user_idx, count(*) AS n_pairs, count(*) FILTER (s.item_idx IS NULL) AS n_candidates,
                   {r6('sum(CASE WHEN s.item_idx IS NULL THEN price ELSE 0 END)')} AS candidate_price_sum
            FROM users u CROSS JOIN items i
            LEFT JOIN (SELECT DISTINCT user_idx, item_idx FROM early) s ON s.user_idx = u.user_idx AND s.item_idx = i.item_idx
            GROUP BY u.user_idx""",
    )
    S["candidates"] = sql(
        BASE,
        f"""SELECT user_idx, item_idx, score AS price FROM ({item_score_lists('SELECT item_idx, price AS score FROM items', 'early', 4 * K)})""",
    )
    S["user_history"] = sql(BASE, "SELECT user_idx, item_idx, price FROM priced_log")
    S["interaction_context"] = sql(
        BASE, "SELECT user_idx, item_idx, relevance, segment, category FROM log JOIN users USING (user_idx) JOIN items USING (item_idx)"
    )
    S["lookup_default"] = sql(BASE, "SELECT user_idx, item_idx, CASE WHEN price >= 20 THEN price ELSE 50.0 END AS price FROM priced_log")
    S["filter_seen"] = sql(
        BASE,
        """SELECT DISTINCT user_idx, item_idx FROM log WHERE __iter > 4
           EXCEPT SELECT user_idx, item_idx FROM log WHERE __iter <= 4""",
    )
    S["split_cold_users"] = sql(BASE, "SELECT user_idx, user_idx NOT IN (SELECT user_idx FROM early) AS is_cold FROM users")
    S["table_counts"] = sql(
        BASE,
        """SELECT 'users' AS table_name, count(*) AS n_rows FROM users UNION ALL SELECT 'items', count(*) FROM items
           UNION ALL SELECT 'log', count(*) FROM log""",
    )
    S["interaction_density"] = sql(
        BASE,
        f"""SELECT n_interactions, n_users, n_items, {r6('n_interactions::DOUBLE / (n_users::DOUBLE * n_items) * 100')} AS density_pct
            FROM (SELECT (SELECT count(*) FROM log) AS n_interactions, (SELECT count(*) FROM users) AS n_users,
                         (SELECT count(*) FROM items) AS n_items)""",
    )
    S["coverage"] = sql(
        BASE,
        f"""SELECT side, n_active, n_total, {r6('n_active::DOUBLE / n_total * 100')} AS share_pct FROM (
            SELECT 'users' AS side, (SELECT count(DISTINCT user_idx) FROM early) AS n_active, (SELECT count(*) FROM users) AS n_total
            UNION ALL SELECT 'items', (SELECT count(DISTINCT item_idx) FROM early), (SELECT count(*) FROM items))""",
    )
    S["relevance_distribution"] = sql("log", "SELECT relevance, count(*) AS n FROM log GROUP BY relevance")
    S["interactions_per_user"] = sql("log", "SELECT user_idx, count(*) AS n_interactions FROM log GROUP BY user_idx")
    S["interactions_per_item"] = sql("log", "SELECT item_idx, count(*) AS n_interactions FROM log GROUP BY item_idx")
    for key in ("user", "item"):
        S[f"interactions_per_{key}_histogram"] = sql(
            "log", histogram("counted", "n", 20), counted=f"SELECT {key}_idx, count(*)::DOUBLE AS n FROM log GROUP BY {key}_idx"
        )
    categories = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    counts = ", ".join(f"count(*) FILTER (category = '{c}') AS {c}" for c in categories)
    S["segment_category_pivot"] = sql(
        BASE, f"SELECT segment, {counts} FROM log JOIN users USING (user_idx) JOIN items USING (item_idx) GROUP BY segment"
    )
    S["attr_correlation"] = sql(
        BASE,
        f"""SELECT 'user_attr_1' AS attr_a, 'user_attr_0' AS attr_b, {r6('corr(user_attr_1, user_attr_0)')} AS correlation FROM users
            UNION ALL SELECT 'item_attr_1', 'item_attr_0', {r6('corr(item_attr_1, item_attr_0)')} FROM items""",
    )
    S["attr_histogram"] = sql(
        BASE, " UNION ALL ".join(histogram("users", f"user_attr_{j}", 20, "segment", f"user_attr_{j}") for j in (0, 1))
    )
    S["item_attr_histogram"] = sql(
        BASE, " UNION ALL ".join(histogram("items", f"item_attr_{j}", 20, "category", f"item_attr_{j}") for j in (0, 1))
    )
    S["price_histogram"] = sql(BASE, histogram("items", "price", 30))
    S["price_by_category_histogram"] = sql(BASE, histogram("items", "price", 20, "category"))
    S["price_percentiles"] = sql(
        BASE, "SELECT " + ", ".join(f"{r6(c)} AS {c}" for c in ("p60", "p75", "p80", "mean_price", "std_price")) + " FROM stats"
    )
    S["high_value_items"] = sql(BASE, "SELECT item_idx, price, is_high_value FROM flagged")
    S["item_popularity"] = sql(
        BASE,
        f"SELECT * REPLACE ({r6('relevance_mean')} AS relevance_mean, {r6('popularity')} AS popularity) FROM pops",
        pops=popularity("log"),
    )
    S["item_value_score"] = sql(
        BASE,
        f"SELECT * REPLACE ({r6('popularity')} AS popularity, {r6('value_score')} AS value_score) FROM vals",
        vals=value_scores("log"),
    )
    tiers = "CASE WHEN avg_price > p80 THEN '{}' WHEN avg_price > p60 THEN '{}' WHEN avg_price > 0.8::DOUBLE * mean_price THEN '{}' ELSE '{}' END"
    S["user_spending_profile"] = sql(
        BASE + " early_profiles",
        f"""SELECT user_idx, {r6('avg_price')} AS avg_price, {r6('price_std')} AS price_std,
                   {tiers.format('premium_buyer', 'high_buyer', 'regular_buyer', 'budget_buyer')} AS tier FROM early_profiles, stats""",
    )
    S["user_price_profile"] = sql(
        BASE + " early_profiles",
        f"""SELECT user_idx, {r6('avg_price')} AS mean_price, {r6('CASE WHEN n > 1 THEN price_std ELSE 15.0 END')} AS std_price,
                   early_profiles.min_price, early_profiles.max_price, n AS interaction_count,
                   {r6('early_profiles.max_price - early_profiles.min_price')} AS price_range,
                   {tiers.format('premium', 'high', 'medium', 'low')} AS tier FROM early_profiles, stats""",
    )
    S["user_price_profile_simple"] = sql(
        BASE + " early_profiles",
        f"""SELECT user_idx, {r6('avg_price')} AS mean_price,
                   CASE WHEN avg_price > 75 THEN 'high' WHEN avg_price > 40 THEN 'medium' ELSE 'low' END AS tier FROM early_profiles""",
    )
    activity = f"""
        SELECT user_idx, avg_price, percentile, CASE WHEN percentile > 75 THEN 'premium' WHEN percentile > 50 THEN 'regular'
               ELSE 'budget' END AS tier, least(3.0::DOUBLE, n_rows / 5.0::DOUBLE) AS activity
        FROM (SELECT user_idx, avg_price, (SELECT count(*) FROM items WHERE price <= round(avg_price, 9))::DOUBLE
                     / (SELECT count(*) FROM items) * 100 AS percentile FROM {{profiles}})
        JOIN (SELECT user_idx, count(*) AS n_rows FROM {{log}} GROUP BY user_idx) USING (user_idx)"""
    S["user_activity_profile"] = sql(
        BASE + " early_profiles",
        f"SELECT user_idx, {r6('avg_price')} AS avg_price, {r6('percentile')} AS percentile, tier, {r6('activity')} AS activity FROM act",
        act=activity.format(profiles="early_profiles", log="early"),
    )
    S["dense_index"] = sql(
        BASE, "SELECT user_idx, row_number() OVER (ORDER BY user_idx) - 1 AS idx FROM (SELECT DISTINCT user_idx FROM early)"
    )
    vocabulary = "SELECT item_idx, row_number() OVER (ORDER BY item_idx) AS item_id FROM (SELECT DISTINCT item_idx FROM early)"
    S["item_vocabulary"] = sql(
        BASE, "SELECT item_idx, coalesce(item_id, 0) AS item_id FROM items LEFT JOIN vocab USING (item_idx)", vocab=vocabulary
    )
    S["top_k_per_user"] = sql(
        BASE,
        f"""SELECT * FROM (SELECT user_idx, item_idx, score,
              CAST(row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS INTEGER) AS rank
            FROM (SELECT DISTINCT user_idx, item_idx, price AS score FROM priced_log)) WHERE rank <= {K}""",
    )
    recent = f"""
        SELECT user_idx, item_idx, relevance, CAST(least(n, {{n}}) - back + 1 AS INTEGER) AS pos FROM (
          SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY {NEWEST}) AS back,
                 count(*) OVER (PARTITION BY user_idx) AS n FROM {{log}}) WHERE back <= {{n}}"""
    S["recent_history"] = sql(BASE, f"SELECT user_idx, pos, item_idx, relevance FROM ({recent.format(n=20, log='log')})")
    S["padded_sequences"] = sql(
        BASE,
        """SELECT u.user_idx, CAST(p AS INTEGER) AS pos, coalesce(item_id, 0) AS item_id, coalesce(price, 0.0) AS price,
                  f.user_idx IS NOT NULL AS mask
           FROM (SELECT user_idx, 100 - max(pos) AS gap FROM filled GROUP BY user_idx) u CROSS JOIN (SELECT unnest(range(100)) AS p)
           LEFT JOIN filled f ON f.user_idx = u.user_idx AND f.pos = p - gap + 1""",
        vocab=vocabulary,
        filled=f"""SELECT user_idx, pos, coalesce(item_id, 0) AS item_id, price
                   FROM ({recent.format(n=100, log='log')}) LEFT JOIN vocab USING (item_idx) LEFT JOIN items USING (item_idx)""",
    )
    parts = bigram_parts("log")
    S["bigrams"] = sql(
        BASE,
        "SELECT user_idx, context, target, target_relevance AS relevance, target_iter AS __iter FROM pairs WHERE target IS NOT NULL",
        **parts,
    )
    S["ngrams"] = sql(
        BASE,
        f"""SELECT * FROM (SELECT user_idx, lag(item_idx, 2) OVER h AS first, lag(item_idx) OVER h AS second, item_idx AS target
            FROM log WINDOW h AS (PARTITION BY user_idx ORDER BY {TIME_ORDER})) WHERE first IS NOT NULL""",
    )
    S["next_item_pairs"] = sql(
        BASE,
        f"""SELECT * FROM (SELECT user_idx, pos, item_idx AS input_item,
              lead(item_idx) OVER (PARTITION BY user_idx ORDER BY pos) AS target_item
            FROM ({recent.format(n=100, log='log')})) WHERE target_item IS NOT NULL""",
    )
    S["temporal_weight"] = sql(BASE, f"SELECT user_idx, item_idx, __iter, {r6('w')} AS time_weight FROM weighted", **parts)
    S["minmax_per_user"] = sql(
        BASE,
        f"""SELECT user_idx, item_idx, price, {r6('CASE WHEN hi > lo THEN (price - lo) / (hi - lo) ELSE 0.5 END')} AS norm FROM (
            SELECT *, min(price) OVER (PARTITION BY user_idx) AS lo, max(price) OVER (PARTITION BY user_idx) AS hi
            FROM (SELECT DISTINCT user_idx, item_idx, price FROM priced_log))""",
    )
    S["softmax_per_user"] = sql(
        BASE,
        f"""SELECT user_idx, item_idx, logit, {r6('exp(logit) / sum(exp(logit)) OVER (PARTITION BY user_idx)')} AS prob
            FROM (SELECT DISTINCT user_idx, item_idx, price / 10 AS logit FROM priced_log)""",
    )
    S["standardize"] = sql(BASE, f"SELECT item_idx, {r6('(price - mean_price) / std_price')} AS price_z FROM items, stats")
    S["global_top_k_for_all"] = sql(BASE, item_score_lists(popular_scores("early", True), None))
    for name in ("weights", "pruned"):
        S[f"bigram_{name}"] = sql(
            BASE,
            f"""SELECT * REPLACE ({r6('weight')} AS weight, {r6('context_total')} AS context_total,
                                  {r6('context_boost')} AS context_boost) FROM {name}""",
            **bigram_parts("log", 2.0),
        )
    S["bigram_probs"] = sql(BASE, f"SELECT context, target, {r6('prob')} AS prob FROM probs", **parts)
    S["staged_fill"] = sql(
        BASE,
        f"""SELECT user_idx, item_idx, score, CAST(stage AS INTEGER) AS stage FROM (
            SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY stage, score DESC, item_idx) AS place FROM (
              SELECT *, 1 AS stage FROM follow UNION ALL
              SELECT p.*, 2 FROM popular p ANTI JOIN first_k f ON f.user_idx = p.user_idx AND f.item_idx = p.item_idx))
            WHERE place <= {K}""",
        **bigram_parts("early"),
        last=recent.format(n=1, log="early"),
        follow="""SELECT user_idx, target AS item_idx, count(*)::DOUBLE AS score
                  FROM (SELECT user_idx, item_idx AS context FROM last) JOIN (SELECT context, target FROM pairs WHERE target IS NOT NULL)
                  USING (context) GROUP BY user_idx, target""",
        first_k=top_k("SELECT * FROM follow"),
        popular=item_score_lists(price_scores(), "early", 2 * K),
    )
    S["model_statistics"] = sql(
        BASE + " early_profiles",
        """SELECT count(DISTINCT context) AS n_contexts, count(*) AS n_bigrams, count(DISTINCT target) AS n_targets,
                  (SELECT count(*) FROM flagged WHERE is_high_value) AS n_high_value_items,
                  (SELECT count(*) FROM early_profiles) AS n_profiles FROM probs""",
        **bigram_parts("early"),
    )
    S["interaction_cells_plain"] = sql(
        BASE, f"SELECT user_idx, item_idx, {r6('sum(greatest(0.1::DOUBLE, relevance))')} AS weight FROM log GROUP BY ALL"
    )
    S["interaction_cells_price"] = sql(BASE + " cells", f"SELECT user_idx, item_idx, {r6('weight')} AS weight FROM cells")
    S["interaction_cells_value"] = sql(
        BASE,
        f"""SELECT user_idx, item_idx, {r6('sum(greatest(0.1::DOUBLE, relevance) * (1 + value_score * 0.1::DOUBLE))')} AS weight
            FROM log JOIN vals USING (item_idx) GROUP BY ALL""",
        vals=value_scores("log"),
    )
    S["matrix_sparsity"] = sql(
        BASE,
        f"""SELECT *, {r6('1 - n_rows::DOUBLE / (n_users::DOUBLE * n_items)')} AS sparsity_rows,
                   {r6('1 - n_cells::DOUBLE / (n_users::DOUBLE * n_items)')} AS sparsity_cells
            FROM (SELECT count(*) AS n_rows, count(DISTINCT user_idx) AS n_users, count(DISTINCT item_idx) AS n_items,
                         (SELECT count(*) FROM (SELECT DISTINCT user_idx, item_idx FROM log)) AS n_cells FROM log)""",
    )
    S["item_cosine"] = sql(BASE + " cells item_norms item_sims", f"SELECT a, b, {r6('sim')} AS sim FROM item_sims WHERE a <= b")
    S["user_cosine"] = sql(BASE + " cells user_norms user_sims", f"SELECT a, b, {r6('sim')} AS sim FROM user_sims WHERE a <= b")
    for side in ("item", "user"):
        S[f"{side}_cosine_join"] = sql(
            BASE + f" cells {side}_norms {side}_sims", f"SELECT * FROM (SELECT a, b, {r6('sim')} AS sim FROM {side}_sims WHERE a < b) WHERE sim >= 0.1::DOUBLE"
        )
    S["propagate"] = sql(
        BASE + " cells user_norms user_sims",
        "SELECT a AS user_idx, " + ", ".join(f"{r6(f'sum(sim * {factor(chr(98), j)})')} AS f{j}" for j in range(4))
        + " FROM user_sims GROUP BY a",
    )
    smooth = ", ".join(
        f"{r6(f'0.75::DOUBLE * any_value({factor(chr(97), j)}) + 0.25::DOUBLE * sum(sim * {factor(chr(98), j)})')} AS f{j}"
        for j in range(4)
    )
    S["graph_smooth"] = sql(BASE + " cells item_norms item_sims", f"SELECT a AS item_idx, {smooth} FROM item_sims GROUP BY a")
    dot = " + ".join(f"{factor('user_idx', j)} * {factor('item_idx', j)}" for j in range(4))
    S["graph_scores"] = sql(
        BASE + " cells item_norms item_sims",
        f"""SELECT user_idx, item_idx, {r6('d')} AS dot, {r6('near')} AS affinity,
                   {r6('0.7::DOUBLE * d + 0.3::DOUBLE * near')} AS score
            FROM (SELECT user_idx, item_idx, {dot} AS d, near FROM (
              SELECT t.user_idx, t.item_idx, sum(sim * o.weight) AS near FROM cells t JOIN cells o USING (user_idx)
              JOIN item_sims ON a = t.item_idx AND b = o.item_idx GROUP BY t.user_idx, t.item_idx))""",
    )
    S["embedding_dot"] = f"""
        SELECT vec_id, label, {r6('sum(e.embedding[j]::DOUBLE * c)')} AS dot
        FROM embeddings e JOIN (SELECT label, j, avg(embedding[j]::DOUBLE) AS c FROM embeddings, (SELECT unnest(range(1, 17)) AS j)
                                GROUP BY label, j) USING (label) GROUP BY vec_id, label"""
    users32, items32 = ([factor(key, j) for j in range(32)] for key in ("user_idx", "item_idx"))
    features = [*users32, *items32, "coalesce(avg_price, 50.0)", "coalesce(activity, 1.0)", "price", "popularity", "value_score"]
    features.append(" + ".join(f"{users32[j]} * {items32[j]}" for j in range(16)))
    S["pair_features"] = sql(
        BASE + " full_profiles",
        "SELECT user_idx, item_idx, " + ", ".join(f"{r6(f)} AS f{j}" for j, f in enumerate(features))
        + """ FROM (SELECT DISTINCT user_idx, item_idx FROM log) LEFT JOIN act USING (user_idx) JOIN items USING (item_idx)
              JOIN vals USING (item_idx)""",
        vals=value_scores("log"),
        act=activity.format(profiles="full_profiles", log="log"),
    )
    for metric in ("euclidean", "manhattan", "cosine"):
        S[f"knn_{metric}"] = knn(metric)
    S["neighbour_share"] = f"SELECT query_id, {r6('avg(CASE WHEN label >= 5 THEN 1.0::DOUBLE ELSE 0.0 END)')} AS prob FROM ({knn('euclidean')}) GROUP BY query_id"
    S["random_recommend"] = sql(BASE, random_lists("early"))
    S["popularity_recommend"] = sql(BASE, item_score_lists(popular_scores("early", False), "early"))
    S["popularity_revenue_recommend"] = sql(BASE, item_score_lists(popular_scores("log", True), "log"))
    S["price_fallback"] = sql(BASE, item_score_lists(price_scores(), None))
    S["content_based_recommend"] = content_lists()
    S["bigram_recommend"] = bigram_lists(True)
    S["bigram_recommend_whole_log"] = bigram_lists(True)
    S["bigram_recommend_with_seen"] = bigram_lists(False)
    S["graph_recommend"] = graph_lists()
    S["graph_cold_start"] = sql(BASE, cold_scores(), pops=popularity("early"))
    S["graph_fallback"] = sql(BASE, item_score_lists(fallback_scores(), None), pops=popularity("early"))
    S["embedding_cold_start"] = sql(
        BASE, item_score_lists(embedding_cold_scores(), "early", users=COLD), vals=value_scores("early")
    )
    S["score_sequences_mean_price"] = sql(
        BASE,
        f"SELECT user_idx, {r6('avg(price)')} AS score FROM ({recent.format(n=100, log='log')}) JOIN items USING (item_idx) GROUP BY user_idx",
    )
    S["discounted_gain"] = sql(
        BASE,
        f"""SELECT {r6('coalesce(avg(gain), 0)')} AS discounted_gain FROM (
            SELECT user_idx, sum(CASE WHEN EXISTS (SELECT 1 FROM future f WHERE f.user_idx = lists.user_idx
                     AND f.item_idx = lists.item_idx AND f.relevance > 0) THEN pow(0.85::DOUBLE, rank - 1) ELSE 0 END) AS gain
            FROM lists GROUP BY user_idx)""",
        **held_out_parts(),
    )
    for metric in METRICS:
        S[metric] = sql(BASE, f"SELECT user_idx, {r6(metric)} AS {metric} FROM per_user", **held_out_parts())
    S["temporal_split"] = sql(
        BASE,
        """SELECT CASE WHEN __iter < 5 THEN 'train' ELSE 'test' END AS phase, __iter, count(*) AS n, sum(relevance) AS n_positive
           FROM log GROUP BY ALL""",
    )
    S["evaluate_by_iteration"] = iteration_results()
    S["compare_models"] = sql(
        BASE, f"SELECT model, phase, iteration, metric, {r6('value')} AS value FROM results", **result_parts()
    )
    S["model_summary"] = sql(
        BASE,
        f"""SELECT model, metric, {r6('train_mean')} AS train_mean, {r6('test_mean')} AS test_mean,
                   {r6('train_total')} AS train_total, {r6('test_total')} AS test_total,
                   {r6('(test_mean / nullif(train_mean, 0) - 1) * 100')} AS change_pct
            FROM (SELECT model, metric, avg(value) FILTER (phase = 'train') AS train_mean,
                         avg(value) FILTER (phase = 'test') AS test_mean, sum(value) FILTER (phase = 'train') AS train_total,
                         sum(value) FILTER (phase = 'test') AS test_total FROM results GROUP BY model, metric)""",
        **result_parts(),
    )
    S["model_leaderboard"] = sql(
        BASE,
        f"""SELECT model, {r6('a')} AS train_total_revenue, {r6('b')} AS test_total_revenue,
                   row_number() OVER (ORDER BY b DESC, model DESC) = 1 AS is_best
            FROM (SELECT model, sum(value) FILTER (phase = 'train') AS a, sum(value) FILTER (phase = 'test') AS b
                  FROM results WHERE metric = 'revenue' GROUP BY model)""",
        **result_parts(),
    )
    S["metric_trajectory"] = sql(
        BASE, f"SELECT model, metric, phase, iteration - 3 AS step, {r6('value')} AS value FROM results", **result_parts()
    )
    S["metric_correlation"] = metric_pairs()
    for name in WHOLE_LOG:
        S[name] = S[name].replace(PARTS["early"], "SELECT * FROM log")
    return S


ORACLES = build()
