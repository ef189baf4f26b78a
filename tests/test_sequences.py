import pytest
from pyspark.sql import functions as F

from revrank.operators import sequences as S
from revrank.operators.features import item_vocabulary


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("n", [2, 3, 4])
def test_long_histories_give_the_same_ngrams(shop, n):
    _, _, log = shop
    plain = S.ngrams(log, n)
    blocked = S.ngrams(log, n, hot_rows=3, block=4)
    assert plain.count() > 0
    columns = ["user_idx", "context", "target", "relevance"]
    as_text = lambda df: rows(df.withColumn("context", F.concat_ws(",", F.col("context").cast("array<string>"))), *columns)
    assert as_text(plain) == as_text(blocked)


def test_padding_and_mask(spark, shop):
    _, items, log = shop
    padded = S.padded_sequences(log, items, item_vocabulary(log), 6)
    lengths = {r["user_idx"]: r["n"] for r in log.groupBy("user_idx").agg(F.count("*").alias("n")).collect()}
    for row in padded.collect():
        kept = min(6, lengths[row["user_idx"]])
        assert row["mask"] == [False] * (6 - kept) + [True] * kept
        assert all(v == 0 for v in row["item_ids"][: 6 - kept]) and all(v > 0 for v in row["item_ids"][6 - kept :])


def test_time_weight_branches(spark):
    make = lambda rows_: spark.createDataFrame(rows_, "user_idx long, item_idx long, __iter int")
    assert rows(S.with_temporal_weight(make([(1, 1, 0), (1, 2, 0)])), "time_weight") == [(1.0,), (1.0,)]
    assert rows(S.with_temporal_weight(make([(1, 1, 0), (1, 2, 2)])), "time_weight") == [(1.0,), (1.3,)]
    plain = S.with_temporal_weight(make([(1, 1, 0)]).drop("__iter"))
    assert rows(plain, "time_weight") == [(1.0,)]


def test_bigram_pruning_and_probabilities(spark):
    items = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, 90.0)], "item_idx long, price double")
    log = spark.createDataFrame(
        [(1, 1, 1.0, 0), (1, 2, 1.0, 1), (2, 1, 0.0, 0), (2, 2, 1.0, 1), (3, 1, 1.0, 0), (3, 3, 1.0, 1), (4, 4, 1.0, 0)],
        "user_idx long, item_idx long, relevance double, __iter int",
    )
    weights = S.bigram_weights(log, items)
    found = {(r["context"], r["target"]): (round(r["weight"], 9), round(r["context_total"], 9)) for r in weights.collect()}
    assert found == {(1, 2): (2.6, 3.9), (1, 3): (1.3, 3.9)}
    kept = S.bigram_pruned(weights, 2.0)
    assert rows(kept.withColumn("t", F.round("context_total", 9)), "context", "target", "t") == [(1, 2, 2.6)]
    probs = S.bigram_probs(S.bigram_pruned(weights, 1.0), 1.0)
    assert {r["target"]: round(r["prob"], 9) for r in probs.collect()} == {2: round(3.6 / 5.9, 9), 3: round(2.3 / 5.9, 9)}


def test_staged_fill_takes_stages_in_order(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_idx long")
    scored = "user_idx long, item_idx long, score double"
    first = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0), (2, 1, 1.0)], scored)
    second = spark.createDataFrame([(u, i, 10.0 - i) for u in (1, 2, 3) for i in range(1, 5)], scored)
    filled = S.staged_fill([first, second], users, 2)
    assert rows(filled, "user_idx", "item_idx", "stage") == [(1, 2, 1), (1, 3, 1), (2, 1, 1), (2, 2, 2), (3, 1, 2), (3, 2, 2)]
