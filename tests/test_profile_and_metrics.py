import math

import pytest
from pyspark.sql import functions as F

from revrank.functions import expressions as E
from revrank.operators import evaluate as V, features as X, profile as P
from revrank.sources.adapters import attr_columns
from revrank.sources.sinks import RECOMMENDATION_SCHEMA, empty_recommendations, to_recommendations
from revrank.recommenders.simple import PopularityRecommender


def test_price_cleaning(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,), ("NaN",)], "p string")
    plain = [r[0] for r in df.select(E.clean_price("p")).collect()]
    assert plain[:3] == [12.5, 50.0, 50.0] and math.isnan(plain[3])
    assert [r[0] for r in df.select(E.clean_price("p", nan_too=True)).collect()] == [12.5, 50.0, 50.0, 50.0]


def test_tiers_and_single_row_deviation(spark):
    items = spark.createDataFrame([(i, float(10 * i)) for i in range(1, 11)], "item_idx long, price double")
    log = spark.createDataFrame(
        [(1, 10, 1.0), (2, 7, 1.0), (3, 5, 1.0), (4, 1, 1.0), (4, 3, 1.0), (5, 9, 0.0), (6, 99, 1.0)],
        "user_idx long, item_idx long, relevance double",
    )
    spending = {r["user_idx"]: r["tier"] for r in P.user_spending_profile(log, items).collect()}
    assert spending == {1: "premium_buyer", 2: "high_buyer", 3: "regular_buyer", 4: "budget_buyer", 6: "regular_buyer"}
    graph = {r["user_idx"]: (r["std_price"], r["interaction_count"]) for r in P.user_price_profile(log, items).collect()}
    assert graph[1] == (15.0, 1) and graph[4] == (10.0, 2)
    simple = {r["user_idx"]: r["tier"] for r in P.user_price_profile_simple(log, items).collect()}
    assert simple == {1: "high", 2: "medium", 3: "medium", 4: "low", 6: "medium"}
    activity = {r["user_idx"]: (r["percentile"], r["tier"], r["activity"]) for r in P.user_activity_profile(log, items).collect()}
    assert activity[1] == (100.0, "premium", 0.2) and activity[4] == (20.0, "budget", 0.4) and 5 not in activity


def test_histogram_edges(spark):
    flat = P.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == [0, 0, 4, 0] and flat[0]["bin_lo"] == 2.5
    spread = P.histogram(spark.createDataFrame([(float(v),) for v in range(11)], "v double"), "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in spread] == [2, 2, 2, 2, 3]


def test_columns_and_vocabulary(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "segment string, user_attr_0 double, user_attr_1 double")
    assert attr_columns(df, "user_attr_", 1) == ["user_attr_0"]
    unseen = spark.createDataFrame([("c", 1.0, 2.0)], df.schema)
    assert X.one_hot(unseen, "segment", ["a", "b"]).collect()[0].asDict() == {
        "user_attr_0": 1.0, "user_attr_1": 2.0, "segment_a": 0, "segment_b": 0
    }
    with pytest.raises(ValueError, match="more than 1 values"):
        P.learn_vocabulary(df, "segment", limit=1)
    with pytest.raises(ValueError, match="relevance"):
        PopularityRecommender().fit(df, df, df)


def test_standardize_uses_population_deviation_and_fit_rows(spark):
    fit = spark.createDataFrame([(1.0,), (3.0,)], "price double")
    new = spark.createDataFrame([(5.0,)], "price double")
    assert X.standardize(new, "price", fit).head()["price_z"] == 3.0
    assert X.standardize(new, "price").head()["price_z"] == 0.0


def test_output_schema(spark):
    scored = spark.createDataFrame([(1, 2, 0.5)], "user_idx int, item_idx int, score double")
    assert [f.dataType for f in to_recommendations(scored).schema] == [f.dataType for f in RECOMMENDATION_SCHEMA]
    assert empty_recommendations(spark).count() == 0 and empty_recommendations(spark).schema == RECOMMENDATION_SCHEMA


def test_discounted_gain(spark):
    schema = "user_idx long, item_idx long, relevance double, rank int"
    rows = spark.createDataFrame([(1, 1, 1.0, 1), (1, 2, 1.0, 3), (2, 5, 0.0, 1), (1, 3, 1.0, 9)], schema)
    assert abs(V.discounted_gain(rows, 2).head()[0] - (1 + 0.85) / 2) < 1e-12
    assert V.discounted_gain(spark.createDataFrame([], schema)).head()[0] == 0.0


def test_metrics_by_hand(spark):
    recs = spark.createDataFrame(
        [(1, 10, 3.0), (1, 11, 2.0), (1, 12, 1.0), (2, 10, 1.0)], "user_idx long, item_idx long, score double"
    )
    truth = spark.createDataFrame([(1, 11, 1.0), (1, 12, 1.0), (1, 99, 1.0), (2, 10, 0.0)], "user_idx long, item_idx long, relevance double")
    items = spark.createDataFrame([(10, 5.0), (11, 7.0), (12, 9.0)], "item_idx long, price double")
    rows = {r["user_idx"]: r for r in V.metrics_per_user(V.with_rank(recs), truth, items, 3).collect()}
    one = rows[1]
    assert one["precision_at_k"] == pytest.approx(2 / 3) and one["mrr"] == 0.5 and one["hit_rate"] == 1.0
    assert one["revenue"] == 16.0 and one["discounted_revenue"] == pytest.approx(7 * 0.85 + 9 * 0.85**2)
    ideal = 1 + 1 / math.log2(3) + 0.5
    assert one["ndcg_at_k"] == pytest.approx((1 / math.log2(3) + 0.5) / ideal)
    assert all(rows[2][m] == 0.0 for m in V.METRICS)
