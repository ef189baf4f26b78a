"""The recommender interface: the extension point for users of the library."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, functions as F

from revrank.functions import expressions as E
from revrank.operators.ranking import Catalogue, global_rank
from revrank.sources.adapters import require_columns
from revrank.sources.sinks import to_recommendations

LOG_COLUMNS = {"user_idx", "item_idx", "relevance"}


class Recommender(ABC):
    """Fits on a log and gives each user the k best items by expected revenue.

    ``fit`` and ``recommend`` take and return DataFrames; nothing of the size of
    the data is brought to the driver.
    """

    name = "recommender"

    @abstractmethod
    def fit(self, log: DataFrame, users: DataFrame, items: DataFrame) -> "Recommender":
        """Learn from the log; keep model tables on ``self``."""

    @abstractmethod
    def recommend(
        self, log: DataFrame, k: int, users: DataFrame, items: DataFrame, filter_seen_items: bool = True
    ) -> DataFrame:
        """At most k rows ``user_idx, item_idx, score`` per user; score is a double."""

    def predict(
        self, log: DataFrame, k: int, users: DataFrame, items: DataFrame, filter_seen_items: bool = True
    ) -> DataFrame:
        """Recommendations in the fixed schema ``user_idx, item_idx, relevance``."""
        return to_recommendations(self.recommend(log, k, users, items, filter_seen_items))

    @staticmethod
    def check(log: DataFrame, items: DataFrame) -> None:
        require_columns(log, LOG_COLUMNS, "log")
        require_columns(items, {"item_idx", "price"}, "items")


def user_ids(users: DataFrame) -> DataFrame:
    return users.select("user_idx").distinct()


def by_score(items: DataFrame, score: str = "score") -> Catalogue:
    """Catalogue in order of an item score, best first, ties by item."""
    return global_rank(items, F.col(score).desc(), F.col("item_idx").asc())


def by_price(items: DataFrame, *columns: str, factor: float = 1.0) -> Catalogue:
    """Catalogue by price, with ``bound`` = factor × price for best-first search."""
    priced = items.withColumn("price", E.clean_price("price")).withColumn("bound", F.col("price") * factor)
    return global_rank(priced.select("item_idx", "price", "bound", *columns), F.col("bound").desc(), "item_idx")
