"""Readers: users, items and the interaction log, from parquet tables.

The three tables of the data model are views on a star schema: customers are
users, parts are items, order lines joined with their orders are the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns that order a user's rows in time. The whole tuple is needed: order
# lines of one order share the date, and line numbers repeat.
TIME_ORDER = ["o_orderdate", "l_orderkey", "l_linenumber", "item_idx", "relevance"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_users(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_idx"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") / F.lit(10000.0)).alias("user_attr_0"),
        (F.col("c_nationkey") / F.lit(24.0)).alias("user_attr_1"),
    )


def load_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_idx"),
        F.col("p_type").alias("category"),
        F.round(F.col("p_retailprice") - F.lit(899.9), 2).alias("price"),
        (F.col("p_size") / F.lit(50.0)).alias("item_attr_0"),
        (F.length("p_name") / F.lit(20.0)).alias("item_attr_1"),
    )


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_idx"),
        F.col("l_partkey").alias("item_idx"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.lit(1.0)).alias("relevance"),
        (F.year("o_orderdate") - F.lit(1995)).alias("__iter"),
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
    )


def load_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def attr_columns(df: DataFrame, prefix: str, limit: int | None = 5) -> list[str]:
    """Attribute columns found by prefix; the first ``limit`` of them."""
    found = [name for name in df.columns if name.startswith(prefix)]
    return found if limit is None else found[:limit]


def require_columns(df: DataFrame, needed: set[str], what: str) -> None:
    """Fail while the plan is built when a required column is missing."""
    missing = sorted(needed - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
