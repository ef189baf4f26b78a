"""The fixed output schema, and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RECOMMENDATION_SCHEMA = T.StructType(
    [
        T.StructField("user_idx", T.LongType(), True),
        T.StructField("item_idx", T.LongType(), True),
        T.StructField("relevance", T.FloatType(), True),
    ]
)


def to_recommendations(df: DataFrame, score: str = "score") -> DataFrame:
    """Project scored pairs to the fixed recommendation schema."""
    return df.select(
        F.col("user_idx").cast("long"),
        F.col("item_idx").cast("long"),
        F.col(score).cast("float").alias("relevance"),
    )


def empty_recommendations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECOMMENDATION_SCHEMA)


def write_results(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a result table as parquet, replacing what was there."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
