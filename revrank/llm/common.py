"""What the operators of this folder share: tables, cut points, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrank.session import cut_lineage

#: Row count up to which a table of single 8-byte ids is broadcast (64 MB as a hash set).
BROADCAST_IDS = 2_000_000


#: Rows in one Arrow batch, where a row may be a long text.
BATCH_ROWS = 1_000


def text_batches(spark: SparkSession) -> None:
    """Hand texts to Python tasks in small batches, unless the session asks for smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_broadcast(ids: DataFrame) -> DataFrame:
    """``ids`` (a written table of ids) with a broadcast hint if its row count allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (id, component), smallest id first.

    Alternates large-star and small-star steps until the edges no longer change:
    a logarithmic number of rounds in practice, each of them two aggregations and
    two joins on the node. No node's neighbours are ever gathered in one place;
    a node with very many is split by skew-join handling. Null ids and loops are
    ignored; no edges give no rows.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # pairs: u > v. Large star works on both directions, small star on the given one.
        if large:
            around = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            around = pairs
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        joined = around.join(least, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.filter("u > v").distinct()

    def digest(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    pairs = cut_lineage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = digest(pairs)
    while before[0]:
        pairs = cut_lineage(star(star(pairs, large=True), large=False))
        after = digest(pairs)
        if after == before:
            break
        before = after
    found = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("id"), "component").distinct())


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...], most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, *columns) of about ``most`` labelled documents, chosen by a hash of the id.

    Labels of one id are averaged and rounded; rows without an id or one of the labels
    are left out. The chosen ids are at most a few more than ``most`` and are broadcast.
    """
    rated = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
    rated = rated.agg(*(F.round(F.avg(c)).cast("int").alias(c) for c in columns)).dropna()
    share = min(1.0, most / max(1, rated.count()))
    chosen = cut_lineage(rated.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id")
