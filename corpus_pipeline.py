"""From raw documents to packed training sequences, in five stages.

Each stage gets what the one before it kept and returns the columns of documents;
the last returns the places of pieces in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrank.llm import minhash, packing, quality, secrets, toxicity
from revrank.llm.common import bounded_broadcast, table, text_batches
from revrank.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.probabilities(F.col("text"), chain)["p_toxic"] < toxicity.TOXIC)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of good quality go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(F.col("text"), model) >= quality.GOOD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    Of rows that repeat a kept id one stays; rows without an id all stay.
    """
    text_batches(spark)
    judged = cut_lineage(minhash.near_duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("kept").alias("kept")))
    gone = cut_lineage(judged.filter("NOT kept").select("doc_id"))
    rest = docs.join(bounded_broadcast(gone), "doc_id", "left_anti")
    repeated = cut_lineage(judged.filter("kept AND rows > 1").select("doc_id"))
    if not repeated.isEmpty():
        repeated = bounded_broadcast(repeated)
        once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        rest = rest.join(repeated, "doc_id", "left_anti").unionByName(once)
    return rest.select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are hidden; documents stay, with their new length."""
    text_batches(spark)
    hidden = secrets.redact(docs)
    return hidden.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    text_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]

#: Models, tokenizers and components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
