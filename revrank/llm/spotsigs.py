"""Document fingerprints from spot signatures, in DataFrame functions alone.

A signature is a chain: a common word (anchor) and the content words that follow
it, other anchors skipped. The set of a text's chains is its fingerprint. Small
edits change few chains, and passages without common words (lists, navigation)
give none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revrank.session import cut_lineage

#: Anchors: frequent function words of English, French, German and Spanish.
ANCHORS = (
    "a an the of to and in is was are be on that this it for with as by at or from what will not "
    "le la les un une des du de et est en que qui dans pour par sur au avec il ne "
    "der die das und ist ein eine den dem von zu mit sich auf für nicht als auch im es "
    "el los las y del se por con una para su al lo como no"
).split()
MARK = "\u0001"
#: Content words in a chain.
CHAIN = 2
#: Signatures are kept as this many buckets of neighbours for each shuffle partition.
BUCKETS_PER_PARTITION = 8


def with_signatures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add ``out``: the sorted distinct signatures (long) of ``text_col``.

    A text without chains has one signature, its words (without words: itself) as a
    whole; the empty and the null text have none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    marked = F.transform(words, lambda w: F.when(w.isin(*ANCHORS), F.concat(w, F.lit(MARK))).otherwise(w))
    # A unit is a content word with the anchors before it. The columns are made one by
    # one: inside a lambda an expression would be worked out anew for every element.
    step = df.withColumn("_line", F.array_join(marked, " "))
    step = step.withColumn("_units", F.split("_line", f"(?<!{MARK}) "))

    def chain(unit: Column, i: Column) -> Column:
        rest = [F.substring_index(F.get("_units", i + k), " ", -1) for k in range(1, CHAIN)]
        whole = unit.contains(MARK) & (i + CHAIN <= F.size("_units")) & ~F.get("_units", i + CHAIN - 1).endswith(MARK)
        return F.when(whole, F.xxhash64(F.substring_index(unit, " ", -2), *rest))

    step = step.withColumn("_found", F.array_sort(F.array_distinct(F.array_compact(F.transform("_units", chain)))))
    none = F.array().cast("array<bigint>")
    alone = F.when(F.col("_line") != "", F.xxhash64("_line")).otherwise(F.xxhash64(F.lit(MARK), text))
    found = F.when(text == "", none).when(F.size("_found") > 0, F.col("_found")).otherwise(F.array(alone))
    return step.withColumn(out, found).drop("_line", "_units", "_found")


def fingerprint(signatures: Column) -> Column:
    """A digest of a signature set, as lowercase hex: equal sets, equal fingerprints."""
    return F.md5(F.array_join(signatures.cast("array<string>"), ","))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty ones are alike, an empty and a filled one are not."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> tuple[DataFrame, Window]:
    """``docs`` dealt to buckets of neighbouring ids, each with a copy of the row that follows its last.

    Returns rows with ``_ghost`` for these copies and the window in which ``lead`` is
    the next row in descending order of ids (after the last one: the first). Bucket
    bounds are quantiles of the ids, a number that grows with the partitions alone; a null id
    comes last, and equal ids are ordered by their text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    side = max(1, math.isqrt(BUCKETS_PER_PARTITION * parts))
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    shares = [i / (side * side) for i in range(1, side * side)] or [0.5]
    bounds = sorted(set(docs.agg(F.percentile_approx(at, shares, 10_000)).first()[0] or []))
    groups = [bounds[i : i + side] for i in range(0, len(bounds), side)] or [[0]]
    coarse = F.array(*(F.lit(g[0]) for g in groups))
    fine = F.array(*(F.array(*map(F.lit, g)) for g in groups))
    dealt = docs.select(*columns, at.alias("_at")).withColumn("_coarse", F.size(F.filter(coarse, lambda b: b <= F.col("_at"))))
    inner = F.size(F.filter(F.get(fine, F.greatest(F.col("_coarse") - 1, F.lit(0))), lambda b: b <= F.col("_at")))
    dealt = dealt.withColumn("_bucket", F.col("_coarse") * (side + 1) + inner).drop("_coarse")
    # One row for each bucket.
    firsts = dealt.groupBy("_bucket").agg(F.max("_at").alias("_at"))
    around = Window.orderBy(F.desc("_at"))
    ends = firsts.select("_at", F.coalesce(F.lag("_bucket").over(around), F.min("_bucket").over(Window.partitionBy())).alias("_to"))
    ghosts = dealt.join(F.broadcast(cut_lineage(ends)), "_at").withColumn("_bucket", F.col("_to")).drop("_to")
    rows = dealt.withColumn("_ghost", F.lit(False)).unionByName(ghosts.withColumn("_ghost", F.lit(True)))
    return rows, Window.partitionBy("_bucket").orderBy("_ghost", F.desc("_at"), F.xxhash64(*columns))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's text, edited text, their signatures, and the next row's signatures.

    The edited text has the last half of the code points replaced by the first as many
    (or all) of the next document, in descending order of ids, after the last the first.
    Returns id_col, text, edited, signatures, edited_signatures, next_signatures. Null
    texts are empty; repeated rows follow one another; a single row follows itself; an
    empty table gives none; other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, order = with_next(named, "id", ["id", "text"])
    rows = rows.withColumn("next", F.lead("text").over(order))
    rows = with_signatures(rows, "text", "signatures")
    rows = rows.withColumn("next_signatures", F.lead("signatures").over(order)).filter("NOT _ghost")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next"), F.lit(1), half))
    rows = with_signatures(rows.withColumn("edited", edited), "edited", "edited_signatures")
    return rows.select(F.col("id").alias(id_col), "text", "edited", "signatures", "edited_signatures", "next_signatures")


def report(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digests and likenesses of ``compared`` rows."""
    return rows.select(
        id_col,
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


def similar_fingerprints(docs: DataFrame, least: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints alike from ``least`` on, and who has each fingerprint.

    Returns (a, b, likeness) over fingerprints and (id_col, fingerprint). Sets are
    partitioned by length, so that only neighbouring partitions can be alike; within
    them only the rarest signatures are looked up, as many as one of any two similar
    sets must share, and a pair is compared if its lengths leave room. Documents
    without signatures are in no pair.
    """
    signed = with_signatures(docs.select(id_col, text_col), text_col, "signatures").select(id_col, "signatures")
    member = cut_lineage(signed.select(id_col, "signatures", fingerprint(F.col("signatures")).alias("fingerprint")))
    sets = cut_lineage(member.filter(F.size("signatures") > 0).groupBy("fingerprint").agg(F.first("signatures").alias("signatures")))
    held = sets.select("fingerprint", F.size("signatures").alias("n"), F.explode("signatures").alias("signature"))
    rarity = held.groupBy("signature").agg(F.count("*").alias("df"))
    nth = F.row_number().over(Window.partitionBy("fingerprint").orderBy("df", "signature"))
    rare = held.join(rarity, "signature").withColumn("nth", nth).filter(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    part = F.floor(F.log(F.col("n")) / math.log(1 / least))
    index = cut_lineage(rare.filter("df > 1").select("fingerprint", "n", "signature", part.alias("part")))
    probe = index.select(F.col("fingerprint").alias("b"), F.col("n").alias("n_b"), "signature", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    room = F.least("n", "n_b") >= least * F.greatest("n", "n_b")
    pairs = index.withColumnRenamed("fingerprint", "a").join(probe, ["signature", "part"]).filter(room & (F.col("a") != F.col("b")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    alike = both.select("a", "b", likeness(F.col("s_a"), F.col("s_b")).alias("likeness")).filter(F.col("likeness") >= least)
    return alike, member.select(id_col, "fingerprint")
