"""Secrets in texts, told apart by how widely the corpus copies them.

Candidates are assignments of passwords and tokens, access keys, long hex strings
and other long mixed strings. Their values are counted over the whole corpus by
distinct repositories and owners: a value that several owners have is a copied
example, one that stays with its owner looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.session import cut_lineage

KINDS = ("assign", "access", "hex", "opaque")
BASE = KINDS[:3]
#: Distinct owners from which on a value counts as a copied example.
COPIED_OWNERS = 2
#: An opaque string: mixed case and digits, at least so long, at least so many bits a character.
OPAQUE_LENGTH, OPAQUE_BITS = 24, 3.5

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_NAMES = re.compile(r"(?ai)passw|secret|token|api_?key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_OPAQUE = re.compile(rf"[A-Za-z0-9+/_-]{{{OPAQUE_LENGTH},}}=*")


def bits_per_character(text: str) -> float:
    counts = Counter(text).values()
    return -sum(n / len(text) * math.log2(n / len(text)) for n in counts)


def candidates(text: str | None) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, value) of each kind's matches; places are code points."""
    if not text:
        return
    taken = []
    if _NAMES.search(text):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                taken.append(m.span(2))
                yield "assign", *m.span(), m[2]
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= 20:
                taken.append(m.span())
                yield "access", *m.span(), m[0]
    for m in _HEX.finditer(text):
        taken.append(m.span())
        yield "hex", *m.span(), m[0]
    for m in _OPAQUE.finditer(text):
        value = m[0]
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        mixed = re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)
        if mixed and bits_per_character(value) >= OPAQUE_BITS:
            yield "opaque", *m.span(), value


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
_SPANS = T.ArrayType(
    T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType()).add("value", T.StringType())
)


@F.arrow_udf(_SPANS)
def spans(texts: pa.Array) -> pa.Array:
    """Candidates by start, then kind; the value is its SHA-256, so that no secret is stored."""
    out = []
    for text in texts.to_pylist():
        found = sorted(candidates(text), key=lambda s: (s[1], KINDS.index(s[0])))
        out.append([{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()} for k, a, b, v in found])
    return pa.array(out, type=pa.list_(_SPAN))


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repositories, n_owners) of a table (value, repository, owner); null counts as a name of its own.

    The distinct (value, repository, owner) are counted first, so that a value that
    is in a large part of the rows is a few rows for each name before it meets.
    """
    named = found.select("value", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("repository", "owner")))
    pairs = named.distinct()
    owners = pairs.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("value").agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "source", owner_col: str = "source") -> DataFrame:
    """(row, id_col, spans): each row's candidates with their corpus-wide status.

    ``spans`` is an array of (kind, start, end, value, n_repositories, n_owners,
    live), by start and kind. A row without candidates, an empty or a null text has
    an empty array. Repeated rows are rows of their own (``row`` numbers them);
    a null repository or owner counts as one name. Other columns are not read.
    """
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias(id_col),
            F.col(repository_col).alias("repository"),
            F.col(owner_col).alias("owner"),
            spans(F.col(text_col)).alias("spans"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    found = rows.filter(F.size("spans") > 0).select("row", "repository", "owner", F.explode("spans").alias("s"))
    status = ownership(found.select(F.col("s.value").alias("value"), "repository", "owner"))
    told = found.select("row", "s.*").join(status, "value", "left")
    told = told.withColumn("live", F.col("n_owners") < COPIED_OWNERS)
    order = F.array(*(F.lit(k) for k in KINDS))
    each = F.struct("start", F.array_position(order, F.col("kind")).alias("place"), "kind", "end", "value", "n_repositories", "n_owners", "live")
    gathered = told.groupBy("row").agg(F.sort_array(F.collect_list(each)).alias("told"))
    return rows.select("row", id_col).join(gathered, "row", "left").select(
        "row", id_col, F.coalesce("told", F.array().cast(gathered.schema["told"].dataType)).alias("spans")
    )


#: Rows with live secrets up to which they are broadcast (a few spans each, about 50 MB).
BROADCAST_ROWS = 100_000
HIDDEN = "[SECRET]"


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "source", owner_col: str = "source") -> DataFrame:
    """``docs`` with every live-looking secret in ``text_col`` replaced by ``HIDDEN``; copied examples stay.

    Spans that touch become one. All other columns, whatever their names, and all rows are as
    before; a null or empty text stays, very long texts are read whole.
    """
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(text_col).cast("string"))
    read = docs.select(key.alias("key"), F.col(text_col).alias("text"), F.col(repository_col).alias("repository"), F.col(owner_col).alias("owner"))
    found = scan(read, "key", "text", "repository", "owner")
    live = F.transform(F.filter("spans", lambda s: s["live"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    hidden = cut_lineage(found.select("key", live.alias("live")).filter(F.size("live") > 0).dropDuplicates(["key"]))
    if hidden.count() <= BROADCAST_ROWS:
        hidden = F.broadcast(hidden)

    @F.arrow_udf(T.StringType())
    def without(texts: pa.Array, spans_: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts.to_pylist(), spans_.to_pylist(), strict=True):
            parts, at = [], 0
            for span in own or []:
                if span["start"] >= at:
                    parts += [text[at : span["start"]], HIDDEN]
                at = max(at, span["end"])
            out.append("".join([*parts, text[at:]]) if parts else text)
        return pa.array(out, type=pa.string())

    # The columns of docs travel as one, so that none can have the name of another.
    joined = docs.select(key.alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).join(hidden, "key", "left")
    own = {c: F.col("doc").getField(c) for c in docs.columns}
    own[text_col] = without(own[text_col], F.col("live"))
    return joined.select(*(value.alias(c) for c, value in own.items()))


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans, all spans, and how many values look live or copied."""

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def listed(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return scanned.select(
        id_col,
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )
