"""Tool calls of conversations: linked to results, ordered, validated, and written as canonical JSON.

DataFrame functions alone. Calls are (conversation, turn, call_id, name,
arguments), arguments a JSON object; results are (conversation, turn, call_id,
content). A call depends on others by ``{"$call": "<call_id>"}`` in its arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators.ranking import global_rank
from revrank.session import cut_lineage

#: JSON types and how Spark names them in a variant's schema.
TYPES = {
    "string": r"^STRING$",
    "integer": r"^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|DECIMAL.*|FLOAT)$",
    "boolean": r"^BOOLEAN$",
    "object": r"^OBJECT<",
    "array": r"^ARRAY<",
}
REFERENCE = r'"\$call"\s*:\s*"((?:[^"\\]|\\.)*)"'


@dataclass(frozen=True)
class Parameter:
    name: str
    type: str
    required: bool = True


Schemas = dict[str, tuple[Parameter, ...]]


def problems(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as array<string>; empty for a valid call."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    found = F.array(F.concat(F.lit("unknown tool: "), F.coalesce(name, F.lit(""))))
    for tool, parameters in schemas.items():
        checks = []
        for p in parameters:
            kind = F.schema_of_variant(F.try_variant_get(value, f"$['{p.name}']", "variant"))
            absent = kind.isNull() | (kind == "VOID")
            missing = F.when(absent, F.lit(f"missing: {p.name}")) if p.required else F.lit(None).cast("string")
            checks += [missing, F.when(~absent & ~kind.rlike(TYPES[p.type]), F.lit(f"not {p.type}: {p.name}"))]
        known = F.array(*(F.lit(p.name) for p in parameters))
        extra = F.transform(F.array_except(F.json_object_keys(arguments), known), lambda k: F.concat(F.lit("unknown: "), k))
        own = F.concat(F.array_compact(F.array(*checks)), F.coalesce(extra, F.array().cast("array<string>")))
        found = F.when(name == tool, own).otherwise(found)
    return F.when(is_object, found).otherwise(F.array(F.lit("arguments are no object")))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls and results joined by conversation and call id; every row of both comes out.

    Adds content, result_turn and status: linked, unanswered (no result), early (the
    result stands before its call), orphan (a result without a call) or extra (a further
    result for an id). Of several results the first by turn, then content, is linked, and
    the others are extra, with or without a call; of several calls with one id each is linked.
    Rows without a conversation or id are linked with nothing: unanswered or orphan. Further
    columns are not read.
    """
    key = ["conversation", "call_id"]
    calls = calls.select(*key, "turn", "name", "arguments")
    results = results.select(*key, F.col("turn").alias("result_turn"), "content")
    known = F.col("conversation").isNotNull() & F.col("call_id").isNotNull()
    # Equal results are one row with a count, so a key with very many of them is added up before it meets its call.
    same = results.filter(known).groupBy(*key, "result_turn", "content").agg(F.count("*").alias("times"))
    first = same.groupBy(*key).agg(F.min(F.struct("result_turn", "content")).alias("r"), F.sum("times").alias("n_results"))
    further = F.col("times") - F.when(F.col("result_turn").eqNullSafe(F.col("r.result_turn")) & F.col("content").eqNullSafe(F.col("r.content")), F.lit(1)).otherwise(F.lit(0))
    extra = same.join(first, key).withColumn("times", further).filter("times > 0")
    extra = extra.select(*key, "result_turn", "content", F.lit("extra").alias("status"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("col")
    first = first.select(*key, "r.result_turn", "r.content", "n_results")
    loose = results.filter(~known).withColumn("n_results", F.lit(1).cast("long"))
    joined = calls.withColumn("is_call", F.lit(True)).join(first.unionByName(loose), key, "full_outer")
    status = (
        F.when(F.col("is_call").isNull(), "orphan")
        .when(F.col("n_results").isNull(), "unanswered")
        .when(F.col("result_turn") < F.col("turn"), "early")
        .otherwise("linked")
    )
    told = joined.withColumn("status", status).drop("is_call").unionByName(extra, allowMissingColumns=True)
    return told.withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))


def levels(calls: DataFrame) -> DataFrame:
    """(conversation, call_id, level): 0 without dependencies, else one more than the deepest of them.

    A round places the calls whose dependencies are all placed, so there are as many
    rounds as levels. Calls in or behind a cycle, or with a dependency that does not
    exist, get no level. Null keys are left out.
    """
    key = ["conversation", "call_id"]
    nodes = calls.filter("conversation IS NOT NULL AND call_id IS NOT NULL")
    edges = nodes.select(*key, F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), 1))).alias("needs")).distinct()
    edges = cut_lineage(edges)
    waiting = edges.select(*key).distinct()
    placed = cut_lineage(nodes.select(*key).distinct().join(waiting, key, "left_anti").withColumn("level", F.lit(0)))
    last, level, open_ = placed, 0, edges
    while not last.isEmpty():
        level += 1
        met = last.select("conversation", F.col("call_id").alias("needs"))
        touched = open_.join(met, ["conversation", "needs"], "left_semi").select(*key).distinct()
        left = cut_lineage(open_.join(met, ["conversation", "needs"], "left_anti"))
        last = cut_lineage(touched.join(left.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(level)))
        placed, open_ = placed.unionByName(last), left
    return placed


def canonical(arguments: Column) -> Column:
    """JSON with keys in order and no white space; null if it is no JSON."""
    return F.to_json(F.try_parse_json(arguments))


def linked_calls(calls: DataFrame, results: DataFrame, schemas: Schemas, context: DataFrame | None = None) -> DataFrame:
    """One row per call and per result that isn't some call's: position, status, problems and canonical JSON.

    ``position`` counts from 1 over the table, conversation by conversation and there
    by level, then turn: every call comes after those it depends on. Rows without a level
    come last in their conversation. ``context``, if given, has turns that are neither
    (conversation, turn, name, content); each comes out with status context. Very long
    texts are handled as any other; empty tables give no rows; further columns are not read.
    """
    key = ["conversation", "call_id"]
    told = link(calls, results).join(levels(calls), key, "left")
    told = told.withColumn("level", F.when(F.col("status") != "extra", F.col("level")))
    if context is not None:
        beside = context.select("conversation", "turn", "name", "content", F.lit("context").alias("status"), F.lit(0).cast("long").alias("n_results"))
        told = told.unionByName(beside, allowMissingColumns=True)
    is_call = ~F.col("status").isin("orphan", "extra", "context")
    told = told.withColumn("problems", F.when(is_call, problems(F.col("name"), F.col("arguments"), schemas)))
    document = F.struct(
        F.try_parse_json("arguments").alias("arguments"),
        F.col("call_id").alias("id"),
        "level",
        "name",
        F.col("content").alias("result"),
        "status",
        (F.size("problems") == 0).alias("valid"),
    )
    told = told.withColumn("json", F.to_json(document))
    place = (F.coalesce("level", F.lit(2**31 - 1)), F.coalesce("turn", "result_turn"))
    ordered = told.withColumn("_level", place[0]).withColumn("_turn", place[1])
    ranked = global_rank(ordered, "conversation", "_level", "_turn", "call_id", "json", name="position").items
    return ranked.select("conversation", "call_id", "turn", "result_turn", "name", "status", "n_results", "level", "position", F.array_join("problems", "; ").alias("problems"), "json")


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and context from plain conversations (conv_id, turn, role, text); each turn is in one of them.

    A user's turn is a call of the tool ``reply`` that refers to the first user turn of
    its conversation as its topic; an assistant's turn is the result of the call in
    the turn before. Turns of any other role, or of none, are context, named by the role.
    Turns without a number have no call id, so nothing is linked to them.
    """
    rows = turns.select(F.col("conv_id").alias("conversation"), F.col("turn").cast("long").alias("turn"), "role", "text")
    asked = rows.filter("role = 'user'")
    first = asked.groupBy("conversation").agg(F.min("turn").alias("first"))
    topic = F.when(F.col("turn") > F.col("first"), F.struct(F.concat(F.lit("call_"), F.col("first").cast("string")).alias("$call")))
    named = F.concat(F.lit("call_"), F.col("turn").cast("string"))
    calls = asked.join(first, "conversation", "left").select(
        "conversation", "turn", named.alias("call_id"), F.lit("reply").alias("name"), F.to_json(F.struct("turn", "text", topic.alias("topic"))).alias("arguments")
    )
    results = rows.filter("role = 'assistant'").select(
        "conversation", "turn", F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content")
    )
    others = rows.filter("role IS NULL OR role NOT IN ('user', 'assistant')")
    return calls, results, others.select("conversation", "turn", F.col("role").alias("name"), F.col("text").alias("content"))


REPLY: Schemas = {"reply": (Parameter("text", "string"), Parameter("turn", "integer"), Parameter("topic", "object", required=False))}
