"""Tool calls linked to results, ordered, validated and serialised, in DataFrame functions only.

Calls and results meet in a hash join on (conversation, call id). A call may
name calls it comes after; levels are peeled off round by round, each round
resolving the calls whose predecessors all have a level, so only unresolved
edges are read again. Arguments are parsed to Spark's variant type, whose
objects keep their keys sorted: checked against a schema per tool, and written
back as canonical JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.session import discard, materialize

#: Of a tool's arguments: key -> (kind, required). Kinds: string, integer, number, boolean, object, array, null.
Schema = dict[str, tuple[str, bool]]
NO_KINDS = "array<struct<key:string,kind:string>>"
UNIQUE = ["conv_id", "call_id"]


def _kind(value: Column) -> Column:
    """JSON kind of a variant."""
    shape = F.schema_of_variant(value)
    named = F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "STRING", "string")
    named = named.when(shape == "BOOLEAN", "boolean").when(shape == "VOID", "null").when(shape == "BIGINT", "integer")
    return named.otherwise("number")


def _faults(kinds: Column, schema: Schema) -> Column:
    """What is wrong with arguments of the given keys and kinds, sorted."""

    def one(key: str, kind: str, required: bool) -> Column:
        there = F.filter(kinds, lambda e: e["key"] == key)
        accepted = [kind, "integer"] if kind == "number" else [kind]
        missing = F.lit(f"missing:{key}") if required else F.lit(None).cast("string")
        return F.when(F.size(there) == 0, missing).when(~there[0]["kind"].isin(accepted), F.lit(f"type:{key}"))

    unknown = F.transform(F.filter(kinds, lambda e: ~e["key"].isin(list(schema))), lambda e: F.concat(F.lit("unknown:"), e["key"]))
    known = F.array_compact(F.array(*[one(k, *spec) for k, spec in schema.items()])) if schema else F.array().cast("array<string>")
    return F.array_sort(F.concat(known, unknown))


def validated(calls: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """``calls (name, arguments, ...)`` with ``faults`` and ``canonical``, the arguments as canonical JSON.

    Canonical JSON has sorted keys and no white space. Text that is no JSON
    object (null too) has the one fault ``no_object`` and null as canonical
    form; a tool without schema has the fault ``unknown_tool``.
    """
    parsed = calls.withColumn("_v", F.try_parse_json("arguments"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    entries = F.map_entries(F.col("_v").cast("map<string,variant>"))
    kinds = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _kind(e["value"]).alias("kind")))
    parsed = parsed.withColumn("_kinds", F.when(is_object, kinds)).withColumn("canonical", F.when(is_object, F.to_json("_v")))
    faults = F.when(F.col("_kinds").isNull(), F.array(F.lit("no_object")))
    for name, schema in schemas.items():
        faults = faults.when(F.col("name") == name, _faults(F.col("_kinds"), schema))
    return parsed.withColumn("faults", faults.otherwise(F.array(F.lit("unknown_tool")))).drop("_v", "_kinds")


def levels(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Levels of ``nodes (conv_id, call_id, after)``, unique in both ids, and the names in ``after`` that are no node.

    ``(conv_id, call_id, level)``: 0 without predecessors, else one more than
    the highest of them; null on a cycle or after one. As many rounds as the
    longest chain has calls, each over the edges still open.
    """
    named = nodes.select("conv_id", F.col("call_id").alias("child"), F.explode(F.array_distinct("after")).alias("call_id")).where("call_id is not null")
    known = nodes.select(*UNIQUE)
    unknown = named.join(known, UNIQUE, "left_anti").groupBy("conv_id", "child").agg(F.count("*").alias("unknown"))
    unknown = unknown.withColumnRenamed("child", "call_id")
    edges = materialize(named.join(known, UNIQUE, "left_semi").withColumn("level", F.lit(None).cast("int")))
    children = edges.select("conv_id", F.col("child").alias("call_id")).distinct()
    new = materialize(known.join(children, UNIQUE, "left_anti").withColumn("level", F.lit(0)))
    found = new
    while not new.isEmpty():
        given = new.select("conv_id", "call_id", F.col("level").alias("given"))
        filled = edges.join(given, UNIQUE, "left").withColumn("level", F.coalesce("level", "given")).drop("given")
        state = filled.groupBy("conv_id", "child").agg((F.count("level") == F.count("*")).alias("done"), (F.max("level") + 1).alias("next"))
        joined = materialize(filled.join(state, ["conv_id", "child"]))
        new = materialize(joined.where("done").select("conv_id", F.col("child").alias("call_id"), F.col("next").alias("level")).distinct())
        found = found.unionByName(new)
        remaining = materialize(joined.where("not done").drop("done", "next"))
        discard(edges, joined)
        edges = remaining
    return known.join(found, UNIQUE, "left"), unknown


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """One row per call of ``calls (conv_id, turn, call_id, name, arguments, after)``, linked to ``results (conv_id, turn, call_id, content)``.

    ``(conv_id, call_id, turn, name, level, result_turn, n_results, faults,
    message)``; calls in the order of ``level`` and ``turn`` come after those
    they depend on, and ``message`` is canonical JSON of arguments, call id,
    name and result. Where a conversation has an id more than once, the first
    call (by turn, then content) stands and gets the fault ``repeated_id``; the
    first result likewise counts and ``n_results`` tells how many there are.
    Calls without a conversation or an id cannot be linked or ordered: each is
    a row with the fault ``no_id``. Further faults: ``unknown_after`` and
    ``cycle``. Results without a call are left to ``orphans``.
    """
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    body = F.struct("turn", "name", "arguments", F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    nodes = materialize(calls.where(has_id).groupBy(*UNIQUE).agg(F.min(body).alias("c"), F.count("*").alias("n_calls")).select(*UNIQUE, "n_calls", "c.*"))
    level, unknown = levels(nodes.select(*UNIQUE, "after"))
    first = F.min(F.struct("turn", "content")).alias("r")
    answers = results.where(has_id).groupBy(*UNIQUE).agg(first, F.count("*").alias("n_results"))
    answers = answers.select(*UNIQUE, F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "n_results")
    joined = nodes.join(answers.hint("shuffle_hash"), UNIQUE, "left").join(level, UNIQUE).join(unknown, UNIQUE, "left")
    lost = calls.where(~has_id).select(
        *UNIQUE, F.lit(1).cast("bigint").alias("n_calls"), "turn", "name", "arguments", "after",
        F.lit(None).cast("bigint").alias("result_turn"), F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("bigint").alias("n_results"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("bigint").alias("unknown"),
    )
    checked = validated(joined.unionByName(lost), schemas)
    more = F.array_compact(
        F.array(
            F.when(~has_id, "no_id"), F.when(F.col("n_calls") > 1, "repeated_id"), F.when(F.col("unknown") > 0, "unknown_after"),
            F.when(has_id & F.col("level").isNull(), "cycle"),
        )
    )
    message = F.to_json(
        F.struct(
            F.try_parse_json("canonical").alias("arguments"), F.col("call_id").alias("call_id"), F.col("name").alias("name"), F.col("content").alias("result")
        ),
        {"ignoreNullFields": "false"},
    )
    return checked.select(
        *UNIQUE, "turn", "name", "level", "result_turn", F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.concat("faults", more).alias("faults"), message.alias("message"),
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose conversation has no call of their id, or that have no id."""
    return results.join(calls.select(*UNIQUE).distinct(), UNIQUE, "left_anti")
