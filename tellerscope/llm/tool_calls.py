"""Chat formatting: tool calls linked with their results, ordered, checked and serialised.

Only DataFrame functions are used. Calls and results meet in a hash join on conversation and
identifier, after results are reduced to the first per identifier. Calls are in topological
order by (level, turn, identifier): the level is 0 wherever every call comes after those that
it depends on, which one join shows; only conversations that break this are put in order by
rounds of taking the calls whose dependencies are all placed.

Arguments are parsed as variants, which keep objects sorted by key, so their text is canonical.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import stored

KEY = ["conv_id", "call_id"]
# How the types of a schema are named, and how those of a variant begin.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
}
#: A schema: parameters by name, each with its type and whether it must be given.
Schema = Mapping[str, tuple[str, bool]]


def argument_errors(name: Column, value: Column, schemas: Mapping[str, Schema]) -> Column:
    """Array of what is wrong with the arguments ``value`` (a variant) of the tool ``name``."""
    none = F.array().cast("array<string>")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    known = F.coalesce(name.isin(*schemas), F.lit(False)) if schemas else F.lit(False)
    found = F.when(~known, F.array(F.lit("unknown tool"))).when(~is_object, F.array(F.lit("arguments are no object")))
    for tool, schema in sorted(schemas.items()):
        checks = []
        for key, (kind, needed) in sorted(schema.items()):
            given = F.schema_of_variant(F.try_variant_get(value, f"$['{key}']", "variant"))
            right = F.lit(False)
            for start in TYPES[kind]:
                right = right | given.startswith(start)
            checks.append(F.when(given.isNull(), F.lit(f"missing {key}") if needed else F.lit(None)).when(~right, F.lit(f"{key} is no {kind}")))
        extra = F.array_except(F.json_object_keys(F.to_json(value)), F.array(*[F.lit(k) for k in sorted(schema)]).cast("array<string>"))
        named = F.transform(F.array_sort(extra), lambda k: F.concat(F.lit("unknown "), k))
        found = found.when(name == tool, F.concat(F.array_compact(F.array(*checks)) if checks else none, named))
    return F.coalesce(found, none)


def _out_of_order(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, needs) of conversations with a call that comes before one it needs."""
    place = F.struct("turn", "call_id")
    edges = calls.select(*KEY, place.alias("place"), F.explode("depends_on").alias("needs")).filter("needs IS NOT NULL")
    there = calls.select("conv_id", F.col("call_id").alias("needs"), place.alias("needed")).groupBy("conv_id", "needs").agg(F.max("needed").alias("needed"))
    edges = edges.join(there, ["conv_id", "needs"])
    bad = edges.filter(F.col("needed") >= F.col("place")).select("conv_id").distinct()
    return edges.join(bad, "conv_id", "left_semi").select(*KEY, "needs").distinct()


def levels(calls: DataFrame) -> DataFrame | None:
    """(conv_id, call_id, level) of the conversations that turns do not put in order.

    Calls that wait for each other in a circle, and those that wait for them, get no level.
    ``None`` if there is no such conversation.
    """
    edges = stored(_out_of_order(calls), "call-edges")
    if not edges.limit(1).count():
        return None
    waiting = calls.join(edges.select("conv_id").distinct(), "conv_id", "left_semi").select(*KEY).distinct()
    waiting, done, level = stored(waiting, "calls-waiting"), None, 0
    while True:
        ready = stored(waiting.join(edges, KEY, "left_anti").withColumn("level", F.lit(level)), "calls-ready")
        if not ready.limit(1).count():
            break
        done = ready if done is None else done.unionByName(ready)
        waiting = stored(waiting.join(ready, KEY, "left_anti"), "calls-waiting")
        met = ready.select("conv_id", F.col("call_id").alias("needs"))
        edges = stored(edges.join(met, ["conv_id", "needs"], "left_anti"), "call-edges")
        level += 1
    circle = waiting.withColumn("level", F.lit(None).cast("int"))
    return circle if done is None else done.unionByName(circle)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per call, and one per identifier that only results have.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), depends_on (array of
    call ids). ``results``: conv_id, turn, call_id, content.

    Returns conv_id, turn, call_id, level, status (answered, pending or orphan), n_results,
    valid, errors (joined by "; ") and json: one line with sorted keys and no blanks, in which
    arguments that are no JSON stay null. (level, turn, call_id) is a topological order inside
    a conversation; level is null for calls in a circle. Of several results the earliest
    counts, ties to the smaller content. A null conversation or identifier links with
    nothing. Dependencies on calls that do not exist are ignored. Repeated calls are rows of
    their own. Empty tables give no rows. Other columns are ignored.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on")
    answers = results.groupBy(*KEY).agg(
        F.min_by("content", F.struct("turn", "content")).alias("content"), F.min("turn").alias("answered_at"), F.count("*").alias("n_results")
    )
    linked = calls.join(answers.hint("shuffle_hash"), KEY, "left").withColumn("status", F.when(F.col("n_results") > 0, "answered").otherwise("pending"))
    own = calls.select(*KEY).distinct()
    orphans = answers.join(own.hint("shuffle_hash"), KEY, "left_anti").select(
        *KEY, F.col("answered_at").alias("turn"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), "content", "answered_at", "n_results", F.lit("orphan").alias("status")
    )
    rows = linked.drop("depends_on").unionByName(orphans)
    placed = levels(calls)
    if placed is None:
        rows = rows.withColumn("level", F.lit(0))
    else:
        rows = rows.join(placed.withColumn("__placed", F.lit(True)), KEY, "left").withColumn("level", F.when(F.col("__placed"), F.col("level")).otherwise(F.lit(0)))
    value = F.try_parse_json("arguments")
    errors = F.when(F.col("status") == "orphan", F.array(F.lit("no call"))).otherwise(argument_errors(F.col("name"), value, schemas))
    rows = rows.withColumn("errors", errors).withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    line = F.to_json(
        F.struct(
            value.alias("arguments"), "call_id", F.col("content"), "conv_id", "errors", "level", "name", "status", "turn"
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(
        "conv_id", "turn", "call_id", "level", "status", "n_results", (F.size("errors") == 0).alias("valid"), F.array_join("errors", "; ").alias("errors"), line.alias("json")
    )


# --- conversations without marked calls -------------------------------------------------------

TURN_SCHEMAS: dict[str, Schema] = {"respond": {"prompt": ("string", True), "turn": ("integer", True)}}


def calls_of_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results): each user turn calls ``respond``, each assistant turn answers the one before.

    A call needs the call two turns earlier. Turns of other roles are neither.
    """
    name = lambda turn: F.concat_ws(":", F.col("conv_id"), turn)
    turn = F.col("turn")
    own = F.when(F.col("conv_id").isNotNull() & turn.isNotNull(), name(turn))
    calls = conversations.filter("role = 'user'").select(
        "conv_id", "turn", own.alias("call_id"), F.lit("respond").alias("name"), F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"), F.array(name(turn - 2)).alias("depends_on")
    )
    answered = F.when(F.col("conv_id").isNotNull() & turn.isNotNull(), name(turn - 1))
    results = conversations.filter("role = 'assistant'").select("conv_id", "turn", answered.alias("call_id"), F.col("text").alias("content"))
    return calls, results
