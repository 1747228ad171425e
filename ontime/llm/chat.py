"""Chat formatting: tool calls linked to results, ordered, validated, serialised.

Calls meet results in a hash join on thread and call identifier, so equal
identifiers of two threads stay apart. A call may name one earlier call of its
thread whose result it needs; the depth of a call below its first ancestor
orders calls topologically, and is found by pointer doubling in log2(longest
chain) joins. Arguments are parsed as JSON variants and checked against the
tool's schema. Messages and arguments become canonical JSON: keys in order, no
blanks, non-ASCII characters as they are.

Defined results: a call has a row for each of its results, which their
positions order, or one row without; results without a call are `orphan`,
calls without a result `unanswered`; calls that need an unknown call start at
depth 0; calls on or below a cycle are `cycle` with a null depth; arguments
that are no JSON object, lack a required field or have one of a wrong type or
length are `invalid`; a null thread is a thread of its own, null identifiers
equal nothing; null texts are JSON null; equal call rows are one call, and of
calls with one identifier that need different ones the least need counts;
empty tables give empty results; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import drop_folders, materialise

# The JSON kinds of a schema, as the start of the type that a variant reports.
KINDS = {
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DECIMAL|DOUBLE)",
    "string": "^STRING$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


class Field(NamedTuple):
    """A field of a tool's arguments; lengths are those of texts, in characters."""

    kind: str
    required: bool = False
    min_length: int = 0
    max_length: int | None = None


Schemas = Mapping[str, Mapping[str, Field]]


def argument_errors(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """Names of fields of a call that break its schema; `*` if it is no JSON object.

    `schemas` maps a tool to its fields. Unknown tools and fields without a
    schema are errors too.
    """
    parsed = F.try_parse_json(arguments)
    shape = F.schema_of_variant(parsed)
    given = F.json_object_keys(arguments)
    errors = F.array(F.lit("*"))
    for name, fields in schemas.items():
        checks = []
        for field, wanted in fields.items():
            value = F.try_variant_get(parsed, f"$.{field}", "variant")
            present = F.array_contains(given, field)
            fits = F.coalesce(F.schema_of_variant(value).rlike(KINDS[wanted.kind]), F.lit(False))
            if wanted.kind == "string":
                length = F.char_length(F.try_variant_get(parsed, f"$.{field}", "string"))
                longest = F.lit(wanted.max_length if wanted.max_length is not None else 2**31 - 1)
                fits &= F.coalesce(length.between(F.lit(wanted.min_length), longest), F.lit(False))
            broken = (present & ~fits) | (~present if wanted.required else F.lit(False))
            checks.append(F.when(broken, F.lit(field)))
        unknown = F.array_except(given, F.array(*(F.lit(field) for field in fields)))
        found = F.array_sort(F.concat(F.array_compact(F.array(*checks)), unknown))
        is_object = F.coalesce(shape.startswith("OBJECT"), F.lit(False))
        errors = F.when((tool == name) & is_object, found).otherwise(errors)
    return errors


def canonical(arguments: Column) -> Column:
    """JSON with keys in order and no blanks; null if it cannot be parsed."""
    return F.to_json(F.try_parse_json(arguments))


def same_call(thread: str, call: str, other_thread: str, other_call: str) -> Column:
    return F.col(thread).eqNullSafe(F.col(other_thread)) & (F.col(call) == F.col(other_call))


def call_depths(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """thread, call_id and depth: the number of calls that have to come before it.

    Each round replaces the call that one waits for by the one that it waits
    for, and adds the distances; a chain of n calls takes log2(n) rounds. What
    still waits after 2^rounds > number of calls steps is on or below a cycle.
    """
    nodes = (
        calls.where("call_id IS NOT NULL").groupBy("thread", "call_id").agg(F.min("needs").alias("needs"))
    )
    known = nodes.select(F.col("thread").alias("k_thread"), F.col("call_id").alias("k_id"))
    start = nodes.join(known, same_call("thread", "needs", "k_thread", "k_id"), "left").select(
        "thread",
        "call_id",
        F.col("k_id").alias("waits_for"),
        F.when(F.col("k_id").isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
    )
    table, folder = materialise(spark, start, "call-depths")
    total = table.count()
    rounds, waiting = 0, table.where("waits_for IS NOT NULL").count()
    while waiting and 1 << rounds <= total:
        target = table.select(
            F.col("thread").alias("t_thread"),
            F.col("call_id").alias("t_id"),
            F.col("waits_for").alias("t_waits"),
            F.col("depth").alias("t_depth"),
        )
        step = table.join(target, same_call("thread", "waits_for", "t_thread", "t_id"), "left").select(
            "thread",
            "call_id",
            F.col("t_waits").alias("waits_for"),
            (F.col("depth") + F.coalesce("t_depth", F.lit(0).cast("long"))).alias("depth"),
        )
        used = folder
        table, folder = materialise(spark, step, "call-depths")
        drop_folders(spark, [used])
        rounds += 1
        waiting = table.where("waits_for IS NOT NULL").count()
    return table.select(
        "thread", "call_id", F.when(F.col("waits_for").isNull(), F.col("depth")).alias("depth")
    )


def linked_calls(
    spark: SparkSession, calls: DataFrame, results: DataFrame, schemas: Schemas
) -> DataFrame:
    """One row per call and result, per call without one and result without a call.

    `calls`: thread, call_id, tool, arguments (JSON text), needs (a call_id or
    null). `results`: thread, call_id, position, content. The rows: thread,
    call_id, tool, position (the result's), depth, status, errors, json.
    """
    depths = call_depths(spark, calls).select(
        F.col("thread").alias("d_thread"), F.col("call_id").alias("d_id"), "depth"
    )
    unique = (
        calls.select("thread", "call_id", "tool", "arguments")
        .distinct()
        .withColumn("errors", argument_errors(F.col("tool"), F.col("arguments"), schemas))
        .join(depths, same_call("thread", "call_id", "d_thread", "d_id"), "left")
        .select("thread", "call_id", "tool", "arguments", "errors", "depth", F.lit(True).alias("called"))
    )
    answers = results.select(
        F.col("thread").alias("r_thread"), F.col("call_id").alias("r_id"), "position", "content"
    )
    # Results are the long side, which Spark may split where a call has very many.
    same = same_call("thread", "call_id", "r_thread", "r_id")
    answered = answers.join(unique, same, "left").withColumn("answered", F.lit(True))
    waiting = unique.join(answers.select("r_thread", "r_id").distinct(), same, "left_anti")
    called = F.coalesce("called", F.lit(False))
    status = (
        F.when(~called, "orphan")
        .when(F.col("call_id").isNotNull() & F.col("depth").isNull(), "cycle")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("answered").isNull(), "unanswered")
        .otherwise("ok")
    )
    return answered.unionByName(waiting, allowMissingColumns=True).select(
        F.when(called, F.col("thread")).otherwise(F.col("r_thread")).alias("thread"),
        F.coalesce("call_id", "r_id").alias("call_id"),
        "tool",
        "position",
        "depth",
        status.alias("status"),
        F.when(called, F.array_join("errors", ",")).alias("errors"),
        F.to_json(
            F.struct(
                canonical(F.col("arguments")).alias("arguments"),
                F.coalesce("call_id", "r_id").alias("id"),
                F.col("content").alias("result"),
                F.col("tool").alias("tool"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("json"),
    )


# How conversations without tool calls are read as such: a user turn is a call,
# and the assistant turn after it the result.
TURN_SCHEMAS: Schemas = {
    "open": {"prompt": Field("string", True, 1, 400), "turn": Field("integer", True)},
    "follow": {
        "after": Field("string", True),
        "prompt": Field("string", True, 1, 400),
        "turn": Field("integer", True),
    },
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and other messages of a table conv_id, turn, role, text.

    A user turn asks, in the first two turns as `open`, else as `follow`, which
    names the user turn two turns before it, if there is one, and needs its
    result. An assistant turn answers the turn before it. All other turns are
    messages. Each row of the table is one of the three.
    """
    role = F.coalesce("role", F.lit(""))

    def call_id(turn: Column) -> Column:
        return F.when(
            F.col("conv_id").isNotNull() & turn.isNotNull(),
            F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn),
        )

    asked = turns.where(role == "user").select("conv_id", "turn", "text")
    earlier = asked.select(
        F.col("conv_id").alias("e_conv"), (F.col("turn") + 2).alias("e_turn"), call_id(F.col("turn")).alias("after")
    ).distinct()
    follows = F.coalesce(F.col("turn") > 1, F.lit(False))
    given = {"after": F.col("after"), "prompt": F.col("text"), "turn": F.col("turn")}
    whole = {"ignoreNullFields": "false"}
    arguments = F.when(
        F.col("after").isNotNull(), F.to_json(F.struct(*(v.alias(k) for k, v in given.items())), whole)
    ).otherwise(F.to_json(F.struct(*(v.alias(k) for k, v in given.items() if k != "after")), whole))
    calls = asked.join(
        earlier, (F.col("conv_id") == F.col("e_conv")) & (F.col("turn") == F.col("e_turn")), "left"
    ).select(
        F.col("conv_id").alias("thread"),
        call_id(F.col("turn")).alias("call_id"),
        F.when(follows, "follow").otherwise("open").alias("tool"),
        arguments.alias("arguments"),
        F.col("after").alias("needs"),
    )
    results = turns.where(role == "assistant").select(
        F.col("conv_id").alias("thread"),
        call_id(F.col("turn") - 1).alias("call_id"),
        F.col("turn").alias("position"),
        F.col("text").alias("content"),
    )
    messages = turns.where(~role.isin("user", "assistant")).select(
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("position"),
        F.lit("message").alias("status"),
        F.to_json(F.struct(F.col("text").alias("content"), F.col("role")), whole).alias("json"),
    )
    return calls, results, messages


def formatted_turns(spark: SparkSession, turns: DataFrame, schemas: Schemas = TURN_SCHEMAS) -> DataFrame:
    """Every turn of the conversations: linked calls and results, and messages as they are."""
    calls, results, messages = conversation_calls(turns)
    return linked_calls(spark, calls, results, schemas).unionByName(messages, allowMissingColumns=True)
