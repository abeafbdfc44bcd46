"""Tool-call linking for chat data, in DataFrame operations only.

Calls and results are joined by their identifier within a conversation. Calls
are put in an order in which each comes after all calls it depends on: its level
is the length of the longest chain of dependencies below it, found level by
level. Arguments are checked against the tools' schemas, and each call with its
result is written as canonical JSON: keys sorted at every depth, no spaces.

Defined cases, all named in ``problems``: a call whose id is null is linked to
nothing (``no id``); of several calls with one id the smallest by turn, name and
arguments is used (``repeated id``), likewise for results (``repeated result``);
results without a call are rows without a name (``result without call``).
Dependencies on unknown calls are left out (``unknown dependency``); calls on a
cycle, or behind one, have no level and come last (``cycle``). Arguments that are
null or aren't a JSON object are ``invalid arguments`` and written as null. A null
conversation is one of its own. Other columns are not looked at; empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import stored
from driftline.operators.scale import running_total

MAX_SCHEMA_ROWS = 100_000


class Parameter(NamedTuple):
    tool: str
    name: str
    kind: str  # string, integer, number, boolean, object or array
    required: bool


def _schemas(spark, parameters: Iterable[Parameter]) -> DataFrame:
    """One row per tool with its parameters; bounded, so that it may be broadcast."""
    rows = list(parameters)
    if len(rows) > MAX_SCHEMA_ROWS:
        raise ValueError(f"{len(rows)} parameters are too many to broadcast")
    table = spark.createDataFrame(rows, "tool string, name string, kind string, required boolean")
    return table.groupBy(F.col("tool").alias("name")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("name").alias("param"), "kind", "required"))).alias(
            "params"
        )
    )


def _kind(value: Column) -> Column:
    """The JSON type of a variant."""
    is_a = F.schema_of_variant(value)
    return (
        F.when(is_a.startswith("OBJECT"), "object")
        .when(is_a.startswith("ARRAY"), "array")
        .when(is_a.startswith("DECIMAL") | is_a.isin("DOUBLE", "FLOAT"), "number")
        .when(is_a == "BIGINT", "integer")
        .when(is_a == "VOID", "null")
        .otherwise(F.lower(is_a))
    )


def _argument_problems(given: Column, params: Column) -> Column:
    """Problems of a map of variants, sorted; ``params`` null: the tool is unknown."""

    def of_param(p: Column) -> Column:
        value = F.get(F.map_values(F.map_filter(given, lambda k, _: k == p["param"])), F.lit(0))
        kind = _kind(value)
        fits = (kind == p["kind"]) | ((p["kind"] == "number") & (kind == "integer"))
        return F.when(
            value.isNull(), F.when(p["required"], F.concat(F.lit("missing "), p["param"]))
        ).when(~fits, F.concat(F.lit("wrong type "), p["param"]))

    known = F.transform(params, lambda p: p["param"])
    extra = F.transform(
        F.array_except(F.map_keys(given), known), lambda k: F.concat(F.lit("unexpected "), k)
    )
    found = F.array_compact(F.concat(F.transform(params, of_param), extra))
    return (
        F.when(params.isNull(), F.array(F.lit("unknown tool")))
        .when(given.isNull(), F.array(F.lit("invalid arguments")))
        .otherwise(F.sort_array(found))
    )


def _unique(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    # Calls without an id are told apart by their content.
    alone = F.when(F.col("call_id").isNull(), F.to_json(F.struct("turn", "name", "arguments")))
    told = F.struct("turn", "name", "arguments", F.array_sort("after").alias("after"))
    one_call = (
        calls.groupBy("conv_id", "call_id", alone.alias("alone"))
        .agg(F.min(told).alias("c"), F.count("*").alias("given"))
        .select("conv_id", "call_id", "c.*", "given")
    )
    one_result = (
        results.where("call_id IS NOT NULL")
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("answers"))
        .select(
            "conv_id",
            "call_id",
            F.col("r.turn").alias("result_turn"),
            F.col("r.content").alias("result"),
            "answers",
        )
    )
    return stored(one_call, "calls"), one_result


def _same(a: str, b: str, *ids: tuple[str, str]) -> Column:
    match = F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    for left, right in ids:
        match = match & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))
    return match


def levels(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id``, ``call_id``, ``level`` of the calls that depend on others and
    can be ordered; and those that name unknown calls."""
    named = calls.where("call_id IS NOT NULL")
    wanted = named.select(
        "conv_id", "call_id", F.explode(F.array_distinct("after")).alias("before")
    ).where("before IS NOT NULL")
    known = named.select("conv_id", "call_id")
    met = _same("e", "k", ("before", "call_id"))
    unknown = wanted.alias("e").join(known.alias("k"), met, "left_anti")
    edges = stored(wanted.alias("e").join(known.alias("k"), met, "left_semi"), "edges")
    waiting = stored(edges.select("conv_id", "call_id").distinct(), "waiting")
    settled = known.alias("k").join(
        waiting.alias("w"), _same("k", "w", ("call_id", "call_id")), "left_anti"
    )
    found = []
    while not waiting.isEmpty():
        edges = stored(
            edges.alias("e").join(
                settled.alias("s"), _same("e", "s", ("before", "call_id")), "left_anti"
            ),
            "edges",
        )
        still = stored(edges.select("conv_id", "call_id").distinct(), "waiting")
        settled = stored(
            waiting.alias("w").join(
                still.alias("s"), _same("w", "s", ("call_id", "call_id")), "left_anti"
            ),
            "settled",
        )
        if settled.isEmpty():
            break  # what waits now is on a cycle, or behind one
        found.append(settled.withColumn("level", F.lit(len(found) + 1)))
        waiting = still
    spark = calls.sparkSession
    ordered = spark.createDataFrame([], known.schema).withColumn("level", F.lit(0))
    for part in found:
        ordered = ordered.unionByName(part)
    if not waiting.isEmpty():
        ordered = ordered.unionByName(
            waiting.withColumn("level", F.lit(-1))  # never settled
        )
    return ordered, unknown.select("conv_id", "call_id").distinct()


def link(calls: DataFrame, results: DataFrame, parameters: Iterable[Parameter]) -> DataFrame:
    """One row per call, and per result without one: ``conv_id``, ``call_id``,
    ``name``, ``turn``, ``result_turn``, ``level``, ``position`` (from 1 within the
    conversation, dependencies first), ``valid``, ``problems`` and ``message``.

    ``calls`` has ``conv_id``, ``call_id``, ``turn``, ``name``, ``arguments`` (JSON)
    and ``after`` (ids of calls); ``results`` has ``conv_id``, ``call_id``, ``turn``
    and ``content``.
    """
    one_call, one_result = _unique(calls, results)
    ordered, unknown = levels(one_call)
    marks = ordered.unionByName(
        unknown.withColumn("level", F.lit(None).cast("int"))
    ).groupBy("conv_id", "call_id").agg(
        F.max("level").alias("level"), F.max(F.col("level").isNull()).alias("astray")
    )
    joined = (
        one_call.alias("c")
        .join(one_result.alias("r"), _same("c", "r", ("call_id", "call_id")), "full_outer")
        .select(
            F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"),
            F.coalesce("c.call_id", "r.call_id").alias("call_id"),
            "c.turn", "c.name", "c.arguments", "c.given",
            "r.result_turn", "r.result", "r.answers",
        )
        .alias("j")
        .join(marks.alias("m"), _same("j", "m", ("call_id", "call_id")), "left")
        .select("j.*", "m.level", "m.astray")
    )
    checked = joined.join(
        F.broadcast(_schemas(calls.sparkSession, parameters)), "name", "left"
    ).withColumn("parsed", F.try_parse_json("arguments"))
    given = F.expr("try_cast(parsed AS map<string, variant>)")
    is_call = F.col("given").isNotNull()
    cyclic = F.coalesce(F.col("level") < 0, F.lit(False))
    flags = F.array_compact(
        F.array(
            F.when(~is_call, F.lit("result without call")),
            F.when(is_call & F.col("call_id").isNull(), F.lit("no id")),
            F.when(F.col("given") > 1, F.lit("repeated id")),
            F.when(F.col("answers") > 1, F.lit("repeated result")),
            F.when(is_call & F.col("answers").isNull(), F.lit("no result")),
            F.when(F.coalesce("astray", F.lit(False)), F.lit("unknown dependency")),
            F.when(cyclic, F.lit("cycle")),
        )
    )
    argued = F.when(is_call, _argument_problems(given, F.col("params"))).otherwise(
        F.array().cast("array<string>")
    )
    message = F.to_json(
        F.struct(
            F.when(given.isNotNull(), F.col("parsed")).alias("arguments"),
            "call_id",
            "name",
            "result",
        ),
        {"ignoreNullFields": "false"},
    )
    rows = checked.select(
        "conv_id",
        "call_id",
        "name",
        "turn",
        "result_turn",
        F.when(is_call & ~cyclic, F.coalesce("level", F.lit(0))).alias("level"),
        argued.alias("argued"),
        flags.alias("flags"),
        message.alias("message"),
    )
    rows = stored(rows, "linked")
    order = [
        F.col("level").asc_nulls_last(),
        F.coalesce("turn", "result_turn").asc_nulls_last(),
        F.col("call_id").asc_nulls_last(),
        F.col("message"),
    ]
    placed = running_total(rows, ["conv_id"], order, F.lit(1).cast("long"), "position")
    return placed.select(
        "conv_id",
        "call_id",
        "name",
        "turn",
        "result_turn",
        "level",
        "position",
        (F.col("name").isNotNull() & (F.size("argued") == 0)).alias("valid"),
        F.concat("argued", "flags").alias("problems"),
        "message",
    )
