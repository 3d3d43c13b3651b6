"""Tool-call linking for chat data, with DataFrame operations only.

Calls and results are joined by their identifier, calls are put in topological
order of all that they wait for, arguments are checked against the schema of their
tool, and every link becomes one line of canonical JSON (keys sorted, no white
space). The i-th call of an identifier meets its i-th result; the numbers come
from runs of a range partitioning, so that no identifier, however frequent,
brings its rows together in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored
from cartwheel.llm.mixing import running

# Schema types and the variant types that satisfy them.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}

Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]


def argument_errors(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with JSON ``arguments`` under ``schemas[tool][parameter] = (type, required)``, as sorted texts."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    per_tool = F.when(F.coalesce(~tool.isin(list(schemas)), F.lit(True)), F.array(F.lit("unknown tool")))
    per_tool = per_tool.when(~is_object, F.array(F.lit("arguments are no JSON object")))
    for name, parameters in schemas.items():
        found = []
        for parameter, (kind, required) in sorted(parameters.items()):
            at = F.try_variant_get(value, f"$.{parameter}", "variant")
            has = F.schema_of_variant(at)
            missing = at.isNull() | (has == "VOID")
            fits = F.regexp_extract(has, r"^[A-Z]+", 0).isin(*TYPES[kind])
            wrong = F.when(~missing & ~fits, F.lit(f"{parameter}: not of type {kind}"))
            found.append(F.when(missing, F.lit(f"{parameter}: missing")).otherwise(wrong) if required else wrong)
        extra = F.transform(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(p) for p in sorted(parameters)])), lambda k: F.concat(k, F.lit(": not in the schema")))
        per_tool = per_tool.when(tool == name, F.sort_array(F.concat(F.array_compact(F.array(*found)), F.coalesce(extra, F.array()))))
    return per_tool


def chains(nodes: DataFrame, single: DataFrame) -> DataFrame:
    """``call_id, anchor, step``: where the chain of single dependencies behind a call ends, and how many steps before.

    ``nodes`` are the call ids, ``single`` the only edges of their calls. Both are null
    in and behind a cycle. Pointer doubling takes log2(longest chain) rounds, each an equi-join on ids.
    """
    up = single.select(F.col("call_id").alias("edge_id"), F.col("after_id").alias("up"))
    state = nodes.join(up, F.col("call_id") == F.col("edge_id"), "left")
    state = state.select("call_id", "up", F.when(F.col("up").isNull(), F.col("call_id")).alias("anchor"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("step"))
    state = stored(state, "call-steps")
    rounds = math.ceil(math.log2(max(2, state.count()))) + 1
    for _ in range(rounds):
        if state.filter("up is not null").isEmpty():
            break
        above = state.select(F.col("call_id").alias("above_id"), F.col("up").alias("above_up"), F.col("anchor").alias("above_anchor"), F.col("step").alias("above_step"))
        state = state.join(above, F.col("up") == F.col("above_id"), "left")
        state = state.select("call_id", F.col("above_up").alias("up"), F.coalesce("anchor", "above_anchor").alias("anchor"), (F.col("step") + F.coalesce("above_step", F.lit(0))).alias("step"))
        state = stored(state, "call-steps")
    return state.select("call_id", "anchor", F.when(F.col("up").isNull(), F.col("step")).alias("step"))


def junction_steps(edges: DataFrame) -> DataFrame:
    """``call_id, step`` of the calls with several dependencies, from ``call_id, anchor, length``; those in or behind a cycle are missing.

    ``length`` is the number of steps from the anchor on. Level by level: a round
    settles the calls all of whose anchors are settled; anchors that are no such calls are at 0.
    """
    ids = edges.select(F.col("call_id").alias("junction_id")).distinct()
    edges = edges.join(ids, F.col("anchor") == F.col("junction_id"), "left")
    value = F.when(F.col("anchor").isNotNull() & F.col("junction_id").isNull(), F.col("length"))
    edges = stored(edges.select("call_id", "anchor", "length", value.alias("value")), "call-levels")
    settled = None
    while True:
        ready = edges.groupBy("call_id").agg(F.max("value").alias("step"), F.count("*").alias("n"), F.count("value").alias("known")).filter("n = known").select("call_id", "step")
        ready = stored(ready, "call-ready")
        settled = ready if settled is None else settled.unionByName(ready)
        if ready.isEmpty():
            return settled
        edges = edges.join(ready.select(F.col("call_id").alias("own_id")), F.col("call_id") == F.col("own_id"), "left_anti")
        edges = edges.join(ready.select(F.col("call_id").alias("ready_id"), F.col("step").alias("ready_step")), F.col("anchor") == F.col("ready_id"), "left")
        edges = edges.select("call_id", "anchor", "length", F.coalesce("value", F.col("ready_step") + F.col("length")).alias("value"))
        edges = stored(edges, "call-levels")


def call_steps(calls: DataFrame, dependencies: DataFrame | None = None) -> DataFrame:
    """``call_id, step``: the length of the longest way of dependencies to a call, null within and behind a cycle.

    ``calls``: ``call_id`` (each once) and ``after_id``, a call it waits for or null;
    ``dependencies``: edges ``call_id, after_id`` for calls that wait for several. A
    call that isn't there is not waited for, and edges of calls that aren't there
    and repeated or null ones count for nothing. Calls with one dependency are taken
    as chains by pointer doubling; the graph that is left, of the calls with several, is
    settled level by level.
    """
    nodes = calls.select("call_id")
    edges = calls.select("call_id", "after_id")
    if dependencies is not None:
        edges = edges.unionByName(dependencies.select("call_id", "after_id")).join(nodes, "call_id", "left_semi")
    edges = edges.join(nodes.select(F.col("call_id").alias("after_id")), "after_id", "left_semi").select("call_id", "after_id")
    if dependencies is None:
        return chains(nodes, edges).select("call_id", "step")
    edges = stored(edges.distinct(), "call-edges")
    several = edges.groupBy("call_id").count().filter("count > 1").select("call_id")
    several = stored(several, "call-junctions")
    chained = chains(nodes, edges.join(several, "call_id", "left_anti"))
    after = chained.select(F.col("call_id").alias("after_id"), "anchor", (F.col("step") + 1).alias("length"))
    levels = junction_steps(edges.join(several, "call_id", "left_semi").join(after, "after_id").select("call_id", "anchor", "length"))
    levels = levels.select(F.col("call_id").alias("level_id"), F.col("step").alias("level"))
    found = chained.join(levels, F.col("anchor") == F.col("level_id"), "left").join(several.select(F.col("call_id").alias("several_id")), F.col("anchor") == F.col("several_id"), "left")
    return found.select("call_id", F.when(F.col("several_id").isNull(), F.col("step")).otherwise(F.col("step") + F.col("level")).alias("step"))


def numbered(rows: DataFrame, order: list[str], text: str) -> DataFrame:
    """``rows`` with a non-null ``call_id`` and ``nth``: their number from 0 within it, by ``order``, the start of ``text`` and its hash."""
    by = [*order, "_start", "_hash", "_tie"]
    rows = rows.filter("call_id is not null").withColumns({"_start": F.left(F.col(text), F.lit(64)), "_hash": F.xxhash64(text), "_tie": F.monotonically_increasing_id()})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartitionByRange(parts, "call_id", *by).withColumn("_run", F.spark_partition_id())
    runs = stored(runs, "chat-runs")
    return running(runs, "call_id", "_run", [F.col(c) for c in by], F.lit(1).cast("long"), "nth").drop("_run", "_start", "_hash", "_tie")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas, each_null: bool = False, dependencies: DataFrame | None = None, messages: DataFrame | None = None) -> DataFrame:
    """One row per call, per result without one and per message: ``call_id, tool, status, step, n_calls, n_results, errors, json``.

    calls: ``call_id, position, after_id, tool, arguments`` (JSON text); results:
    ``call_id, position, content``; dependencies: edges ``call_id, after_id`` beside
    the calls' own ``after_id``, for calls that wait for several; messages: ``call_id,
    content`` of turns that are neither call nor result, which are linked with nothing
    and come out one by one as ``message``, at step 0, as they wait for no call. status is else ``linked``, ``pending`` (no
    result) or ``orphan`` (no call), with ``/cycle`` appended where the call has
    no topological position. Of rows that repeat an identifier the i-th call
    and the i-th result by position are linked (at one position by text) and
    what is left over is pending or orphan; n_calls and n_results tell how many
    the identifier has. A call that waits for a repeated identifier waits for
    its first call. Null identifiers can't be linked and are left out of the
    join; with ``each_null`` every such row comes out as pending or orphan,
    without it they come out as one pending and one orphan row with their
    numbers. A null tool is unknown; null arguments are no
    object; arguments that are no JSON (or repeat a key, or are beyond Spark's size
    limit of a variant) are no object either and stand in the JSON as the text that
    they are. Numbers of more than 38 digits are written as doubles. Further columns are ignored;
    empty tables give no rows. Order by (step, call_id) runs every call after
    those it waits for.
    """
    calls = calls.select("call_id", "position", "after_id", "tool", "arguments")
    results = results.select("call_id", "position", "content")
    named = stored(numbered(calls, ["position", "after_id", "tool"], "arguments"), "calls")
    answers = stored(numbered(results, ["position"], "content"), "results")
    steps = call_steps(named.filter("nth = 0").select("call_id", "after_id"), dependencies).select(F.col("call_id").alias("step_id"), F.col("step").alias("step_before"))
    step = F.when(F.col("step_id").isNull(), F.lit(0)).otherwise(F.col("step_before") + 1).cast("long")
    placed = named.join(steps, F.col("after_id") == F.col("step_id"), "left")
    if dependencies is not None:
        others = dependencies.select(F.col("call_id").alias("edge_id"), F.col("after_id").alias("edge_after")).join(steps, F.col("edge_after") == F.col("step_id"))
        others = others.groupBy("edge_id").agg(F.max("step_before").alias("edge_step"), F.bool_or(F.col("step_before").isNull()).alias("edge_cycle"))
        placed = placed.join(others, F.col("call_id") == F.col("edge_id"), "left")
        step = F.when(F.col("edge_id").isNull(), step).when(~F.col("edge_cycle") & step.isNotNull(), F.greatest(step, F.col("edge_step") + 1))
    placed = placed.select("call_id", "nth", "tool", "arguments", step.alias("step"), F.lit(True).alias("is_call"))
    answers_by = answers.select(F.col("call_id").alias("result_id"), F.col("nth").alias("result_nth"), "content", F.lit(True).alias("is_result"))
    both = placed.join(answers_by, (F.col("call_id") == F.col("result_id")) & (F.col("nth") == F.col("result_nth")), "full")
    both = both.withColumn("call_id", F.coalesce("call_id", "result_id"))
    counts = named.select("call_id", F.lit(1).alias("c"), F.lit(0).alias("r")).unionByName(answers.select("call_id", F.lit(0).alias("c"), F.lit(1).alias("r")))
    counts = counts.groupBy(F.col("call_id").alias("count_id")).agg(F.sum("c").alias("n_calls"), F.sum("r").alias("n_results"))
    shape = ["call_id", "nth", "tool", "arguments", "step", "is_call", "is_result", "content", "n_calls", "n_results"]
    both = both.join(counts, F.col("call_id") == F.col("count_id"), "left").select(*shape)
    lost_calls, lost_results = calls.filter("call_id is null"), results.filter("call_id is null")
    if each_null:
        lost_calls = lost_calls.withColumn("n", F.lit(1).cast("long"))
        lost_results = lost_results.withColumn("n", F.lit(1).cast("long"))
    else:
        lost_calls = lost_calls.groupBy("call_id").agg(F.min(F.struct("position", "after_id", "tool", "arguments")).alias("x"), F.count("*").alias("n")).select("call_id", "x.*", "n")
        lost_results = lost_results.groupBy("call_id").agg(F.min(F.struct("position", "content")).alias("x"), F.count("*").alias("n")).select("call_id", "x.*", "n")
    lost_calls = lost_calls.select("call_id", "tool", "arguments", F.lit(True).alias("is_call"), F.col("n").alias("n_calls"))
    lost_results = lost_results.select("call_id", "content", F.lit(True).alias("is_result"), F.col("n").alias("n_results"))
    both = both.unionByName(lost_calls, allowMissingColumns=True).unionByName(lost_results, allowMissingColumns=True)
    is_message = F.lit(False)
    if messages is not None:
        both = both.unionByName(messages.select("call_id", "content", F.lit(0).cast("long").alias("step"), F.lit(True).alias("is_message")), allowMissingColumns=True)
        is_message = F.col("is_message").isNotNull()
    is_call, is_result = F.col("is_call").isNotNull(), F.col("is_result").isNotNull()
    status = F.when(is_message, "message").when(is_call & is_result, "linked").when(is_call, "pending").otherwise("orphan")
    status = F.concat(status, F.when(is_call & F.col("call_id").isNotNull() & F.col("step").isNull(), "/cycle").otherwise(""))
    rows = both.select(
        "call_id",
        "tool",
        status.alias("status"),
        "step",
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.when(is_call, argument_errors(F.col("tool"), F.col("arguments"), schemas)).otherwise(F.array().cast("array<string>")).alias("errors"),
        "arguments",
        "content",
    )
    # a parsed variant keeps the keys of every object sorted; the other keys are written in order
    raw = F.to_json(F.struct(F.col("arguments").alias("a")))  # {"a":"..."}
    raw = F.when(F.col("arguments").isNotNull(), F.substring(raw, F.lit(6), F.length(raw) - 6))
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), raw, F.lit("null"))
    rest = F.to_json(F.struct("call_id", "errors", F.col("content").alias("result"), "status", "step", "tool"), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"arguments":'), arguments, F.lit(","), F.substring(rest, 2, 2**31 - 2))
    return rows.select("call_id", "tool", "status", "step", "n_calls", "n_results", "errors", text.alias("json"))
