"""Tool calls of conversations linked to their results, ordered, validated and written as canonical JSON.

DataFrame operations only. Calls that depend on one other call form chains and trees; the depth of a call in
them is found by doubling the distance that a pointer skips. Calls that depend on several cut the graph into
such chains, and are ordered in rounds.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.llm.components import written

#: Up to so many ids that different calls share are sent to every task.
BROADCAST_IDS = 100_000
#: Kind of a parameter -> what schema_of_variant calls values of that kind.
KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",)}


def problems(name: Column, arguments: Column, schemas: dict[str, dict[str, dict]]) -> Column:
    """What is wrong with a call, as a sorted array of strings; an empty one if nothing is.

    `schemas` has for each tool its parameters: {"kind": ..., "required": bool, "least": number, "most": number,
    "longest": characters}. `arguments` is a variant, null where the text was no JSON object.
    """
    known = reduce(lambda a, b: a | b, [name == tool for tool in schemas], F.lit(False))
    found = [F.when(~F.coalesce(known, F.lit(False)), F.lit("unknown tool")), F.when(arguments.isNull(), F.lit("arguments are no object"))]
    for tool, parameters in schemas.items():
        for parameter, rule in parameters.items():
            value = F.try_variant_get(arguments, f"$.{parameter}", "variant")
            kind = F.regexp_extract(F.schema_of_variant(value), r"^(\w+)", 1)
            checks = []
            if rule.get("required"):
                checks.append((value.isNull() | (kind == "VOID"), "missing"))
            checks.append((value.isNotNull() & ~kind.isin("VOID", *KINDS[rule["kind"]]), "no " + rule["kind"]))
            number = F.try_variant_get(arguments, f"$.{parameter}", "double")
            if "least" in rule:
                checks.append((number < rule["least"], "too small"))
            if "most" in rule:
                checks.append((number > rule["most"], "too large"))
            if "longest" in rule:
                checks.append((F.length(F.try_variant_get(arguments, f"$.{parameter}", "string")) > rule["longest"], "too long"))
            found += [F.when((name == tool) & arguments.isNotNull() & test, F.lit(f"{parameter}: {text}")) for test, text in checks]
    return F.array_sort(F.array_compact(F.array(*found)))


def call_depths(calls: DataFrame, needs: DataFrame | None = None) -> DataFrame:
    """(call_id, depth) for calls with distinct ids: 0 for one that depends on no call there is, else one
    more than the greatest of those it depends on; null on a circle and after one.

    A call depends on its `depends_on`, and on those that `needs` (call_id, depends_on) has for it, if given.
    Repeated and null dependencies and those on or of calls that are not there count for nothing.
    """
    edges = calls.select("call_id", F.col("depends_on").alias("to"))
    several = None
    if needs is not None:
        own = calls.select("call_id")
        edges = edges.union(needs.select(F.col("call_id").cast("string"), F.col("depends_on").cast("string")).join(own, "call_id", "left_semi"))
        edges = edges.join(own.select(F.col("call_id").alias("to")), "to", "left_semi").select("call_id", "to").distinct()
        edges = written(edges, "dependencies")
        counted = edges.groupBy("call_id").agg(F.min("to").alias("to"), F.count("*").alias("n"))
        several = edges.join(counted.filter("n > 1").select("call_id"), "call_id", "left_semi")
        several = written(several, "several") if several.limit(1).count() else None
        # Chains and trees end where a call has several dependencies.
        state = own.join(counted.filter("n = 1").select("call_id", "to"), "call_id", "left").withColumn("there", F.col("to").isNotNull())
    else:
        ids = calls.select(F.col("call_id").alias("to"), F.lit(True).alias("there"))
        state = edges.join(ids, "to", "left")
    there = F.col("there").eqNullSafe(True)
    state = state.select("call_id", F.when(there, F.col("to")).alias("to"), F.when(there, 1).otherwise(0).alias("depth"), F.when(~there, F.col("call_id")).alias("end"))
    state = written(state if several is not None else state.drop("end"), "depths")
    # After so many rounds the pointer of every call that is on no circle has come to its end.
    for _ in range(math.ceil(math.log2(max(2, state.count()))) + 1):
        if not state.filter("to is not null").limit(1).count():
            break
        ahead = state.select(F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"), *([F.col("end").alias("last")] if several is not None else []))
        ends = [F.coalesce("end", "last").alias("end")] if several is not None else []
        state = state.join(ahead, "to", "left").select("call_id", F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), *ends)
        state = written(state, "depths")
    depth = F.when(F.col("to").isNull(), F.col("depth"))
    if several is None:
        return state.select("call_id", depth.alias("depth"))
    levels = _levels(several, state.select("call_id", depth.alias("depth"), F.when(F.col("to").isNull(), F.col("end")).alias("end")))
    meets = several.select(F.col("call_id").alias("end"), F.lit(True).alias("meets")).distinct()
    # A chain that ends at a call without dependencies counts from there.
    level = F.when(F.col("meets"), F.col("level")).otherwise(0)
    return state.join(meets, "end", "left").join(levels.withColumnRenamed("call_id", "end"), "end", "left").select("call_id", (depth + level).alias("depth"))


def _levels(several: DataFrame, chains: DataFrame) -> DataFrame:
    """(call_id, level): depths of calls with several dependencies, in rounds of those of which all are known.

    `several` has their dependencies, `chains` for every call its distance from the `end` of its chain. There are
    as many rounds as such calls lie on one path; each writes only what is still open.
    """
    meets = several.select(F.col("call_id").alias("end"), F.lit(True).alias("meets")).distinct()
    open_ = several.join(chains.withColumnsRenamed({"call_id": "to"}), "to").join(meets, "end", "left")
    known = F.when(F.col("end").isNotNull() & F.col("meets").isNull(), F.col("depth") + 1)
    open_ = written(open_.select("call_id", "end", "depth", known.alias("level")), "open")
    found = []
    while True:
        ready = open_.groupBy("call_id").agg(F.max("level").alias("level"), F.count_if(F.col("level").isNull()).alias("unknown")).filter("unknown = 0")
        ready = written(ready.select("call_id", "level"), "levels")
        found.append(ready)
        if not ready.limit(1).count():
            return reduce(DataFrame.union, found)
        of_end = ready.select(F.col("call_id").alias("end"), F.col("level").alias("at"))
        rest = open_.join(ready.select("call_id"), "call_id", "left_anti").join(of_end, "end", "left")
        open_ = written(rest.select("call_id", "end", "depth", F.coalesce("level", F.col("at") + F.col("depth") + 1).alias("level")), "open")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, dict]], needs: DataFrame | None = None) -> DataFrame:
    """Every call with each of its results, as canonical JSON.

    `calls` has call_id, name, arguments (JSON text) and depends_on (a call_id or null), `results` has call_id,
    place (any orderable value) and content. Gives call_id, name, place, depth, n_problems, problems and
    message: compact JSON with keys in order, {"arguments", "content", "id", "name", "valid"}, nulls as
    null, arguments that are no JSON object as null. A call without a name is one of an unknown tool.

    A call without a result has one row with a null place; a result without a call has one with a null
    name, and so have rows with a null id. Of different calls with equal ids the one with the smallest (name,
    arguments, depends_on) is linked to all results of that id and counts for those that depend on it; each
    of the others has one row without place and depth, and `id of another call` among its problems. Calls
    that repeat all three are one. Equal results stay apart. `needs` (call_id, depends_on) has further
    dependencies, any number for a call; see call_depths.
    Ordered by depth, over the whole output, no call comes before one it depends on; rows of a partition are
    in that order. Other columns are not read.
    """
    calls = calls.select("call_id", F.struct("name", "arguments", "depends_on").alias("call"))
    first = calls.filter("call_id is not null").groupBy("call_id").agg(F.min("call").alias("call"), F.max("call").alias("last"))
    first = written(first.unionByName(calls.filter("call_id is null"), allowMissingColumns=True), "calls")
    given = first.select("call_id", "call.*")
    named = given.filter("call_id is not null")
    shared = first.filter("call_id is not null and not call <=> last").select("call_id", F.col("call").alias("chosen"))
    shared = F.broadcast(shared) if shared.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else shared
    others = calls.join(shared, "call_id").filter("not call <=> chosen").select("call_id", "call").distinct().select("call_id", "call.name", "call.arguments")
    depths = call_depths(named, needs)
    placed = named.join(depths.hint("shuffle_hash"), "call_id").select("call_id", "name", "arguments", "depth", F.lit(True).alias("is_call"))
    results = results.select("call_id", "place", "content")
    answered = results.join(placed.hint("shuffle_hash"), "call_id", "left")
    rest = placed.drop("is_call").join(results.select("call_id").distinct(), "call_id", "left_anti").union(
        given.filter("call_id is null").select("call_id", "name", "arguments", F.lit(0).alias("depth"))
    ).withColumns({"is_call": F.lit(True), "is_other": F.lit(False)})
    rest = rest.unionByName(others.withColumns({"is_call": F.lit(True), "is_other": F.lit(True)}), allowMissingColumns=True)
    columns = ["call_id", "name", "arguments", "depth", "place", "content", "is_call"]
    linked = answered.select(*columns).unionByName(rest, allowMissingColumns=True)
    parsed = F.try_parse_json("arguments")
    linked = linked.withColumn("__arguments", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))
    found = F.when(F.col("is_call"), problems(F.col("name"), F.col("__arguments"), schemas))
    linked = linked.withColumn("problems", F.when(F.col("is_other"), F.array_append(found, F.lit("id of another call"))).otherwise(found))
    text = lambda c: F.coalesce(F.expr(f"substring(to_json(named_struct('v', {c})), 6, length(to_json(named_struct('v', {c}))) - 6)"), F.lit("null"))
    quoted = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(text(c))
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("__arguments"), F.lit("null")),
        F.lit(',"content":'), quoted("content"), F.lit(',"id":'), quoted("call_id"), F.lit(',"name":'), quoted("name"),
        F.lit(',"valid":'), F.coalesce((F.size("problems") == 0).cast("string"), F.lit("null")), F.lit("}"),
    )
    return linked.select(
        "call_id", "name", "place", "depth", F.size("problems").alias("n_problems"), F.array_join("problems", "; ").alias("problems"), message.alias("message")
    ).sortWithinPartitions("depth", "call_id", "place")
