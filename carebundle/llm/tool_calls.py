"""Tool-call linking for chat formatting; built-in functions only.

Calls and results meet in a hash join by conversation and identifier.  Calls are put in a topological order of their
dependencies: where every dependency stands before its call, the order of the transcript is one already, which one
join shows; only conversations with a dependency that stands behind are peeled level by level.  Arguments are
validated against the parameters of their tool, and each call is serialised as canonical JSON: keys sorted at every
level, no white space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.llm.common import null_safe, stored, table
from carebundle.operators.copies import write_copies
from carebundle.sources.literal import literal_frame

CALL_COLUMNS = "conv_id bigint, position bigint, call_id string, name string, arguments string, depends_on array<string>"
RESULT_COLUMNS = "conv_id bigint, position bigint, call_id string, content string"
# JSON types of parameters and what a variant calls them.
TYPES = {
    "string": r"STRING",
    "integer": r"BIGINT",
    "number": r"BIGINT|DECIMAL.*|DOUBLE|FLOAT",
    "boolean": r"BOOLEAN",
    "object": r"OBJECT.*",
    "array": r"ARRAY.*",
    "null": r"VOID",
}


def json_text(text: Column) -> Column:
    """A text as a JSON string, or null as JSON."""
    inside = F.to_json(F.array(text))
    return F.coalesce(F.substring(inside, F.lit(2), F.length(inside) - 2), F.lit("null"))


def canonical(json: Column) -> Column:
    """JSON with sorted keys and without white space; null if it is not JSON (or names a key twice)."""
    return F.to_json(F.try_parse_json(json))


def first_of_each(frame: DataFrame, value: list[str]) -> DataFrame:
    """The earliest row of each (conv_id, call_id), of equal positions the smallest, and the number of its rows."""
    best = F.min(F.struct("position", *value)).alias("best")
    grouped = frame.where("call_id is not null").groupBy("conv_id", "call_id").agg(best, F.count(F.lit(1)).alias("copies"))
    return grouped.select("conv_id", "call_id", "best.*", "copies")


def call_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, ordered): calls sorted by level and position are in topological order.

    Level 0 holds all calls of a conversation whose dependencies stand before them.  In other conversations it is the
    length of the longest chain of dependencies; calls in a cycle, or behind one, have no level and ``ordered`` is false.
    Dependencies on calls that are not there do not count.
    """
    spark = calls.sparkSession
    nodes = calls.select("conv_id", "call_id", "position")
    wanted = calls.select("conv_id", "call_id", "position", F.explode(F.array_distinct("depends_on")).alias("needs"))
    held = nodes.select(F.col("conv_id").alias("c"), F.col("call_id").alias("needs"), F.col("position").alias("at"))
    edges = wanted.join(held.withColumnRenamed("needs", "n"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("needs") == F.col("n")))
    edges = stored(edges.select("conv_id", "call_id", "needs", (F.col("at") >= F.col("position")).alias("behind")), "call-edges")
    tangled = stored(edges.where("behind").select("conv_id").distinct(), "tangled-conversations")
    rest = nodes.join(tangled, null_safe(nodes, tangled, ["conv_id"]), "left_semi").select("conv_id", "call_id")
    links = edges.join(tangled, null_safe(edges, tangled, ["conv_id"]), "left_semi").select("conv_id", "call_id", "needs")
    rest, links = stored(rest, "call-rest"), stored(links, "call-links")
    done, level = [], 0
    key = ["conv_id", "call_id"]
    while not rest.isEmpty():
        waiting = links.select(*key).distinct()
        ready = stored(rest.join(waiting, null_safe(rest, waiting, key), "left_anti"), "call-level")
        if ready.isEmpty():
            break
        done.append(ready.withColumn("level", F.lit(level)).withColumn("ordered", F.lit(True)))
        met = ready.select(F.col("conv_id").alias("c"), F.col("call_id").alias("r"))
        links = stored(
            links.join(met, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("needs") == F.col("r")), "left_anti"), "call-links"
        )
        rest = stored(rest.join(ready, null_safe(rest, ready, key), "left_anti"), "call-rest")
        level += 1
    done.append(rest.withColumn("level", F.lit(None).cast("int")).withColumn("ordered", F.lit(False)))
    plain = nodes.join(tangled, null_safe(nodes, tangled, ["conv_id"]), "left_anti").select(*key)
    done.append(plain.withColumn("level", F.lit(0)).withColumn("ordered", F.lit(True)))
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "conv_id bigint, call_id string, level int, ordered boolean")


def _argument_errors(arguments: Column, parameters: Column) -> Column:
    """What is wrong with arguments (a variant), sorted: an entry for each missing, unknown or mistyped one."""
    given = F.try_variant_get(arguments, "$", "map<string,variant>")
    kind = lambda p: F.schema_of_variant(F.try_element_at(given, p["parameter"]))
    matches = lambda p: reduce(
        lambda found, item: F.when(p["type"] == item[0], kind(p).rlike(f"^(?:{item[1]})$")).otherwise(found),
        TYPES.items(),
        F.lit(True),
    )
    missing = F.transform(
        F.filter(parameters, lambda p: p["required"] & ~F.map_contains_key(given, p["parameter"])),
        lambda p: F.concat(F.lit("missing "), p["parameter"]),
    )
    mistyped = F.transform(
        F.filter(parameters, lambda p: F.map_contains_key(given, p["parameter"]) & ~matches(p)),
        lambda p: F.concat(F.lit("not "), p["type"], F.lit(": "), p["parameter"]),
    )
    unknown = F.transform(
        F.array_except(F.map_keys(given), F.transform(parameters, lambda p: p["parameter"])),
        lambda name: F.concat(F.lit("unknown "), name),
    )
    return (
        F.when(arguments.isNull(), F.array(F.lit("not JSON")))
        .when(given.isNull(), F.array(F.lit("not an object")))
        .otherwise(F.array_sort(F.concat(missing, mistyped, unknown)))
    )


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, position, call_id, name, level, ordered, repeated, answered, result_position, errors
    (array, empty if valid) and json.

    ``calls`` has :data:`CALL_COLUMNS`, ``results`` :data:`RESULT_COLUMNS`, ``schemas`` (name, parameter, type,
    required).  Of calls, and of results, with the same conversation and identifier the earliest counts (then the
    smallest content); every further row of such a call is ``repeated`` and neither answered nor ordered.  Null
    identifiers link with nothing.  A call of a tool without parameters in ``schemas`` has the error ``unknown tool``.
    Null arguments are not JSON; arguments that are not JSON are serialised as a text.  Rows sorted by conversation,
    level and position are the formatted transcript.  Empty tables give an empty result; other columns are dropped.
    """
    numbered = calls.select("conv_id", "position", "call_id", "name", "arguments", "depends_on")
    row = ["position", "name", "arguments", "depends_on"]
    unique = stored(first_of_each(numbered, row[1:]), "calls")
    key = ["conv_id", "call_id"]
    again = unique.where("copies > 1")
    extra = numbered.join(again.select(*key), null_safe(numbered, again, key), "left_semi").groupBy(*numbered.columns).agg(F.count(F.lit(1)).alias("n"))
    firsts = again.select(*numbered.columns).withColumn("own", F.lit(1))
    extra = extra.join(firsts, null_safe(extra, firsts, numbered.columns), "left").select(*[extra[c] for c in numbered.columns], (F.col("n") - F.coalesce("own", F.lit(0))).alias("n"))
    extra = write_copies(stored(extra.where("n > 0"), "repeated-calls"), "n", "copy").drop("copy")
    extra = extra.unionByName(numbered.where("call_id is null"))
    levels = call_levels(unique)
    answers = first_of_each(results, ["content"]).select(
        F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("position").alias("result_position"), "content"
    )
    linked = unique.drop("copies").join(levels.withColumnsRenamed({"conv_id": "lc", "call_id": "li"}), F.col("conv_id").eqNullSafe(F.col("lc")) & (F.col("call_id") == F.col("li")), "left")
    linked = linked.join(answers, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")), "left")
    linked = linked.select(*numbered.columns, "level", "ordered", F.lit(False).alias("repeated"), F.col("i").isNotNull().alias("answered"), "result_position", "content")
    rest = extra.select(
        *numbered.columns, F.lit(None).cast("int").alias("level"), F.lit(False).alias("ordered"), F.col("call_id").isNotNull().alias("repeated"),
        F.lit(False).alias("answered"), F.lit(None).cast("bigint").alias("result_position"), F.lit(None).cast("string").alias("content"),
    )
    tools = stored(
        schemas.groupBy("name").agg(F.collect_set(F.struct("parameter", "type", "required")).alias("parameters")), "tools"
    )
    rows = linked.unionByName(rest)
    rows = rows.join(tools.withColumnRenamed("name", "tool"), F.col("name") == F.col("tool"), "left")
    parsed = rows.withColumn("parsed", F.try_parse_json("arguments"))
    errors = F.when(F.col("tool").isNull(), F.array(F.lit("unknown tool"))).otherwise(
        _argument_errors(F.col("parsed"), F.col("parameters"))
    )
    json = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("parsed"), json_text(F.col("arguments"))),
        F.lit(',"id":'), json_text(F.col("call_id")),
        F.lit(',"name":'), json_text(F.col("name")),
        F.when(F.col("answered"), F.concat(F.lit(',"result":'), F.coalesce(canonical(F.col("content")), json_text(F.col("content"))))).otherwise(""),
        F.lit("}"),
    )
    return parsed.select(
        "conv_id", "position", "call_id", "name", "level", "ordered", "repeated", "answered", "result_position",
        errors.alias("errors"), json.alias("json"),
    )


def unlinked_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """The results that no row of :func:`link_tool_calls` has: conv_id, position, call_id, repeated, content.  A result of an
    answered call after the first is ``repeated``; the others have no call, or a null identifier.  One row per row."""
    key, row = ["conv_id", "call_id"], ["conv_id", "position", "call_id", "content"]
    counted = results.groupBy(*row).agg(F.count(F.lit(1)).alias("n"))
    firsts = first_of_each(results, ["content"]).select(*row, F.lit(1).alias("own"))
    known = calls.where("call_id is not null").select(*key).distinct().withColumn("known", F.lit(True))
    own = counted.join(firsts, null_safe(counted, firsts, row), "left").select(*(counted[name] for name in row), "n", "own")
    rows = own.join(known, null_safe(own, known, key), "left").select(*(own[name] for name in row), "n", "own", "known")
    repeated = F.coalesce("known", F.lit(False))
    left = F.col("n") - F.when(repeated, F.coalesce("own", F.lit(0))).otherwise(0)
    rows = stored(rows.select(*row, repeated.alias("repeated"), left.alias("n")).where("n > 0"), "unlinked-results")
    return write_copies(rows, "n", "copy").select("conv_id", "position", "call_id", "repeated", "content")


def transcript(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """The rows of :func:`link_tool_calls`, ``kind`` call, and those of :func:`unlinked_results`, ``kind`` result: nothing that was
    said is lost.  A result of its own has its position, no name, level and errors, and as json its identifier and
    content."""
    linked = link_tool_calls(calls, results, schemas).withColumn("kind", F.lit("call"))
    json = F.concat(
        F.lit('{"id":'), json_text(F.col("call_id")),
        F.lit(',"result":'), F.coalesce(canonical(F.col("content")), json_text(F.col("content"))), F.lit("}"),
    )
    alone = unlinked_results(calls, results).select("conv_id", "position", "call_id", "repeated", json.alias("json"), F.lit("result").alias("kind"))
    return linked.unionByName(alone, allowMissingColumns=True)


# --- The conversations table -------------------------------------------------------------------------------------

# The tools as which the turns of a plain conversation are seen.
TURN_TOOLS = [
    ("ask", "text", "string", True),
    ("ask", "turn", "integer", True),
    ("instruct", "text", "string", True),
    ("instruct", "turn", "integer", True),
]
_MESSAGE = (
    "struct<tool_calls:array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>,"
    "tool_call_id:string,content:string>"
)


def turn_tools(spark: SparkSession) -> DataFrame:
    schema = T.StructType.fromDDL("name string, parameter string, type string, required boolean")
    return literal_frame(spark, TURN_TOOLS, schema)


def calls_of_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in a table (conv_id, turn, role, text).

    A text that is JSON with ``tool_calls`` makes those calls, one with ``tool_call_id`` is a result.  Of other turns, a
    user's is a call ``ask``, a system's a call ``instruct``, both named by conversation and turn, with text and turn as
    arguments; each depends on the turn two before and the one before it.  An assistant's turn is the result of the
    turn before.  Turns without a number, and of other roles, are neither.
    """
    message = F.when(F.col("text").startswith("{"), F.from_json("text", _MESSAGE))
    rows = conversations.select("conv_id", F.col("turn").alias("position"), "role", "text", message.alias("message"))
    own = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("position") - back).cast("string"))
    is_call, is_result = F.col("message.tool_calls").isNotNull(), F.col("message.tool_call_id").isNotNull()
    made = rows.where(is_call).select("conv_id", "position", F.explode("message.tool_calls").alias("call"))
    made = made.select("conv_id", "position", F.col("call.id").alias("call_id"), "call.name", "call.arguments", "call.depends_on")
    plain = rows.where("position is not null and role is not null").where(~F.coalesce(is_call | is_result, F.lit(False)))
    asked = plain.where("role in ('user', 'system')").select(
        "conv_id", "position", own(0).alias("call_id"),
        F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("name"),
        F.concat(F.lit('{"turn":'), F.col("position").cast("string"), F.lit(',"text":'), json_text(F.col("text")), F.lit("}")).alias("arguments"),
        F.array(own(2), own(1)).alias("depends_on"),
    )
    given = rows.where(is_result).select("conv_id", "position", F.col("message.tool_call_id").alias("call_id"), F.col("message.content").alias("content"))
    answered = plain.where("role = 'assistant'").select("conv_id", "position", own(1).alias("call_id"), F.col("text").alias("content"))
    return made.unionByName(asked), given.unionByName(answered)


def format_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The linked calls of the conversations table of a folder, and the results without one."""
    calls, results = calls_of_conversations(table(spark, folder, "conversations"))
    return transcript(calls, results, turn_tools(spark))
