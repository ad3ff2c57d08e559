"""Tool calls and their results: linked by identifier, ordered, validated and written as canonical JSON.

Only DataFrame functions are used. No conversation is collected: a row is a call, and its place in the order is its depth.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import WORD_SPLIT, query, table
from keyscore.storage import materialize

CALL_KEY = ("conv_id", "call_id")


@dataclass(frozen=True)
class Parameter:
    """A parameter of a tool: its JSON type, whether it must be there, and bounds of a number or of a string's length."""

    name: str
    kind: str  # string, integer, number, boolean, array, object
    required: bool = True
    least: float | None = None
    most: float | None = None


#: How the type of a JSON value is named by ``schema_of_variant``.
KINDS = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}


def argument_errors(value: Column, tools: dict[str, tuple[Parameter, ...]], name: Column) -> Column:
    """The first thing wrong with the arguments ``value`` (a variant) of the tool ``name``, or null.

    Order: unknown tool, not a JSON object, then each parameter as listed (missing, wrong type, out of bounds).
    Parameters that the schema does not list are allowed.
    """
    out = F.when(name.isNull() | ~name.isin(*tools), F.lit("unknown_tool")).when(
        F.coalesce(~F.schema_of_variant(value).rlike(KINDS["object"]), F.lit(True)), F.lit("not_an_object")
    )
    for tool, parameters in tools.items():
        for p in parameters:
            path = f"$['{p.name}']"
            there = F.try_variant_get(value, path, "variant")
            kind = F.schema_of_variant(there)
            missing = there.isNull() | (kind == "VOID")
            if p.required:
                out = out.when((name == tool) & missing, F.lit(f"missing:{p.name}"))
            out = out.when((name == tool) & ~missing & ~kind.rlike(KINDS[p.kind]), F.lit(f"type:{p.name}"))
            size = F.length(F.try_variant_get(value, path, "string")) if p.kind == "string" else F.try_variant_get(value, path, "double")
            for bound, beyond in ((p.least, size < p.least if p.least is not None else None), (p.most, size > p.most if p.most is not None else None)):
                if bound is not None:
                    out = out.when((name == tool) & ~missing & beyond, F.lit(f"range:{p.name}"))
    return out


def depths(nodes: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``depth``: how many calls a call waits for in turn, 0 if for none.

    ``nodes`` has a row for each call with ``parent_id``. Ancestors are doubled in each round, so a chain of a million
    calls takes 20 rounds. A parent that is not among the calls counts as none. A call in a circle, or behind one, has
    a null depth: its ancestors are still there when a chain of all calls would have ended.
    """
    known = nodes.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    state = nodes.select(*CALL_KEY, "parent_id").join(known, ["conv_id", "parent_id"], "left")
    state = state.select(
        *CALL_KEY, F.when(F.col("there"), F.col("parent_id")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth")
    )
    state = materialize(state, "calls-depth")
    total, open_rows = state.count(), state.where("up is not null").count()
    reach = 1
    while open_rows and reach <= total:
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        state = state.join(above, ["conv_id", "up"], "left").select(
            *CALL_KEY, F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )
        state = materialize(state, "calls-depth")
        reach *= 2
        open_rows = state.where("up is not null").count()
    return state.select(*CALL_KEY, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, tools: dict[str, tuple[Parameter, ...]]) -> DataFrame:
    """One row for each call, and for each identifier that only has results.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), parent_id (the call whose result it needs, or null).
    ``results``: conv_id, turn, call_id, content. Other columns are not read. Returns conv_id, call_id, turn,
    result_turn, n_calls, n_results, name, depth, status, error, json.

    Of several calls (results) with an identifier the one of the earliest turn counts, ties by text, and n_calls
    (n_results) says how many there were; a null turn comes first. A call without an identifier (or conversation) stays,
    unlinked. status: ``no_id``, ``orphan_result``, ``no_result``, ``cycle`` (see ``depths``), ``result_first`` (the
    result stands at or before the call), ``linked``. error: what is wrong with the arguments, or null. json: the call
    and its result as JSON with sorted keys and no blanks; arguments that are no JSON are null in it. Rows in the order
    of conv_id, depth, turn and call_id follow all that they need. Empty tables give no row.
    """
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    fields = ["turn", "name", "arguments", "parent_id"]
    calls = calls.select(*CALL_KEY, *fields)
    first = calls.where(has_id).groupBy(*CALL_KEY).agg(F.min(F.struct(*fields)).alias("c"), F.count("*").alias("n_calls"))
    loose = calls.where(~has_id).select(*CALL_KEY, F.struct(*fields).alias("c"), F.lit(1).cast("long").alias("n_calls"))
    found = results.select(*CALL_KEY, F.struct("turn", "content").alias("r")).where(has_id).groupBy(*CALL_KEY)
    found = found.agg(F.min("r").alias("r"), F.count("*").alias("n_results"))
    nodes = first.select(*CALL_KEY, F.col("c.parent_id").alias("parent_id"))
    linked = first.join(found, list(CALL_KEY), "full").join(depths(nodes), list(CALL_KEY), "left")
    linked = linked.unionByName(loose, allowMissingColumns=True)
    call, result = F.col("c"), F.col("r")
    status = (
        F.when(~has_id, "no_id")
        .when(call.isNull(), "orphan_result")
        .when(F.col("depth").isNull(), "cycle")
        .when(result.isNull(), "no_result")
        .when(F.coalesce(result["turn"] <= call["turn"], F.lit(False)), "result_first")
        .otherwise("linked")
    )
    value = F.try_parse_json(call["arguments"])
    rows = linked.select(
        *CALL_KEY,
        call["turn"].alias("turn"),
        result["turn"].alias("result_turn"),
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        call["name"].alias("name"),
        "depth",
        status.alias("status"),
        result["content"].alias("content"),
        value.alias("value"),
    )
    quoted = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", ""), F.lit("null"))
    json = F.concat(
        F.lit('{"arguments":'),
        F.coalesce(F.to_json("value"), F.lit("null")),
        F.lit(',"call_id":'),
        quoted(F.col("call_id")),
        F.lit(',"name":'),
        quoted(F.col("name")),
        F.lit(',"result":'),
        quoted(F.col("content")),
        F.lit("}"),
    )
    error = F.when(~F.col("status").isin("orphan_result"), argument_errors(F.col("value"), tools, F.col("name")))
    return rows.select(*CALL_KEY, "turn", "result_turn", "n_calls", "n_results", "name", "depth", "status", error.alias("error"), json.alias("json"))


#: The tools that the turns of ``conversations`` stand for.
TOOLS = {
    "reply": (Parameter("n_words", "integer", least=4), Parameter("prompt", "string", most=400), Parameter("turn", "integer", least=0)),
    "configure": (Parameter("prompt", "string", least=1), Parameter("turn", "integer", most=0)),
}


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The calls and results that a table of turns stands for.

    A user's turn calls ``reply`` and a system's turn ``configure``; a call's identifier is its turn's number and it
    needs the result of the call two turns before. An assistant's turn is the result for the call one turn before.
    A null turn gives no identifier; other roles are left out.
    """
    n_words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), WORD_SPLIT), lambda w: w != ""))
    place = lambda back: F.concat(F.lit("turn-"), (F.col("turn") - back).cast("string"))
    asked = turns.where(F.col("role").isin("user", "system"))
    calls = asked.select(
        "conv_id",
        "turn",
        place(0).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct("turn", F.col("text").alias("prompt"), n_words.alias("n_words"))).alias("arguments"),
        F.when(F.col("role") == "user", place(2)).alias("parent_id"),
    )
    results = turns.where(F.col("role") == "assistant").select("conv_id", "turn", place(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


OP9_SQL = r"""
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, 'turn-' || turn AS call_id, text, CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END AS name,
         len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n_words
  FROM conversations WHERE role IN ('user', 'system')),
results AS (SELECT conv_id, turn AS result_turn, 'turn-' || (turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'assistant'),
edges AS (
  SELECT c.conv_id, c.turn, p.turn AS up FROM calls c LEFT JOIN calls p
  ON c.conv_id = p.conv_id AND p.turn = c.turn - 2 AND c.name = 'reply'),
deep AS (
  SELECT conv_id, turn, 0 AS depth FROM edges WHERE up IS NULL
  UNION ALL
  SELECT e.conv_id, e.turn, d.depth + 1 FROM edges e JOIN deep d ON e.conv_id = d.conv_id AND e.up = d.turn),
linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, r.result_turn, c.name, c.text, c.n_words, r.content
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id)
SELECT l.conv_id, l.call_id, l.turn, l.result_turn,
  CAST(CASE WHEN l.turn IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_calls,
  CAST(CASE WHEN l.result_turn IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_results,
  l.name, CAST(d.depth AS BIGINT) AS depth,
  CASE WHEN l.turn IS NULL THEN 'orphan_result' WHEN l.result_turn IS NULL THEN 'no_result' ELSE 'linked' END AS status,
  CASE WHEN l.name = 'reply' AND l.n_words < 4 THEN 'range:n_words' WHEN l.name = 'reply' AND length(l.text) > 400 THEN 'range:prompt'
       WHEN l.name = 'configure' AND length(l.text) < 1 THEN 'range:prompt' WHEN l.name = 'configure' AND l.turn > 0 THEN 'range:turn' END AS error,
  sha256('{"arguments":' || CASE WHEN l.turn IS NULL THEN 'null' ELSE '{"n_words":' || l.n_words || ',"prompt":' || to_json(l.text) || ',"turn":' || l.turn || '}' END
    || ',"call_id":' || to_json(l.call_id) || ',"name":' || coalesce(to_json(l.name), 'null') || ',"result":' || coalesce(to_json(l.content), 'null') || '}') AS json_sha256
FROM linked l LEFT JOIN deep d ON l.conv_id = d.conv_id AND l.turn = d.turn
"""


@query("op9_tool_calls", OP9_SQL)
def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_calls(*calls_of_conversations(table(spark, sf_dir, "conversations")), TOOLS)
    return linked.withColumn("json_sha256", F.sha2("json", 256)).drop("json")
