"""Tool-call linking for chat formatting, with DataFrame operations only.

Calls (conv_id, call_id, position, tool, arguments, needs) are hash-joined with
results (call_id, result) by identifier, put in topological order of the calls
they need, validated against the tools' schemas and serialised as canonical
JSON.

* Order: ``level`` is the length of the longest chain of needed calls before a
  call, so (level, position) is a topological order. Levels are found for all
  conversations at once: edges to finished calls are settled, and an edge to a
  call with a single need jumps over it, which halves chains in every round. Before
  that, needs that another need of the same call has already are left out, so
  calls that each need the several before them are a chain too. A
  conversation is never gathered; a chain of n calls takes about log2(n)
  rounds. Calls on or behind a cycle keep a null level.
* Validation: ``SCHEMAS`` gives each tool's fields with type, whether they are
  required, and limits; what is not listed is not allowed. Arguments are parsed
  once, as a variant.
* Canonical JSON: keys in code point order, no white space, so equal objects
  are equal texts.

Defined cases: a call without result has status ``unanswered``; results whose
call does not exist are ``orphan_results``; of several rows with one call_id
the first by (position, tool, arguments) counts and ``duplicates`` says how
many more there are; of several results of one call_id the smallest text
counts; needs that name no call, nulls and repeats in them are ignored; null, unparsable
or non-object arguments and unknown tools are invalid, with a reason; a null call_id
is never linked; empty tables give empty results; very long arguments and
results are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

CALL_COLUMNS = ("conv_id", "call_id", "position", "tool", "arguments", "needs")


def one_per_id(calls: DataFrame) -> DataFrame:
    """One row per call_id, with ``duplicates``; rows without an id are left out."""
    rest = [c for c in CALL_COLUMNS if c != "call_id"]
    first = F.min(F.struct(F.col("position"), F.col("tool"), F.col("arguments"), F.col("conv_id"), F.array_sort("needs").alias("needs"))).alias("first")
    return (calls.where("call_id is not null").groupBy("call_id").agg(first, (F.count("*") - 1).alias("duplicates"))
            .select("call_id", *[F.col(f"first.{c}").alias(c) for c in rest], "duplicates"))


def needed(calls: DataFrame) -> DataFrame:
    """(a, b): call a needs call b, without needs that the next later need of the same call has itself.

    Levels stay: the longest chain never runs over an edge that two others
    bypass. Of the needs from which a cycle is reached, a call keeps the last by
    (position, call_id), since what bypasses an edge is later; so a call behind
    a cycle stays behind one.
    """
    edges = calls.select(F.col("call_id").alias("a"), F.explode("needs").alias("b")).where("b is not null").distinct() \
        .join(calls.select(F.col("call_id").alias("b"), "position"), "b")
    later = Window.partitionBy("a").orderBy(F.col("position").desc(), F.col("b").desc())  # the needs of one row of calls
    edges = saved(edges.select("a", "b", F.lag("b").over(later).alias("via")), "needs-all")
    spared = edges.join(edges.select(F.col("a").alias("via"), "b"), ["via", "b"], "left_semi").select("a", "b")
    return edges.select("a", "b").join(spared, ["a", "b"], "left_anti")


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): longest chain of needed calls before each; null on or behind a cycle."""
    nodes = saved(calls.select("call_id", F.lit(0).cast("long").alias("base"), F.lit(None).cast("long").alias("level")), "calls")
    edges = saved(needed(calls).select("a", "b", F.lit(1).cast("long").alias("w"), F.lit(0).cast("long").alias("kept")), "needs")
    n, before = nodes.count(), None
    while True:
        # what is known of a call: its longest finished chain, and its open need if there is just one
        reached = edges.join(nodes.select(F.col("call_id").alias("b"), F.col("level").alias("_l")), "b", "left")
        open_ = F.col("_l").isNull()
        seen = reached.groupBy("a").agg(F.max(F.when(~open_, F.col("_l") + F.col("w"))).alias("r"), F.max("kept").alias("k"),
                                        F.count(F.when(open_, 1)).alias("o"), F.min(F.when(open_, F.col("b"))).alias("c"),
                                        F.min(F.when(open_, F.col("w"))).alias("x"))
        base = F.greatest("base", F.coalesce("r", F.lit(0)), F.coalesce("k", F.lit(0)))
        nodes = saved(nodes.select("call_id", "base", "level").join(seen, F.col("call_id") == F.col("a"), "left").select(
            "call_id", base.alias("base"), F.coalesce("level", F.when(F.coalesce("o", F.lit(0)) == 0, base)).alias("level"),
            F.when(F.col("o") == 1, F.col("c")).alias("c"), "x"), "levels")
        # an open need that itself has one open need is jumped over; chains longer than there are calls are cycles
        via = nodes.where("c is not null and level is null").select(F.col("call_id").alias("b"), "c", "x", F.col("base").alias("_base"))
        hop = F.col("c").isNotNull() & (F.col("w") <= n)
        edges = saved(reached.where(open_).join(via, "b", "left").select(
            "a", F.when(hop, F.col("c")).otherwise(F.col("b")).alias("b"), F.when(hop, F.col("w") + F.col("x")).otherwise(F.col("w")).alias("w"),
            F.greatest("kept", F.when(hop, F.col("w") + F.col("_base"))).alias("kept"))
            .groupBy("a", "b").agg(F.max("w").alias("w"), F.max("kept").alias("kept")), "needs")
        now = (edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b", "w", "kept").cast("decimal(38,0)"))).first(),
               nodes.where("level is not null").count())
        if not now[0][0] or now == before:
            return nodes.select("call_id", "level")
        before = now


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, "$['" + name.replace("'", "\\'") + "']", "variant")


def _faults(v: Column, keys: Column, fields: dict) -> Column:
    """Array of what is wrong with an object for one tool."""
    kinds = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"],
             "object": ["OBJECT"], "array": ["ARRAY"]}
    found = [F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, fields)) if fields else F.array().cast("array<string>"))),
                         lambda k: F.concat(F.lit("unexpected "), k))]
    for name, rule in fields.items():
        value, text = _field(v, name), F.try_variant_get(v, "$['" + name.replace("'", "\\'") + "']", "string")
        there, kind = F.array_contains(keys, name), F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        tests = [(there & ~kind.isin(kinds[rule["type"]]), f"{name} is not {rule['type']}")]
        if rule.get("required"):
            tests.append((~there, f"{name} is missing"))
        if "enum" in rule:
            tests.append((there & ~text.isin([str(x) for x in rule["enum"]]), f"{name} is not one of its values"))
        if "min_length" in rule:
            tests.append((there & (F.length(text) < rule["min_length"]), f"{name} is too short"))
        if "minimum" in rule:
            tests.append((there & (text.try_cast("double") < rule["minimum"]), f"{name} is too small"))
        found += [F.when(test, F.array(F.lit(said))).otherwise(F.array().cast("array<string>")) for test, said in tests]
    return F.concat(*found)


def validated(calls: DataFrame, schemas: dict) -> DataFrame:
    """Adds parsed (variant), faults (array of texts) and valid to calls."""
    v, keys = F.col("parsed"), F.json_object_keys("arguments")
    faults = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        faults = F.when(F.col("tool") == tool, _faults(v, keys, fields)).otherwise(faults)
    broken = v.isNull() | keys.isNull()
    faults = F.when(broken, F.array(F.lit("arguments are not an object"))).otherwise(faults)
    return calls.withColumn("parsed", F.try_parse_json("arguments")).withColumn("faults", faults).withColumn("valid", F.size("faults") == 0)


def link(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """(conv_id, call_id, position, level, tool, status, valid, faults, duplicates, message) of every call_id.

    ``message`` is the canonical JSON of the linked pair; arguments that don't parse stand in it as text.
    """
    one = saved(one_per_id(calls), "calls-once")
    answers = results.where("call_id is not null").groupBy("call_id").agg(F.min("result").alias("result"), F.count("*").alias("answers"))
    linked = one.join(levels(one), "call_id").join(answers, "call_id", "left")
    status = F.when(F.col("level").isNull(), "cyclic").when(F.col("answers").isNull(), "unanswered").otherwise("answered")
    out = validated(linked, schemas).withColumn("status", status)
    arguments = F.coalesce(F.to_json("parsed"), F.to_json(F.struct(F.col("arguments").alias("unparsed")), {"ignoreNullFields": "false"}))
    pair = F.struct(F.try_parse_json(arguments).alias("arguments"), "call_id", "conv_id", "level", "result", "tool")
    message = F.to_json(pair, {"ignoreNullFields": "false"})
    return out.select("conv_id", "call_id", "position", "level", "tool", "status", "valid", F.array_join("faults", "; ").alias("faults"),
                      "duplicates", message.alias("message"))


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that name no call, a null call_id included."""
    return results.join(calls.where("call_id is not null").select("call_id").distinct(), "call_id", "left_anti")


#: The tools that turns of plain conversations stand for.
SCHEMAS = {
    "configure": {"text": {"type": "string", "required": True}, "turn": {"type": "integer", "required": True, "minimum": 0}},
    "ask": {"text": {"type": "string", "required": True, "min_length": 1}, "turn": {"type": "integer", "required": True, "minimum": 0},
            "words": {"type": "integer", "minimum": 1}},
}


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table of turns (conv_id, turn, role, text).

    A system turn is a call of ``configure`` and a user turn one of ``ask``; each
    needs the calls among the two turns before it. An assistant turn is the
    result of the turn before it.
    """
    ident = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))
    words = F.size(F.split(F.trim("text"), "\\s+"))
    arguments = F.to_json(F.struct(F.col("turn").cast("long").alias("turn"), "text",
                                   F.when(F.col("role") == "user", F.when(F.trim("text") != "", words).otherwise(0)).alias("words")))
    calls = turns.where(F.col("role").isin("system", "user")).select(
        F.col("conv_id").cast("long").alias("conv_id"), ident(0).alias("call_id"), F.col("turn").cast("long").alias("position"),
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("tool"), arguments.alias("arguments"),
        F.array(ident(1), ident(2)).alias("needs"))
    return calls, turns.where("role = 'assistant'").select(ident(1).alias("call_id"), F.col("text").alias("result"))
