"""Tool-call linking against plain Python."""

import json
import random

from goldvein.llm import tool_links as T
from goldvein.llm.catalog import ORACLES, QUERIES

from ..conftest import SF_SMALL
from ..oracle_compare import compare, duck

CALLS = "conv_id long, call_id string, position long, tool string, arguments string, needs array<string>, message string"
RESULTS = "call_id string, result string, tool string"
SCHEMAS = {"add": {"a": {"type": "integer", "required": True, "minimum": 0}, "b": {"type": "number"}, "how": {"type": "string", "enum": ["x", "y"]}},
           "none": {}}


def depth(needs):
    """Longest chains; None on or behind a cycle."""
    state = {}

    def visit(k):
        if k not in state:
            state[k] = "open"
            below = [visit(b) for b in needs[k]]
            state[k] = None if None in below or "open" in below else max((x + 1 for x in below), default=0)
        return state[k]

    order = list(needs)
    for _ in range(2):  # a node first met through a cycle is judged again
        for k in order:
            visit(k)
    reach = {k: set(needs[k]) for k in needs}
    for _ in needs:
        for k in needs:
            for b in list(reach[k]):
                reach[k] |= reach[b]
    bad = {k for k in needs if k in reach[k]}
    bad |= {k for k in needs if reach[k] & bad}

    def level(k):
        return None if k in bad else max((level(b) + 1 for b in needs[k]), default=0)
    return {k: level(k) for k in needs}


def test_levels_equal_brute_force(spark):
    rng = random.Random(6)
    needs = {f"d{i}": {f"d{rng.randrange(i)}" for _ in range(rng.choice((0, 1, 1, 2, 3)))} if i else set() for i in range(60)}
    needs |= {f"c{i}": {f"c{i - 1}"} if i else set() for i in range(90)}  # a long chain
    needs |= {"x0": {"x1"}, "x1": {"x2"}, "x2": {"x0"}, "x3": {"x2", "d5"}, "x4": {"x4"}}  # cycles and what hangs on one
    needs |= {"m0": {"m1", "m2"}, "m1": {"m0", "m2"}, "m2": {"m0", "m1"}}  # a cycle without single needs
    rows = [(1, k, 0, "none", "{}", [*sorted(v), None, "gone", *sorted(v)], "") for k, v in needs.items()]
    rng.shuffle(rows)
    got = {r.call_id: r.level for r in T.levels(spark.createDataFrame(rows, CALLS)).collect()}
    assert got == depth(needs)


def test_ladders_take_few_rounds(spark, monkeypatch):
    """Calls that need the two or five before them: a round more when their number doubles, not twice as many."""
    keep, rounds = T.saved, []
    monkeypatch.setattr(T, "saved", lambda df, name: (rounds.append(name), keep(df, name))[1])
    for width, n in ((2, 16), (2, 64), (5, 64)):
        needs = {f"c{i}": {f"c{j}" for j in range(max(0, i - width), i)} for i in range(n)}
        rows = [(1, k, int(k[1:]), "none", "{}", [*sorted(v)], "") for k, v in needs.items()]
        rounds.clear()
        got = {r.call_id: r.level for r in T.levels(spark.createDataFrame(rows, CALLS)).collect()}
        assert got == {f"c{i}": i for i in range(n)}
        assert rounds.count("levels") <= n.bit_length() + 2


def test_left_out_needs_keep_levels_and_cycles(spark):
    """Random graphs with cycles, calls with many needs and equal positions, behind and on cycles."""
    for seed in range(4):
        rng = random.Random(seed)
        needs = {f"k{i}": {f"k{rng.randrange(14)}" if rng.random() < 0.12 else f"k{rng.randrange(i + 1)}" for _ in range(rng.randrange(5))} - {f"k{i}"}
                 for i in range(14)}
        needs |= {"y0": {"y1"}, "y1": {"y0"}, "y2": {"y0", "y1", "k0"}}  # both needs of y2 bypass each other
        rows = [(1, k, rng.choice((None, 0, 1, 2)), "none", "{}", [*sorted(v)], "") for k, v in needs.items()]
        got = {r.call_id: r.level for r in T.levels(spark.createDataFrame(rows, CALLS)).collect()}
        assert got == depth(needs)


def test_validation_canonical_json_and_odd_rows(spark):
    args = {"ok": '{ "how":"x", "b": 1.5,\n "a":3}', "extra": '{"a":1,"zz":1,"c":2}', "type": '{"a":"1"}', "small": '{"a":-1}', "missing": '{"b":2}',
            "enum": '{"a":1,"how":"q"}', "broken": '{"a":', "list": "[1]", "null": None, "long": json.dumps({"a": 1, "how": "x" * 200_000})}
    rows = [(1, k, n, "add", v, None, "m") for n, (k, v) in enumerate(args.items())]
    rows += [(1, "tool", 50, "other", "{}", [], "m"), (None, "n", None, "none", "{}", ["n"], None), (2, None, 1, "none", "{}", [], ""),
             (1, "ok", 99, "add", '{"a":9}', [], "m"), (1, "ok", 99, "add", '{"a":9}', [], "m")]
    results = spark.createDataFrame([("ok", "second", ""), ("ok", "first", ""), ("gone", "r", ""), (None, "r", "")], RESULTS)
    calls = spark.createDataFrame(rows, CALLS)
    got = {r.call_id: r for r in T.link(calls, results, SCHEMAS).collect()}
    assert len(got) == len(args) + 2
    faults = {k: got[k].faults for k in got}
    assert faults == {"ok": "", "extra": "unexpected c; unexpected zz", "type": "a is not integer", "small": "a is too small",
                      "missing": "a is missing", "enum": "how is not one of its values", "broken": "arguments are not an object",
                      "list": "arguments are not an object", "null": "arguments are not an object", "tool": "unknown tool", "n": "",
                      "long": "how is not one of its values"}
    ok = got["ok"]
    assert (ok.status, ok.duplicates, ok.valid, ok.level) == ("answered", 2, True, 0)
    assert ok.message == '{"arguments":{"a":3,"b":1.5,"how":"x"},"call_id":"ok","conv_id":1,"level":0,"result":"first","tool":"add"}'
    assert got["n"].status == "cyclic" and got["n"].level is None and got["tool"].status == "unanswered"
    assert json.loads(got["broken"].message)["arguments"] == {"unparsed": '{"a":'}
    assert len(got["long"].message) > 200_000
    assert sorted((r.call_id or "-") for r in T.orphan_results(calls, results).collect()) == ["-", "gone"]


def test_query_equals_oracle_without_python(spark):
    df = QUERIES["op1_tool_links"](spark, SF_SMALL)
    ok, msg = compare(spark, duck(SF_SMALL), "op1_tool_links", df, ORACLES["op1_tool_links"])
    assert ok, msg
    assert "Python" not in df._jdf.queryExecution().toString()


def test_empty(spark):
    assert T.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect() == []
