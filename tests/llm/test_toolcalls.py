import json

from keyscore.llm import toolcalls as tc

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, parent_id string, depth int"
RESULTS = "conv_id long, turn long, call_id string, content string, status string"
TOOLS = {"add": (tc.Parameter("a", "integer", least=0), tc.Parameter("b", "number", required=False), tc.Parameter("s", "string", required=False, most=3))}


def link(spark, calls, results):
    calls = spark.createDataFrame([(*c, 9) for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULTS)
    out = tc.link_calls(calls, results, TOOLS)
    assert "Python" not in out._jdf.queryExecution().toString()
    return {(r.conv_id, r.call_id): r for r in out.collect()}


def test_links_orders_and_validates(spark):
    got = link(
        spark,
        [
            (1, 0, "x", "add", '{"b": 1.5, "a": 2}', None),
            (1, 2, "y", "add", '{"a": -1}', "x"),
            (1, 4, "z", "add", "[1]", "y"),
            (1, 6, "w", "none", "{}", "gone"),
            (1, 8, "v", "add", "{oops", None),
            (1, 9, "u", "add", '{"a": 1, "s": "long"}', None),
            (1, 9, "t", "add", '{"a": "1"}', None),
            (1, 9, "s", "add", '{"b": 1}', None),
            (2, 5, "x", "add", '{"a": 1}', None),
            (None, 5, "x", "add", '{"a": 1}', None),
            (2, 5, None, "add", '{"a": 1}', None),
        ],
        [(1, 1, "x", "3\n"), (1, 1, "x", "2"), (1, 3, "y", None), (1, 7, "q", "lost"), (2, 4, "x", "early")],
    )
    assert [got[1, c].depth for c in "xyzw"] == [0, 1, 2, 0]
    assert [got[1, c].status for c in "xyzq"] == ["linked", "linked", "no_result", "orphan_result"]
    assert got[2, "x"].status == "result_first" and got[None, "x"].status == got[2, None].status == "no_id"
    errors = {c: got[1, c].error for c in "xyzwvutsq"}
    assert errors == {"x": None, "y": "range:a", "z": "not_an_object", "w": "unknown_tool", "v": "not_an_object", "u": "range:s", "t": "type:a", "s": "missing:a", "q": None}
    assert got[1, "x"].n_results == 2 and got[1, "x"].json == '{"arguments":{"a":2,"b":1.5},"call_id":"x","name":"add","result":"2"}'
    for r in got.values():
        value = json.loads(r.json)
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json


def test_circles_repeats_and_long_chains(spark):
    chain = [(3, i, f"c{i}", "add", '{"a": 1}', f"c{i - 1}") for i in range(300)]
    got = link(spark, [(1, 0, "a", "add", "{}", "b"), (1, 1, "b", "add", "{}", "a"), (1, 2, "c", "add", "{}", "b"), (2, 0, "a", "add", "{}", None), (2, 0, "a", "add", "{}", None), *chain], [])
    assert {got[1, c].status for c in "abc"} == {"cycle"}
    assert got[2, "a"].n_calls == 2 and got[2, "a"].depth == 0
    assert all(got[3, f"c{i}"].depth == i for i in range(300))


def test_empty_tables(spark):
    assert link(spark, [], []) == {}
    turns = spark.createDataFrame([(None, None, None, None, 1), (1, None, "user", None, 1), (1, 0, "user", "", 1)], "conv_id long, turn long, role string, text string, name int")
    out = tc.link_calls(*tc.calls_of_conversations(turns), tc.TOOLS).collect()
    assert sorted(r.status for r in out) == ["no_id", "no_result"]
