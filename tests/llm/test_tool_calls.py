import json

import pytest

from driftline.llm import tool_calls
from driftline.llm.tool_calls import Parameter

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after array<string>, level int"
RESULTS = "conv_id long, call_id string, turn long, content string, name string"
TOOLS = [
    Parameter("add", "x", "number", True),
    Parameter("add", "y", "integer", True),
    Parameter("add", "note", "string", False),
    Parameter("tag", "names", "array", True),
    Parameter("tag", "on", "boolean", False),
    Parameter("tag", "more", "object", False),
]
OK = '{"y": 2, "x": 1.5}'


def run(spark, calls, results):
    calls = spark.createDataFrame([(*c, 9) for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "z") for r in results], RESULTS)
    out = tool_calls.link(calls, results, TOOLS)
    assert not [c for c in out.columns if c.startswith("_")]
    return {(r.conv_id, r.call_id): r for r in out.collect()}


def test_linking_and_order(spark):
    calls = [
        (1, "c", 1, "add", OK, ["a", "b"]),
        (1, "a", 2, "add", OK, []),
        (1, "b", 3, "add", OK, ["a", "a"]),
        (1, "d", 0, "add", OK, None),
        (2, "a", 1, "add", OK, ["gone"]),
        (None, "a", 1, "add", OK, []),
    ]
    got = run(spark, calls, [(1, "a", 5, "A"), (2, "a", 6, "B"), (1, "x", 7, "C"), (None, "a", 8, "N")])
    assert [got[1, i].level for i in "dabc"] == [0, 0, 1, 2]
    assert [got[1, i].position for i in "dabc"] == [1, 2, 3, 4]
    assert got[1, "x"].position == 5 and got[1, "x"].problems == ["result without call"]
    assert got[1, "a"].result_turn == 5 and got[2, "a"].result_turn == 6
    assert got[None, "a"].result_turn == 8
    assert got[1, "b"].problems == ["no result"] and got[1, "b"].valid
    assert got[2, "a"].problems == ["unknown dependency"]


def test_cycles(spark):
    calls = [
        (1, "a", 1, "add", OK, ["b"]), (1, "b", 2, "add", OK, ["a"]), (1, "c", 3, "add", OK, ["b"]),
        (1, "d", 4, "add", OK, []), (1, "e", 5, "add", OK, ["e"]), (1, "f", 6, "add", OK, ["d"]),
    ]
    got = run(spark, calls, [])
    assert [got[1, i].level for i in "abcdef"] == [None, None, None, 0, None, 1]
    assert [i for i in "abcdef" if "cycle" in got[1, i].problems] == ["a", "b", "c", "e"]
    assert [got[1, i].position for i in "dfabce"] == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize(
    ("name", "arguments", "problems"),
    [
        ("add", OK, []),
        ("add", '{"x": 1, "y": 2, "note": "n"}', []),
        ("add", '{"x": "1", "y": 2.5}', ["wrong type x", "wrong type y"]),
        ("add", '{"z": 1, "y": null}', ["missing x", "unexpected z", "wrong type y"]),
        ("tag", '{"names": [1], "on": false, "more": {"b": 1, "a": []}}', []),
        ("tag", '{"names": {}, "on": 0, "more": []}', ["wrong type more", "wrong type names", "wrong type on"]),
        ("add", "[1]", ["invalid arguments"]),
        ("add", "{", ["invalid arguments"]),
        ("add", None, ["invalid arguments"]),
        ("none", OK, ["unknown tool"]),
        (None, OK, ["unknown tool"]),
    ],
)
def test_arguments(spark, name, arguments, problems):
    got = run(spark, [(1, "a", 1, name, arguments, [])], [(1, "a", 2, "r")])[1, "a"]
    assert got.problems == problems and got.valid == (not problems)
    message = json.loads(got.message)
    try:
        given = json.loads(arguments or "null")
    except ValueError:
        given = None
    assert message == {
        "arguments": given if isinstance(given, dict) else None,
        "call_id": "a",
        "name": name,
        "result": "r",
    }
    assert got.message == json.dumps(message, sort_keys=True, separators=(",", ":"))


def test_repeats_and_missing_ids(spark):
    calls = [
        (1, "a", 1, "add", OK, []), (1, "a", 1, "add", OK, []), (1, "b", 2, "tag", "{}", []), (1, "b", 1, "add", OK, []),
        (1, None, 3, "add", OK, []), (1, None, 4, "add", OK, ["a"]),
    ]
    calls = spark.createDataFrame([(*c, 9) for c in calls], CALLS)
    results = spark.createDataFrame([(1, "a", 5, "one", "z"), (1, "a", 4, "two", "z"), (1, None, 6, "lost", "z")], RESULTS)
    got = sorted(tool_calls.link(calls, results, TOOLS).collect(), key=lambda r: r.position)
    assert [(r.call_id, r.turn) for r in got] == [("a", 1), ("b", 1), (None, 3), (None, 4)]
    assert got[0].problems == ["repeated id", "repeated result"]
    assert json.loads(got[0].message)["result"] == "two"
    assert got[1].problems == ["repeated id", "no result"]
    assert got[2].problems == ["no id", "no result"]
    assert tool_calls.link(calls.limit(0), results.limit(0), TOOLS).count() == 0


def test_text_is_kept_whole(spark):
    text = 'quote " slash / back \\ tab\t é ☃  ' + "x" * 100_000
    arguments = json.dumps({"x": 1, "y": 2, "note": text})
    got = run(spark, [(1, "a", 1, "add", arguments, [])], [(1, "a", 2, text)])[1, "a"]
    assert json.loads(got.message) == {
        "arguments": {"x": 1, "y": 2, "note": text}, "call_id": "a", "name": "add", "result": text
    }
