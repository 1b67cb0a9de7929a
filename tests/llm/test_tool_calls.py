import json

import pytest

from clicktide.llm import tool_calls

CALLS = "conv_id bigint, turn bigint, call_id string, parent_id string, tool string, arguments string, level int"
RESULTS = "conv_id bigint, turn bigint, call_id string, content string, status string"
SCHEMAS = {
    "add": {
        "type": "object",
        "properties": {
            "a": {"type": "integer", "minimum": 0, "maximum": 9},
            "b": {"type": ["number", "null"]},
            "op": {"type": "string", "enum": ["+", "-"], "minLength": 1},
            "list": {"type": "array"},
        },
        "required": ["a", "op"],
        "additionalProperties": False,
    }
}


def run(spark, calls, results):
    calls = spark.createDataFrame([(*c, 77) for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULTS)
    return tool_calls.link(calls, results, SCHEMAS).collect()


@pytest.mark.parametrize(
    ("tool", "arguments", "problems"),
    [
        ("add", '{"op":"+","a":1}', []),
        ("add", '{"a":1.5,"op":"+"}', ["type of a"]),
        ("add", '{"a":10,"op":"*"}', ["maximum of a", "enum of op"]),
        ("add", '{"a":-1,"op":""}', ["minimum of a", "minLength of op", "enum of op"]),
        ("add", '{"b":null,"list":{}}', ["missing a", "missing op", "type of list"]),
        ("add", '{"a":0,"b":2.5,"op":"-","list":[1],"z":1}', ["unknown property"]),
        ("add", "[1]", ["arguments are no object"]),
        ("add", "not json", ["arguments are no object"]),
        ("add", '{"a":1,"a":2}', ["arguments are no object"]),
        ("add", None, ["arguments are no object"]),
        ("sub", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
    ],
)
def test_arguments_against_schema(spark, tool, arguments, problems):
    (row,) = run(spark, [(1, 0, "c", None, tool, arguments)], [])
    assert row.problems == problems


def test_canonical_json(spark):
    text = '{ "op":"+", "a": 1, "b": 2.50, "list":[ {"y":1,"x":"é\\n\\"/"} ] }'
    (row,) = run(spark, [(1, 0, 'i"d', "p", "add", text)], [])
    assert row.json == '{"arguments":{"a":1,"b":2.5,"list":[{"x":"é\\n\\"/","y":1}],"op":"+"},"id":"i\\"d","parent":"p","tool":"add"}'
    assert json.loads(row.json)["arguments"] == json.loads(text)


def test_links_levels_and_statuses(spark):
    ok = '{"a":1,"op":"+"}'
    calls = [(1, 9 - i, f"c{i}", f"c{i - 1}" if i else None, "add", ok) for i in range(10)]  # against the turns
    calls += [(1, 3, "c3", "c2", "add", '{"a":2,"op":"+"}'), (2, 0, None, None, "add", ok), (2, 1, "d", "nowhere", "add", ok)]
    calls += [(3, 0, "x", "y", "add", ok), (3, 1, "y", "x", "add", ok), (3, 2, "z", "y", "add", ok)]  # a cycle
    results = [(1, 20, "c4", "four"), (1, 21, "c4", "again"), (1, 22, "q", None), (1, 23, None, "n"), (2, 1, "d", "")]
    rows = run(spark, calls, results)
    assert len(rows) == len(calls) + len(results)
    call = {(r.call_id, r.turn): r for r in rows if not r.is_result}
    # c3 comes twice; the smaller turn is the call.
    assert [call[(f"c{i}", 9 - i)].level for i in range(10)] == list(range(10))
    assert call[("c3", 6)].status == "duplicate" and call[("c3", 3)].status == "unanswered"
    assert call[("c4", 5)].status == "answered" and call[(None, 0)].status == "no id"
    assert call[("d", 1)].level == 0
    assert all(call[k].level is None for k in (("x", 0), ("y", 1), ("z", 2)))
    result = {(r.call_id, r.turn): (r.status, r.level) for r in rows if r.is_result}
    assert result == {("c4", 20): ("linked", 4), ("c4", 21): ("linked", 4), ("q", 22): ("orphan", None),
                      (None, 23): ("no id", None), ("d", 1): ("linked", 0)}
    assert run(spark, [], []) == []


def test_ids_count_within_their_conversation(spark):
    ok = '{"a":1,"op":"+"}'
    calls = [(1, 0, "c", None, "add", ok), (2, 5, "c", None, "add", ok), (2, 7, "e", "c", "add", ok),
             (None, 0, "c", None, "add", ok), (3, 0, "f", "c", "add", ok)]
    results = [(2, 6, "c", "two"), (3, 1, "c", "none"), (None, 1, "c", "null")]
    rows = run(spark, calls, results)
    status = {(r.conv_id, r.turn): (r.status, r.level) for r in rows}
    assert status == {(1, 0): ("unanswered", 0), (2, 5): ("answered", 0), (2, 7): ("unanswered", 1),
                      (None, 0): ("answered", 0), (3, 0): ("unanswered", 0), (2, 6): ("linked", 0),
                      (3, 1): ("orphan", None), (None, 1): ("linked", 0)}


def test_equal_calls_are_one_call_and_its_duplicates(spark):
    call = (1, 0, "c", None, "add", '{"a":1,"op":"+"}')
    rows = run(spark, [call] * 5 + [(1, 0, None, None, "add", "{}")] * 2, [(1, 1, "c", "r")] * 3)
    assert sorted(r.status for r in rows) == ["answered"] + ["duplicate"] * 4 + ["linked"] * 3 + ["no id"] * 2


NESTED = {
    "find": {
        "properties": {
            "where": {
                "type": "object",
                "properties": {
                    "city": {"type": "string", "minLength": 2},
                    "box": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}}},
                },
                "required": ["city"],
                "additionalProperties": False,
            },
            "tags": {"type": "array", "items": {"type": ["string", "null"]}},
        },
        "required": ["where", "who"],
    }
}


@pytest.mark.parametrize(
    ("arguments", "problems"),
    [
        ('{"where":{"city":"Rome","box":{"x":1}},"who":1,"tags":["a",null]}', []),
        ('{"where":{"city":"R","box":{}},"who":1}', ["minLength of where.city", "missing where.box.x"]),
        ('{"where":{"box":{"x":"1"},"zip":1},"tags":["a",1],"who":null}',
         ["missing where.city", "type of where.box.x", "unknown property of where", "items of tags"]),
        ('{"where":[],"tags":{}}', ["type of where", "type of tags", "missing who"]),
        ('{"where":{"city":"Rome","box":3},"who":1,"tags":[]}', ["type of where.box"]),
    ],
)
def test_nested_schemas(spark, arguments, problems):
    calls = spark.createDataFrame([(1, 0, "c", None, "find", arguments, 77)], CALLS)
    results = spark.createDataFrame([], RESULTS)
    (row,) = tool_calls.link(calls, results, NESTED).collect()
    assert row.problems == problems


def test_schemas_with_other_words_are_refused(spark):
    for schema in ({"oneOf": []}, {"properties": {"a": {"pattern": "x"}}}, {"properties": {"a": {"items": {"enum": [1]}}}},
                   {"additionalProperties": {"type": "string"}}):
        with pytest.raises(ValueError):
            tool_calls.argument_problems("tool", "arguments", {"t": schema})


def test_large_arguments_are_named(spark):
    text = '{"a":1,"op":"' + "+" * (17 << 20) + '"}'
    calls = spark.createDataFrame([(1, 0, "c", None, "add", text, 77)], CALLS)
    (row,) = tool_calls.link(calls, spark.createDataFrame([], RESULTS), SCHEMAS).select("problems").collect()
    assert row.problems in (["arguments too large"], ["enum of op"])  # as much as a variant may hold


def test_a_long_chain(spark):
    n = 700
    calls = [(1, i, f"c{i}", f"c{i - 1}", "add", "{}") for i in range(n)]
    rows = run(spark, calls, [])
    assert {r.call_id: r.level for r in rows} == {f"c{i}": i for i in range(n)}


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, 0, "user", "x"),
            (2, None, "user", "x"), (3, 0, None, ""), (4, 5, "assistant", "late"), (5, 0, "user", "w " * 100_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, json string")
    got = tool_calls.link(
        tool_calls.calls_of_conversations(table), tool_calls.results_of_conversations(table), tool_calls.SCHEMAS
    ).collect()
    assert len(got) == len(rows)
    assert all(json.loads(r.json) for r in got)
    by = {(r.conv_id, r.turn, r.is_result): (r.status, r.problems) for r in got}
    assert by[(1, 0, False)] == ("answered", ["type of prompt"])
    assert by[(3, 0, False)] == ("unanswered", ["minLength of prompt"])
    assert by[(4, 5, True)][0] == "orphan" and by[(5, 0, False)][1] == ["maxLength of prompt"]
    assert by[(None, 0, False)][0] == "no id" and by[(2, None, False)][0] == "no id"
