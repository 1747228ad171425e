from __future__ import annotations

import json

from ontime.llm import chat

SCHEMAS = {
    "add": {"a": chat.Field("integer", True), "b": chat.Field("number"), "tags": chat.Field("array")},
    "say": {"text": chat.Field("string", False, 2, 5)},
}
CALL = "thread long, call_id string, tool string, arguments string, needs string, position long, depth int"
RESULT = "thread long, call_id string, position long, content string, tool string"


def linked(spark, calls, results=()):
    calls = spark.createDataFrame([(1, *c, None, None) for c in calls], CALL)
    results = spark.createDataFrame([(1, *r, None) for r in results], RESULT)
    rows = chat.linked_calls(spark, calls, results, SCHEMAS).orderBy("position").collect()
    first = {}
    for row in rows:
        first.setdefault(row.call_id, row)
    return first


def test_links_order_and_status(spark):
    chain = [(f"c{i}", "add", '{"a": 1}', f"c{i - 1}" if i else None) for i in range(70)]
    cycle = [("x", "add", '{"a":1}', "y"), ("y", "add", '{"a":1}', "x"), ("z", "add", '{"a":1}', "y")]
    calls = [*chain, chain[3], *cycle, ("far", "add", '{"a":1}', "unknown"), ("self", "add", '{"a":1}', "self")]
    results = [("c1", 5, "late"), ("c1", 2, "early"), ("nobody", 1, "lost")]
    got = linked(spark, calls, results)
    assert [got[f"c{i}"].depth for i in range(70)] == list(range(70))
    assert json.loads(got["c1"].json)["result"] == "early"
    assert got["c1"].status == "ok"
    assert got["c2"].status == "unanswered"
    assert got["nobody"].status == "orphan"
    assert {got[c].status for c in ("x", "y", "z", "self")} == {"cycle"}
    assert got["x"].depth is None
    assert got["far"].depth == 0
    assert len(got) == 70 + 3 + 2 + 1


def test_threads_share_identifiers(spark):
    calls = [(1, "call_0", "add", '{"a":1}', None), (2, "call_0", "add", '{"a":2}', None)]
    calls += [(2, "call_1", "add", '{"a":3}', "call_0"), (1, "call_1", "add", '{"a":4}', None)]
    calls += [(None, "call_0", "add", '{"a":5}', None), (3, None, "add", '{"a":6}', None)]
    results = [(1, "call_0", 1, "answer A"), (2, "call_0", 1, "answer B"), (2, "call_0", 2, "more B")]
    results += [(None, "call_0", 1, "answer N"), (3, None, 1, "to whom"), (4, "call_0", 9, "no such thread")]
    found = chat.linked_calls(
        spark,
        spark.createDataFrame(calls, "thread long, call_id string, tool string, arguments string, needs string"),
        spark.createDataFrame(results, "thread long, call_id string, position long, content string"),
        SCHEMAS,
    )
    rows = {
        (r.thread, r.call_id, json.loads(r.json)["result"], r.depth, r.status) for r in found.collect()
    }
    assert rows == {
        (1, "call_0", "answer A", 0, "ok"),
        (2, "call_0", "answer B", 0, "ok"),
        (2, "call_0", "more B", 0, "ok"),
        (None, "call_0", "answer N", 0, "ok"),
        (2, "call_1", None, 1, "unanswered"),
        (1, "call_1", None, 0, "unanswered"),
        (3, None, None, None, "unanswered"),
        (3, None, "to whom", None, "orphan"),
        (4, "call_0", "no such thread", None, "orphan"),
    }


def test_lengths_of_texts(spark):
    cases = {"": "text", "a": "text", "ab": "", "éé日本語": "", "abcdef": "text"}
    calls = [(str(n), "say", json.dumps({"text": text}), None) for n, text in enumerate(cases)]
    got = linked(spark, calls)
    assert [got[str(n)].errors for n in range(len(cases))] == list(cases.values())


def test_arguments_are_validated(spark):
    cases = {
        '{"a":1}': "",
        '{"b":2.5,"a":1,"tags":[1]}': "",
        '{"a":"1"}': "a",
        '{"b":1}': "a",
        '{"a":1,"b":"x","tags":{}}': "b,tags",
        '{"a":1,"more":2}': "more",
        '{"a":null}': "a",
        "[1]": "*",
        "no json": "*",
        "": "*",
    }
    calls = [(str(i), "add", text, None) for i, text in enumerate(cases)]
    calls += [("null", "add", None, None), ("tool", "other", '{"a":1}', None)]
    results = [(c[0], 1, "r") for c in calls]
    got = linked(spark, calls, results)
    for i, errors in enumerate(cases.values()):
        assert (got[str(i)].errors, got[str(i)].status) == (errors, "invalid" if errors else "ok")
    assert got["null"].errors == got["tool"].errors == "*"


def test_json_is_canonical(spark):
    got = linked(spark, [("1", "add", ' {"b" : 2.50, "a":1, "tags": ["é\\u00e9", {"z":1,"y":2}]} ', None)])
    assert got["1"].json == json.dumps(
        {"arguments": '{"a":1,"b":2.5,"tags":["éé",{"y":2,"z":1}]}', "id": "1", "result": None, "tool": "add"},
        ensure_ascii=False,
        separators=(",", ":"),
    )


def test_every_turn_of_a_conversation_stands_in_a_row(spark):
    kinds = "conv_id long, turn long, role string, text string, prompt string"
    rows = [
        (1, 0, "user", "hi", ""),
        (1, 1, "assistant", "hello", ""),
        (1, 1, "assistant", "another answer", ""),
        (1, 2, "user", None, ""),
        (1, 3, "assistant", "x" * 100_000, ""),
        (1, 4, "user", "z" * 401, ""),
        (2, 0, "assistant", "to nobody", ""),
        (2, 4, "user", "follows nothing", ""),
        (None, 1, "assistant", "no conversation", ""),
        (3, None, "assistant", "no turn", ""),
        (3, None, "user", "no turn either", ""),
        (4, 0, "system", "be good", ""),
        (4, 1, None, None, None),
    ]
    turns = spark.createDataFrame(rows, kinds)
    found = chat.formatted_turns(spark, turns).collect()

    def row(status, **values):
        some = [r for r in found if r.status == status and all(getattr(r, k) == v for k, v in values.items())]
        assert len(some) == 1, (status, values)
        return some[0]

    assert row("ok", call_id="call-1-0", position=1, json=json.dumps(
        {"arguments": '{"prompt":"hi","turn":0}', "id": "call-1-0", "result": "hello", "tool": "open"},
        separators=(",", ":"),
    )) or True
    assert sorted(json.loads(r.json)["result"] for r in found if r.call_id == "call-1-0") == ["another answer", "hello"]
    assert row("invalid", call_id="call-1-2").errors == "prompt"
    assert (row("invalid", call_id="call-1-4").depth, row("invalid", call_id="call-1-4").errors) == (2, "prompt")
    assert row("orphan", thread=2).call_id == "call-2--1"
    assert row("invalid", call_id="call-2-4").errors == "after"
    assert row("invalid", thread=3).errors == "turn"
    assert {json.loads(r.json)["result"] for r in found if r.status == "orphan"} == {
        "to nobody", "no conversation", "no turn"
    }
    assert {r.json for r in found if r.status == "message"} == {
        '{"content":"be good","role":"system"}', '{"content":null,"role":null}'
    }
    # Two rows of a call and its result where both exist.
    assert len(found) == len(rows) - 2
    nothing = chat.formatted_turns(spark, turns.where("false"))
    assert nothing.collect() == []
