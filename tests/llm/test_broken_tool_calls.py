"""Messages whose calls are broken, or that answer and call at once."""

import json

from usageloom.llm import tool_calls

TOOLS = {"add": {"type": "object", "required": ["x"]}}
GOOD = '{"id":"%s","name":"add","arguments":"{\\"x\\":1}"}'


def report(spark, rows):
    messages = spark.createDataFrame(
        rows, "conv_id long, turn long, text string, tool_calls string, tool_call_id string")
    found = tool_calls.positioned(tool_calls.linked_calls(messages, TOOLS)).collect()
    return sorted(found, key=lambda r: (r["conv_id"], r["position"]))


def test_broken_tool_calls_are_kept_as_invalid(spark):
    texts = ["no json", '[{"id":"a"', '"text"', "7", "", "null"]
    rows = report(spark, [(1, i, "said", text, None) for i, text in enumerate(texts)] + [(1, 9, "r", None, "a")])
    assert [(r["kind"], r["status"]) for r in rows] == [("call", "invalid")] * len(texts) + [("result", "orphan")]
    for r, text in zip(rows, texts, strict=False):
        assert r["call_id"] is None and r["problem"] == "$: no array of calls"
        assert json.loads(r["json"])["raw"] == text and json.loads(r["json"])["content"] == "said"


def test_elements_that_are_no_objects_leave_the_others(spark):
    text = f'[{GOOD % "a"},null,{GOOD % "b"}]'
    rows = report(spark, [(1, 0, None, text, None), (1, 1, "r", None, "a"), (1, 2, "r", None, "b")])
    assert sorted((r["call_id"] or "", r["kind"], r["status"]) for r in rows) == [
        ("", "call", "invalid"), ("a", "call", "ok"), ("a", "result", "ok"), ("b", "call", "ok"), ("b", "result", "ok")]
    assert next(json.loads(r["json"])["raw"] for r in rows if r["call_id"] is None) == text
    for odd in (f'[{GOOD % "a"},5]', f'[5,{GOOD % "a"}]', f'[[{GOOD % "a"}]]', '["x"]'):
        assert "invalid" in [r["status"] for r in report(spark, [(1, 0, None, odd, None)])], odd


def test_message_that_answers_and_calls(spark):
    rows = report(spark, [
        (1, 0, "first", f'[{GOOD % "a"},{GOOD % "c"}]', None), (1, 1, "of a", f'[{GOOD % "b"}]', "a"),
        (1, 2, "of b", "no json", "b"), (1, 3, "of c", "[]", "c")])
    assert [(r["call_id"], r["kind"], r["status"]) for r in rows] == [
        ("a", "call", "ok"), ("a", "result", "ok"), ("c", "call", "ok"), ("c", "result", "ok"),
        ("b", "call", "ok"), ("b", "result", "ok"), (None, "call", "invalid")]
    bodies = {(r["call_id"], r["kind"]): json.loads(r["json"]) for r in rows}
    assert bodies["a", "call"]["content"] == "first" and "content" not in bodies["c", "call"]
    assert [bodies[i, "result"]["content"] for i in "abc"] == ["of a", "of b", "of c"]
    assert "content" not in bodies["b", "call"]


def test_arguments_that_are_no_json_are_kept(spark):
    row, = report(spark, [(1, 0, None, '[{"id":"a","name":"add","arguments":"{x"}]', None)])
    assert row["status"] == "invalid" and json.loads(row["json"])["raw"] == "{x"
