import json

from starmill.llm import chat_format as C

CALLS = "conv_id string, call_id string, turn long, name string, arguments string, after array<string>"
RESULTS = "conv_id string, call_id string, turn long, content string"
OTHERS = "conv_id string, turn long, role string, text string"
SCHEMAS = {"f": {"z": C.Field(("BIGINT",)), "y": C.Field(("OBJECT",), required=False)}}


def linked(spark, calls, results=(), others=()):
    def table(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    df = C.link_tool_calls(table(calls, CALLS), table(results, RESULTS), table(others, OTHERS), SCHEMAS)
    return {(r.conv_id, r.call_id): r for r in df.collect()}


def test_links_orders_validates_and_serialises(spark):
    found = linked(
        spark,
        [("c", "a", 0, "f", '{"z":1,"y":{"b":2,"a":[1, 2.50]}}', ["b"]), ("c", "b", 1, "f", '{"z":"x"}', []),
         ("c", "a", 9, "f", "{}", []), ("c", "k", 4, "g", "{}", []), ("c", "l", 5, "f", "nope", []),
         ("c", "m", 6, "f", '{"z":1,"q":null}', ["missing"]), ("d", "a", 0, "f", '{"z":3}', None)],
        [("c", "b", 5, "B"), ("c", "b", 3, "earlier"), ("c", "q", 6, "Q")],
        [("c", 0, "system", "be\nbrief"), ("c", None, None, "")],
    )
    a, b = found["c", "a"], found["c", "b"]
    assert (a.status, a.copies, a.valid, a.order_key) == ("open", 2, True, 2)
    assert a.json == '{"arguments":{"y":{"a":[1,2.5],"b":2},"z":1},"call_id":"a","name":"f"}'
    assert (b.status, b.valid, b.errors, b.order_key) == ("linked", False, "wrong type of z", 1)
    assert json.loads(b.json)["content"] == "earlier"
    assert found["c", "k"].errors == "unknown tool"
    assert found["c", "l"].errors == "arguments are no object"
    assert found["c", "m"].errors == "unknown field q" and found["c", "m"].order_key == 6
    assert found["d", "a"].valid and found["d", "a"].order_key == 0
    assert (found["c", "q"].status, found["c", "q"].copies) == ("orphan", 0)
    assert found["c", ""].status == "message"


def test_order_is_topological_and_cycles_have_none(spark):
    chain = [("c", f"n{i}", 100 - i, "f", '{"z":1}', [f"n{i - 1}"] if i else []) for i in range(12)]
    cycle = [("c", "x", 1, "f", '{"z":1}', ["y"]), ("c", "y", 2, "f", '{"z":1}', ["x"]),
             ("c", "behind", 3, "f", '{"z":1}', ["y"]), ("c", "self", 4, "f", '{"z":1}', ["self"])]
    found = linked(spark, chain + cycle)
    keys = [found["c", f"n{i}"].order_key for i in range(12)]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    assert [found["c", n].order_key for n in ("x", "y", "behind", "self")] == [None] * 4


def test_transcripts(spark):
    df = spark.createDataFrame([
        (1, 0, "system", "rules"), (1, 1, "user", 'say "hi"'), (1, 2, "assistant", "hi"),
        (1, 3, "user", None), (2, 0, "assistant", "first"), (None, 0, "user", "no id"),
        (3, 0, None, "no role"), (3, None, "user", "no turn"), (1, 1, "user", 'say "hi"'),
    ], "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn, r.status): r for r in C.format_chats(df).collect()}
    assert set(found) == {
        ("1", 0, "message"), ("1", 1, "linked"), ("1", 3, "open"), ("2", 0, "orphan"),
        ("", 0, "open"), ("3", 0, "message"), ("3", None, "message"),
    }
    call = found["1", 1, "linked"]
    assert call.copies == 2 and json.loads(call.json) == {
        "arguments": {"prompt": 'say "hi"', "turn": 1}, "call_id": "call-1", "content": "hi", "name": "reply"}
    assert call.json == json.dumps(json.loads(call.json), sort_keys=True, separators=(",", ":"))
    assert C.format_chats(df.filter("false")).count() == 0
    assert C.format_chats(df.selectExpr("*", "1 AS status", "2 AS call_id")).count() == len(found)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = C.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_turns_with_other_texts_all_stay(spark):
    df = spark.createDataFrame([
        (1, 1, "user", "A"), (1, 1, "user", "B"), (1, 1, "user", "B"),
        (1, 2, "assistant", "X"), (1, 2, "assistant", "Y"), (1, 4, "assistant", "P"), (1, 4, "assistant", "Q"),
        (None, 1, "user", "one"), (None, 1, "user", "two"), (None, 2, "assistant", "three"),
        (None, 2, "assistant", "four"),
    ], "conv_id long, turn long, role string, text string").selectExpr(
        "cast(conv_id as string) conv_id", "turn", "role", "text"
    ).union(spark.createDataFrame([("", 1, "user", "empty id")], "a string, b long, c string, d string"))
    found = set()
    for r in C.format_chats(df).collect():
        line = json.loads(r.json)
        found.add((r.conv_id, r.turn, r.status, r.copies, line.get("arguments", {}).get("prompt"), line.get("content")))
    assert found == {
        ("1", 1, "linked", 3, "A", "X"), ("1", 1, "duplicate", 2, "B", None),
        ("1", 2, "duplicate", 1, None, "Y"), ("1", 4, "orphan", 0, None, "P"), ("1", 4, "duplicate", 1, None, "Q"),
        ("", 1, "open", 1, "one", None), ("", 1, "open", 1, "two", None), ("", 1, "open", 1, "empty id", None),
        ("", 2, "orphan", 0, None, "three"), ("", 2, "orphan", 0, None, "four"),
    }
