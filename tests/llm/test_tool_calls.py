import json
import random

import pytest

from wattloom.llm.tool_calls import assembled, by_rounds, canonical, errors, linked, order, parse, settled

SCHEMA = "conv_id long, turn long, role string, text string"


def call(i, name="add", **args):
    return {"id": i, "type": "function", "function": {"name": name, "arguments": json.dumps(args)}}


def says(*calls, **more):
    return json.dumps({"content": None, "tool_calls": list(calls), **more})


TOOLS = json.dumps({"content": "tools", "tools": [{"type": "function", "function": {"name": "add", "parameters": {
    "type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"enum": ["x", "y"]}}, "additionalProperties": False}}}]})


def test_schema_errors():
    rule = json.loads(TOOLS)["tools"][0]["function"]["parameters"]
    assert errors({"a": 1, "b": "x"}, rule) == [] and errors({"a": 2.0}, rule) == []
    assert errors({"a": -1, "b": "z", "c": 0}, rule) == ["$.a: minimum", "$.b: enum", "$.c: unknown"]
    assert errors({}, rule) == ["$.a: required"] and errors({"a": True}, rule) == ["$.a: type"] and errors("x", rule) == ["$: type"]
    assert errors([1, "x"], {"items": {"type": "number"}, "maxItems": 1}) == ["$: maxItems", "$[1]: type"]


def test_canonical_and_parse():
    assert canonical({"b": 1.0, "a": [None, True, "é\n"], "c": float("nan")}) == '{"a":[null,true,"é\\n"],"b":1,"c":null}'
    assert parse("user", "{not json") == {"content": "{not json", "calls": [], "answers": None, "schemas": []}
    tagged = parse("assistant", 'See <tool_call>{"id": 7, "name": "f", "arguments": {"z": {"$ref": "q"}}}</tool_call>')
    assert tagged["content"] == "See" and tagged["calls"] == [{"id": "7", "name": "f", "arguments": '{"z":{"$ref":"q"}}', "refs": ["q"]}]
    assert parse("tool", '{"tool_call_id": "c", "content": {"b": 1, "a": 2}}')["content"] == '{"a":2,"b":1}'


def test_links_order_and_validation(spark):
    rows = [
        (1, 0, "system", TOOLS), (1, 1, "tool", '{"tool_call_id": "c1", "content": "early"}'), (1, 2, "assistant", says(call("c1", a=1), call("c2", b="q"))),
        (1, 3, "tool", '{"tool_call_id": "zz", "content": "lost"}'), (1, 4, "assistant", says(call("c3", a={"$ref": "c4"}))), (1, 5, "assistant", says(call("c4", a=2))), (1, 6, "tool", '{"tool_call_id": "c4", "content": "4"}'),
        (2, 0, "assistant", says(call("c1", a=1))), (2, 1, "assistant", says(call("x", a={"$ref": "y"}))), (2, 2, "assistant", says(call("y", a={"$ref": "x"}))), (2, 3, "tool", '{"tool_call_id": "x"}'), (2, 4, "tool", '{"tool_call_id": "y"}'),
        (None, 0, "assistant", says(call("n"))), (None, 1, "tool", '{"tool_call_id": "n"}'), (3, None, None, None), (3, 0, "user", ""), (3, 0, "user", ""),
    ]
    out = linked(spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", row int, json string").repartition(3)).collect()
    got = {(r.conv_id, r.turn): (r.n_calls, r.n_answered, r.n_invalid, r.status) for r in out}
    assert len(out) == len(rows)
    assert got[1, 2] == (2, 1, 1, "ok") and got[1, 1] == (0, 0, 0, "ok") and got[1, 3] == (0, 0, 0, "no_call") and got[1, 4] == (1, 0, 1, "ok")
    assert got[2, 0] == (1, 0, 0, "ok") and got[2, 1][3] == got[2, 4][3] == "cyclic"
    assert got[None, 0] == (1, 0, 0, "ok") and got[None, 1][3] == "no_call" and got[3, None] == (0, 0, 0, "ok")
    first = sorted((r for r in out if r.conv_id == 1), key=lambda r: (r.position, r.depth, r.turn))
    assert [r.turn for r in first] == [0, 2, 1, 3, 5, 6, 4]
    assert next(r.json for r in out if (r.conv_id, r.turn) == (1, 1)) == '{"content":"early","role":"tool","tool_call_id":"c1"}'
    whole = {r.conv_id: json.loads(r.json)["messages"] for r in assembled(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [m["role"] for m in whole[1]] == ["system", "assistant", "tool", "tool", "assistant", "tool", "assistant"] and len(whole[3]) == 3


@pytest.mark.parametrize("n", [40])
def test_long_chain(spark, n):
    rows = [(1, n - i, "assistant", says(call(f"c{i}", a={"$ref": f"c{i - 1}"}))) for i in range(n)] + [(1, 100 + i, "tool", json.dumps({"tool_call_id": f"c{i}"})) for i in range(3)]
    out = sorted(linked(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.position, r.depth, r.turn))
    at = {json.loads(r.json).get("tool_call_id") or json.loads(r.json)["tool_calls"][0]["id"] + "!": k for k, r in enumerate(out)}
    assert at["c0!"] < at["c0"] < at["c1!"] < at["c1"] < at["c2!"] < at["c2"] < at["c3!"]


def test_plain_chats(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = sorted((r.conv_id, r.turn, canonical({"role": r.role, "content": r.text})) for r in df.collect())
    assert sorted((r.conv_id, r.turn, r.json) for r in linked(df).collect()) == want
    assert linked(df.limit(0)).count() == 0


def test_several_responses_in_one_message(spark):
    tags = lambda *ids: "".join(f'<tool_response>{{"tool_call_id": "{i}", "content": 1}}</tool_response>\n' for i in ids)
    assert parse("tool", tags("a", "b", "a"))["answers"] == ["a", "b"]
    rows = [
        (1, 0, "tool", tags("a", "b")), (1, 1, "assistant", says(call("n", a={"$ref": "a"}))), (1, 2, "assistant", says(call("a", a=1), call("b", a=2), call("u", a=3))),
        (1, 3, "tool", tags("n", "lost")), (2, 0, "assistant", says(call("a", a=1))), (2, 1, "tool", tags("a")),
    ]
    out = {(r.conv_id, r.turn): r for r in linked(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == len(rows)
    assert {k: (r.n_calls, r.n_answered, r.status) for k, r in out.items()} == {
        (1, 0): (0, 0, "ok"), (1, 1): (1, 1, "ok"), (1, 2): (3, 2, "ok"), (1, 3): (0, 0, "no_call"), (2, 0): (1, 1, "ok"), (2, 1): (0, 0, "ok")}
    assert [t for _, t in sorted((k for k in out if k[0] == 1), key=lambda k: (out[k].position, out[k].depth, k[1]))] == [2, 0, 1, 3]
    assert json.loads(out[1, 0].json)["tool_call_ids"] == ["a", "b"] and json.loads(out[2, 1].json)["tool_call_id"] == "a"
    assert out[1, 1].depth == out[1, 0].depth + 1  # by its $ref to the first of both results


def test_surrogates_and_malformed_schemas_do_not_end_the_job(spark):
    odd = ['{"tool_calls": [{"id": "a\\ud800", "function": {"name": "f\\udfff", "arguments": "{\\"x\\": \\"\\\\ud800\\"}"}}]}', '{"tool_call_id": "a\\ud800", "content": "c\\udc00"}', '{"tools": [{"name": "f", "parameters": {"k": "\\ud900"}}]}']
    deep = '{"tool_calls": [' + '{"a":[' * 3000 + "]}" * 3000 + "]}"
    rules = [{"enum": 5}, {"minLength": "x"}, {"required": 5}, {"required": [1, "a"]}, {"type": {}}, {"type": [["x"]]}, {"properties": 3}, {"items": 7}, {"maximum": True}]
    rows = [(1, i, "assistant", t) for i, t in enumerate([*odd, deep, odd[0]])]
    rows += [(2 + i, 0, "system", json.dumps({"tools": [{"name": "g", "parameters": r}]})) for i, r in enumerate(rules)]
    rows += [(2 + i, 1, "assistant", json.dumps({"tool_calls": [call("z", "g", a="text", b=[1])]})) for i in range(len(rules))]
    got = {(r.conv_id, r.turn): r for r in linked(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows) and json.loads(got[1, 0].json)["tool_calls"][0]["id"] == "a\ufffd" and got[1, 0].n_answered == 1
    assert json.loads(json.loads(got[1, 0].json)["tool_calls"][0]["function"]["arguments"]) == {"x": "\ud800"}
    assert [got[2 + i, 1].n_invalid for i in range(len(rules))] == [1, 1, 1, 1, 1, 1, 1, 0, 1]


def test_any_schema_gives_errors_and_no_exception():
    rnd = random.Random(1)
    values = [None, True, 0, -3, 2.5, float("inf"), "", "abc", [], [1, "x"], {}, {"a": 1, "b": [None]}]
    keys = ["type", "enum", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "required", "properties", "items", "additionalProperties"]
    for _ in range(20000):
        rule = {k: rnd.choice([*values, "string", "integer", ["a"], ["string", "null"], {"a": {"type": "integer"}}, False]) for k in rnd.sample(keys, rnd.randint(0, 4))}
        assert all(isinstance(e, str) for e in errors(rnd.choice(values), rule))


def plain_order(edges, own):
    """Positions pushed along edges until nothing moves or a node is deeper than there are edges."""
    at = {v: (own[v], 0) for e in edges for v in e}
    for _ in range(3 * len(edges) + 3):
        for a, b in edges:
            if at[b][1] <= len(edges):
                at[b] = max(at[b], (at[a][0], at[a][1] + 1))
    return {v: (own[v], 0, True) if d > len(edges) else (p, d, False) for v, (p, d) in at.items()}


def test_order_equals_pushing(spark):
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(2, 9)
        edges = sorted({(a, b) for a, b in ((rnd.randrange(n), rnd.randrange(n)) for _ in range(rnd.randint(1, 14))) if a != b})
        own = {v: rnd.randint(0, 6) for v in range(n)}
        if edges:
            got = settled([a for a, _ in edges], [b for _, b in edges], {v: own[v] for e in edges for v in e})
            assert got == plain_order(edges, own)
    chain = [(k, k + 1) for k in range(4000)] + [(4000, 3900)]
    got = settled([a for a, _ in chain], [b for _, b in chain], dict.fromkeys(range(4001), 5))
    assert got[3899] == (5, 3899, False) and got[3900][2] and got[4000][2]


def test_large_conversations_are_ordered_alike(spark):
    edges = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 1), (1, 2, 3), (2, 4, 5)], "conv_id long, src long, dst long")
    turns = spark.createDataFrame([(k, t) for k, t in enumerate([3, 1, 2, 9, 8, 0])], "row long, own long")
    want = sorted(map(tuple, order(edges, turns).collect()))
    assert want == sorted(map(tuple, order(edges, turns, most=1).collect())) == sorted(map(tuple, by_rounds(edges, turns).collect()))
