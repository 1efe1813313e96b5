"""Run rows with their lists, where intents come from, and schemas of nested objects, against plain Python."""

import json
import random

import pytest

from spanforge.operators import dataset, runs

STEP = "op_id string, agent string, ts int, ord int, tool string, is_a2a boolean, error_kind string, errored boolean, empty boolean, truncated boolean, arguments string, duration double"


def test_the_lists_of_a_run(spark):
    bad = [("o", "a", 5 + i, i, "find", False, None, False, True, False, "x" * (300 + i), 1.0) for i in range(4)]
    rows = [("o", "a", 2, 9, "srv___get", False, "other_error", True, False, False, '{"k": 1}', 1.0), ("o", "a", 1, 9, "helper", True, None, False, False, False, None, 2.0), ("p", "b", 1, 1, "t", False, None, False, False, False, "", 0.0)]
    usage = spark.createDataFrame([("o", "a", 7)], "op_id string, agent string, output_tokens int")
    found = {r.op_id: r for r in runs.run_rows(spark.createDataFrame(rows + bad, STEP), usage).collect()}
    o, p = found["o"], found["p"]
    assert o.tool_names == ["helper", "srv___get", *["find"] * 4] and o.a2a_calls == ["helper"] and (o.n_calls, o.tool_ms, o.output_tokens) == (6, 7.0, 7)
    assert [tuple(x) for x in o.tool_errors] == [("srv___get", "other_error", '{"k": 1}')]
    assert [(x.tool, len(x.args)) for x in o.empty_results] == [("find", 200)] * 4
    assert [(x.tool, x.length, [len(a) for a in x.args]) for x in o.search_cascades] == [("find", 4, [200] * 4)]
    assert [(x.role, x.content[0].type, x.content[0].name, len(x.content[0].arguments or "")) for x in o.actions][2:3] == [("assistant", "function_call", "find", 300)]
    assert p.search_cascades == p.tool_errors == p.a2a_calls == [] and p.output_tokens is None


@pytest.mark.parametrize(("messages", "handed", "handed_on", "wanted"), [
    ("intent=full triage", None, None, ("Full Triage", "declared")), ('[{"parts": [{"content": "intent: Bogus"}, {"text": "intent: write request"}]}]', "intent=Explanation", None, ("Write Request", "declared")),
    ("Automated flow", 'x intent="Enrichment"', "intent=Explanation", ("Enrichment", "inbound")), ("go", "intent=Bogus; intent=Explanation", "intent=no; intent=Explanation", ("Explanation", "delegated")),
    (None, None, "no mention", (None, "unknown")), ("intent=Bogus", None, None, (None, "unknown")),
])
def test_where_an_intent_comes_from(spark, messages, handed, handed_on, wanted):
    kind = "op_id string, agent string, ts int, ord int, tool string, is_a2a boolean, arguments string"
    steps = [("o", "caller", 1, 1, "me", True, handed)] * (handed is not None) + [("o", "me", 2, 2, "child", True, handed_on)] * (handed_on is not None)
    asked = spark.createDataFrame([("o", "me", messages)], "op_id string, agent string, messages string")
    row = runs.resolved_intents(asked, spark.createDataFrame(steps, kind)).first()
    assert (row.intent, row.intent_source) == wanted and row.traj_key == "|".join(filter(None, ("me", wanted[0])))


def kind_of(x):
    return "null" if x is None else "boolean" if isinstance(x, bool) else "integer" if isinstance(x, int) else "number" if isinstance(x, float) else "string" if isinstance(x, str) else "array" if isinstance(x, list) else "object"


def described(values):
    """The schema of objects, as the rules say it: names, types, those that are never null, and what is in objects alone."""
    names = {k for v in values for k in v}
    seen = {k: [v[k] for v in values if k in v] for k in names}
    props = {}
    for k, inner in seen.items():
        types = sorted({kind_of(x) for x in inner})
        props[k] = {"type": types[0] if len(types) == 1 else types} | (described(inner) if types == ["object"] else {})
    return {"type": "object", "properties": props, "required": sorted(k for k, inner in seen.items() if None not in inner)}


@pytest.mark.parametrize("rows", [
    [{"outer": {"inner": 35756}}], [{"a": {"b": {"c": 1}}}], [{"a": 1, "b": None}, {"a": 2, "b": 3}], [{"tool_outcomes": [1, {"x": 2}]}], [], [{"a": {}}, {"a": {"b.c/d": 1.5}}],
    [{"a": {"b": 1}}, {"a": None}], [{"a": {"b": {"c": None}}}, {"a": {"b": {"c": True, "d": "x"}}}, {"e": ""}],
])
def test_schemas_of_nested_objects(spark, rows):
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("nope",), ("[1]",), (None,)], "json string")
    assert dataset.json_schema(dataset.nested_schema(df).collect()) == described(rows)


def test_schemas_of_random_objects(spark):
    rng = random.Random(3)
    value = lambda deep: rng.choice([1, "x", 2.5, None, [1], *[{k: value(deep - 1) for k in rng.sample("abc", 2)}] * 6]) if deep else 1
    rows = [{"a": {"b": {"c": value(3)}}, "d": value(2)} for _ in range(40)]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "json string").repartition(4)
    assert dataset.json_schema(dataset.nested_schema(df).collect()) == described(rows)
