"""Expressions on results, intents, timestamps and joined content, value by value."""

import json

import pytest
from pyspark.sql import functions as F

from spanforge.config import DEFAULT
from spanforge.functions import text
from spanforge.operators.spans import tool_steps
from spanforge.sources import readers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("result, success, kind", [
    ("", True, None), ("", False, "empty_failed"), (None, False, "empty_failed"), ("Unknown reference type 'x'", True, "invalid_reference_type"),
    ("it is not found in registry", True, "invalid_entity"), ("Error: Script gone", True, "missing_script"), ('{"count":0}', True, None),
    ('{"error": 1}', True, "other_error"), ("Error: other", True, "other_error"), ("x" * 700 + " rate_limited", True, None),
])
def test_error_kinds(spark, result, success, kind):
    assert value(spark, text.error_kind(F.lit(result).cast("string"), F.lit(success))) == kind


def test_results_that_hold_nothing(spark):
    assert value(spark, text.is_empty(F.lit('{"count": 0, "data": []}'))) and not value(spark, text.is_empty(F.lit('{"count": 3}')))


@pytest.mark.parametrize("said, intent", [
    ("intent=Full Triage; ticket=8; mode=x", "Full Triage"), ("intent: Information Request", "Information Request"), ('{"intent":"Write Request","ticket":1}', "Write Request"),
    ("intent=full triage", "Full Triage"), ("triage 8", None), ("intent=unheard of; intent: Enrichment", "Enrichment"),
])
def test_intents(spark, said, intent):
    assert value(spark, text.first_intent(F.lit(said))) == intent


@pytest.mark.parametrize("raw, normal", [
    ("9/3/2026, 5:29:42.893 PM", "2026-09-03T17:29:42.893Z"), ("9/30/2026, 1:00:00.000 AM", "2026-09-30T01:00:00.000Z"),
    ("2026-09-03T19:29:42.893+02:00", "2026-09-03T17:29:42.893Z"), ("whenever", "whenever"),
])
def test_timestamps(spark, raw, normal):
    assert value(spark, text.normal_timestamp(F.lit(raw))) == normal


def spans_of(spark, folder, bag, **more):
    row = {"name": "execute_tool q", "id": "s", "operation_Id": "op", "success": "True", "timestamp": "2026-10-02T16:07:46.493Z"}
    bag = {"gen_ai.agent.name": "a", "gen_ai.tool.name": "q"} | bag
    (folder / "t.json").write_text(json.dumps([row | {"customDimensions": json.dumps(bag)} | more]))
    return readers.spans(readers.json_rows(spark, str(folder / "t.json")))


ARGUMENTS, RESULT = "gen_ai.tool.call.arguments", "gen_ai.tool.call.result"


@pytest.mark.parametrize("bag, joined, result, missing", [
    ({RESULT: "pointer:abc"}, {"ToolCallResult": '{"count": 3}'}, '{"count": 3}', False),
    ({RESULT: "x" * 8192}, {"ToolCallResult": "x" * 20000}, "x" * 20000, False),
    ({RESULT: "inline"}, {"ToolCallResult": "", "InputMessages": None}, "inline", False),
    ({ARGUMENTS: DEFAULT.placeholder, RESULT: DEFAULT.placeholder}, {}, DEFAULT.placeholder, True),
    ({ARGUMENTS: DEFAULT.placeholder}, {"ToolCallArguments": '{"e": 1}', "ToolCallResult": ""}, "", False),
    ({ARGUMENTS: '{"e": 1}', RESULT: '{"count": 1}'}, {}, '{"count": 1}', False),
])
def test_joined_content(spark, tmp_path, bag, joined, result, missing):
    step = tool_steps(spans_of(spark, tmp_path, bag, **joined)).first()
    assert (step["result"], step["content_missing"]) == (result, missing)


def test_a_failed_call_without_result(spark, tmp_path):
    step = tool_steps(spans_of(spark, tmp_path, {ARGUMENTS: DEFAULT.placeholder}, ToolCallArguments='{"e": 1}', ToolCallResult=None, success="False")).first()
    assert (step["error_kind"], step["content_missing"]) == ("empty_failed", False)


def test_one_manifest_in_each_form(spark, tmp_path):
    tool = {"name": "q", "inputSchema": {"type": "object"}, "annotations": {"readOnlyHint": True}}
    (tmp_path / "m.json").write_text(json.dumps({"toolbox": "box", "version": "5", "tools": [tool]}))
    (tmp_path / "n.json").write_text(json.dumps({"toolbox": "box", "versions": ["6", "7"], "result": {"tools": [tool]}}))
    found = {(r.toolbox, tuple(r.versions), r.tool, r.schema, r.read_only) for r in readers.manifests(spark, str(tmp_path)).collect()}
    assert found == {("box", ("5",), "q", '{"type":"object"}', True), ("box", ("6", "7"), "q", '{"type":"object"}', True)}


def test_csv_export(spark, tmp_path):
    (tmp_path / "t.csv").write_text('"timestamp [UTC]",name,operation_Id,customDimensions\n"9/3/2026, 5:29:42.893 PM",execute_tool q,op,"{""gen_ai.agent.name"": ""a"",\n""k"": ""v""}"\n')
    row = readers.spans(readers.csv_rows(spark, str(tmp_path / "t.csv"))).first()
    assert (str(row["ts"]), row["name"], row["op_id"], row["d"]["gen_ai.agent.name"], row["d"]["k"], row["duration"], row["success"]) == ("2026-09-03 17:29:42.893000", "execute_tool q", "op", "a", "v", 0.0, True)
