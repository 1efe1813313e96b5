"""Sinks, the row scrub, message contents and write predicates."""

import json
from datetime import datetime

import pytest

from spanforge.config import EngineConfig
from spanforge.operators import dataset, redaction, runs
from spanforge.operators.spans import write_calls
from spanforge.sources import readers, sinks

SALT = "a salt of sixteen characters"


def test_watermarks_go_on(spark, tmp_path):
    store, end = f"file://{tmp_path}/marks", datetime(2024, 1, 2)
    spans = spark.createDataFrame([(datetime(2024, 1, 1, 5),)], "ts timestamp")
    assert sinks.stored_watermark(spark, store) is None
    sinks.save_watermark(spans, end, store)
    assert sinks.stored_watermark(spark, store) == datetime(2024, 1, 1, 5)
    sinks.save_watermark(spans.limit(0), end, store)
    assert sinks.stored_watermark(spark, store) == end


def test_all_or_nothing(spark, tmp_path):
    root, one = f"file://{tmp_path}/both", spark.range(3)
    none = spark.createDataFrame([], "failure string")
    assert sinks.write_together({"a": one, "b": one}, none, root)
    assert not sinks.write_together({"a": spark.range(9)}, spark.createDataFrame([("bad",)], "failure string"), root)
    with pytest.raises(Exception):
        sinks.write_together({"a": spark.range(9), "b": one.selectExpr("raise_error('no') as x")}, none, root)
    assert sinks.read_together(spark, root, "a").count() == 3


def test_recordings_spans_and_summaries(spark, tmp_path):
    rows = spark.createDataFrame([("o1", 0, "a", "t", False), ("o1", 1, "b", "t", False), ("o2", 0, "a", "t", True)], "op_id string, seq int, agent string, tool string, truncated boolean")
    sinks.write_recordings(rows, f"file://{tmp_path}/rec", strict=True)
    assert [r.op_id for r in spark.read.json(f"file://{tmp_path}/rec/headers").collect()] == ["o1"]
    assert spark.read.json(f"file://{tmp_path}/rec/interactions").count() == 2
    spans = spark.createDataFrame([("o", datetime(2024, 1, 1)), ("o", datetime(2024, 1, 2))], "op_id string, ts timestamp")
    assert sinks.write_spans(spans, f"file://{tmp_path}/spans", asked="all").first().asDict() == {"asked": "all", "spans": 2, "operations": 1}
    sinks.write_summary(rows.limit(0), f"file://{tmp_path}/none")
    assert not (tmp_path / "none").exists()
    for text in ("one", "two"):
        sinks.append_summary(spark, text, f"file://{tmp_path}/report")
    assert {r.value for r in spark.read.text(f"file://{tmp_path}/report").collect()} == {"one", "two"}


def test_datasets_are_refused(spark, tmp_path):
    good = spark.createDataFrame([([("user", "hi")],), (None,)], "messages array<struct<role: string, content: string>>")
    sinks.write_dataset(good, f"file://{tmp_path}/d")
    assert spark.read.json(f"file://{tmp_path}/d").count() == 2
    with pytest.raises(ValueError, match="objects: x"):
        sinks.write_dataset(good.selectExpr("named_struct('a', 1) as x"), f"file://{tmp_path}/e")
    with pytest.raises(ValueError, match="1 rows"):
        sinks.write_dataset(spark.createDataFrame([([("user", "")],)], good.schema), f"file://{tmp_path}/f")


def test_rows_are_scrubbed(spark):
    bag = {"gen_ai.tool.call.result": json.dumps({"name": "Ann Lee", "note": "mail a@b.org"}), "other": "Ann Lee", "gen_ai.agent.name": "x"}
    rows = spark.createDataFrame([(1, bag, "by ann lee", None), (2, None, None, "z")], "ord int, d map<string,string>, c_input string, c_output string")
    listed = spark.createDataFrame([("Ann Lee", "PERSON")], "literal string, kind string")
    out = {r.ord: r for r in redaction.scrubbed(rows, listed, SALT, ("c_input", "c_output")).collect()}
    told = json.loads(out[1].d["gen_ai.tool.call.result"])
    assert told["name"].startswith("PERSON_") == out[1].d["other"].startswith("PERSON_") == True  # noqa: E712
    assert "EMAIL_" in told["note"] and out[1].d["gen_ai.agent.name"] == "x" and out[1].c_input == f"by {told['name']}"
    assert (out[2].d, out[2].c_input, out[2].c_output) == (None, None, "z")
    found = redaction.payloads(rows, ("c_input", "c_output"))
    assert {(r.ord, r.name) for r in found.collect()} == {(1, "gen_ai.tool.call.result"), (1, "c_input"), (2, "c_output")}
    assert redaction.sidecar(spark, listed, SALT, "t").first().tokens_issued == 1


@pytest.mark.parametrize("raw, wanted", [
    ('[{"role": "user", "content": "hi"}, {"content": [{"type": "text", "text": "a"}, {"type": "image", "text": "no"}, "b", {"content": {"text": "c"}}]}]', [("user", "hi"), ("user", "a\nb\nc")]),
    ('[{"role": "tool", "content": "", "parts": [{"content": "p"}]}, 3, "x"]', [("tool", "p")]),
    ("no json", [("assistant", "no json")]), ('"said"', [("assistant", "said")]), ("", []), (None, []), ('{"role": "user"}', []), ("[]", []),
])
def test_messages(spark, raw, wanted):
    row = spark.createDataFrame([(raw,)], "raw string").select(dataset.plain_messages("raw").alias("m")).first()
    assert [tuple(m) for m in row.m] == wanted


def test_write_predicate(spark):
    steps = spark.createDataFrame([("address_lookup",), ("Settings_read",), ("set.x",), ("put",)], "bare_tool string")
    told = lambda config: [r.is_write for r in write_calls(steps, config=config).collect()]
    assert told(EngineConfig()) == [False] * 4
    assert told(EngineConfig(write_prefixes=("set.", "Set"), write_tools=("put",))) == [False, True, True, True]


def test_exports_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"name": "x"')
    with pytest.raises(Exception, match="not JSON"):
        readers.json_rows(spark, str(tmp_path / "bad.json")).collect()


def test_tool_skeletons(spark):
    steps = spark.createDataFrame(
        [("get", "", '{"b": 1}', False, 1, 1), ("get", "reads", '{"a": 1}', False, 2, 2), ("agent", "x", "{}", True, 3, 3), ("bare", None, "no", False, 4, 4)],
        "bare_tool string, description string, arguments string, is_a2a boolean, ts int, ord int",
    )
    assert {tuple(map(str, r)) for r in runs.tool_skeletons(steps).collect()} == {("get", "reads", "['a', 'b']"), ("bare", "", "[]")}
