"""Exports in their envelopes become spans and steps."""

import json
import random

import pytest

from spanforge.operators.spans import tool_steps
from spanforge.sources import readers, split_json


def row(name, bag, **more):
    return {"timestamp [UTC]": "9/3/2026, 1:02:03.004 PM", "id": "s1", "operation_Id": "op", "name": name, "success": "False", "customDimensions": json.dumps(bag)} | more


def test_json_envelope_to_steps(spark, tmp_path):
    call = {"gen_ai.agent.name": "a", "gen_ai.tool.name": "srv___call_tool", "gen_ai.tool.call.arguments": '{"name": "b", "arguments": {"x": 1}}'}
    rows = [row("execute_tool x", call, ToolCallResult="Error: Script x"), row("chat", {"gen_ai.agent.name": "b"})]
    (tmp_path / "t.json").write_text(json.dumps({"value": rows}))
    found = readers.spans(readers.json_rows(spark, str(tmp_path / "t.json")))
    assert [str(r["ts"]) for r in found.select("ts").collect()] == ["2026-09-03 13:02:03.004000"] * 2
    step = tool_steps(found).first()
    assert (step["tool"], step["arguments"], step["error_kind"], step["is_a2a"], step["unwrapped"], step["success"]) == ("b", '{"x":1}', "missing_script", True, True, False)


@pytest.fixture
def ranges(spark, monkeypatch):
    """Sets how many bytes a range of the file has; the tables stored from it are read as ever."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    was, stored = {k: spark.conf.get(k) for k in names}, split_json.Scratch.stored

    def usual():
        for k, v in was.items():
            spark.conf.set(k, v)

    def cut(size):
        def first(self, df):
            usual()
            if self.n == 0:
                spark.conf.set(names[0], size)
                spark.conf.set(names[1], 1)
            found = stored(self, df)
            usual()
            return found

        monkeypatch.setattr(split_json.Scratch, "stored", first)

    yield cut
    usual()


def made_up(seed, n):
    rng = random.Random(seed)
    strings = ["", "}", "{", "]", "[{", '"', "\\", '\\"', "a}b", "é}", "\n", '{"k": "}"}', "x" * 40, "\\}", "😀"]
    value = lambda deep: rng.choice([1, None, True, rng.choice(strings), *([{rng.choice(strings) or "k": value(deep - 1)}, [value(deep - 1)] * 2, {}, []] if deep else [])])
    return [{"i": i, "s": rng.choice(strings), "v": value(3)} for i in range(n)]


@pytest.mark.parametrize(("size", "seed"), [(1, 1), (3, 2), (7, 3), (50, 4), (10**8, 5)])
def test_ranges_of_any_size_give_the_rows_of_a_whole_parse(spark, tmp_path, ranges, size, seed):
    wanted = {f"{name}.json": made_up(seed + i, n) for i, (name, n) in enumerate((("a", 2 + min(size, 9)), ("b", 1), ("c", 0)))}
    for i, (name, rows) in enumerate(wanted.items()):
        (tmp_path / name).write_bytes(("\ufeff" * (i == 0) + json.dumps(rows, indent=[None, 2, 1][i], ensure_ascii=i == 1)).encode())
    ranges(size)
    found = {}
    for r in split_json.elements(spark, str(tmp_path)).orderBy("_file", "_ord").collect():
        found.setdefault(r["_file"].rsplit("/", 1)[1], []).append((r["_ord"], json.loads(r["value"])))
    assert found == {name: list(enumerate(rows)) for name, rows in wanted.items() if rows}


@pytest.mark.parametrize("text", ['[{"a": 1}, {"b"', '[{"a": 1}', '[{"a": 1},', '{"a": 1}', '[{"a": 1} {"b": 2}]', '[1, {"a": 1}]', '[{"a": "x}]', '[{"a": 1}]]', "[", 'nope', '[{"a": tru}]', '[{"a": 1}, 2]', '[{"a": 1}]}'])
@pytest.mark.parametrize("size", [3, 10**8])
def test_a_broken_array_is_an_error(spark, tmp_path, ranges, text, size):
    (tmp_path / "x.json").write_text(text)
    ranges(size)
    with pytest.raises(Exception, match="not JSON"):
        split_json.array_rows(spark, str(tmp_path / "x.json")).collect()


def test_the_form_of_an_export_is_seen_from_its_first_character(spark, tmp_path):
    rows = [row("execute_tool x", {"gen_ai.agent.name": "a"}), row("chat", {})]
    (tmp_path / "a.json").write_text("\ufeff \n" + json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps({"rows": rows}))
    (tmp_path / "c.csv").write_text("name,operation_Id\nexecute_tool x,op\nchat,op\n")
    for name in ("a.json", "b.json", "c.csv"):
        found = readers.spans(readers.rows(spark, str(tmp_path / name))).orderBy("ord")
        assert [(r.name, r.op_id) for r in found.collect()] == [("execute_tool x", "op"), ("chat", "op")], name


def test_manifests_of_all_forms(spark, tmp_path):
    tools = [{"name": "srv___get", "inputSchema": {"type": "object"}}, {"name": "put", "parameters": {}}]
    forms = {"bare.json": tools, "listed.v1.json": {"jsonrpc": "2.0", "result": {"tools": tools}}, "result.json": {"result": tools}, "named.json": {"toolbox": "box", "tools": tools}, "none.json": []}
    for name, form in forms.items():
        (tmp_path / name).write_text(json.dumps(form))
    found = {(r.toolbox, r.tool) for r in readers.manifests(spark, str(tmp_path)).collect()}
    assert found == {(b, t) for b in ("bare", "listed", "result", "box") for t in ("get", "put")}
    assert {r.toolbox for r in readers.manifests(spark, str(tmp_path / "bare.json"), "mine").collect()} == {"mine"}
    (tmp_path / "bad.json").write_text('{"toolbox": "x"}')
    with pytest.raises(Exception, match="lists no tools: bad.json"):
        readers.manifests(spark, str(tmp_path / "bad.json")).collect()


def test_baselines_that_are_no_list_of_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('\ufeff[{"orchestration_id": "o", "run_agent": "a"}]')
    (tmp_path / "b.json").write_text('{"note": 1}')
    assert [(r.file, r.op_id, r.hits) for r in readers.baselines(spark, str(tmp_path)).collect()] == [("a.json", "o", 1)]
    (tmp_path / "c.json").write_text('[{"orchestration_id": "o", ')
    with pytest.raises(Exception, match="not a list of rows: c.json"):
        readers.baselines(spark, str(tmp_path)).collect()
