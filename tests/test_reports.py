"""Reports on scored runs, datasets before they are handed on, names of skill files, and scrubbed exports from file to file."""

import json

from spanforge.operators import baseline, dataset, rates, redaction
from spanforge.operators.spans import tool_steps
from spanforge.sources import readers, sinks

SALT = "a salt of sixteen characters"


def test_the_sections_of_a_report(spark):
    runs = spark.createDataFrame([("o2", "a", "a|x", 1, 3), ("o1", "b", "b", 1, 0), ("o1", "a", "a", 1, 2), ("o0", "z", "z", 0, 1)], "op_id string, agent string, traj_key string, started int, n_calls int")
    rows = [("o2", "a", "late", 1, True, False, "r1"), ("o2", "a", "early", 0, False, False, "r0"), ("o1", "a", "early", 0, False, False, "r2"), ("o1", "a", "late", 1, True, None, "none"),
            ("o1", "b", "late", 1, True, None, "none"), ("o0", "z", "late", 1, True, True, None)]
    verdict = spark.createDataFrame(rows, "op_id string, agent string, check string, place int, gating boolean, passed boolean, reason string")
    found = {k: [tuple(r) for r in df.collect()] for k, df in rates.report(runs, verdict).items()}
    assert [(r[2], r[1], r[5], r[6]) for r in found["runs"]] == [("o0", "z", True, "all clear"), ("o1", "a", True, "early"), ("o2", "a", False, "early, late"), ("o1", "b", True, "all clear")]
    assert [(r[2], r[1], r[6], r[7]) for r in found["detail"]] == [("o1", "a", "early", "r2"), ("o2", "a", "early", "r0"), ("o2", "a", "late", "r1")]
    assert found["not_scored"] == [("late", "none", 2)] and found["summary"] == [("late", True, 1, 2, 2), ("early", False, 0, 2, 0)]
    none = rates.report(runs.limit(0), verdict.limit(0))
    assert all(df.count() == 0 for df in none.values())


def test_columns_in_the_order_of_their_first_row(spark):
    rows = [{"b": 1, "a": 2}, {"a": 1, "c": 1, "b": None}, {}, {"d": 1, "a": 0}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("nope",), (None,)], "json string").coalesce(1)
    assert [tuple(r) for r in dataset.columns_in_order(df).collect()] == [("b", 0, 2), ("a", 1, 3), ("c", 2, 1), ("d", 3, 1)]


def test_a_dataset_before_it_is_handed_on(spark):
    kind = "traj_key string, expected_actions array<string>, tool_outcomes array<string>, text string"
    rows = spark.createDataFrame([("a|PERSON_12", ["x"], ["1", "2"], "t" * 50), ("a|Full", [], None, ""), ("a|PERSON_12", None, [], "")], kind)
    row = dataset.dataset_summary(rows, largest=60).first()
    assert (row["rows"], row.calls, row.with_expectations, row.too_large, row.scrubbed_keys) == (3, 2, 1, True, ["a|PERSON_12"]) and row.largest > 60
    row = dataset.dataset_summary(rows.drop("traj_key").limit(0)).first()
    assert (row["rows"], row.calls, row.too_large, row.scrubbed_keys) == (0, 0, False, [])


def test_names_of_skill_files_are_nobodys(spark):
    skill = "---\nname: classification\n---\n# Priority Matrix\nAsk the Triage Teams."
    texts = spark.createDataFrame([(skill,), ("Priority Matrix applies. Eli Seale and the Triage Team reported this to a.b@example.com",), (None,)], "text string")
    found = redaction.without_skills(redaction.candidates(texts.where("text not like '---%'")), texts)
    assert {(r.literal, r.kind) for r in found.collect()} == {("Eli Seale", "NAME?"), ("a.b@example.com", "EMAIL")}
    assert redaction.without_skills(found.limit(0), texts).count() == 0


def test_from_an_export_to_scrubbed_rows(spark, tmp_path):
    call = {"gen_ai.agent.name": "a", "gen_ai.tool.name": "find", "gen_ai.tool.call.arguments": json.dumps({"query": "Eli Seale"}), "gen_ai.tool.call.result": json.dumps({"notes": "José\nmail a@b.org"})}
    (tmp_path / "t.json").write_text(json.dumps([{"timestamp": "2026-09-03T13:02:03Z", "id": "s1", "operation_Id": "op", "name": "execute_tool find", "customDimensions": json.dumps(call)}]))
    listed = spark.createDataFrame([("Eli Seale", "PERSON"), ("josé", "PERSON")], "literal string, kind string")
    spans = readers.spans(readers.rows(spark, str(tmp_path / "t.json")))
    told = sinks.write_scrubbed(redaction.scrubbed(spans, listed, SALT), listed, SALT, f"file://{tmp_path}/out", "t.json").first()
    assert (told.salt_fingerprint, told.literals, told.source) == (redaction.fingerprint(SALT), 2, "t.json")
    kept = sinks.read_together(spark, f"file://{tmp_path}/out", "rows")
    step = tool_steps(kept).first()
    assert step.arguments.startswith('{"query": "PERSON_') and "EMAIL_" in step.result and "José" not in step.result and step.tool == "find"
    assert redaction.still_there(kept.selectExpr("to_json(d) as text"), listed).count() == 0


def test_each_side_of_a_comparison_is_read_once(spark, tmp_path):
    """Changes of every kind, without and with a check that only one side has; the plan scans each side a single time."""
    columns = "op_id string, agent string, check string, gating boolean, passed boolean"
    now = [("a", "x", "c1", True, False), ("a", "x", "c2", True, True), ("a", "x", "c3", False, None), ("a", "x", "c4", False, True), ("b", "x", "c1", True, True), (None, "x", "c1", True, True)]
    was = [("a", "x", "c1", True, True), ("a", "x", "c2", True, False), ("a", "x", "c3", False, True), ("a", "x", "c5", True, True), ("d", "x", "c1", True, False), (None, "x", "c1", True, True)]
    for name, rows in (("now", now), ("was", was)):
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}")
    current, before = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("now", "was"))
    found = baseline.differences(current, before)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        ("a", "x", "c1", True, True, False, "regression"), ("a", "x", "c2", True, False, True, "fix"), ("a", "x", "c3", False, True, None, "lost"), ("a", "x", "c4", False, None, True, "same"),
        ("b", "x", None, None, None, None, "new"), (None, "x", None, None, None, None, "new"), ("d", "x", None, None, None, None, "missing"), (None, "x", None, None, None, None, "missing"),
    ]))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    failures = lambda df: {r["reason"]: r["n"] for r in df.collect()}
    assert failures(baseline.strict(baseline.paired(current, before))) == failures(baseline.strict_failures(current, before)) == {
        "scored without a baseline": 2, "in the baseline, not scored": 2,
    }
