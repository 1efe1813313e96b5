"""Graders by signature, messages of any depth, exit codes of a build, and operations by their ids."""

import json

import pytest
from pyspark.errors import AnalysisException

from spanforge.operators import baseline, dataset, discovery, graders
from spanforge.operators.graders import Grader


def overlap(response, expected, least=1, weight=1.0):
    if response is None or least is None:
        return None
    hits = len(set(response.split()) & set(expected or []))
    return {"score": weight * hits, "reason": f"{hits} of {least}", "enough": hits >= least}


OVERLAP = Grader("overlap", overlap, "score double, reason string, enough boolean", threshold=2.0, gating=True, description="words in common", categories=("text",), settings={"weight": 2.0})
LENGTH = Grader("length", lambda response: len(response or ""), "n long")
ROWS = [("a b", ["a", "b"], 2), ("a", ["x"], 1), (None, None, 1), ("", [], None), ("a b c", ["b"], 1)]


def test_arguments_are_columns_and_outputs_are_declared(spark):
    rows = spark.createDataFrame(ROWS, "response string, expected array<string>, least int")
    found = graders.passed(graders.graded(rows, OVERLAP, LENGTH), OVERLAP, LENGTH)
    assert [tuple(r.overlap) for r in found.collect()] == [(4.0, "2 of 2", True), (0.0, "0 of 1", False), (None,) * 3, (None,) * 3, (2.0, "1 of 1", True)]
    assert [(r.overlap.score, r.length.n, r.overlap_passed) for r in found.collect()][:3] == [(4.0, 3, True), (0.0, 1, False), (None, 0, None)]
    told = {(r.grader, r.metric): (r.n, r.average) for r in graders.metrics(graders.graded(rows.limit(3), OVERLAP, LENGTH), OVERLAP, LENGTH).collect()}
    assert told == {("overlap", "score"): (2, 2.0), ("overlap", "enough"): (2, 0.5), ("length", "n"): (3, pytest.approx(4 / 3))}
    assert graders.graded(rows.limit(0), OVERLAP).schema["overlap"].dataType == OVERLAP.schema()


def test_a_missing_column_fails_at_analysis(spark):
    rows = spark.createDataFrame([("a b",)], "response string")
    with pytest.raises(AnalysisException, match="overlap needs columns that the table lacks: expected"):
        graders.graded(rows, OVERLAP)
    # A default stands for a column that is absent.
    assert graders.graded(rows.selectExpr("response", "array('a') as expected"), OVERLAP).first().overlap.reason == "1 of 1"
    with pytest.raises(AnalysisException, match="already"):
        graders.graded(rows.selectExpr("response", "1 as length"), LENGTH)


def test_the_registry_as_a_table(spark):
    rows = {r.name: r for r in graders.catalogue(spark, (OVERLAP, LENGTH), {"overlap": "3"}).collect()}
    assert (rows["overlap"]["columns"], rows["overlap"].version, rows["overlap"].threshold, rows["length"].version) == (["response", "expected", "least"], "3", 2.0, None)
    with pytest.raises(ValueError, match="unknown graders: gone"):
        graders.catalogue(spark, (OVERLAP,), {"gone": "1"})


def test_messages_of_any_depth(spark):
    deep = "bottom"
    for i in range(40):
        deep = [deep] if i % 2 else {"content": deep}
    raw = [json.dumps([{"role": "user", "content": deep}, {"parts": [{"type": "image", "content": "no"}, {"text": "a"}, [[["b"]], ""]]}]), "plain", '"quoted"', "", None, '{"a": 1}', "[" * 5000]
    df = spark.createDataFrame([(x,) for x in raw], "raw string").select(dataset.plain_messages("raw").alias("m"))
    assert [[tuple(m) for m in r.m] for r in df.collect()] == [
        [("user", "bottom"), ("user", "a\nb")], [("assistant", "plain")], [("assistant", "quoted")], [], [], [], [("assistant", "[" * 5000)]]


def test_dataset_rows_with_prompt_and_answer(spark):
    kind = "op_id string, agent string, ts int, ord int, tool string, arguments string, call_id string, result string, success boolean"
    steps = spark.createDataFrame([("o", "a", 2, 2, "put", "{}", "", "done", True), ("o", "a", 1, 1, "get", '{"k": 1}', "c1", "r" * 700, True)], kind)
    asked = json.dumps([{"role": "system", "content": ""}, {"role": "user", "content": [{"text": "please"}]}])
    said = json.dumps([{"role": "tool", "content": "x"}, {"role": "assistant", "content": "first"}, {"role": "assistant", "parts": [{"content": "last"}]}, {"role": "assistant", "content": " "}])
    runs = spark.createDataFrame([("o", "a", asked, said, ["get"]), ("p", "b", "go", None, None)], "op_id string, agent string, query string, response string, expected array<string>")
    found = {r.op_id: r for r in dataset.dataset_rows(steps, runs).collect()}
    assert [(m.role, m.type, m.content[:5]) for m in found["o"].messages] == [
        ("user", "text", "pleas"), ("assistant", "tool_call", '{"k":'), ("tool", "tool_result", "rrrrr"), ("assistant", "tool_call", "{}"), ("tool", "tool_result", "done"), ("assistant", "text", "last")]
    assert (found["o"].tool_outcomes[0].result_len, len(found["o"].tool_outcomes[0].result_head), found["o"].expected_actions) == (700, 600, ["get"])
    assert [(m.role, m.content) for m in found["p"].messages] == [("assistant", "go")] and found["p"].n_steps == 0


@pytest.mark.parametrize(("below", "decided", "passed", "wanted"), [
    (["x"], True, True, (1, "below a threshold")), (["x"], False, False, (1, "below a threshold")), ([], False, True, (1, "worse than the baseline")), ([], True, False, (0, None)),
    (None, None, False, (1, "a run failed")), (None, None, True, (0, None)), ([], None, None, (0, None)),
])
def test_what_a_build_ends_with(spark, below, decided, passed, wanted):
    runs = spark.createDataFrame([] if passed is None else [("o", passed)], "op_id string, passed boolean")
    under = None if below is None else spark.createDataFrame([(x,) for x in below], "check string")
    row = baseline.exit_code(runs, below=under, decided=None if decided is None else spark.createDataFrame([(decided,)], "passed boolean")).first()
    assert (row.exit_code, row.reason) == wanted


def test_lost_coverage_may_be_allowed(spark):
    changes = spark.createDataFrame([("o", "a", "c", "lost", True)], "op_id string, agent string, check string, change string, gating boolean")
    assert [baseline.decision(changes, allow_lost=x).first().passed for x in (False, True)] == [False, True]


def test_operations_by_their_ids(spark, monkeypatch):
    spans = spark.createDataFrame([("o", "a"), ("o", "b"), ("p", "a"), ("q", "c")], "op_id string, agent string")
    found = lambda *a: sorted((r.op_id, r.agent) for r in discovery.named_operations(spans, *a).collect())
    assert found([" o ", "", "o"]) == [("o", "a"), ("o", "b")] and found([], ("b",)) == [("o", "a"), ("o", "b")]
    monkeypatch.setattr(discovery, "MOST_IDS", 1)
    assert found(["q", "p"]) == [("p", "a"), ("q", "c")]
