"""Attribution of replays: claims, several failures of one replay, and the spans of a replay under the recording's names."""

import random

import pytest

from spanforge.operators import attribution

M = (
    "replay string, replay_agent string, temp_version string, toolbox string, recorded_op_id string, recorded_agent string, agent string, "
    "has_local boolean, honoured boolean, has_journal boolean, excess int, missing int, remote int"
)
R = "op_id string, agent string, version string, toolboxes array<string>, a2a_calls int, content_missing int"
B = "op_id string, agent string, file string"


def manifest(replay, version, recorded, **more):
    row = {"replay_agent": "a", "toolbox": "tb@1", "agent": "a", "recorded_agent": "a", "has_local": True, "honoured": True, "has_journal": True, "excess": 0, "missing": 0, "remote": 0}
    return row | {"replay": replay, "temp_version": version, "recorded_op_id": recorded} | more


def run(op, version, **more):
    return {"op_id": op, "agent": "a", "version": version, "toolboxes": ["tb@1"], "a2a_calls": 0, "content_missing": 0} | more


def found(spark, manifests, runs, baselines):
    make = lambda rows, kind: spark.createDataFrame([tuple(r[c.split()[0]] for c in kind.split(", ")) for r in rows], kind)
    out = attribution.attributed(make(manifests, M), make(runs, R), spark.createDataFrame(baselines, B))
    return out, {r.replay: [tuple(x) for x in r.failures] for r in out.collect()}


def test_only_a_replay_with_one_baseline_takes_a_run_and_a_recording(spark):
    manifests = [manifest("m1", "1", "r1"), manifest("m2", "2", "r1"), manifest("m3", "3", "none"), manifest("m4", "4", "none"), manifest("m5", "1", "r5"), manifest("m6", "6", "twice")]
    runs = [run(f"o{i}", str(i)) for i in (1, 2, 3, 4, 6)]
    out, failures = found(spark, manifests, runs, [("r1", "a", "f"), ("r5", "a", "f"), ("twice", "a", "f"), ("twice", "a", "g")])
    assert failures == {
        "m1": [], "m2": [("the recording is replayed twice", False)], "m3": [("no baseline", False)], "m4": [("no baseline", False)],
        "m5": [("the run is attributed to another replay", False)], "m6": [("several baselines", False)],
    }
    assert attribution.exit_code(out).first()[0] == 1


def test_a_refused_replay_takes_nothing(spark):
    """m2 loses its recording to m1, so its run is free for m3."""
    manifests = [manifest("m1", "1", "r1"), manifest("m2", "2", "r1"), manifest("m3", "2", "r3")]
    _, failures = found(spark, manifests, [run("o1", "1"), run("o2", "2")], [("r1", "a", "f"), ("r3", "a", "f")])
    assert failures == {"m1": [], "m2": [("the recording is replayed twice", False)], "m3": []}


def test_all_that_speaks_against_a_replay_is_told(spark):
    manifests = [manifest("m1", "1", "r1", missing=2), manifest("m2", "2", "r2", has_local=False), manifest("m3", "3", "r3", honoured=None, remote=2), manifest("m4", "9", "r4"), manifest("m5", "", "r5")]
    runs = [run("o1", "1", a2a_calls=1, toolboxes=["live@2"]), run("o2", "2", content_missing=1), run("o3", "3")]
    out, failures = found(spark, manifests, runs, [])
    assert failures["m1"] == [("the run called other agents", False), ("the run used another toolbox", False), ("journalled calls are not ingested yet", True)]
    assert failures["m2"] == [("the manifest has no local tools", False)] and failures["m3"] == [("calls reached no session that is known", False)]
    assert failures["m4"] == [("no scored run yet", True)] and failures["m5"] == [("the manifest lacks a field", False)]
    assert attribution.failures_of(out).count() == 7 and attribution.exit_code(out.where("replay = 'm4'")).first()[0] == 3
    assert attribution.exit_code(out.limit(0)).first()[0] == 0


def test_runs_of_one_version_are_told_apart_by_toolbox(spark):
    runs = [run("o1", "1"), run("o2", "1", toolboxes=["tb@2"])]
    _, failures = found(spark, [manifest("m1", "1", "r1"), manifest("m2", "1", "r2", toolbox="tb@3"), manifest("m3", "1", "r3", toolbox=None)], runs, [("r1", "a", "f")])
    assert failures == {"m1": [], "m2": [("no run used the toolbox of the replay yet", True)], "m3": [("several scored runs", False)]}


def test_tool_differences_and_relabelling(spark):
    manifests = spark.createDataFrame([("m", "o", "a")], "replay string, op_id string, agent string")
    calls = spark.createDataFrame([("o", "a", "get", 3), ("o", "a", "load_skill", 2)], "op_id string, agent string, tool string, n int")
    journal = spark.createDataFrame([("m", "get", 1), ("m", "put", 2)], "replay string, tool string, n int")
    local = spark.createDataFrame([("m", "load_skill")], "replay string, tool string")
    assert [tuple(r) for r in attribution.tool_differences(manifests, calls, journal, local).collect()] == [("m", 2, 2)]


def test_spans_keep_their_operation(spark):
    spans = spark.createDataFrame(
        [("o", "invoke_agent a-replay", {"gen_ai.agent.name": "a-replay", "x": "y"}), ("o", "POST /api/projects/p/toolboxes/tb-r/versions/1/mcp", {}), ("p", "chat", {})],
        "op_id string, name string, d map<string,string>",
    )
    names = spark.createDataFrame([("o", "a-replay", "a", "tb-r@1", "tb@7")], "op_id string, agent string, recorded_agent string, toolbox string, recorded_toolbox string")
    rows = sorted(attribution.as_recorded(spans, names).collect(), key=lambda r: r.name, reverse=True)
    assert [(r.op_id, r.name, r.d) for r in rows] == [
        ("o", "invoke_agent a", {"gen_ai.agent.name": "a", "x": "y"}), ("o", "POST /api/projects/p/toolboxes/tb/versions/7/mcp", {})]


def test_a_chain_of_refusals(spark):
    """Each second replay is refused, and frees what the next one needs."""
    chain = [("m1", "1", "r1"), ("m2", "2", "r1"), ("m3", "2", "r3"), ("m4", "4", "r3"), ("m5", "4", "r5"), ("m6", "6", "r5"), ("m7", "6", "r7")]
    _, failures = found(spark, [manifest(*x) for x in chain], [run(f"o{i}", str(i)) for i in (1, 2, 4, 6)], [(f"r{i}", "a", "f") for i in (1, 3, 5, 7)])
    assert [m for m, x in failures.items() if not x] == ["m1", "m3", "m5", "m7"]
    assert failures["m2"] == failures["m4"] == failures["m6"] == [("the recording is replayed twice", False)]


@pytest.mark.parametrize(("seed", "runs", "keys"), [(1, 30, 30), (2, 5, 40), (3, 40, 3), (4, 12, 12)])
def test_matching_is_that_of_a_loop(spark, seed, runs, keys):
    rng = random.Random(seed)
    claims = [(i, rng.randrange(runs), rng.randrange(keys)) for i in range(60)] + [(60 + i, 100 + i // 2, 100 + (i + 1) // 2) for i in range(14)]
    taken, used, met = set(), set(), []
    for i, r, k in claims:
        if r not in taken and k not in used:
            taken.add(r), used.add(k), met.append(i)
    df = spark.createDataFrame(claims, "order int, r int, k int").repartition(3)
    assert sorted(r.order for r in attribution.matched(df, ["r"], ["k"]).collect()) == met
    assert attribution.matched(df.limit(0), ["r"], ["k"]).count() == 0


def test_one_of_two_replays_of_a_recording(spark):
    out, _ = found(spark, [manifest("m1", "1", "r1"), manifest("m2", "2", "r1")], [run("o1", "1"), run("o2", "2")], [("r1", "a", "f")])
    assert out.where("failure is null").count() == 1
