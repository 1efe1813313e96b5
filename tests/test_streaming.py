"""Streams: the cap of an hour over micro-batches and restarts, replays that wait, content that lands late, and sessions that go on."""

from datetime import datetime, timedelta

import pytest

from spanforge.operators import attribution
from spanforge.streaming import caps, incremental, sessions
from spanforge.streaming.retries import Retries
from tests.test_attribution import B, M, R, manifest, run

BEGIN = datetime(2024, 1, 1, 10)


def drained(stream, folder, name="out"):
    """All that is there goes through the stream, one file a batch."""
    writer = stream.writeStream.format("parquet").option("path", str(folder / name)).option("checkpointLocation", str(folder / f"{name}-state"))
    writer.trigger(availableNow=True).start().awaitTermination()


def added(spark, rows, kind, path):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(path))


def test_the_cap_of_an_hour_holds_over_batches_and_a_restart(spark, tmp_path):
    kind = "agent string, ts timestamp, n int"

    def stream():
        rows = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return caps.capped_by_hour(rows, 3, "agent", order=("n",))

    for batch in range(2):
        added(spark, [("a", BEGIN + timedelta(minutes=9 * batch + i % 4), 10 * batch + i) for i in range(10)][::-1] + [("b", BEGIN, batch)], kind, tmp_path / "in")
    drained(stream(), tmp_path)
    for batch in range(2, 5):  # after a restart
        added(spark, [("a", BEGIN + timedelta(minutes=9 * batch), 10 * batch + i) for i in range(4)] + [("b", BEGIN, batch)], kind, tmp_path / "in")
    drained(stream(), tmp_path)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.agent, r.n) for r in found.collect()) == [("a", 0), ("a", 4), ("a", 8), ("b", 0), ("b", 1), ("b", 2)]
    # The watermark passes the hour: its state goes, and what comes later than the delay is dropped.
    added(spark, [("a", BEGIN + timedelta(hours=5), 100)], kind, tmp_path / "in")
    drained(stream(), tmp_path)
    added(spark, [("a", BEGIN + timedelta(minutes=50), 101), ("a", BEGIN + timedelta(hours=5), 102)], kind, tmp_path / "in")
    drained(stream(), tmp_path)
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).where("n >= 100").collect()) == [100, 102]


def test_a_share_below_one_percent_is_refused(spark):
    for percent in (0, 0.25, 101):
        with pytest.raises(ValueError, match="percent"):
            incremental.sampled(spark.range(9), percent, "id")
    assert incremental.sampled(spark.range(9), 100, "id").count() == 9


def made(spark, rows, kind):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in kind.split(", ")) for r in rows], kind)


def test_replays_wait_until_their_content_is_there(spark, tmp_path):
    runs = {"rows": []}
    known = lambda: (made(spark, runs["rows"], R), spark.createDataFrame([("r1", "a", "f"), ("r2", "a", "f")], B))
    retries = lambda: Retries(spark, str(tmp_path / "store"), known, tries=4)
    exits, none = [], made(spark, [], M)
    batches = [
        ([manifest("m1", "1", "r1"), manifest("m2", "2", "r2", has_local=False)], [run("o1", "1", content_missing=2), run("o2", "2")]),
        ([], [run("o1", "1", content_missing=1), run("o2", "2")]),
        ([manifest("m3", "9", "r2")], [run("o1", "1"), run("o2", "2")]),
        ([manifest("m4", "1", "r2"), manifest("m5", "4", "r1")], [run("o1", "1"), run("o4", "4")]), ([], []), ([], []), ([], []),
    ]
    for i, (arrived, there) in enumerate(batches):
        runs["rows"] = there
        one = retries()  # each batch is judged by a new one, as after a restart
        one.step(made(spark, arrived, M) if arrived else none, i)
        if i == 2:
            one.step(made(spark, arrived, M), i)  # and a batch that is repeated changes nothing
        exits.append(attribution.exit_code(one.results().where("replay <> 'm2'")).first()[0])
    found = {r.replay: (r.outcome, r.tries, [x.failure for x in r.failures]) for r in retries().results().collect()}
    assert found == {
        "m1": ("attributed", 3, []), "m2": ("failed", 1, ["the manifest has no local tools"]), "m3": ("gave up", 4, ["no scored run yet"]),
        "m4": ("failed", 1, ["the run is attributed to another replay"]), "m5": ("failed", 1, ["the recording is replayed twice"]),
    }
    assert exits[:3] == [3, 3, 3]
    only = retries().results().where("replay = 'm1'")
    assert attribution.exit_code(only).first()[0] == 0


def test_ticks_judge_replays_that_wait(spark, tmp_path):
    known = lambda: (made(spark, [], R), spark.createDataFrame([], B))
    made(spark, [manifest("m1", "1", "r1")], M).write.parquet(str(tmp_path / "in"))
    retries = Retries(spark, str(tmp_path / "store"), known, tries=2)
    query = retries.start(spark.readStream.schema(M).parquet(str(tmp_path / "in")), str(tmp_path / "state"), every="1 second")
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if query.exception() is not None or len(list((tmp_path / "store" / "waiting").glob("batch=*"))) > 2:
                break
    finally:
        query.stop()
    assert [(r.replay, r.outcome, r.tries) for r in retries.results().collect()] == [("m1", "gave up", 2)]


def test_content_that_lands_late_and_content_that_does_not(spark, tmp_path):
    spans, content = "id string, ts timestamp", "id string, landed timestamp, arguments string, result string"

    def stream():
        read = lambda kind, name: spark.readStream.schema(kind).parquet(str(tmp_path / name))
        return incremental.enriched(read(spans, "spans"), read(content, "content"), delay="1 minute")

    added(spark, [("s1", BEGIN), ("s2", BEGIN), ("s3", BEGIN)], spans, tmp_path / "spans")
    added(spark, [("s1", BEGIN + timedelta(seconds=5), "{}", "now")], content, tmp_path / "content")
    drained(stream(), tmp_path)
    added(spark, [("s2", BEGIN + timedelta(seconds=22), "{}", "late"), ("s3", BEGIN + timedelta(seconds=90), "{}", "too late")], content, tmp_path / "content")
    added(spark, [("s9", BEGIN + timedelta(hours=1))], spans, tmp_path / "spans")
    drained(stream(), tmp_path)
    added(spark, [("s10", BEGIN + timedelta(hours=2))], spans, tmp_path / "spans")
    added(spark, [("s10", BEGIN + timedelta(hours=2), "{}", "x")], content, tmp_path / "content")
    drained(stream(), tmp_path)
    drained(stream(), tmp_path)
    found = {r.id: (r["_result"], r.content_missing) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert (found["s1"], found["s2"], found["s3"]) == (("now", False), ("late", False), (None, True))


@pytest.mark.parametrize("exhausted", ["repeat", "diverge"])
def test_sessions_go_on_after_a_restart(spark, tmp_path, exhausted):
    kind = "session string, op_id string, ord long, tool string, key string"
    recorded = spark.createDataFrame([("o", "k"), ("o", "k"), ("o", "x")], "op_id string, key string")

    def stream():
        return sessions.replay_sessions(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), recorded, exhausted=exhausted)

    for batch in ([("s", "o", 1, "t", "k"), ("s", "o", 2, "t", "none"), ("r", "o", 1, "t", "x")], [("s", "o", 3, "t", "k"), ("s", "o", 4, "t", "k"), ("r", "o", 2, "t", "x")]):
        added(spark, batch, kind, tmp_path / "in")
        drained(stream(), tmp_path)
    found = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("session", "seq", "outcome", "answer").orderBy("session", "seq").collect()]
    more = ("repeated", "repeated") if exhausted == "repeat" else ("diverged", "diverged")
    last = (1, 2) if exhausted == "repeat" else (None, None)
    assert found == [("r", 0, "matched", 1), ("r", 1, more[0], last[0]), ("s", 0, "matched", 1), ("s", 1, "diverged", None), ("s", 2, "matched", 2), ("s", 3, more[1], last[1])]
