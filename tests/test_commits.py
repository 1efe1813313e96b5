"""Versions of tables under several writers at once."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from spanforge.sources import sinks
from spanforge.sources.commits import CommitLog, Conflict


def folders(root):
    return {x for x in os.listdir(root) if not x.startswith(("_", "."))}


def skills(spark, *rows):
    kind = "op_id string, started string, ord long, skill_name string, sha256 string, body string, truncated boolean, errored boolean"
    return spark.createDataFrame([(f"o{i}", "t", i, f"s{h}", h, f"body {h}", False, False) for i, h in enumerate(rows)], kind)


def test_an_entry_is_put_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/x")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.put(1, {"folder": str(i), "tables": []}), range(8)))
    assert sum(won) == 1 and log.versions() == [1] and log.entry(1)["folder"] == str(won.index(True))
    assert [x for x in os.listdir(tmp_path / "x" / "_versions") if not x.endswith(".crc")] == [f"{1:020d}.json"]


def test_writers_at_once_lose_no_version_and_add_each_hash_once(spark, tmp_path):
    root = f"file://{tmp_path}/registry"
    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(lambda i: sinks.append_skills(spark, skills(spark, "a", f"own{i}"), root).count(), range(4)))
    held = sorted(r.sha256 for r in sinks.registered_skills(spark, root).collect())
    assert held == ["a", "own0", "own1", "own2", "own3"] and sorted(added) == [1, 1, 1, 2]
    assert CommitLog(spark, root).versions() == [1, 2, 3, 4] and len(folders(tmp_path / "registry")) == 4
    assert sinks.append_skills(spark, skills(spark, "a"), root).count() == 0 and CommitLog(spark, root).latest() == 4


def test_a_writer_that_comes_second_is_told(spark, tmp_path):
    root, none = f"file://{tmp_path}/both", spark.createDataFrame([], "failure string")
    assert sinks.write_together({"a": spark.range(1), "b": spark.range(1)}, none, root, after=0)
    with pytest.raises(Conflict, match="version 1 "):
        sinks.write_together({"a": spark.range(2)}, none, root, after=0)
    assert sinks.write_together({"a": spark.range(3)}, none, root)
    assert [sinks.read_together(spark, root, "a", version=v).count() for v in (1, 2)] == [1, 3]
    assert sinks.read_together(spark, root, "b").count() == 1 and sinks.read_together(spark, root, "c") is None
    assert len(folders(tmp_path / "both")) == 2


def test_what_an_aborted_write_has_staged_is_removed(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/x")
    with pytest.raises(Exception, match="no"):
        log.write(lambda _: {"a": spark.range(3), "b": spark.range(3).selectExpr("raise_error('no') as x")})
    assert log.versions() == [] and not folders(tmp_path / "x")

    def late(base):
        log.put(base + 1, {"folder": "other", "tables": []})
        return {"a": spark.range(base + 1)}

    with pytest.raises(Conflict):
        log.write(late, tries=3)
    assert log.versions() == [1, 2, 3] and not folders(tmp_path / "x")
