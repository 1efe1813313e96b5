import hashlib
import zlib

import pyarrow.fs as pafs
import pytest

from spanforge.llm import media

TEXTS = ["", "a", "x" * 575, "x" * 576, "x" * 577, "größer 日本 " * 3000, "a", None]


def test_png_round_trip():
    for text in TEXTS:
        data = (text or "").encode()
        n, samples = media.from_png(media.to_png(data))
        assert n == len(data) and samples.tobytes() == media.padded(data)
        assert len(media.padded(data)) % 576 == 0 and len(media.padded(data)) >= 576
    assert media.to_png(b"a") == media.to_png(b"a")
    damaged = bytearray(media.to_png(b"abc"))
    damaged[60] ^= 1
    with pytest.raises(ValueError):
        media.from_png(bytes(damaged))


def written(spark, tmp_path, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(cast(text as binary), x'') as payload").coalesce(2)
    return media.write_archives(docs, f"file://{tmp_path}/in", key="doc_id", payload="payload", **options)


def test_written_and_read_in_ranges(spark, tmp_path):
    rows = [*enumerate(TEXTS), (None, "null id"), (1, "a")]
    done = written(spark, tmp_path, rows, archive_bytes=2000)
    assert done.agg({"members": "sum"}).first()[0] == len(rows)
    for size in (100, 5000, 1 << 20):
        read = media.read_archives(spark, f"file://{tmp_path}/in", range_bytes=size)
        got = sorted((r.key or "", r.n_bytes, r.payload_sha256, r.tail_crc32, r.error) for r in media.described(read).collect())
        want = []
        for k, text in rows:
            data = (text or "").encode()
            payload = media.padded(data)
            want.append(("" if k is None else str(k), len(data), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), None))
        assert got == sorted(want)


def test_damaged_member_is_alone(spark, tmp_path):
    written(spark, tmp_path, [(i, f"text {i} " * 50) for i in range(6)]).collect()
    bad = media.read_archives(spark, f"file://{tmp_path}/in").orderBy("archive", "at").first()
    with open(bad.archive, "r+b") as file:
        file.seek(bad.at + 60)
        file.write(b"\0\0\0\0")
    rows = media.described(media.read_archives(spark, f"file://{tmp_path}/in", tries=2)).collect()
    assert len(rows) == 6 and [r.key for r in rows if r.error] == [bad.key]
    assert all((r.n_bytes is None) == (r.error is not None) for r in rows)


def test_member_is_tried_again(monkeypatch, tmp_path, spark):
    written(spark, tmp_path, [(1, "one"), (2, "two")]).collect()
    real, failed = media.read_member, []

    def flaky(system, path, info):
        if info.filename not in failed:
            failed.append(info.filename)
            raise OSError("gone")
        return real(system, path, info)

    monkeypatch.setattr(media, "read_member", flaky)
    reader = media.ArchiveReader(f"file://{tmp_path}/in", media.RANGE, 2)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["key"] for r in rows) == ["1", "2"] and all(r["error"] is None for r in rows) and failed


def test_empty_table(spark, tmp_path):
    written(spark, tmp_path, []).collect()
    assert media.described(media.read_archives(spark, f"file://{tmp_path}/in")).count() == 0
    assert isinstance(pafs.LocalFileSystem(), pafs.FileSystem)


def test_an_archive_without_a_directory_and_a_broken_image_stop_nothing(spark, tmp_path):
    written(spark, tmp_path, [(i, f"text {i} " * 50) for i in range(8)], archive_bytes=500).collect()
    first, *_ = sorted(str(x) for x in (tmp_path / "in").glob("*.zip"))
    members = media.read_archives(spark, f"file://{tmp_path}/in").where(f"archive = '{first}'").count()
    with open(first, "r+b") as file:
        file.seek(-22, 2)
        file.write(b"\0" * 22)
    rows = media.described(media.read_archives(spark, f"file://{tmp_path}/in", tries=2, range_bytes=100)).collect()
    assert len(rows) == 8 - members + 1 and [r.error[:9] for r in rows if r.error] == ["directory"]
    broken = spark.createDataFrame([("k", bytearray(b"no image"), None), ("l", bytearray(media.to_png(b"x")[:40]), None), ("m", bytearray(media.to_png(b"x")), None)], "key string, media binary, error string")
    assert [(r.key, r.n_bytes, r.error is None) for r in media.described(broken).collect()] == [("k", None, False), ("l", None, False), ("m", 1, True)]
