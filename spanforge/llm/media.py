"""Media columns: images in archive directories, written by tasks and read through a data source of its own.

Payloads are stored as 8-bit grey PNG images, 576 samples to a row, in ZIP archives without further
compression. A task writes its archives under a name of its own and moves them into place, so a task that runs
again replaces what it wrote before. ``ArchiveSource`` plans byte ranges over the files of a directory; each
range reads the members whose header begins in it, one by one at its offset, checks them, and tries a member again
on its own when that fails. A member that cannot be read becomes a row with ``error`` and no ``media``.

Cases: null and empty texts are one row of padding; texts are stored whole; a null key is stored as such; repeated
rows are members of their own; an empty table writes no archive and gives an empty result. Extra columns are not stored.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spanforge.llm.common import shared_dir, table

ROW = 576
PAD = b"\xff"
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Bytes of payloads before a task begins another archive, of a read range, and of a batch.
ARCHIVE, RANGE, BATCH = 64 << 20, 8 << 20, 8 << 20
TRIES = 3
SCHEMA = "archive string, key string, at long, media binary, error string"


def padded(data: bytes) -> bytes:
    return data + PAD * (max(1, -(-len(data) // ROW)) * ROW - len(data))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(data: bytes) -> bytes:
    """The padded bytes as the samples of an image; the number of bytes without padding is kept beside them."""
    samples = np.frombuffer(padded(data), np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(samples), ROW + 1), np.uint8)
    lines[:, 1:] = samples
    head = struct.pack(">IIBBBBB", ROW, len(samples), 8, 0, 0, 0, 0)
    return b"".join([
        SIGNATURE, _chunk(b"IHDR", head), _chunk(b"tEXt", b"Length\0%d" % len(data)),
        _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)), _chunk(b"IEND", b""),
    ])


def from_png(media: bytes) -> tuple[int, np.ndarray]:
    """The number of bytes without padding, and the samples by row, of an image that ``to_png`` made."""
    if not media.startswith(SIGNATURE):
        raise ValueError("not a PNG image")
    at, n, parts, height = len(SIGNATURE), None, [], 0
    while at < len(media):
        size, kind = struct.unpack_from(">I4s", media, at)
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + size)[0]:
            raise ValueError(f"chunk {kind!r} is damaged")
        if kind == b"IHDR":
            height = struct.unpack(">IIBBBBB", body)[1]
        elif kind == b"tEXt":
            n = int(body.partition(b"\0")[2])
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, ROW + 1)
    if lines[:, 0].any():
        raise ValueError("only rows without filter are read")
    return n, lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean, contrast, edges and an eight-bin histogram of the samples, as text."""
    flat = samples.ravel()
    bins = np.bincount(flat >> 5, minlength=8)
    edges = float(np.abs(np.diff(flat.astype(np.int16))).mean())
    return f"{flat.mean():.4f};{flat.std():.4f};{edges:.4f};" + ",".join(map(str, bins.tolist()))


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_archives(rows: DataFrame, directory: str, *, key: str, payload: str, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Writes an image of each row's ``payload`` (binary) under its ``key``, and returns the archives with their
    numbers of members; it is this frame's evaluation that writes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(directory)
        system.create_dir(folder, recursive=True)
        task, number, archive, done = TaskContext.get().partitionId(), 0, None, []

        def close() -> None:
            nonlocal archive
            members = len(archive.infolist())
            archive.close()
            stream.close()
            system.move(temporary, final)
            done.append((final, members))
            archive = None

        for batch in batches:
            for k, data in zip(batch.column("_key").to_pylist(), batch.column("_payload")):
                if archive is None:
                    final = f"{folder}/part-{task:06d}-{number:04d}.zip"
                    temporary, number = f"{folder}/.{uuid.uuid4().hex}", number + 1
                    stream, written = system.open_output_stream(temporary), 0
                    archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                data = data.as_py() or b""
                info = zipfile.ZipInfo(f"{len(archive.infolist())}" + ("" if k is None else f".{k}"))
                archive.writestr(info, to_png(data))
                written += len(data)
                if written >= archive_bytes:
                    close()
        if archive is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["archive", "members"])

    chosen = rows.select(F.col(key).cast("string").alias("_key"), F.col(payload).alias("_payload"))
    return chosen.mapInArrow(run, "archive string, members long")


class Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


def read_member(system: pafs.FileSystem, path: str, info: zipfile.ZipInfo) -> bytes:
    """One member at its offset, checked against its checksum."""
    with system.open_input_file(path) as file:
        file.seek(info.header_offset)
        head = file.read(30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("no member begins here")
        name, extra = struct.unpack_from("<HH", head, 26)
        file.seek(info.header_offset + 30 + name + extra)
        data = file.read(info.compress_size)
    if zlib.crc32(data) != info.CRC:
        raise ValueError("checksum differs")
    return data


class ArchiveReader(DataSourceReader):
    def __init__(self, directory: str, range_bytes: int, tries: int):
        self.directory, self.range_bytes, self.tries = directory, range_bytes, tries

    def partitions(self) -> list[Range]:
        system, folder = _opened(self.directory)
        if system.get_file_info(folder).type != pafs.FileType.Directory:
            return [Range("", 0, 0)]
        files = [f for f in system.get_file_info(pafs.FileSelector(folder)) if f.is_file and f.base_name.endswith(".zip")]
        step = self.range_bytes
        return [Range(f.path, at, at + step) for f in sorted(files, key=lambda f: f.path) for at in range(0, f.size, step)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = _opened(self.directory)
        rows, size, members = [], 0, []
        for attempt in range(self.tries):
            try:
                with system.open_input_file(partition.path) as file, zipfile.ZipFile(file) as archive:
                    members = [x for x in archive.infolist() if partition.begin <= x.header_offset < partition.end]
                rows = []
                break
            except (OSError, ValueError, zipfile.BadZipFile) as e:
                # Its first range tells that an archive can't be read; the others have nothing.
                rows = [(partition.path, None, 0, None, f"directory: {e}")] if partition.begin == 0 else []
                time.sleep(0.1 * attempt)
        for info in members:
            media, error = None, None
            for attempt in range(self.tries):
                try:
                    media, error = read_member(system, partition.path, info), None
                    break
                except (OSError, ValueError) as e:
                    error = str(e)
                    time.sleep(0.1 * attempt)
            _, dot, key = info.filename.partition(".")
            rows.append((partition.path, key if dot else None, info.header_offset, media, error))
            size += len(media or b"")
            if size >= BATCH:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["archive", "key", "at", "media", "error"])


class ArchiveSource(DataSource):
    """``spark.read.format("media_archive").load(directory)``; options ``range_bytes`` and ``tries``."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options["path"], int(self.options.get("range_bytes", RANGE)), int(self.options.get("tries", TRIES)))


def read_archives(spark: SparkSession, directory: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("media_archive").options(**options).load(directory)


def described(members: DataFrame) -> DataFrame:
    """``members`` with n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and feature in place
    of their media; all null for members with an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, errors = [], batch.column("error").to_pylist()
            for i, media in enumerate(batch.column("media")):
                media = media.as_py()
                if media is None:
                    rows.append((None,) * 7)
                    continue
                try:
                    n, samples = from_png(media)
                except (ValueError, struct.error, zlib.error) as e:
                    rows.append((None,) * 7)
                    errors[i] = str(e)
                    continue
                payload = samples.tobytes()
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(errors, pa.string()), *(pa.array(x, t) for x, t in zip(columns, kinds))], names=names)

    names = ["key", "error", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kind = "key string, error string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return members.select("key", "error", "media").mapInArrow(run, kind)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    directory = f"{shared_dir(spark)}/spanforge/media-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    write_archives(docs.select("doc_id", payload.alias("payload")), directory, key="doc_id", payload="payload").agg(F.sum("members")).collect()
    found = described(read_archives(spark, directory))
    return found.select(F.col("key").cast("long").alias("doc_id"), *found.columns[2:], "error")
