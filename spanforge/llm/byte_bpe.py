"""Byte-level BPE encoding and decoding with overlapping chunks.

Texts up to ``chunk`` characters are encoded where they are read. Longer ones are cut into chunks that overlap
and are dealt out again: each chunk is pre-tokenised on its own, and two neighbours are stitched at the first
boundary in their overlap that both have found and that holds wherever a scan begins, which is the end of a
run of letters or digits and a change to white space. The stretches between such cuts are encoded in parallel.
Where a run is longer than the overlap no cut is found, and the chunks that it spans become one stretch. Ids
are exactly those of encoding the whole text at once; decoding concatenates the bytes of the ids.

A pre-token is merged by ranks: its bytes are a linked list, a queue holds the adjacent pairs by rank and place, and the
first of the lowest rank is merged until no pair is a token; a short one does without list and queue. A worker remembers the ids of short pre-tokens.

Cases: null and empty texts have no ids and decode to no bytes; repeated rows are encoded each; an empty table
gives an empty result; texts of any length are encoded whole. The text column is replaced by ``ids``
(unsigned 32-bit little-endian) and ``n_tokens``; other columns pass through, those with these names are
replaced. Names of other columns don't matter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import packed, stored, table, unpacked

CHUNK, OVERLAP = 1 << 15, 1 << 11
#: The longest look ahead of the pattern: a quotation mark and two letters.
AHEAD = 3
#: A cut that holds wherever a scan begins, as what stands before and after it.
HARD = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\P{White_Space})(?=\p{White_Space})")


#: Characters of a pre-token that is remembered, and how many are.
SHORT, REMEMBERED = 48, 1 << 18
#: Above every rank: a pair that is no token.
NEVER = 1 << 32


class Merges(dict):
    """Ids (little-endian) by pre-token; those that are not known yet are merged by ranks."""

    def __init__(self, path: str):
        super().__init__()
        #: What was remembered before; of this, what is met again moves on, so frequent pre-tokens are never forgotten.
        self.older: dict[str, bytes] = {}
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}

    def __missing__(self, token: str) -> bytes:
        found = self.older.get(token)
        if found is None:
            data = token.encode()
            ids = self.merged_short(data) if len(data) <= SHORT else self.merged(data)
            found = pack(f"<{len(ids)}I", *ids)
        if len(token) <= SHORT:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[token] = found
        return found

    def merged_short(self, data: bytes) -> list[int]:
        """As ``merged``, by looking through all pairs each time, which is quicker for a few bytes."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        get = ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) != NEVER:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return [ranks[x] for x in parts]

    def merged(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        n = len(data)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        rank = [self.ranks.get(data[i : i + 2]) for i in range(n - 1)] + [None]
        queue = [(r, i) for i, r in enumerate(rank) if r is not None]
        heapify(queue)

        def pair(i: int) -> None:
            """The rank of the part at ``i`` with the next one."""
            j = after[i]
            rank[i] = self.ranks.get(data[i : end[j]]) if j < n else None
            if rank[i] is not None:
                heappush(queue, (rank[i], i))

        while queue:
            r, i = heappop(queue)
            if rank[i] != r:
                continue  # One of its parts has been merged meanwhile.
            j = after[i]
            end[i], after[i], rank[j] = end[j], after[j], None
            if after[j] < n:
                before[after[j]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = after[i]
        return out


@cache
def merges(path: str) -> Merges:
    """Read once in each Python worker."""
    return Merges(path)


@cache
def token_bytes(path: str) -> dict[int, bytes]:
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


def encode_stretch(text: str, path: str, pattern: str) -> bytes:
    return b"".join(map(merges(path).__getitem__, _pre_tokens(pattern).findall(text)))


def decode_ids(ids: bytes, path: str) -> bytes:
    known = token_bytes(path)
    return b"".join(map(known.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def _pre_tokens(pattern: str):
    return regex.compile(pattern)


def boundaries(text: str, pattern: str, begin: int, end: int) -> list[int]:
    """The ends of pre-tokens of ``text`` from ``begin`` to ``end`` that what follows the text can't change."""
    sure = len(text) - AHEAD
    return [m.end() for m in _pre_tokens(pattern).finditer(text, begin) if begin <= m.end() <= min(end, sure)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _ids(own: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([own, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["_own", "n_tokens", "ids"])


def encode(
    docs: DataFrame, *, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` without their text, with ``n_tokens`` long and ``ids`` binary."""
    encoded = _encoded(docs, text, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern, chunk, overlap)
    return unpacked(encoded, [c for c in docs.columns if c != text], "n_tokens", "ids")


def _encoded(docs: DataFrame, text: str, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """_own (the columns of ``docs`` but the text), n_tokens, ids."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    rows = docs.select(F.struct(*rest).alias("_own"), F.col(f"`{text}`").cast("string").alias("_text"))
    out = T.StructType([rows.schema["_own"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                yield _ids(part.column("_own"), [encode_stretch(x or "", path, pattern) for x in part.column("_text").to_pylist()])

    long = F.length("_text") > chunk
    short = rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(whole, out)
    return short.unionByName(_encode_long(rows.where(long), out, path, pattern, chunk, overlap))


def _encode_long(docs: DataFrame, out: T.StructType, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    chunks_type = T.StructType([
        T.StructField("_key", T.StringType()), T.StructField("_chunk", T.LongType()),
        T.StructField("_text", T.StringType()), T.StructField("_own", docs.schema["_own"].dataType),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of each text with their overlap; the first one carries the other columns."""
        n, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            carried = batch.column("_own")
            for i, body in enumerate(batch.column("_text")):
                body, n = body.as_py(), n + 1
                starts = range(0, len(body), chunk)
                for at in range(0, len(starts), 64):
                    some = starts[at : at + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{task}-{n}"] * len(some)), pa.array([x // chunk for x in some], pa.int64()),
                        pa.array([body[x : x + chunk + overlap] for x in some]), carried.take(pa.array([None if x else i for x in some], pa.int64())),
                    ], names=["_key", "_chunk", "_text", "_own"])

    chunks = stored(docs.mapInArrow(cut, chunks_type), "bpe-chunks")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each chunk, cuts among its boundaries near its beginning and in the overlap after it, from its
        beginning and from the beginning of the next."""
        for batch in batches:
            heads, tails = [], []
            for body in batch.column("_text").to_pylist():
                ends = [x for x in boundaries(body, pattern, 0, chunk + overlap) if HARD.match(body, x)]
                heads.append([x for x in ends if x <= overlap])
                tails.append([x - chunk for x in ends if x >= chunk])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_chunk"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=["_key", "_chunk", "_head", "_tail"],
            )

    order = Window.partitionBy("_key").orderBy("_chunk")
    ends = chunks.select("_key", "_chunk", "_text").mapInArrow(found, "_key string, _chunk long, _head array<int>, _tail array<int>")
    # A cut in the beginning of the chunk, where both scans have met; a chunk without one belongs to the stretch before it.
    common = F.array_min(F.array_intersect("_head", F.lag("_tail").over(order)))
    cuts = ends.select("_key", "_chunk", F.when(F.col("_chunk") == 0, F.lit(0)).otherwise(common).alias("_from"))
    cuts = cuts.withColumn("_stretch", F.max(F.when(F.col("_from").isNotNull(), F.col("_chunk"))).over(order))
    cuts = cuts.withColumn("_to", F.lead("_from").over(order))
    stretches = (
        chunks.join(cuts, ["_key", "_chunk"])
        .groupBy("_key", "_stretch")
        .agg(F.sort_array(F.collect_list(F.struct("_chunk", "_from", "_to", "_text"))).alias("_parts"), F.first("_own", ignorenulls=True).alias("_own"))
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for parts in batch.column("_parts"):
                parts = parts.as_py()
                body = "".join(x["_text"][:chunk] for x in parts[:-1]) + parts[-1]["_text"]
                end = parts[-1]["_to"]
                upto = len(body) if end is None else (len(parts)) * chunk + end
                ids.append(encode_stretch(body[parts[0]["_from"] : upto], path, pattern))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_key", "_stretch", "_own")), pa.array(ids, pa.binary())], names=["_key", "_stretch", "_own", "_ids"])

    # The last chunk of a text may lie wholly in the overlap of the one before; its stretch is what follows the cut.
    ids_type = T.StructType([T.StructField("_key", T.StringType()), T.StructField("_stretch", T.LongType()), chunks_type["_own"], T.StructField("_ids", T.BinaryType())])
    joined = (
        stretches.mapInArrow(encoded, ids_type)
        .groupBy("_key")
        .agg(F.sort_array(F.collect_list(F.struct("_stretch", "_ids"))).alias("_all"), F.first("_own", ignorenulls=True).alias("_own"))
    )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _ids(batch.column("_own"), [b"".join(x["_ids"] for x in parts.as_py()) for parts in batch.column("_all")])

    return joined.select("_own", "_all").mapInArrow(gathered, out)


def decode(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` binary in place of ``ids``: the bytes that the ids stand for."""
    rest = [c for c in encoded.columns if c != "ids"]
    return unpacked(_decoded(packed(encoded, F.col("ids")), path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), rest, "decoded")


def _decoded(rows: DataFrame, path: str) -> DataFrame:
    """_own, decoded of ``rows`` (_own, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                found = [decode_ids(x or b"", path) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_own"), pa.array(found, pa.binary())], names=["_own", "decoded"])

    return rows.select("_own", "ids").mapInArrow(run, T.StructType([rows.schema["_own"], T.StructField("decoded", T.BinaryType())]))


def round_trip(
    docs: DataFrame, *, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Encodes and decodes; digests of both in place of ids and bytes: n_tokens, ids_sha256, decoded_sha256."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = _encoded(docs, text, path, pattern, chunk, overlap)
    both = _decoded(encoded.select(F.struct("_own", "n_tokens", F.sha2("ids", 256).alias("ids_sha256")).alias("_own"), "ids"), path)
    digested = both.select("_own._own", "_own.n_tokens", "_own.ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
    return unpacked(digested, [c for c in docs.columns if c != text], "n_tokens", "ids_sha256", "decoded_sha256")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
