"""Ids against an encoder of another make, bytes against the texts."""

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from spanforge.llm import byte_bpe
from spanforge.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(PATH, "rb") as lines:
    RANKS = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
OTHER = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [
    None, "", " ", "a", "It's we'll they've I'd !'s sun", "\n\n  \t x", "Größe 12,345.67 ñandú 日本語、テキスト。", "x" * 700,
    "word " * 300, "don't " * 200 + "'", " " * 500 + "a" + " " * 300, "1234567890" * 60, "'s" * 300, "日本語" * 120 + "。" + "字" * 90, "🙂🙂 ok" * 50,
    "ab12 " * 100 + "!'re''ll" * 40,
]


def digests(text):
    ids = OTHER.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_merges_of_odd_tokens():
    rng = random.Random(4)
    made = byte_bpe.Merges(PATH)
    for k in range(3000):
        kind = rng.choice(("abcde", "aeiou nrst", "\u0000\u00ff\u0100\u4e00\U0001f642", "=-_*#", "0123456789", "éèüñß"))
        text = "".join(rng.choice(kind) for _ in range(rng.randrange(1, 200)))
        assert byte_bpe.encode_stretch(text, PATH, public_tokenizers.PATTERN) == struct.pack(f"<{len(x := OTHER.encode_ordinary(text))}I", *x)
    assert made.merged(b"a" * 20_000) == [RANKS[b] for b in OTHER.decode_tokens_bytes(OTHER.encode_ordinary("a" * 20_000))]


def test_short_merges_are_those_of_the_queue():
    rng, made = random.Random(5), byte_bpe.Merges(PATH)
    for n in range(1, byte_bpe.SHORT + 1):
        for kind in (b"a", b"ab e", "éñ0.".encode()):
            data = bytes(rng.choice(kind) for _ in range(n))
            assert made.merged_short(data) == made.merged(data)


def test_frequent_pre_tokens_are_merged_once(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 16)
    made, merged = byte_bpe.Merges(PATH), []
    for name in ("merged", "merged_short"):
        monkeypatch.setattr(made, name, lambda data, run=getattr(made, name): merged.append(data) or run(data))
    for k in range(100):
        assert made["often met"] and made[f"rare{k}"] and len(made) + len(made.older) <= 16
    assert merged.count(b"often met") == 1


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    texts = dict(docs.collect())
    found = byte_bpe.round_trip(docs).collect()
    assert len(found) == len(texts)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(texts[r.doc_id]) for r in found)


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (100, 40), (1 << 15, 1 << 11)])
def test_same_ids_as_whole_text(spark, chunk, overlap):
    docs = spark.createDataFrame([(i, x, "keep") for i, x in enumerate(TEXTS)] + [(3, "a", "keep")], "doc_id long, text string, ids string")
    found = byte_bpe.round_trip(docs, chunk=chunk, overlap=overlap).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(TEXTS[row.doc_id]), TEXTS[row.doc_id]


def test_other_columns_pass(spark):
    names = ("odd.name", "_own", "_text", "_key", "_rest", "_ids", "decoded")
    kinds = ", ".join(["doc_id long, text string, n_chars long", *(f"`{n}` string" for n in names)])
    docs = spark.createDataFrame([(1, "y" * 300, None, *names), (2, "z", 3, *names)], kinds)
    encoded = byte_bpe.encode(docs, chunk=50, overlap=10)
    assert encoded.columns == ["doc_id", "n_chars", *names, "n_tokens", "ids"]
    for row in encoded.collect():
        assert tuple(row)[2:-2] == names and row.n_tokens == len(row.ids) // 4
    decoded = byte_bpe.decode(encoded).collect()
    assert {r.doc_id: bytes(r.decoded) for r in decoded} == {1: b"y" * 300, 2: b"z"}
    assert byte_bpe.round_trip(docs, chunk=50, overlap=10).columns == ["doc_id", "n_chars", *names, "n_tokens", "ids_sha256", "decoded_sha256"]
    assert byte_bpe.encode(docs.select("text")).columns == ["n_tokens", "ids"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(docs).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert byte_bpe.round_trip(docs).count() == 0
