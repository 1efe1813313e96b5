"""Importance resampling against plain Python, sums of bit slices against plain sums, and the cases of the docstring."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import catalogue, importance
from tests.compare import connection, differences

SF = "/root/testdata/sf0.001"


def test_same_as_sql(spark):
    assert differences(spark, connection(SF), catalogue.queries()["op12_importance"], importance.ORACLE_SQL, SF) is None


@pytest.mark.parametrize("most", [1, 2, 70, 5000])
def test_sums_of_slices(most):
    rng = np.random.default_rng(most)
    values = rng.integers(-9000, 7000, 777)
    values[:3] = [0, -8192, 8191]
    lists = [rng.integers(0, 1 + most % 777, n) for n in [0, 1, most, 0, 40] * 30]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    found = np.concatenate(lists)
    assert importance.sliced_sums(offsets, found, importance.gain_planes(values), 777).tolist() == [int(values[x].sum()) for x in lists]


def brute(docs, target, longest=1, buckets=10_000, least=20, percent=10):
    """docs: (doc_id, text) in order of rows; (doc_id, n_features, weight, score, rank) of each."""
    def cut(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    def features(found):
        return [zlib.crc32(" ".join(found[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(found) - n + 1)]

    s, t, found = [0] * buckets, [0] * buckets, [cut(x) for _, x in docs]
    for f in found:
        for b in features(f):
            s[b] += 1
    for x in target:
        for b in features(cut(x)):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for (d, _), f in zip(docs, found, strict=True):
        own = features(f)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((i for i, f in enumerate(found) if len(f) >= least), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0))
    for place, i in enumerate(may[: len(may) * percent // 100]):
        out[i][4] = place + 1
    return sorted(map(tuple, out), key=str)


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"Wort{i}" for i in range(60)] + ["ÄÖ", "naïve", "日本", "x'y", "A-b", "_", "\x00", "😀"]
    return [" ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 21, 60]))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 64, "percent": 50}, {"least": 0, "percent": 100}])
def test_same_as_plain_python(spark, options):
    docs = [*enumerate(texts(150, 1)), (None, None), (900, None), (901, ""), (902, "the " * 200_000), (None, texts(8, 3)[7])]
    docs += [(7, "copy of one text " * 9)] * 30  # repeated rows
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = texts(20, 2)
    rows = importance.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), **options)
    assert sorted(map(tuple, rows.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str) == brute(docs, target, **options)


def test_ranks_of_a_third_of_equal_rows(spark):
    docs = [(7, "one text of some words that is repeated in a third of all the rows of this table and so on")] * 400 + [*enumerate(texts(800, 4))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    ranks = importance.resample(df, df.limit(3).select("text"), percent=70).where("rank is not null").select("rank", "score").orderBy("rank").collect()
    n = sum(len(re.findall(importance.WORD, x.lower())) >= 20 for _, x in docs)
    assert [r.rank for r in ranks] == list(range(1, n * 70 // 100 + 1))
    assert all(a.score >= b.score for a, b in zip(ranks, ranks[1:], strict=False))


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(empty, empty.select("text")).collect() == []
    odd = spark.createDataFrame([(1, "a b c " * 9, 5, 6, 7, 8, 9)], "doc_id long, text string, Weight int, `odd.name` int, _own int, _buckets int, rank int")
    row = importance.resample(odd, empty.select("text"), percent=100).first()
    assert (row["odd.name"], row["_own"], row["_buckets"], row["rank"], row["n_features"]) == (6, 7, 8, 1, 27)
    assert importance.resample(odd, odd.select("text"), keep_text=False).columns == ["doc_id", "odd.name", "_own", "_buckets", "n_features", "weight", "score", "rank"]
    assert importance.resample(odd.select("text"), odd.select("text"), doc_id="text").select(F.max("rank")).first()[0] is None
