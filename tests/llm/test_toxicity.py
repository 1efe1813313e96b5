import math
import random

import numpy as np
import pytest

from spanforge.llm import toxicity
from spanforge.llm.common import in_split, table, thinned

SF = "/root/testdata/sf0.1"


def test_features_by_brute_force():
    text = "Abc déf"
    data = [ord(c) for c in text.lower()]
    for n, found in zip(toxicity.ORDERS, toxicity.features(text)):
        for i in range(len(data) - n + 1):
            h = 0
            for b in data[i : i + n]:
                h = (h * 0x01000193 + b) % 2**32
            h = (h ^ (h >> 15)) * 0x9E3779B1 % 2**32
            assert found[i] == (h >> (32 - toxicity.BITS)) + (toxicity.ORDERS.index(n) << toxicity.BITS)
        assert len(found) == len(data) - n + 1
    assert toxicity.features(None) == toxicity.features("") == []


def brute_score(model, text):
    """The sum of the weights of the kept n-grams that a text has, found one by one."""
    chars, hit = [ord(c) for c in (text or "").lower()], set()
    for n in toxicity.ORDERS:
        for i in range(len(chars) - n + 1):
            h = 0
            for c in chars[i : i + n]:
                h = (h * 0x01000193 + c) % 2**32
            h = (h ^ (h >> 15)) * 0x9E3779B1 % 2**32
            hit.add(int(model.slot[(h >> (32 - toxicity.BITS)) + (toxicity.ORDERS.index(n) << toxicity.BITS)]) - 1)
    z = model.intercept + sum(float(model.weight[i]) for i in sorted(hit - {-1}))
    return 1 / (1 + math.exp(-z))


def test_scores_by_brute_force(spark):
    texts = [f"clean words number {i} über alles" for i in range(150)] + [f"Ünfug {i} böse wörter" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 150)) for i in range(210)], "doc_id long, toxic int")
    model = toxicity.learned(docs, labels)
    assert model.weight.any()
    for text in (texts[0], texts[180], "ÜNFUG", "bös", "", None, "x" * 3000):
        assert model.score(text) == pytest.approx(brute_score(model, text), rel=1e-9)


def test_evidence_is_zero_for_equal_rates():
    assert np.allclose(toxicity.evidence(np.array([5]), 10, np.array([50]), 100), 0)
    assert toxicity.evidence(np.array([10]), 10, np.array([0]), 100)[0] > 50


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.learned(docs, labels)
    held = labels.where(in_split(labels.doc_id, 3, 1)).join(docs, "doc_id").where("lang = 'en'")
    rows = toxicity.score(held.select("doc_id", "text", "toxic"), model).collect()
    wrong = sum(r.predicted != r.toxic for r in rows)
    false = sum(r.predicted > r.toxic for r in rows)
    assert len(rows) > 500 and wrong <= 0.02 * len(rows) and false <= 3


def test_odd_rows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [(i, " ".join(word() for _ in range(20)) + (" qqqvile" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame([*texts, (900, None), (901, ""), (902, "x"), (903, "qqqvile " * 50_000), (903, "qqqvile"), (None, "qqqvile")], "doc_id long, text string")
    model = toxicity.learned(docs, labels)
    rows = toxicity.score(docs.selectExpr("doc_id", "text", "1 as score", "'k' as lang"), model).collect()
    assert len(rows) == 406 and all(r.lang == "k" and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == ("vile" in (r.text or "")) for r in rows if r.text)
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} >= {900, 901, 902}


@pytest.mark.parametrize("n", [0, 3])
def test_without_labels(spark, n):
    docs = spark.createDataFrame([(i, "text") for i in range(n)], "doc_id long, text string")
    model = toxicity.learned(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0] * n


def test_an_id_with_many_documents_stays_within_the_sample(spark, monkeypatch):
    seen = []  # counted at once, since the fit deletes its tables

    def counted(rows, *a):
        found = thinned(rows, *a)
        seen.append(found.count())
        return found

    monkeypatch.setattr(toxicity, "thinned", counted)
    docs = spark.createDataFrame([(1, "bad words")] * 3000 + [(2, "good words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, most_rows=500, rounds=3)
    assert 300 < seen[0] <= 500
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0
