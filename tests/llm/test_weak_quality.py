"""The label model against planted accuracies, and the classifier against held-out quality labels."""

import numpy as np
from pyspark.sql import functions as F

from spanforge.llm import weak_quality as w

SF = "/root/testdata/sf0.01"


def test_expectation_maximisation_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    right, says, prior = np.array([0.95, 0.9, 0.8, 0.7, 0.85]), np.array([0.9, 0.8, 1.0, 0.6, 0.7]), 0.75
    good = rng.random(60_000) < prior
    correct = rng.random((len(good), 5)) < right
    vote = np.where(rng.random(correct.shape) < says, np.where(correct == good[:, None], w.GOOD, w.BAD), w.NONE)
    patterns, counts = np.unique((vote * 3 ** np.arange(5)).sum(axis=1), return_counts=True)
    model = w.estimate(patterns, counts.astype(float), 5)
    assert abs(model.prior - prior) < 0.02
    assert np.abs(model.accuracy() - right).max() < 0.02


def test_kept_documents_have_good_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    found = w.op2_weak_quality(spark, SF).join(labels, "doc_id").agg(
        F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")
    ).first()
    assert found["good"] > 0.98 and found["bad"] < 0.3


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "Some words.", "x"), (3, "a b " * 400_000, "x"), (3, "a b", "x")], "doc_id long, text string, score string")
    found = w.classify(docs).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert {(r["score"], r["kept"]) for r in found if r["doc_id"] in (1, 2)} == {(0.0, False)}
    assert w.classify(docs.limit(0)).count() == 0
