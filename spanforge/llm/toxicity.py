"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed n-grams of the lower-cased characters of a text, present or absent. From a sample of labelled
rows of at most ``most_rows`` (chosen by a hash of the id), the ratio of each feature between toxic and other
texts is counted in blocks of features; those whose ratio is sure enough are kept, by their evidence alone: there is no
other bound on them than the number of hashes. A logistic regression over the scaled features then learns their weights from the same rows, whose losses
and gradients are summed where they lie.

Cases: null and empty texts have no feature and get the score of the intercept; texts are read whole, however
long; rows without label or of the held-out part teach nothing; without labelled rows every score is 0.5 at
most; repeated rows score alike; an empty table gives an empty result. Other columns pass through; columns
named as the results are replaced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import bounded_share, drop, in_split, packed, stored, table, thinned, unpacked

ORDERS = (4, 5, 6)
BITS = 18
#: Blocks of features in which ratios are counted, and partitions of the sample.
BLOCKS, PARTS = 64, 8


def features(text: str | None) -> list[np.ndarray]:
    """Hashed n-grams of each order, in order of the text, with repeats."""
    data = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found, h = [], None
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            break
        h = data if n == 1 else h[:-1] * np.uint32(0x01000193) + data[n - 1 :]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
            found.append((mixed >> np.uint32(32 - BITS)).astype(np.int64) + (ORDERS.index(n) << BITS))
    return found


@dataclass(frozen=True)
class Model:
    """``weight`` of each kept feature, its ratio included; ``slot`` is 0 or 1 + the place of a feature there."""

    slot: np.ndarray
    weight: np.ndarray
    intercept: float

    def places(self, text: str | None) -> np.ndarray:
        """Places of the kept features that a text has."""
        hits = [s[s > 0] for s in (self.slot[f] for f in features(text))]
        return np.unique(np.concatenate(hits)) - 1 if hits else np.zeros(0, np.int64)

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weight[self.places(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition, how many toxic and other texts have each feature, by block of features."""
    size = len(ORDERS) << BITS
    counts = np.zeros((2, size), np.uint32)
    rows = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            rows[toxic] += 1
            for f in features(text):
                counts[toxic, np.unique(f)] += 1
    parts = counts.reshape(2, BLOCKS, -1)
    blocks = range(BLOCKS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array([parts[1, b].tobytes() for b in blocks]), pa.array([parts[0, b].tobytes() for b in blocks]),
         pa.array([rows[1]] * BLOCKS, pa.int64()), pa.array([rows[0]] * BLOCKS, pa.int64())],
        names=["block", "toxic", "other", "n_toxic", "n_other"],
    )


def evidence(toxic: np.ndarray, n: int, other: np.ndarray, m: int) -> np.ndarray:
    """The log-likelihood ratio statistic of each feature's counts among n toxic and m other texts, against one
    rate for both."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0.0)

    rate = (toxic + other) / max(1, n + m)
    return 2 * (part(toxic, n * rate) + part(other, m * rate) + part(n - toxic, n * (1 - rate)) + part(m - other, m * (1 - rate)))


def fit(
    docs: DataFrame, labels: DataFrame, *, most_rows: int = 30_000, least: float = 20.0,
    l2: float = 3.0, rounds: int = 60, seed: int = 11,
) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of the rows to learn from."""
    marked = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    # At most about most_rows pairs of numbers: small enough to send to every executor.
    chosen = bounded_share(marked, most_rows, seed, "doc_id", "toxic")
    whole = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic").repartition(PARTS), "toxicity-sample")
    # An id may have many documents.
    sample = thinned(whole, {"": whole.count()}, most_rows, seed)

    def keep(key, rows):
        """Sums a block over the partitions and keeps the features whose ratio is surest."""
        toxic = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in rows.column("toxic"))
        other = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in rows.column("other"))
        n, m = sum(rows.column("n_toxic").to_pylist()), sum(rows.column("n_other").to_pylist())
        ratio = np.log((toxic + 1) / (n + 2)) - np.log((other + 1) / (m + 2))
        sure = evidence(toxic, n, other, m)
        best = np.flatnonzero(sure >= least)
        base = key[0].as_py() * len(sure)
        return pa.table({"feature": pa.array(best + base, pa.int64()), "ratio": pa.array(ratio[best])})

    blocks = sample.mapInArrow(_count_blocks, "block int, toxic binary, other binary, n_toxic long, n_other long")
    kept = sorted((r["feature"], r["ratio"]) for r in blocks.groupBy("block").applyInArrow(keep, "feature long, ratio double").collect())
    slot = np.zeros(len(ORDERS) << BITS, np.uint32)
    slot[[f for f, _ in kept]] = np.arange(1, len(kept) + 1)
    ratio = np.array([r for _, r in kept])
    empty = Model(slot, np.zeros(len(kept)), 0.0)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [empty.places(x.as_py()).astype("<i4").tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], names=["toxic", "places"])

    rows = stored(sample.mapInArrow(reduce, "toxic int, places binary"), "toxicity-places")
    weight, intercept = _logistic(rows, ratio, l2, rounds)
    drop(whole, rows)
    return Model(slot, weight * ratio, intercept)


def _logistic(rows: DataFrame, ratio: np.ndarray, l2: float, rounds: int) -> tuple[np.ndarray, float]:
    """Limited-memory BFGS on the regularised log loss of ``rows`` (toxic, places); their features are scaled by ``ratio``. Each step sums loss and
    gradient in the partitions; the driver holds some vectors as long as there are kept features."""
    context, k = rows.sparkSession.sparkContext, len(ratio)
    known = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n, at = known.n, np.zeros(k + 1)
    at[k] = np.log((known.toxic + 1) / (n - known.toxic + 1))
    if not n or not k:
        return at[:k], float(at[k])

    def summed(at: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((at[:k] * ratio, at[k]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (w, b), sums = shared.value, np.zeros(k + 2)
            for batch in batches:
                found = [x.as_py() for x in batch.column("places")]
                y, sizes = batch.column("toxic").to_numpy().astype(float), np.array([len(x) // 4 for x in found])
                col, full = np.frombuffer(b"".join(found), "<i4"), np.flatnonzero(sizes)
                z = np.full(len(y), b)
                if len(full):
                    z[full] += np.add.reduceat(w[col], np.cumsum(sizes[full]) - sizes[full])
                rest = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
                sums[:k] += np.bincount(col, np.repeat(rest, sizes), minlength=k)
                sums[k] += rest.sum()
                sums[k + 1] += (np.logaddexp(0, z) - y * z).sum()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([sums.tobytes()])], names=["part", "sums"])

        parts = sorted((r.part, bytes(r.sums)) for r in rows.mapInArrow(run, "part long, sums binary").collect())
        shared.destroy()
        total = sum(np.frombuffer(x) for _, x in parts) / n
        slope = np.append(total[:k] * ratio + l2 / n * at[:k], total[k])
        return float(total[k + 1] + l2 / (2 * n) * at[:k] @ at[:k]), slope

    loss, slope = summed(at)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=10)
    for _ in range(rounds):
        if np.abs(slope).max() < 1e-7:
            break
        way, shares = slope.copy(), []
        for step, change in reversed(pairs):
            shares.append(step @ way / (change @ step))
            way -= shares[-1] * change
        way *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / np.linalg.norm(slope)
        for step, change in pairs:
            way += step * (shares.pop() - change @ way / (change @ step))
        length = 1.0
        while True:
            new = at - length * way
            new_loss, new_slope = summed(new)
            if new_loss <= loss - 1e-4 * length * (slope @ way) or length < 1e-6:
                break
            length /= 2
        if new_loss > loss:
            break
        if (new_slope - slope) @ (new - at) > 1e-12:
            pairs.append((new - at, new_slope - slope))
        done = loss - new_loss < 1e-7 * loss
        at, loss, slope = new, new_loss, new_slope
        if done:
            break
    return at[:k], float(at[k])


def score(docs: DataFrame, model: Model, *, text: str = "text", toxic_from: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``toxic_from``)."""
    return unpacked(_scored(docs, model, text, toxic_from), docs.columns, "score", "predicted")


def _scored(docs: DataFrame, model: Model, text: str = "text", toxic_from: float = 0.7) -> DataFrame:
    own = packed(docs, F.col(f"`{text}`").cast("string").alias("_text"))
    out = T.StructType([own.schema["_own"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([shared.value.score(x.as_py()) for x in batch.column("_text")], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_own"), pa.array(scores), pa.array((scores >= toxic_from).astype(np.int32))], names=["_own", "score", "predicted"]
            )

    return own.mapInArrow(run, out)


def learned(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """A model that never sees the labels of the held-out third."""
    return fit(docs, labels.where(~in_split(F.col("doc_id"), 3, 1)), **options)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, in their own columns."""
    return unpacked(_scored(docs, learned(docs, labels)).where("predicted = 0"), docs.columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, learned(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", in_split(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
