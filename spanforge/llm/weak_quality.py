"""Quality classifier from weak labels: expectation-maximisation over heuristic labellers, and a hashed linear scorer.

1. Labellers are Spark expressions over the whole text, each voting good (2), bad (1) or not at all (0). They
   overlap, so a text's votes are one of at most 3^k patterns, and the corpus is counted by pattern.
2. From these counts, expectation-maximisation estimates the share of good texts and, for each labeller, how
   often it votes each way on good and on bad texts. Every pattern so gets a posterior probability of good.
3. Posteriors of a bounded sample of texts (``most_rows``) are the soft labels of a linear scorer over hashed byte
   n-grams. Partitions of the sample train apart and their weights are averaged, block by block, by rows.
4. The scorer judges every whole text; it sees only the n-grams, so it also speaks where no labeller votes.

Cases: a null or empty text has no n-grams, gets score 0 and isn't kept; repeated rows are judged alike; ids may repeat or
be null; an empty table gives an empty result; without votes that differ, the prior is the posterior of all.
Extra columns pass through ``score``; columns named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import SPACE, WORD, bounded_share, stored, table

#: Orders of the byte n-grams, bits of the hash of each order, partitions that train apart, blocks of the weights.
ORDERS, BITS, PARTS, BLOCKS = (1, 3), 15, 8, 16
WIDTH = len(ORDERS) << BITS
GOOD, BAD, NONE = 2, 1, 0


def labellers(text: Column) -> dict[str, Column]:
    """Votes on a text; shares are by its words."""
    words = F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1))
    chars = F.greatest(F.length(text), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(NONE))

    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>{}=@\\^~]+")) / words
    shouts = F.regexp_count(text, F.lit(r"[!?]{2,}")) / words
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}")) / chars
    letters = F.regexp_count(text, F.lit(r"\p{L}+")) / words
    ends = F.regexp_count(text, F.lit(r"[.!?](?=\s|$)")) / words
    stutters = F.regexp_count(text, F.lit(rf"(?<!\S)(\S++)(?:{SPACE}\1(?!\S)){{3,}}")) / words
    distinct = F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))
    return {
        "symbols": vote(symbols > 0.15, symbols < 0.03),
        "shouts": vote(shouts > 0.1, F.lit(False)),
        "capitals": vote(capitals > 0.3, (capitals > 0.002) & (capitals < 0.1)),
        "letters": vote(letters < 0.6, (letters > 0.9) & (letters < 1.2)),
        "sentences": vote((words >= 20) & (ends < 0.01), (words >= 20) & (ends > 0.03) & (ends < 0.4)),
        "stutters": vote(stutters > 0.005, stutters == 0),
        "lines": vote((F.size(lines) >= 4) & (distinct < 0.6), (F.size(lines) >= 4) & (distinct > 0.9)),
    }


def pattern(text: Column) -> Column:
    """The votes of all labellers as digits to the base 3, the first labeller's the lowest."""
    return sum((v * 3**k for k, v in enumerate(labellers(text).values())), F.lit(0)).cast("int")


def votes(patterns: np.ndarray, n: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n) % 3


@dataclass(frozen=True)
class LabelModel:
    """``rates[k, c, v]``: how often labeller k gives vote v on texts of class c (1: good)."""

    prior: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        cast = votes(patterns, len(self.rates))
        logs = np.log([1 - self.prior, self.prior]) + np.log(self.rates[np.arange(len(self.rates)), :, cast]).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))

    def accuracy(self) -> np.ndarray:
        """Of each labeller, the share of its votes that are right."""
        share = np.array([1 - self.prior, self.prior])
        right = share[0] * self.rates[:, 0, BAD] + share[1] * self.rates[:, 1, GOOD]
        return right / np.maximum((share[:, None] * self.rates[:, :, 1:].transpose(1, 0, 2).sum(axis=2)).sum(axis=0), 1e-12)


def estimate(patterns: np.ndarray, counts: np.ndarray, n: int, *, rounds: int = 200, smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation from patterns of ``n`` labellers and their counts, begun at the majority vote."""
    cast = votes(patterns, n)
    good, bad = (cast == GOOD).sum(axis=1), (cast == BAD).sum(axis=1)
    p = (good + 0.5) / (good + bad + 1)
    p = np.where(bad >= 2, np.minimum(p, 0.3), p)
    model = LabelModel(0.5, np.full((n, 2, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        tallies = np.stack([[np.bincount(cast[:, k], w, 3) for w in weight] for k in range(n)]) + smooth
        total = weight.sum(axis=1)
        model = LabelModel(float((total[1] + smooth) / (total.sum() + 2 * smooth)), tallies / tallies.sum(axis=2, keepdims=True))
        was, p = p, model.posterior(patterns)
        if not len(p) or np.abs(p - was).max() < 1e-9:
            break
    return model


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashed n-grams of a text and their values, of length 1 in all."""
    data = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
    counts = np.zeros(WIDTH, np.float64)
    for at in range(0, len(data), 1 << 20):
        piece = data[at : at + (1 << 20) + max(ORDERS) - 1]
        for i, n in enumerate(ORDERS):
            end = min(len(piece), (1 << 20) + n - 1)
            if end < n:
                continue
            h = np.zeros(end - n + 1, np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + piece[k : end - n + 1 + k] + np.uint32(1)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
            counts[i << BITS : (i + 1) << BITS] += np.bincount(h, minlength=1 << BITS)
    places = np.flatnonzero(counts)
    values = np.sqrt(counts[places])
    return places, values / max(1.0, float(np.sqrt((values * values).sum())))


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _trained(texts: list[str | None], wanted: list[float], epochs: int, rate: float, l2: float, seed: int) -> np.ndarray:
    """Weights, the last of them the intercept, by adaptive gradient steps on the log loss of soft labels."""
    rows = [features(x) for x in texts]
    w, seen = np.zeros(WIDTH + 1), np.full(WIDTH + 1, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            places, values = rows[i]
            error = _sigmoid(float(w[places] @ values) + w[-1]) - wanted[i]
            step = error * values + l2 * w[places]
            seen[places] += step * step
            w[places] -= rate * step / np.sqrt(seen[places])
            seen[-1] += error * error
            w[-1] -= rate * error / np.sqrt(seen[-1])
    return w


@dataclass(frozen=True)
class Scorer:
    weight: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        places, values = features(text)
        return _sigmoid(float(self.weight[places] @ values) + self.intercept) if len(places) else 0.0


def label_model(docs: DataFrame, *, text: str = "text") -> LabelModel:
    """The labellers' model from the votes on all of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.where(F.length(body) > 0).groupBy(pattern(body).alias("pattern")).count().orderBy("pattern").collect()
    n = len(labellers(F.lit("")))
    return estimate(np.array([r["pattern"] for r in found], np.int64), np.array([r["count"] for r in found], float), n)


def posteriors(spark: SparkSession, model: LabelModel) -> DataFrame:
    """pattern, n_votes, posterior of all patterns: 3^k rows, small enough to broadcast."""
    patterns = np.arange(3 ** len(model.rates))
    n = (votes(patterns, len(model.rates)) > 0).sum(axis=1)
    rows = zip(patterns.tolist(), n.tolist(), model.posterior(patterns).tolist())
    return spark.createDataFrame(list(rows), "pattern int, n_votes int, posterior double")


def fit(
    docs: DataFrame, model: LabelModel, *, most_rows: int = 16_000, epochs: int = 6, rate: float = 0.5, l2: float = 1e-4, seed: int = 7
) -> Scorer:
    """A scorer from about ``most_rows`` of ``docs`` (doc_id, text) at most, chosen by a hash of their ids."""
    body = F.coalesce(F.col("text"), F.lit(""))
    chosen = bounded_share(docs.where(F.length(body) > 0), most_rows, seed, "doc_id", "text")
    sample = chosen.select("doc_id", "text", pattern(body).alias("pattern")).join(F.broadcast(posteriors(docs.sparkSession, model)), "pattern")
    sample = stored(sample.select("doc_id", "text", "posterior").repartition(PARTS, "doc_id").sortWithinPartitions("doc_id", "text"), "weak-sample")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, wanted = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            wanted += batch.column("posterior").to_pylist()
        if texts:
            w = _trained(texts, wanted, epochs, rate, l2, seed)
            parts = [x.tobytes() for x in w[:-1].reshape(BLOCKS, -1)] + [w[-1:].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS + 1), pa.int32()), pa.array(parts), pa.array([len(texts)] * (BLOCKS + 1), pa.int64())], names=["block", "w", "n"]
            )

    def mean(key, rows):
        n = np.array(rows.column("n").to_pylist(), float)
        order = np.argsort([x.as_py() for x in rows.column("w")])
        parts = np.stack([np.frombuffer(x.as_py(), np.float64) for x in rows.column("w")])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "w": pa.array([(n[order] @ parts[order] / n.sum()).tobytes()])})

    found = sample.mapInArrow(train, "block int, w binary, n long").groupBy("block").applyInArrow(mean, "block int, w binary").collect()
    if not found:
        return Scorer(np.zeros(WIDTH), 0.0)
    w = np.concatenate([np.frombuffer(r["w"], np.float64) for r in sorted(found, key=lambda r: r["block"])])
    return Scorer(w[:-1], float(w[-1]))


def score(docs: DataFrame, scorer: Scorer, *, text: str = "text", kept_from: float = 0.5) -> DataFrame:
    """``docs`` with score (0 to 1, higher: better) and kept (from ``kept_from``)."""
    docs = docs.drop("score", "kept")
    out = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([shared.value.score(x.as_py()) for x in batch.column(text)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array(scores >= kept_from)], names=[*batch.schema.names, "score", "kept"])

    return docs.mapInArrow(run, out)


def classify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_votes, posterior, score, kept of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = label_model(docs)
    scored = score(docs.withColumn("pattern", pattern(F.coalesce("text", F.lit("")))), fit(docs, model, **options)).drop("text")
    known = F.broadcast(posteriors(docs.sparkSession, model))
    return scored.join(known, "pattern").select("doc_id", "n_votes", "posterior", "score", "kept")


def op2_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
