"""Language identification: known words first, shorter and shorter n-grams for the others.

Words are counted by language over a sample of at most ``rows_each`` labelled texts of each language (chosen by a hash of id
and text), so a rare language is known as well as a frequent one; n-grams are counted over these words, in Spark, and
those seen ``least_gram`` times at least are kept. A text is
the sum over its words of log frequencies by language: those of the word, or, where it is unknown, the mean
over its n-grams of the longest order of which any is known.

The model holds every word of the sample and nothing else, so its size is bounded by that of the sample: sorted 64-bit hashes, and
a row of 32-bit log frequencies each.

Cases: a null text, or one without a letter, is ``und`` with score 0; a text whose every letter is unknown is
judged by how frequent the languages are; ties go to the first language by code point; rows with a null
language teach nothing, and without any every prediction is ``und``; texts are read whole; repeated rows are
judged alike; an empty table gives an empty result. Other columns pass through; columns named as the results
are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import in_split, packed, stored, table, thinned, unpacked

WORDS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
#: Words whose vectors a worker remembers; the memory is emptied when it is full.
REMEMBERED = 200_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def n_grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def hash_of(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


@dataclass
class Counted:
    """Sorted hashes of words, or of the n-grams of one order, and log frequencies by language less their mean."""

    hashes: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, keys: list[str], langs: list[str], counts: np.ndarray, languages: list[str]) -> Counted:
        hashes, place = np.unique(np.fromiter(map(hash_of, keys), np.uint64, len(keys)), return_inverse=True)
        at = {x: i for i, x in enumerate(languages)}
        table = np.full((len(hashes), len(languages)), 0.5)
        np.add.at(table, (place, np.fromiter((at[x] for x in langs), np.int64, len(langs))), counts)
        logs = np.log(table / np.maximum(table.sum(axis=0), 1))
        return cls(hashes, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32) if len(hashes) else logs.astype(np.float32))

    def rows(self, keys: list[str]) -> np.ndarray:
        """The row of each key, -1 for unknown ones."""
        wanted = np.fromiter(map(hash_of, keys), np.uint64, len(keys))
        if not len(self.hashes):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, at, -1)


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: Counted
    grams: dict[int, Counted]
    #: Words that were met, each with its place among the vectors.
    _seen: dict[str, int] = field(default_factory=dict)
    _vectors: np.ndarray | None = None

    def unknown(self, words: list[str]) -> np.ndarray:
        """Of each word, the mean over its n-grams of the longest order that the model knows any of."""
        out, left = np.zeros((len(words), len(self.languages)), np.float32), np.arange(len(words))
        for n in ORDERS:
            grams = [n_grams(words[i], n) for i in left]
            rows = self.grams[n].rows([g for x in grams for g in x])
            of = np.repeat(np.arange(len(left)), [len(x) for x in grams])[rows >= 0]
            times = np.bincount(of, minlength=len(left))
            sums = np.zeros((len(left), len(self.languages)), np.float32)
            if len(of):
                sums[times > 0] = np.add.reduceat(self.grams[n].vectors[rows[rows >= 0]], np.searchsorted(of, np.flatnonzero(times)), axis=0)
            out[left[times > 0]] = sums[times > 0] / times[times > 0, None]
            left = left[times == 0]
        return out

    def meet(self, words: list[str]) -> None:
        """Remembers the vectors of at most ``REMEMBERED`` words; the memory is emptied when it is full."""
        new = [w for w in words if w not in self._seen]
        if not new:
            return
        if len(self._seen) + len(new) > REMEMBERED:
            self._seen.clear()
            new = words
        if self._vectors is None:
            self._vectors = np.zeros((REMEMBERED, len(self.languages)), np.float32)
        rows, begin = self.words.rows(new), len(self._seen)
        vectors = self._vectors[begin : begin + len(new)]
        vectors[rows >= 0] = self.words.vectors[rows[rows >= 0]]
        if (rows < 0).any():
            vectors[rows < 0] = self.unknown([new[i] for i in np.flatnonzero(rows < 0)])
        self._seen.update(zip(new, range(begin, begin + len(new))))

    def predict(self, text: str | None, found: Counter | None = None) -> tuple[str, float]:
        """The language and its share; ``found`` are the counted words, if they are known already."""
        if not self.languages or not has_letter(text):
            return "und", 0.0
        found = Counter(words_of(text)) if found is None else found
        total, words = self.prior.copy(), list(found)
        # The words of a very long text are met in parts, so that what is remembered stays bounded.
        for begin in range(0, len(words), REMEMBERED):
            some = words[begin : begin + REMEMBERED]
            self.meet(some)
            at = np.fromiter(map(self._seen.__getitem__, some), np.int64, len(some))
            total += np.fromiter(map(found.__getitem__, some), float, len(some)) @ self._vectors[at]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def sampled(known: DataFrame, sizes: dict[str, int], rows_each: int, seed: int) -> DataFrame:
    """At most about ``rows_each`` rows of each language, by a hash of id and text; ``sizes`` are the rows of each."""
    if not sizes:
        return known
    cuts = known.sparkSession.createDataFrame([(k, min(2**31, int(rows_each / n * 2**31))) for k, n in sizes.items()], "_lang string, _cut long")
    h = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(2**31))
    return known.join(F.broadcast(cuts), (F.col("lang") == F.col("_lang")) & (h < F.col("_cut"))).drop("_lang", "_cut")


def fit(docs: DataFrame, *, rows_each: int = 5_000, least_gram: int = 5, seed: int = 23) -> Model:
    """A model from ``docs`` (doc_id, text, lang). What reaches the driver is as large as the words of the sample."""
    known = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)

    def batch_of(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, keys in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(list(keys), pa.string()), pa.array(list(keys.values()), pa.int64())], names=["lang", "key", "n"]
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: defaultdict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                found[lang].update(words_of(text.as_py()))
            yield from batch_of(found)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: defaultdict[str, Counter] = defaultdict(Counter)
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "n"))):
                for order in ORDERS:
                    for g in n_grams(word, order):
                        found[lang][g] += n
            yield from batch_of(found)

    kind = "lang string, key string, n long"
    total = F.sum("n").alias("n")
    # The hash of id and text takes repeats as one, so what it has chosen is counted and, if it is more, thinned by row.
    chosen = stored(sampled(known, sizes, rows_each, seed).select("text", "lang"), "language-sample")
    chosen = thinned(chosen, {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect() if r["count"] > 1.1 * rows_each}, rows_each, seed, "lang")
    words = stored(chosen.mapInArrow(count, kind).groupBy("lang", "key").agg(total), "language-words")
    grams = words.mapInArrow(split, kind).groupBy("lang", "key").agg(total).where(F.col("n") >= least_gram)

    def counted(rows: pa.Table) -> Counted:
        return Counted.of(rows.column("key").to_pylist(), rows.column("lang").to_pylist(), rows.column("n").to_numpy(), languages)

    found = grams.toArrow()
    length = np.array([len(x) for x in found.column("key").to_pylist()], np.int64)
    by_order = {n: counted(found.filter(pa.array(length == n, pa.bool_()))) for n in ORDERS}
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(1, sum(sizes.values()))) if languages else np.zeros(0)
    return Model(languages, prior, counted(words.toArrow()), by_order)


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the share of the prediction in the likelihoods of all languages."""
    own = packed(docs, F.col(f"`{text}`").cast("string").alias("_text"))
    out = T.StructType([own.schema["_own"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            texts = batch.column("_text").to_pylist()
            # The words of many texts are met at once, if they are not too many.
            counted = [Counter(words_of(x)) if x and len(x) < 65_536 else None for x in texts]
            words = list(set().union(*(x for x in counted if x)))
            if model.languages and len(words) <= REMEMBERED // 2:
                model.meet(words)
            found = [model.predict(x, c) for x, c in zip(texts, counted)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_own"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["_own", "lang_pred", "score"]
            )

    return unpacked(own.mapInArrow(run, out), docs.columns, "lang_pred", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~in_split(F.col("doc_id"), 5, 0)))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_split(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
