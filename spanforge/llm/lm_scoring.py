"""Language-model scores of whole documents.

Words are counted over all training texts. The most frequent ones are the vocabulary of a small gated recurrent
model (``gru.py``); the model gives all others as one token, and which of them it is has the smoothed share
of its count among them, so the probabilities of all words add up to one. The recurrent model starts
at the counted frequencies and is trained on every training text, in rounds: shards of rows train side by side, piece by piece,
and their parameters are averaged, in groups, until one model is left. The state is carried through a whole text.

Counts stay in Spark: each task knows the ``HEAD`` most frequent words, and rarer ones are joined to their
counts by word, so what is broadcast has a fixed bound.

Cases: null and empty texts are the end token alone; texts are read whole; a null id is never held out; repeated rows
are scored each; an empty table gives an empty result, and without training texts all words are unknown.
Extra columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.common import in_split, stored, table
from spanforge.llm.gru import Gru

#: Words with counts in each task, words of the recurrent model, and the number of models averaged at once.
HEAD, VOCABULARY, FAN_IN = 1 << 18, 4096, 8
#: Bytes of text that are split at once.
PIECE = 1 << 22
#: The end of a text among words; no word is empty.
END = b""


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in order, about ``PIECE`` bytes at a time: what is made of their words is bounded."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // PIECE)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all ``texts``, in order, and the number of the text that each is from. These functions of
    Arrow know ASCII only and leave all other bytes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, text = split.flatten(), np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
    # Separators at the ends of a text leave empty strings.
    whole = pc.greater(pc.binary_length(words), 0)
    return words.filter(whole), text[whole.to_numpy(zero_copy_only=False)]


def coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different ones of ``words``, and the place of each word among them."""
    encoded = words.dictionary_encode()
    return encoded.dictionary.cast(pa.binary()), encoded.indices.to_numpy()


def count_words(docs: DataFrame) -> DataFrame:
    """word, c over all texts, the end token included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = pa.chunked_array([words_of(texts)[0] for texts in pieces(batch.column("text"))]).value_counts()
            words = pa.concat_arrays([found.field("values").cast(pa.binary()), pa.array([END])])
            yield pa.RecordBatch.from_arrays([words, pa.concat_arrays([found.field("counts"), pa.array([batch.num_rows])])], names=["word", "c"])

    rows = docs.select(F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Places of the head words by falling count, with their counts; the recurrent model's token of each; sums of the
    words outside that model."""

    places: dict[bytes, int]
    counts: np.ndarray
    tokens: np.ndarray
    token_counts: np.ndarray
    end: int
    other: int
    n: int
    v: int
    other_n: int
    other_v: int

    @classmethod
    def of(cls, counts: DataFrame, head: int, size: int) -> Vocabulary:
        n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        # A count that no more than ``head`` words exceed: a limit over all words would bring ``head`` of each partition here.
        least, above = 0, 0
        for r in counts.groupBy("c").agg(F.count("*").alias("k")).orderBy(F.desc("c")).toLocalIterator():
            above += r["k"]
            if above > head:
                least = r["c"]
                break
        top = counts.where(F.col("c") > least).toArrow()
        found = dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))
        if len(found) < min(size, head):
            found |= {bytes(r["word"]): r["c"] for r in counts.orderBy(F.desc("c"), "word").limit(min(size, head)).collect()}
        found = sorted(found.items(), key=lambda x: (-x[1], x[0]))
        own = dict(found[: size - 2]) | {END: dict(found).get(END, 0)}
        other_n = n - sum(own.values())
        # The model's tokens by falling count; None is any other word.
        ordered = sorted([*own.items(), (None, other_n)], key=lambda x: (-x[1], x[0] or b""))
        number = {word: i for i, (word, _) in enumerate(ordered)}
        return cls(
            {w: i for i, (w, _) in enumerate(found)}, np.array([c for _, c in found], np.int64),
            np.array([number.get(w, number[None]) for w, _ in found] + [number[None]], np.int64),
            np.array([c for _, c in ordered], np.float64), number[END], number[None], n, v, other_n, v - sum(c > 0 for c in own.values()),
        )

    def places_of(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 for those outside the head."""
        get = self.places.get
        return np.array([get(w, -1) for w in words.to_numpy(zero_copy_only=False).tolist()], np.int64)


def _averaged(models: DataFrame) -> np.ndarray:
    """The mean of models (shard, weights), in groups of ``FAN_IN`` at a time."""
    def mean(key, rows):
        many = [np.frombuffer(x.as_py(), np.float32) for x in rows.column("weights")]
        n = np.array(rows.column("n").to_pylist(), np.float64)
        flat = sum(m * (k / n.sum()) for m, k in zip(many, n)).astype(np.float32)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([int(n.sum())], pa.int64()), "weights": pa.array([flat.tobytes()], pa.binary())})

    left = models.count()
    while left > 1:
        group = F.floor(F.col("shard") / FAN_IN)
        models = stored(models.groupBy(group.alias("g")).applyInArrow(mean, "shard long, n long, weights binary"), "lm-averages")
        left = models.count()
    return np.frombuffer(models.first()["weights"], np.float32)


def token_rows(docs: DataFrame, words: Vocabulary, rounds: int) -> DataFrame:
    """row, round, tokens of every row of ``docs``, stored: the row's number, the round that it is dealt to, and the
    recurrent model's tokens in 16 bits each. Copies of a text are rows of their own."""
    known = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, part, seen = known.value, TaskContext.get().partitionId(), 0
        for texts in (x for batch in batches for x in pieces(batch.column("text"))):
            rows = seen + np.arange(len(texts))
            seen += len(texts)
            words, text = words_of(texts)
            unique, codes = coded(words)
            tokens = vocabulary.tokens[vocabulary.places_of(unique)].astype(np.uint16)[codes]
            ends = 2 * np.cumsum(np.bincount(text, minlength=len(texts)))
            tokens = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(tokens)])
            yield pa.RecordBatch.from_arrays(
                [pa.array((part << 33) + rows, pa.int64()), pa.array((part + rows) % rounds, pa.int64()), tokens], names=["row", "round", "tokens"]
            )

    rows = stored(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "row long, round long, tokens binary"), "lm-tokens")
    known.unpersist()
    return rows


def shard_models(rows: DataFrame, start: Gru, shards: int, piece_tokens: int) -> DataFrame:
    """shard, n, weights: a model for each shard, of all its rows, and the tokens it has learned from. Rows are dealt out in turn,
    so copies of a text spread over the shards. A shard is learned piece by piece, each from the model of the one before."""
    begin = rows.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, squares, texts, waiting, n = begin.value, {}, [], 0, 0
        for batch in batches:
            for x in batch.column("tokens"):
                texts.append(np.frombuffer(x.as_py(), np.uint16).astype(np.int64))
                waiting += len(texts[-1]) + 1
                if waiting >= piece_tokens:
                    model = model.train(texts, squares=squares)
                    texts, waiting, n = [], 0, n + waiting
        if texts:
            model, n = model.train(texts, squares=squares), n + waiting
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([model.vector().tobytes()], pa.binary())],
                names=["shard", "n", "weights"],
            )

    dealt = rows.select("row", "tokens").repartition(shards).sortWithinPartitions(F.xxhash64("row"))
    models = stored(dealt.select("tokens").mapInArrow(run, "shard long, n long, weights binary"), "lm-models")
    begin.unpersist()
    return models


def train(docs: DataFrame, words: Vocabulary, *, rounds: int = 2, shard_tokens: int = 2_000_000, piece_tokens: int = 1 << 20) -> Gru:
    """The recurrent model of the training texts ``docs``: one pass over all of them, each row in one of the rounds."""
    model = Gru.new(words.token_counts, words.end)
    rows = token_rows(docs, words, rounds)
    shards = max(1, math.ceil(words.n / rounds / shard_tokens))
    for k in range(rounds):
        models = shard_models(rows.where(F.col("round") == k), model, shards, piece_tokens)
        if models.head(1):
            model = model.with_vector(_averaged(models))
    return model


def score(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: Gru) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row of ``docs`` (doc_id, text)."""
    context = docs.sparkSession.sparkContext
    known, net = context.broadcast(words), context.broadcast(model)
    base_of, other_of = float(words.n + words.v + 1), float(words.other_n + words.other_v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = known.value, 0
        # The last place is that of the words outside the head.
        base = np.append(np.log10((vocabulary.counts + 1) / base_of), 0.0)
        # What a word outside the model adds to the score of its token.
        added = np.append(np.where(vocabulary.tokens[:-1] == vocabulary.other, np.log10((vocabulary.counts + 1) / other_of), 0.0), 0.0)
        end = (vocabulary.counts[vocabulary.places[END]] if END in vocabulary.places else 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, found = [], []
            for texts in pieces(batch.column("text")):
                n, (words, text) = len(texts), words_of(texts)
                unique, codes = coded(words)
                places = vocabulary.places_of(unique)
                lengths = np.bincount(text, minlength=n)
                tokens += np.split(vocabulary.tokens[places].astype(np.uint16)[codes], np.cumsum(lengths)[:-1])
                outside = np.flatnonzero((places < 0)[codes])
                pairs, k = np.unique(text[outside] * len(unique) + codes[outside], return_counts=True)
                owner, word = np.divmod(pairs, max(1, len(unique)))
                rare = pa.StructArray.from_arrays([unique.take(pa.array(word)), pa.array(k, pa.int64())], names=["word", "k"])
                found.append(pa.RecordBatch.from_arrays(
                    [
                        pa.array(lengths + 1), pa.array(lengths - np.bincount(text[outside], minlength=n) + int(end > 0)),
                        pa.array(np.bincount(text, base[places][codes], n) + math.log10((end + 1) / base_of)), pa.array(np.bincount(text, added[places][codes], n)),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=n))), pa.int32()), rare),
                    ],
                    names=["n_tokens", "n_known", "base_score", "score", "_rare"],
                ))
            logs = net.value.score(tokens) / math.log(10)
            ids = (TaskContext.get().partitionId() << 33) + seen + np.arange(len(logs))
            seen += len(logs)
            counted, inside, base_sum, more, rare = pa.Table.from_batches(found).combine_chunks().to_batches()[0].columns
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.int64()), counted, inside, base_sum, pa.array(logs + more.to_numpy()), rare],
                names=["doc_id", "_row", "n_tokens", "n_known", "base_score", "score", "_rare"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, _row long, n_tokens long, n_known long, base_score double, score double, _rare array<struct<word: binary, k: long>>"
    scored = stored(rows.mapInArrow(run, kind), "lm-scored")
    # No word outside the head is frequent, so the join has no hot key.
    rare = scored.select("_row", F.inline("_rare")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("_row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("_known"),
        F.sum(F.col("k") * F.log10((c + 1) / base_of)).alias("_base"),
        F.sum(F.col("k") * F.log10((c + 1) / other_of)).alias("_score"),
    )
    add = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    return scored.drop("_rare").join(sums, "_row", "left").select(
        "doc_id", "n_tokens", add("n_known", "_known"), add("base_score", "_base"), add("score", "_score")
    )


def learned(docs: DataFrame, *, head: int = HEAD, size: int = VOCABULARY, **options) -> tuple[DataFrame, Vocabulary, Gru]:
    """Counts, vocabulary and recurrent model of the training texts ``docs``."""
    counts = stored(count_words(docs), "lm-counts")
    words = Vocabulary.of(counts, head, size)
    return counts, words, train(docs, words, **options)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_split(F.col("doc_id"), 7, 2)
    counts, words, model = learned(docs.where(~held_out))
    scored = score(docs, counts, words, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(words.n).cast("long").alias("train_tokens"), "base_score", "score"
    )
