"""The recurrent model learns from every training row, and copies of a text do not gather in one shard."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm import lm_scoring
from spanforge.llm.common import in_split, table
from spanforge.llm.gru import Gru


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50, 40)) for _ in range(400)] + ["the same text again and again " * 5] * 400 + ["", None]
    return spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def words(docs):
    return lm_scoring.Vocabulary.of(lm_scoring.count_words(docs), 1000, 100)


def test_every_row_is_learned_once(docs, words):
    rows = lm_scoring.token_rows(docs, words, 2)
    start = Gru.new(words.token_counts, words.end)
    n = [[r["n"] for r in lm_scoring.shard_models(rows.where(f"round = {k}"), start, 4, 500).collect()] for k in range(2)]
    assert sum(map(sum, n)) == words.n
    for shards in n:
        assert len(shards) == 4 and max(shards) < 1.3 * min(shards)


def test_training_helps(docs, words):
    def mean(model):
        scored = lm_scoring.score(docs, lm_scoring.count_words(docs), words, model).agg({"score": "sum", "n_tokens": "sum"}).first()
        return scored["sum(score)"] / scored["sum(n_tokens)"]

    start = Gru.new(words.token_counts, words.end)
    assert mean(lm_scoring.train(docs, words, shard_tokens=8000, piece_tokens=2000)) > mean(start) + 0.1


def test_pieces_carry_the_optimiser():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 20, 30) for _ in range(50)]
    start, squares = Gru.new(np.ones(20), 0), {}
    one = start.train(texts, squares=squares)
    before = {k: v.copy() for k, v in squares.items()}
    two = one.train(texts, squares=squares)
    assert all((squares[k] >= before[k]).all() for k in squares) and not math.isclose(one.vector().sum(), two.vector().sum(), abs_tol=1e-9)


@pytest.mark.parametrize("head, size", [(1000, 100), (20, 10), (5, 4)])
def test_head_holds_the_most_frequent_words(docs, head, size):
    counts = lm_scoring.count_words(docs)
    found = lm_scoring.Vocabulary.of(counts, head, size)
    ordered = [bytes(r["word"]) for r in counts.orderBy("c", ascending=False).collect()]
    assert len(found.places) <= head and set(found.places) <= set(ordered)
    assert all(a >= b for a, b in zip(found.counts, found.counts[1:])) and len(found.token_counts) >= min(size, head, found.v) - 1


def test_words_of_odd_texts(monkeypatch):
    """Words of many texts at once are those of ``bytes.lower`` and ``bytes.split``, however many texts make a piece."""
    rng = np.random.default_rng(5)
    signs = ["a", "B", "\u00c9", "\u0130", "\u212a", "\u00a0", "\u2003", "\x1c", "\x1f", "\x85", "\x00", *" \t\n\v\f\r"]
    texts = [None, "", " ", *("".join(rng.choice(signs, n)) for n in rng.integers(0, 30, 2000)), None]
    for piece in (1, 100, 1 << 22):
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        found = []
        for some in lm_scoring.pieces(pa.array(texts)):
            words, text = lm_scoring.words_of(some)
            unique, codes = lm_scoring.coded(words)
            unique = unique.to_pylist()
            own = [[] for _ in range(len(some))]
            for code, i in zip(codes, text):
                own[i].append(unique[code])
            found += own
        assert found == [(t or "").encode().lower().split() for t in texts]


def test_counts_and_base_score_by_plain_python(spark):
    """n_tokens, n_known, train_tokens and base_score of the registered query, over a small table with odd rows."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"W{x}" for x in rng.zipf(1.5, 30) % 80) for _ in range(120)] + [None, "", " \t\n", "one", "\u00a0x\u2003y", "same words " * 40, "same words " * 40]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "an id again"), (None, "no id unseen-word")]

    def words_in(t):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in words_in(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(
        (i is None, i, held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
        for i, t in rows for w in [words_in(t)]
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where(~in_split(docs.doc_id, 7, 2))
    # A small head, so that most words are joined to their counts.
    counted, words, model = lm_scoring.learned(train, head=8, size=6)
    found = lm_scoring.score(docs, counted, words, model).collect()
    assert words.n == n and words.v == v
    assert sorted((r.doc_id is None, r.doc_id, held(r.doc_id), r.n_tokens, r.n_known, n, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 for r in found)


def test_probabilities_add_up_to_one():
    model = Gru.new(np.arange(30, 0, -1.0), 3, hidden=5, classes=4)
    h = np.zeros((1, 5), np.float32)
    state = model._step(np.array([model.end]), h)[0]
    logs, _ = model._outputs(np.repeat(state, 30, axis=0), np.arange(30))
    assert math.isclose(np.exp(logs.astype(float)).sum(), 1, rel_tol=1e-4)


def by_rows(model, h, y, grads):
    """What ``Gru._outputs`` adds to the gradients, with a row of logits for each token."""
    def part(h, j, w, b, dw, db):
        logits = h @ w.T + b
        logits -= logits.max(axis=1, keepdims=True)
        probs = np.exp(logits)
        probs /= (probs @ np.ones(len(b), np.float32))[:, None]
        probs[np.arange(len(j)), j] -= 1
        dw += probs.T @ h
        db += probs.sum(axis=0)
        return probs @ w

    of, p = model.of[y], model.p
    dh = part(h, of, p["wc"].T, p["bc"], grads["wc"].T, grads["bc"])
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(len(model.bounds)))
    for k, (a, b) in enumerate(zip(model.bounds, model.bounds[1:])):
        rows = order[cuts[k] : cuts[k + 1]]
        if b - a > 1 and len(rows):
            dh[rows] += part(h.take(rows, axis=0), y[rows] - a, p["wo"][a:b], p["bo"][a:b], grads["wo"][a:b], grads["bo"][a:b])
    return dh


def test_softmax_costs_less_than_row_by_row():
    """The same gradients as with a row of logits for each token, in clearly less CPU time."""
    rng = np.random.default_rng(8)
    counts = 1e7 / np.arange(1, 4097)
    model = Gru.new(counts, 3)
    h = rng.uniform(-1, 1, (8192, model.hidden)).astype(np.float32)
    y = rng.choice(4096, 8192, p=counts / counts.sum())
    took, found = {}, {}
    for name, run in (("rows", lambda g: by_rows(model, h, y, g)), ("model", lambda g: model._outputs(h, y, g)[1])) * 9:
        grads = {k: np.zeros_like(v) for k, v in model.p.items()}
        began = time.thread_time()
        found[name] = [run(grads), *(grads[k] for k in ("wc", "bc", "wo", "bo"))]
        took[name] = min(took.get(name, 9), time.thread_time() - began)
    assert all(np.allclose(a, b, rtol=1e-3, atol=1e-3) for a, b in zip(found["rows"], found["model"]))
    assert took["model"] < 0.85 * took["rows"], took


def test_large_logits_are_shifted():
    """Weights whose powers overflow 32 bits give finite scores, those of plain 64-bit sums."""
    model = Gru.new(np.arange(30, 0, -1.0), 3, hidden=5, classes=4)
    model.p |= {k: model.p[k] * 9000 for k in ("wc", "wo")}
    h = np.random.default_rng(9).uniform(-1, 1, (30, 5)).astype(np.float32)
    logs, _ = model._outputs(h, np.arange(30))

    def log_softmax(logits):
        logits = logits - logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    p, wanted = {k: v.astype(float) for k, v in model.p.items()}, []
    for y in range(30):
        a, b = model.bounds[model.of[y]], model.bounds[model.of[y] + 1]
        wanted.append(log_softmax(h[[y]] @ p["wc"] + p["bc"])[0, model.of[y]] + log_softmax(h[[y]] @ p["wo"][a:b].T + p["bo"][a:b])[0, y - a])
    assert min(wanted) < -100 and np.allclose(logs, wanted, rtol=1e-3, atol=1e-3)


def test_state_is_carried_through_windows():
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 20, n) for n in (0, 1, 5, 33, 200, 1000)]
    model = Gru.new(np.ones(20), 0).train(texts * 20)
    whole = model.score(texts)
    assert np.allclose(whole, model.score(texts, window=7, together=2, outputs=50), rtol=1e-4)

    def by_hand(text):
        h, total = np.zeros((1, model.hidden), np.float32), 0.0
        for x, y in zip([0, *text], [*text, 0]):
            h = model._step(np.array([x]), h)[0]
            total += float(model._outputs(h, np.array([y]))[0][0])
        return total

    assert np.allclose(whole, [by_hand(t) for t in texts], rtol=1e-4)


def test_gradient_by_differences():
    """A step of the optimiser against numeric derivatives of the loss, through two steps of time."""
    rng = np.random.default_rng(6)
    model = Gru.new(np.arange(12, 0, -1.0), 0, hidden=3, classes=3)
    for k in model.p:
        model.p[k] = model.p[k] + rng.standard_normal(model.p[k].shape).astype(np.float32) * 0.3
    text = np.array([3, 7])
    squares = {}
    after = model.train([text], streams=1, window=3, rate=1.0, squares=squares)
    moved = {k: np.sign(model.p[k] - after.p[k]) * np.sqrt(np.maximum(squares[k] - 1e-2, 0)) for k in model.p}
    loss = lambda: -model.score([text])[0] / 3
    for k in ("u", "c", "wc", "bo", "x"):
        flat = model.p[k].reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-2
            up = loss()
            flat[i] = kept - 1e-2
            down = loss()
            flat[i] = kept
            numeric = np.clip((up - down) / 2e-2, -0.1, 0.1)
            assert abs(numeric - moved[k].reshape(-1)[i]) < 5e-3, (k, i)


@pytest.mark.parametrize("n", [0, 2])
def test_without_training_texts(spark, n):
    docs = spark.createDataFrame([(i, "some words") for i in range(n)], "doc_id long, text string")
    counted, words, model = lm_scoring.learned(docs.limit(0))
    found = lm_scoring.score(docs, counted, words, model).collect()
    assert [(r.n_tokens, r.n_known, r.base_score) for r in found] == [(3, 0, 0.0)] * n


def test_scores_do_not_depend_on_partitions(spark, docs):
    """The models are as many as the tokens ask for, and rows are dealt by number, however the input is cut."""
    scores = []
    for parts in (2, 37):
        train = docs.coalesce(1).repartition(parts)
        counted, words, model = lm_scoring.learned(train, head=1000, size=100, shard_tokens=8000)
        scores.append(sum(r.score for r in lm_scoring.score(docs, counted, words, model).collect()))
    assert scores[0] == pytest.approx(scores[1], rel=0.02)


def test_held_out_gain(spark):
    """On held-out texts the recurrent model is well above smoothed unigrams."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    held = in_split(docs.doc_id, 7, 2)
    counted, words, model = lm_scoring.learned(docs.where(~held))
    sums = lm_scoring.score(docs.where(held), counted, words, model).agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert (sums["sum(score)"] - sums["sum(base_score)"]) / sums["sum(n_tokens)"] > 0.08
