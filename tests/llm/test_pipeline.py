"""The whole pipeline, each stage against plain Python on the input that it had."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from tests.llm.test_mixing import size_of, targets_of
from tests.llm.test_near_dedup import brute
from tests.llm.test_quality_rules import by_hand

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, `odd.name` string, _key string"
LABELS = "doc_id long, quality int, toxic int"
GOOD, TOXIC, BAD, COPIES = range(300), range(1000, 1090), range(2000, 2100), range(3000, 3040)


def documents():
    rng = random.Random(11)
    words = lambda: [f"w{rng.randrange(3000)}x" for _ in range(rng.randrange(40, 90))]
    texts = {i: words() for i in GOOD}
    for i in TOXIC:
        texts[i] = words()
        for at in rng.sample(range(40), 8):
            texts[i][at] = rng.choice(("vilescum", "hatefilth"))
    for i in BAD:
        texts[i] = [f"#{w}*" for w in words()]
    for i in COPIES:
        texts[i] = texts[(i - COPIES[0]) // 2][: -1 if i % 2 else None]
    rows = [(i, " ".join(x)) for i, x in texts.items()]
    rows += [(4000, None), (4001, ""), (4002, " \n "), (4003, "few words"), (4004, "say again " * 400), (None, " ".join(words())), (7, rows[7][1])]
    return [(i, t, "en", ("a", "b", "b", None)[k % 4], len(t or ""), "777", "odd", "key") for k, (i, t) in enumerate(rows)]


def labels():
    return [(i, int(i not in BAD), int(i in TOXIC)) for i in [*GOOD, *TOXIC, *BAD]]


def run(spark, folder, docs, marks):
    """The rows of the pipeline, and what each of its stages was given."""
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, LABELS).write.parquet(f"{folder}/labels.parquet")
    given, stages = [], corpus_pipeline.STAGES
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "STAGES", [(n, lambda s, d, p, f=f: given.append(d) or f(s, d, p)) for n, f in stages])
        out = corpus_pipeline.run(spark, str(folder))
    assert len(given) == len(stages) and all(d.schema.names == given[0].schema.names for d in given)
    return out, given


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    out, given = run(spark, tmp_path_factory.mktemp("whole"), documents(), labels())
    return out.collect(), [d.collect() for d in given]


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_toxic_documents_go(ran):
    before, after = ids(ran[1][0]), ids(ran[1][1])
    assert not after.keys() & set(TOXIC)
    assert before - after == Counter({i: 1 for i in TOXIC})


def test_low_quality_goes(ran):
    before, after = ran[1][1:3]
    failed = [r.doc_id for r in before if (n := by_hand(r.text))[0] < 20 or 100 * n[4] > 30 * n[0]]
    assert ids(before) - ids(after) == Counter([*failed, *BAD]) and {4000, 4001, 4002, 4003, 4004} <= set(failed)


def test_one_of_each_group_stays(ran):
    before, after = ran[1][2:4]
    wanted = [i for i, _, _, kept in brute([(r.doc_id, r.text) for r in before if r.doc_id is not None]) if kept]
    assert ids(after) == Counter([*wanted, None]) and not set(COPIES) & set(wanted) and len(wanted) == len(GOOD)


def test_sources_meet_their_targets(ran):
    before, after = ran[1][3:5]
    key = lambda r: (r.doc_id, r.text, r.source)
    copies = Counter(map(key, after))
    assert copies.keys() <= set(map(key, before)) and max(copies.values()) <= 3
    sources = {r.source for r in before}
    total = lambda rows: {s: sum(size_of(r.text) for r in rows if r.source == s) for s in sources}
    wanted, found = targets_of(total(before)), total(after)
    assert all(abs(found[s] - wanted[s]) <= max(size_of(r.text) for r in before if r.source == s) for s in sources)


def test_encoded_as_by_another_encoder(ran):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def encoded(r):
        found = other.encode_ordinary(r.text)
        return r.doc_id, len(found), sha(np.array(found, "<u4").tobytes()), sha(r.text.encode())

    assert Counter(map(encoded, ran[1][4])) == Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in ran[0])
    assert all((r.size, r["odd.name"], r._key) == ("777", "odd", "key") for r in ran[0])


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, "a", "b", "c"), (None, "", None, "a", 0, "a", "b", "c")]])
def test_nothing_is_left(spark, tmp_path, rows):
    """An empty table, and one of which no text is good, without a label."""
    out, _ = run(spark, tmp_path, rows, [])
    assert out.count() == 0 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
