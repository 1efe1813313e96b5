"""The mix against plain Python: targets, epochs, nearness, ties, reruns, and columns whose names clash."""

import re

import pytest

from spanforge.llm import mixing
from spanforge.llm.common import table

WEIGHTS = (5, 2, 1)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes, most=3):
    """Shares by weight in the order of the names; what is above the limit of a source is dealt again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    fixed, left, open_ = {}, float(sum(sizes.values())), list(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in open_}
        for s in over:
            fixed[s] = float(most * sizes[s])
            left -= fixed[s]
            open_.remove(s)
    return fixed


def check(rows, texts):
    """``rows``: of op3; ``texts``: (doc_id, source, text)."""
    sizes, sources = {}, {}
    for _, s, t in texts:
        sources[s] = sources.get(s, 0) + size_of(t)
    wanted = targets_of(sources)
    assert sorted((r.doc_id is None, r.doc_id, r.size) for r in rows) == sorted((d is None, d, size_of(t)) for d, _, t in texts)
    taken, largest = {}, {}
    for r in rows:
        s = r.source
        assert r.source_size == sources[s] and r.target == pytest.approx(wanted[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        epochs = int(wanted[s] / sources[s] + 1e-9) if sources[s] else 0
        assert r.copies in (epochs, epochs + 1)
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r.size)
        sizes[s] = True
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= largest[s], s


def documents():
    texts = [(i, "a", "w " * (1 + i % 40)) for i in range(200)] + [(1000 + i, "b", "v " * 30) for i in range(7)]
    texts += [(2000 + i, None, "u\tx\n" * (i % 5)) for i in range(30)] + [(3000, "Z", None), (3001, "Z", ""), (None, "b", "no id"), (5, "a", "same id"), (5, "a", "same id")]
    return [*texts, (4000, "c", "long " * 3000)]


def test_against_plain_python(spark):
    texts = documents()
    docs = spark.createDataFrame([(d, t, s) for d, s, t in texts], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    check(rows, texts)
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.text or "", r.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_whole_table_against_plain_python(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "source", "text")
    rows = mixing.mix(docs).collect()
    check(rows, [tuple(r) for r in docs.collect()])


def test_equal_rows_meet_the_target(spark):
    texts = [(None, "b", "the same fifteen words of one text that is here again and again to fill up")] * 400 + [(i, "a", "w " * 30) for i in range(50)] + [(7, "c", "x y")] * 2000
    docs = spark.createDataFrame([(d, t, s) for d, s, t in texts], "doc_id long, text string, source string").repartition(6)
    rows = mixing.mix(docs).collect()
    check(rows, texts)
    assert len({r.copies for r in rows if r.source == "c"}) == 2


def test_clashing_columns(spark):
    names = ("size", "taken", "_copy", "_key", "_source", "_own", "odd.name", "copies", "target", "words", "need")
    kinds = ", ".join(["doc_id long, text string, source string", *(f"`{n}` long" for n in names)])
    docs = spark.createDataFrame([(i, t, s, *range(700 + i, 711 + i)) for i, t, s in ((1, "a b c d e", "x"), (2, "f g", "x"), (3, "", "y"))], kinds)
    out = mixing.repeated(docs)
    assert out.schema == docs.schema and out.count() > 0
    assert all(list(r)[3:] == list(range(700 + r.doc_id, 711 + r.doc_id)) for r in out.collect())
    mixed = mixing.mix(docs)
    assert len(mixed.columns) == len(set(mixed.columns)) == 3 + len(names) + 1 and mixed.count() == 3
    assert {r.doc_id: r.size for r in mixed.collect()} == {1: 5, 2: 2, 3: 0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0 and mixing.repeated(docs).columns == docs.columns and mixing.repeated(docs).count() == 0
