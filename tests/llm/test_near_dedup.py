"""Near-duplicates against brute force over all pairs, and the cases of the contract."""

import random
import re

import pytest

from spanforge.llm import near_dedup

COLUMNS = "doc_id long, text string, lang string"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=85):
    sets = {i: shingles_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def documents(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice((8, 60, 200, 700)))] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(8):
            copy = list(b)
            for _ in range(rng.randrange(0, 1 + len(copy) // 60)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(rng.choice((" ", "\n", "\t ")).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    return list(enumerate([*texts, None, "", " \n ", "one", "ONE", "a b c d", "a b c d", "a b c d e"]))


@pytest.mark.parametrize("seed, block, percent", [(1, 5, 85), (2, 3, 85), (3, 1024, 80)])
def test_same_as_brute_force(spark, seed, block, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = documents(seed)
    found = near_dedup.near_duplicates(spark.createDataFrame([(i, t, "x") for i, t in rows], COLUMNS), percent=percent)
    assert {tuple(r) for r in found.collect()} == brute(rows, percent)


def test_short_sets_at_a_low_threshold(spark):
    """Sets of 4 and 5 shingles reach 0.8, though not 0.85."""
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "q r s t u v w x"), (4, "q r s t u v w x y z")]
    found = near_dedup.near_duplicates(spark.createDataFrame([(i, t, "x") for i, t in rows], COLUMNS), percent=80)
    assert {tuple(r) for r in found.collect()} == brute(rows, 80)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_miss_holds_over_all_looks(percent):
    least = near_dedup.least_matches(percent / 100, 1e-4)
    assert near_dedup.drop_probability(least, percent / 100) <= 1e-4
    assert (1 - (percent / 100) ** near_dedup.ROWS) ** near_dedup.band_count(percent, 1e-4) <= 1e-4


def test_many_texts_just_below_the_threshold(spark, monkeypatch):
    """What is given out stays linear where most pairs pass the signatures and none is linked."""
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(400)]
    texts = []
    for i in range(260):
        own = list(base)
        for at in rng.sample(range(0, 400, 5), 8):
            own[at] = f"x{i}_{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], COLUMNS)
    made = []
    monkeypatch.setattr(near_dedup, "stored", lambda df, name, real=near_dedup.stored: made.append((name, real(df, name))) or made[-1][1])
    found = near_dedup.near_duplicates(docs)
    assert {tuple(r) for r in found.collect()} == brute(list(enumerate(texts)))
    counts = {name: df.count() for name, df in made if "links" in name}
    assert sum(counts.values()) < 2 * len(texts), counts


def test_a_large_group_of_copies_is_dealt_out_once(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 50)
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join([*base[:-1], f"end{i}"]) for i in range(600)] + [" ".join(f"z{i}" for i in range(100))]
    made = []
    monkeypatch.setattr(near_dedup, "stored", lambda df, name, real=near_dedup.stored: made.append((name, real(df, name))) or made[-1][1])
    found = near_dedup.near_duplicates(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], COLUMNS)).collect()
    assert {r.component_id for r in found} == {0, 600}
    pairs = [df.count() for name, df in made if name == "near-pairs"]
    # Each class is in two blocks of the bands that it is compared in, and the second pass has nothing to do.
    assert len(pairs) == 2 and pairs[1] == 0 and pairs[0] <= 2 * 600 * 3


def test_empty_table_repeated_ids_and_clashing_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "b"), (3, text, "c"), (3, text, "d"), (None, "other words here", "e"), (None, "other words here", "f"), (3, "yet another", "g"), (None, None, "h"), (3, "", "i")]
    names = ("_dropped", "_row", "_kept", "_own", "odd.name", "row")
    docs = spark.createDataFrame([(*r, *names) for r in rows], ", ".join(["doc_id long, text string, lang string", *(f"`{n}` string" for n in names)]))
    out = near_dedup.keep_one(docs)
    found = out.collect()
    kept = sorted(r[2] for r in found)
    assert out.schema == docs.schema and len(kept) == 5 and all(tuple(r)[3:] == names for r in found)
    assert len(set("cd") & set(kept)) == 1 and len(set("ef") & set(kept)) == 1 and set("ghi") <= set(kept)
    found = near_dedup.near_duplicates(docs)
    assert sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in found.collect() if r.n_shingles > 1) == [
        (False, 3, 3, True), (False, 3, 3, True), (False, 5, 3, False), (False, 5, 3, False)]


def test_rows_are_kept_by_their_bits_and_not_shuffled(spark, monkeypatch):
    """Numbers of several partitions, at the bounds of pieces too; however many rows are kept, texts stay where they are."""
    monkeypatch.setattr(near_dedup, "stored", lambda df, name: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbers = [p * 2**33 + i for p in range(3) for i in (*range(20), 32767, 32768, 32769, 65535, 65536, 65537)]
        kept = [x for x in numbers if x % 3 != 1]
        numbered = spark.createDataFrame([(x, "text") for x in numbers], "_row long, _text string")
        found = near_dedup._marked(numbered, spark.createDataFrame([(x,) for x in kept], "_row long"))
        assert sorted(r["_row"] for r in found.collect()) == kept
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
