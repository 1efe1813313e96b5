"""Statistics against plain Python, the learned list, and what the stage of the pipeline keeps."""

import re

from spanforge.llm import quality_rules as q

TEXTS = [
    None, "", " \n ", "one two", "#a $b\n#a $b\n\nx", "a b c d e f g h " * 3, "w " * 40, "É ü | <b>\tz\x0bq", " ".join(f"word{i}" for i in range(60)),
]


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'extra' as n_words", "1 as lang")
    found = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in q.with_statistics(docs).collect()}
    assert found == {i: by_hand(t) for i, t in enumerate(TEXTS)}


def test_keeps_good_documents_whole(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(40 + i)), "en", 1) for i in range(200)]
    bad = [(1000 + i, " ".join(f"#w{i}x{j}*" for j in range(40 + i)), "en", 0) for i in range(100)]
    docs = spark.createDataFrame([r[:3] for r in good + bad] + [(5000, "short", None), (None, None, "en")], "doc_id long, text string, `odd.name` string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in good + bad], "doc_id long, quality int")
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in good}


def test_without_labels_the_base_rules_decide(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, " ".join(f"w{j}" for j in range(30)))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["doc_id"] for r in q.keep_good(docs, labels).collect()] == [2]
    assert q.keep_good(docs.limit(0), labels).count() == 0


def test_clashing_columns_repeats_long_texts_and_an_empty_table(spark):
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    names = ("_text", "odd.name", "_own", "_lines", "_hashes", "n_lines", "quality")
    rows = [(1, long, *range(7)), (1, long, *range(7)), (None, None, *range(7))]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long, text string", *(f"`{n}` int" for n in names)]))
    found = q.with_statistics(docs).collect()
    assert [(r["_text"], r["odd.name"], r["_own"], r["_lines"], r["_hashes"], r["quality"]) for r in found] == [(0, 1, 2, 3, 4, 6)] * 3
    assert [r.n_words for r in found] == [40_000, 40_000, 0] and found[0].n_repeat_words == by_hand(" ".join(f"w{i % 50}" for i in range(400)))[4] * 100
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert q.keep_good(docs, labels).columns == docs.columns and q.keep_good(docs.limit(0), labels).count() == 0
