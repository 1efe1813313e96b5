import math
import re
from collections import Counter

import pytest

from spanforge.llm import language
from spanforge.llm.common import in_split, table, thinned

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, SF, "documents")
    return language.fit(docs.where(~in_split(docs.doc_id, 5, 0)))


def test_held_out_accuracy(spark, model):
    docs = table(spark, SF, "documents")
    rows = language.identify(docs.where(in_split(docs.doc_id, 5, 0)), model).collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_odd_texts(spark, model):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "123 ... \n"), (4, "日本"), (None, "the and of with"), (6, "the and of with " * 50_000), (6, "la des que les vous")],
        "doc_id long, text string",
    ).selectExpr("*", "'x' as lang_pred", "'own' as lang")
    rows = {(r.doc_id, (r.text or "")[:3]): r for r in language.identify(docs, model).collect()}
    assert len(rows) == 7 and all(r.lang == "own" and 0 <= r.score <= 1 for r in rows.values())
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 for k in ((1, ""), (2, ""), (3, "123")))
    assert rows[None, "the"].lang_pred == rows[6, "the"].lang_pred == "en" and rows[6, "la "].lang_pred == "fr"


def test_backs_off_to_shorter_grams(model):
    en = model.languages.index("en")
    word = next(w for w in ("thandred", "eringtion", "thationing") if model.words.rows([w])[0] < 0)
    found = model.unknown([word, "字"])
    assert found[0].argmax() == en and not found[1].any()


def brute(rows, text, least=5):
    """Scores by language of one text, from (text, lang) rows, by dictionaries of counts."""
    words, grams, langs = {}, {}, sorted({lang for _, lang in rows})
    for body, lang in rows:
        for w in re.findall(r"[^\W\d_]+", body.lower()):
            words.setdefault(w, Counter())[lang] += 1
    for w, c in words.items():
        for n in (5, 4, 3, 2, 1):
            padded = f" {w} " if n > 1 else w
            for i in range(len(padded) - n + 1):
                for lang, k in c.items():
                    grams.setdefault(n, {}).setdefault(padded[i : i + n], Counter())[lang] += k
    for n in grams:
        grams[n] = {g: Counter({x: k for x, k in c.items() if k >= least}) for g, c in grams[n].items()}
        grams[n] = {g: c for g, c in grams[n].items() if c}

    def logs(table):
        sums = {x: sum(c[x] + 0.5 for c in table.values()) for x in langs}
        out = {}
        for key, c in table.items():
            row = [math.log((c[x] + 0.5) / sums[x]) for x in langs]
            out[key] = [v - sum(row) / len(row) for v in row]
        return out

    known, of_grams = logs(words), {n: logs(t) for n, t in grams.items()}
    sizes = Counter(lang for _, lang in rows)
    total = [math.log(sizes[x] / len(rows)) for x in langs]
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        row = known.get(w)
        for n in (5, 4, 3, 2, 1):
            if row is not None:
                break
            padded = f" {w} " if n > 1 else w
            found = [of_grams[n][g] for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g in of_grams.get(n, {})]
            if found:
                row = [sum(x) / len(found) for x in zip(*found)]
        for i, v in enumerate(row or []):
            total[i] += v
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp(v - total[best]) for v in total)


def test_scores_against_brute_force(spark):
    rows = [("the cat and the dog", "en"), ("a dog of the house", "en"), ("la casa de la gata", "es"), ("el perro de la casa", "es"), ("le chat et la maison", "fr")] * 3
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    for text in ("the house", "casas perros", "le chien", "zzz", "Houses of CATS", "la"):
        lang, score = model.predict(text)
        wanted = brute(rows, text)
        assert lang == wanted[0] and score == pytest.approx(wanted[1], rel=1e-4), text


def test_a_rare_language_is_learned(spark):
    rows = [(i, f"the word {i} and of", "en") for i in range(3000)] + [(10_000 + i, "ja nein und oder nicht", "de") for i in range(6)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows_each=50)
    assert model.languages == ["de", "en"] and model.predict("nicht und nein")[0] == "de"
    assert len(model.words.hashes) < 50 * 5


def test_without_languages(spark):
    docs = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()] == ["und"]
    none = docs.limit(0)
    assert language.identify(none, language.fit(none)).count() == 0


def test_repeated_rows_stay_within_the_sample(spark, monkeypatch):
    """All rows are equal in id and text, so their hash takes all or none; what it takes is thinned by row."""
    seen = []
    monkeypatch.setattr(language, "thinned", lambda rows, *a: seen.append(thinned(rows, *a)) or seen[-1])
    rows = [(7, "the same words of one text", "en")] * 3000 + [(i, f"andere woorden {i}", "nl") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for seed in range(1, 40):
        chosen = language.sampled(docs, {"en": 3000, "nl": 40}, 2000, seed).where("lang = 'en'").count()
        if chosen:
            break
    assert chosen == 3000
    language.fit(docs, rows_each=2000, seed=seed)
    counts = {r["lang"]: r["count"] for r in seen[0].groupBy("lang").count().collect()}
    assert 1500 < counts["en"] <= 2000 and counts["nl"] == 40


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(empty, language.fit(empty)).count() == 0
