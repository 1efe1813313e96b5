"""The reference's cases of escapes, nested JSON and sensitive keys, in the sweep, the residual check and the candidates."""

import hashlib
import json
import random
import re
import time

import pytest

from spanforge.operators import redaction
from spanforge.operators.literals import Automaton, View, edited, folded, strings_of

SALT = "a salt of sixteen characters"
LISTED = [("José Muñoz", "PERSON"), ("Eli Seale", "PERSON"), ("Zoë Hart", "PERSON"), ("Process", "WORD")]
CUT = json.dumps({"text": json.dumps({"notes": "José Muñoz called\nEli Seale"})})[:-5]


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame(LISTED, "literal string, kind string")


def texts(spark, *rows):
    return spark.createDataFrame([(x,) for x in rows], "text string")


@pytest.mark.parametrize("text", [CUT, json.dumps("a JOSÉ MUÑOZ b"), r"\\nEli Seale", r"x\\u00f1Eli Seale", r"Jos\\u00e9 Mu\\u00f1oz"])
def test_escaped_literals_are_swept(spark, listed, text):
    assert redaction.still_there(texts(spark, text), listed).count() > 0
    out = redaction.swept(texts(spark, text), ["text"], listed, SALT)
    assert "PERSON_" in out.first()["text"] and "Seale" not in out.first()["text"] and "oz" not in out.first()["text"].lower()
    assert redaction.still_there(out, listed).count() == 0


def test_the_residual_check_decodes_nested_json(spark, listed):
    inner = json.dumps({"t": "Muñoz was José Muñoz\nZoë Hart"})
    found = redaction.still_there(texts(spark, json.dumps({"content": inner}), "Processing", None, "Eli Seale, eli seale"), listed)
    assert {r["literal"]: r["n"] for r in found.collect()} == {"José Muñoz": 1, "Zoë Hart": 1, "Eli Seale": 1}


def test_candidates_of_decoded_text_and_sensitive_keys(spark):
    nested = json.dumps({"content": json.dumps({"username": "lowercase", "notes": "was called by José Muñoz"})})
    schema = json.dumps({"name": "srv___get", "parameters": {"description": "hidden words"}})
    found = redaction.candidates(texts(spark, nested, CUT, schema, "mail a.b@example.com, a.b@example.com", None, "[]"))
    kinds = {r["literal"]: (r["kind"], r["n"]) for r in found.collect()}
    assert kinds["lowercase"] == ("PERSON", 1)
    assert kinds["José Muñoz"][1] == 2 and kinds["Eli Seale"][1] == 1
    assert kinds["a.b@example.com"] == ("EMAIL", 2)
    assert "hidden words" not in kinds


def test_a_phrase_of_many_words_does_not_overflow(spark):
    found = redaction.candidates(texts(spark, "Word " * 50_000, "Ann of Berlin"))
    assert [r["literal"] for r in found.collect()] == ["Ann of Berlin"]


def naive(text, literals):
    """Of those that begin first the longest, one after another, each at the bounds of words where it has word characters."""
    low, out, at = folded(text), [], 0
    word = lambda c: c.isalnum() or c == "_"
    while at < len(low):
        hits = [
            x for x in map(folded, literals)
            if low.startswith(x, at) and not (at and word(x[0]) and word(low[at - 1])) and not (at + len(x) < len(low) and word(x[-1]) and word(low[at + len(x)]))
        ]
        best = max(hits, key=len, default=None)
        out.append(f"<{best}>" if best else text[at])
        at += len(best) if best else 1
    return "".join(out)


@pytest.mark.parametrize("seed", range(5))
def test_the_automaton_finds_what_a_search_for_each_finds(seed):
    rng = random.Random(seed)
    alphabet = "abAB +-_\u00e9.İß"
    for _ in range(300):
        literals = tuple({"".join(rng.choices(alphabet, k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))})
        text = "".join(rng.choices(alphabet, k=40))
        assert Automaton(literals).replaced(text, lambda x: f"<{x}>") == naive(text, literals)


def test_the_cost_of_a_text_does_not_grow_with_the_list():
    rng = random.Random(1)
    names = [f"{''.join(rng.choices('abcdefghij', k=6))} {''.join(rng.choices('abcdefghij', k=7))}" for _ in range(50_000)]
    text = " ".join(rng.choices(["word", "another", *names[:50]], k=20_000))
    took = []
    for n in (10, 50_000):
        known = Automaton(tuple(names[:n]))
        begin = time.perf_counter()
        known.found(text)
        took.append(time.perf_counter() - begin)
    assert took[1] < 20 * took[0] + 0.5


@pytest.mark.parametrize(("text", "read"), [
    (r"a\nb", "a\nb"), (r"a\\\\nb", "a\nb"), (r"Mu\u00f1oz", "Muñoz"), (r"\ud83d\ude00!", "😀!"), (r"\ud83d!", "\ufffd!"), ("DOM\\\\eli", "DOM\\eli"), ("\\", "\\"), ("", ""),
])
def test_views_keep_places(text, read):
    view = View(text)
    assert view.text == read
    assert view.place(len(view.text)) == len(text) and [view.place(i) for i in range(len(read) + 1)] == sorted({view.place(i) for i in range(len(read) + 1)})


def test_escapes_at_any_depth_and_logins(spark):
    listed = spark.createDataFrame([("José Muñoz", "PERSON"), ("DOM\\noah", "USER"), ("Ann", "PERSON")], "literal string, kind string")
    text = "José Muñoz\nAnn"
    for _ in range(6):  # five times escaped, and cut off so that nothing parses
        text = json.dumps(text)
        cut = text[1:-1] + ' "'
        out = redaction.swept(texts(spark, cut), ["text"], listed, SALT).first()["text"]
        assert out.count("PERSON_") == 2 and redaction.still_there(texts(spark, cut), listed).count() == 2, cut
    for login in ("DOM\\noah", "DOM\\\\noah"):
        assert redaction.swept(texts(spark, f"by {login} now"), ["text"], listed, SALT).first()["text"].startswith("by USER_")


def test_literals_with_punctuation_are_found_where_they_are_swept(spark):
    listed = spark.createDataFrame([(x, "WORD") for x in ("C++", "##", "+49-x", "a.b")], "literal string, kind string")
    rows = texts(spark, "C++x", "x##y", "calls+49-x", "xa.b", "xC++", None, "")
    assert {r["literal"]: r["n"] for r in redaction.still_there(rows, listed).collect()} == {"C++": 1, "##": 1, "+49-x": 1}
    assert [r["text"] for r in redaction.swept(rows, ["text"], listed, SALT).collect()][3:5] == ["xa.b", "xC++"]


def test_what_the_sweep_replaces_the_check_finds(spark):
    rng = random.Random(9)
    pieces = ["Eli", "Ann Hart", "C++", "é-b", "\\n", "\\u00e9-b", " ", "x", '"', "{", "}", "[1]", "\n", "_", "-"]
    rows = ["".join(rng.choices(pieces, k=12)) for _ in range(120)]
    rows += [json.dumps({"k": x, "Eli": [x, json.dumps({"deep": x})]}) for x in rows[:60]]
    listed = [("eli", "P"), ("Ann Hart", "P"), ("Hart", "P"), ("C++", "P"), ("é-b", "P"), ("-", "P")]
    df = spark.createDataFrame(listed, "literal string, kind string")
    out = [r["text"] for r in redaction.swept(texts(spark, *rows), ["text"], df, SALT).collect()]
    for was, now in zip(rows, out, strict=True):
        known = Automaton(tuple(x for x, _ in listed))
        parts = [was, *(leaf.text for leaf in strings_of(was) or ())]
        assert (was == now) or any(known.found(x) for x in parts), was
    left = redaction.still_there(texts(spark, *[x for x in out if not x.lstrip().startswith(("{", "["))]), df).count()
    assert left == 0


def test_only_changed_values_of_json_are_written_anew():
    text = '{ "a" : "x" ,"x":[1.50, "x\\u0041", {"x": "{\\"y\\":  \\"x\\"}"}]}'
    assert edited(text, lambda x: x) == text
    out = edited(text, lambda x: x.replace("x", "Z"))
    assert out.startswith('{ "a" : "Z" ,"x":[1.50, "ZA", {"x": ') and json.loads(json.loads(out)["x"][2]["x"]) == {"y": "Z"}
    deep = "[" * 100_000
    assert edited(deep, str.upper) == deep and strings_of(deep) is None


def test_strings_of_schemas():
    schema = {"name": "f", "parameters": {"description": "in"}, "arguments": {"q": "out", "deep": [{"name": "g", "inputSchema": "in"}]}, "x": json.dumps({"y": "in"})}
    found = {(leaf.text, leaf.schema) for leaf in strings_of(json.dumps([schema, {"free": "out"}]))}
    assert found == {("f", True), ("in", True), ("out", False), ("g", True)}


@pytest.mark.parametrize(("text", "names"), [
    ("the eBay Inc and Hi Zoë Hart", {"Inc and Hi Zoë Hart"}), ("Hi Zoë, José Muñoz called {", {"Zoë", "José Muñoz"}), ("Thanks,\nEli\nRestart the Server {", {"Eli"}),
    ("Contacted Jeff Gilbert at", {"Contacted Jeff Gilbert"}), ("SAN JOAQUIN COUNCIL OF GOVERNMENTS and the San Joaquin Council of Governments {", {
        "SAN JOAQUIN COUNCIL OF GOVERNMENTS", "San Joaquin Council of Governments"}),
    ("Hello Dear Ann", {"Ann"}), ("requested by Bob.", {"Bob"}), ("Restart now", set()), ("Contact Grant", {"Contact Grant"}), ("cc: Ann Lee", {"Ann Lee"}), ("x2Bay City", {"Bay City"}),
    ("Hi\nMaria de Souza", {"Maria de Souza"}), ("Ann\nBob", set()), ("with O'Neil-Smith", {"O'Neil-Smith"}), ("Hello there", set()), ("see Dr. Ann. Bob", {"Dr. Ann. Bob"}),
])
def test_phrases(spark, text, names):
    found = redaction.candidates(texts(spark, text))
    assert {r["literal"] for r in found.where("kind = 'NAME?'").collect()} == names


@pytest.mark.parametrize("text", ["(209) 456-1688", r"\(209\) 456-1688", "209-456-1688", "209.456.1688", "+1 209 456 1688", "2094561688"])
def test_phone_shapes_are_swept(spark, text):
    none = spark.createDataFrame([], "literal string, kind string")
    out = redaction.swept(texts(spark, f"call {text} today"), ["text"], none, SALT).first()["text"]
    assert "456" not in out.replace(re.search("PHONE_[0-9a-f]{8}", out)[0], "")


@pytest.mark.parametrize("text", ['{"search_score": "0.8234567891"}', "2026-07-06T10:00:00Z", "ticket 805545", "v1.209.456.1688", "host 10.20.3.44, call 456-1688, Stockton CA 95202-1234 {"])
def test_what_is_no_phone_is_left_alone(spark, text):
    none = spark.createDataFrame([], "literal string, kind string")
    assert redaction.swept(texts(spark, text), ["text"], none, SALT).first()["text"] == text


def test_phone_redaction_goes_by_letters_of_any_language_and_takes_neighbours(spark, tmp_path):
    """A number that hangs on a letter is none, with or without a mark; of two with one space between both are replaced, as they are written."""
    from spanforge.plans import catalogue

    rows = [(1, "é269-555-3296 and 836-555-9331"), (2, "+1 (269) 555-3296 +1 (836) 555-9331"), (3, "836-555-9331\n269-555-3296"), (4, "none"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    named = lambda *x: ",".join(f"PHONE_{hashlib.sha256((catalogue.SALT + n).encode()).hexdigest()[:8]}" for n in x)
    found = {r["doc_id"]: (r["tokens"], r["left"]) for r in catalogue.phone_redaction(spark, str(tmp_path)).collect()}
    assert found == {
        1: (named("836-555-9331"), 0), 2: (named("+1 (269) 555-3296", "+1 (836) 555-9331"), 0), 3: (named("836-555-9331", "269-555-3296"), 0),
    }


def test_candidates_are_counted_by_hash_and_only_escapes_go_to_python(spark):
    """A key's kind comes before that of a shape, numbers of keys are held to the rule of numbers; counting needs no sort."""
    nested = json.dumps({"phone": "555-1234", "contactPhone": "2695553296", "name": "ops@example.com"})
    found = redaction.candidates(texts(spark, nested, "of Ann Lee, from: Bo. see a.b.example.com or x..y-.com", "Ann Lee"))
    kinds = {r["literal"]: (r["kind"], r["n"]) for r in found.collect()}
    assert kinds["2695553296"] == ("PHONE", 2) and kinds["ops@example.com"][0] == "PERSON" and kinds["Ann Lee"] == ("NAME?", 2)
    assert kinds["a.b.example.com"] == ("DOMAIN?", 1) and kinds["555-1234"][0] == "PHONE?" and "x..y-.com" not in kinds
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_the_sweep_takes_a_few_texts_at_a_time(spark, listed, monkeypatch):
    monkeypatch.setattr(redaction, "PIECE", 3)
    rows = [(i, None if i % 7 == 0 else f"{i} Eli Seale") for i in range(100)]
    out = redaction.swept(spark.createDataFrame(rows, "id int, text string"), ["text"], listed, SALT)
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        assert r["text"] is None if r["id"] % 7 == 0 else r["text"].startswith(f"{r['id']} PERSON_")
    assert redaction.swept(spark.createDataFrame([], "text string"), ["text"], listed, SALT).collect() == []
