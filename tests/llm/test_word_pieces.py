import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from spanforge.llm import word_pieces

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENS = set(word_pieces.vocabulary(PATH))


@given(st.lists(st.text("abc", min_size=1, max_size=6), max_size=20), st.text("abcd", max_size=25))
@settings(max_examples=300, deadline=None)
def test_same_as_greedy_on_small_vocabularies(tokens, word):
    known = {x.encode() for x in tokens} | {x.encode() for x in "abcd"}
    assert word_pieces.Automaton(sorted(known)).pieces(word.encode()) == len(word_pieces.greedy_split(word.encode(), known))


def test_word_without_split():
    assert word_pieces.Automaton([b"ab", b"abcd"]).pieces(b"abc") == -1
    assert word_pieces.Automaton([b"ab", b"abcd"]).pieces(b"ababcdab") == 3


def test_texts(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice("aeiou strnlß日🙂\n\t#1") for _ in range(400)) for _ in range(20)]
    texts = [None, "", " \t\n", "one", "x" * 5000, *made, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'z' as n_words", "text as note")
    rows = {r.doc_id: r for r in word_pieces.count_pieces(docs).collect()}
    for i, x in enumerate(texts):
        counts = [len(word_pieces.greedy_split(b" " + w, TOKENS)) for w in (x or "").encode().split()]
        assert (rows[i].n_words, rows[i].n_pieces, rows[i].longest_word_pieces) == (len(counts), sum(counts), max(counts, default=0))
        assert rows[i].note == x


def test_empty_table(spark):
    assert word_pieces.count_pieces(spark.createDataFrame([], "doc_id long, text string")).count() == 0
