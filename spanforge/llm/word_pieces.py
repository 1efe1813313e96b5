"""Token counts by a linear longest-match automaton over a word-piece vocabulary.

The vocabulary is a trie over bytes: tokens that begin with a space begin a word, the others continue one. For
every state a failure link leads to the state that remains once the pieces which are then certain are popped,
and the number of those pieces is stored with the link. A word is read once, byte by byte, adding up popped
counts; no piece is ever built. A word's count is the length of its greedy longest-match split.

Since all single bytes are continuing tokens, every word can be split: where no token begins the word, the
space is a piece of its own. Words are runs of anything but ASCII white space.

Cases: null and empty texts have 0 words and 0 pieces; texts are counted whole, however long; repeated rows
are counted each; an empty table gives an empty result. Other columns pass through; columns named as the
results are replaced.
"""

from __future__ import annotations

import base64
from collections import Counter, deque
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanforge.llm.common import table

#: Counts of words that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000


class Automaton:
    """States are numbers; state 0 is where a piece that continues a word begins."""

    def __init__(self, tokens: list[bytes]):
        self.step: list[dict[int, int]] = [{}]
        self.ends = [False]
        for token in tokens:
            at = 0
            for byte in token:
                nxt = self.step[at].get(byte)
                if nxt is None:
                    nxt = self.step[at][byte] = len(self.step)
                    self.step.append({})
                    self.ends.append(False)
                at = nxt
            self.ends[at] = True
        self.fail = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        self._link()

    def _link(self) -> None:
        """Breadth first: a token's own state pops itself; another state pops what its parent pops and follows
        the parent's links until one has the byte."""
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, state in self.step[parent].items():
                if self.ends[state]:
                    self.fail[state], self.popped[state] = 0, 1
                else:
                    at, popped = self.fail[parent], self.popped[parent]
                    while at >= 0 and byte not in self.step[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[state], self.popped[state] = self.step[at][byte], popped
                queue.append(state)

    def pieces(self, word: bytes) -> int:
        """How many pieces the greedy split of ``word`` has; -1 if it has none."""
        step, fail, popped = self.step, self.fail, self.popped
        at = total = 0
        for byte in word:
            nxt = step[at].get(byte)
            while nxt is None:
                total += popped[at]
                at = fail[at]
                if at < 0:
                    return -1
                nxt = step[at].get(byte)
            at = nxt
        while at > 0:
            total += popped[at]
            at = fail[at]
        return total if at == 0 else -1


def vocabulary(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines]


@cache
def automaton(path: str) -> Automaton:
    """Built once in each Python worker."""
    return Automaton(vocabulary(path))


def greedy_split(word: bytes, tokens: set[bytes]) -> list[bytes]:
    """The longest token first, again and again; for tests."""
    pieces = []
    while word:
        n = next(k for k in range(len(word), 0, -1) if word[:k] in tokens)
        pieces.append(word[:n])
        word = word[n:]
    return pieces


def count_pieces(docs: DataFrame, *, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` without their text, with n_words and n_pieces (long) and longest_word_pieces (int)."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType()), T.StructField("longest_word_pieces", T.IntegerType())]
    docs = docs.drop(*({f.name for f in added} - {text}))
    out = T.StructType([*(f for f in docs.schema if f.name != text), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        machine = automaton(path)
        for batch in batches:
            words, pieces, longest = [], [], []
            for body in batch.column(text):
                counts = Counter((body.as_py() or "").encode().split())
                total = most = 0
                for word, n in counts.items():
                    k = known.get(word)
                    if k is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        k = machine.pieces(b" " + word)
                        if len(word) <= 64:
                            known[word] = k
                    total += k * n
                    most = max(most, k)
                words.append(counts.total())
                pieces.append(total)
                longest.append(most)
            kept = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(longest, pa.int32())],
                names=[*kept, *(f.name for f in added)],
            )

    return docs.mapInArrow(run, out)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
