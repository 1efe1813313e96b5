"""Repair of the structure of conversations, by an auction for shortest paths.

Roles of a sound conversation begin with ``(s?(ua)+)?``: an optional system row, then user and assistant in turn. A lattice has a node for each row
and each of the four states of that pattern; its arcs are the edits Keep, Rerole, Delete and Insert with whole costs. Every node has a price,
at first the least that its remaining rows cost in any state. The auction keeps one path from its origin: where the last node is cheaper than its
cheapest arc and the price behind it, its price rises to that and the path contracts by it; otherwise the path extends along this arc, until it
reaches the goal. Prices then satisfy ``price <= cost + price behind`` on all arcs, and every cheapest path consists of arcs where both
are equal; the one whose edits read least in ASCII is traced along these tight arcs.

A conversation of more than ``SEGMENT`` rows is cut into segments. Each gives the cheapest edits from every state to every state, and
these are put together in order.

Cases: nulls of role and text count as one space, and so do a null id or turn in the hash of the damage; a null id is a conversation of
its own; null turns come first and are left out of gaps; rows of one turn are taken by role and text; a role is kept only if its first character is the one
that the pattern wants; a conversation of which nothing is left gives zeros, an empty audit and the hash of nothing; an empty table gives an
empty result. Other columns are not read.

Scale: one shuffle by ranges of (conversation, turn), so a long conversation is spread over many tasks. A task solves what begins and ends inside its
range and has at most ``MOST_ROWS`` rows; of others it passes the rows on, and they are solved segment by segment. Only the hash of a long
conversation's repaired text reads it in order, as a stream, since a hash can't be put together from parts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import stored, table

BLANKS = " \t\n\x0b\x0c\r"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
#: States of ``(s?(ua)+)?``: nothing yet, after system, after user, after assistant. What an inserted or renamed row leads to,
#: and what a kept row of some initial leads to.
NEXT = (2, 2, 3, 2)
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
LAWFUL = {"su", "ua", "au"}
DELETE, INSERT, RENAME, OPEN_END = 4, 3, 3, 3
SEGMENT = 64
#: Rows of a conversation that a task holds at once.
MOST_ROWS = 4096

Code = tuple[str, str]  # a row's initial, and its fault: "", "blank", "duplicate" or "truncated"
Edits = dict[tuple[int, int], tuple[int, str]]  # from state to state: cost, and letters of edits


def lattice(codes: list[Code], exits: Iterable[int]) -> tuple[list[list[tuple[str, int, int]]], list[int]]:
    """Arcs (letter, cost, node) of each node 4 * row + state in the order of their letters, and first prices. The last node is the goal, reached from ``exits``.
    Arcs to nodes from which it can't be reached are left out."""
    n = len(codes)
    goal, least = 4 * n + 4, 0
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(goal + 1)]
    prices = [0] * (goal + 1)
    alive = [False] * (goal + 1)
    for i in range(n, -1, -1):
        initial, fault = codes[i] if i < n else ("", "")
        extra = OPEN_END if fault == "truncated" else 0
        doomed = fault in ("blank", "duplicate")
        least += (DELETE if doomed else extra) if i < n else 0
        for q in range(4):
            at = 4 * i + q
            prices[at] = least
            found = [("", 0, goal)] if i == n and q in exits else []
            if i < n:
                found.append(("D", DELETE, at + 4))
            found.append(("I", INSERT, 4 * i + NEXT[q]))
            if i < n and not doomed:
                if (initial, q) in KEPT:
                    found.append(("K", extra, 4 * i + 4 + KEPT[initial, q]))
                found.append(("R", RENAME + extra, 4 * i + 4 + NEXT[q]))
            arcs[at] = found
            alive[at] = any(j == goal or j >= 4 * i + 4 and alive[j] for _, _, j in found)
        for q in (3, 2, 1, 0, 3):  # an insertion stays in the row
            alive[4 * i + q] = alive[4 * i + q] or alive[4 * i + NEXT[q]]
    return [[x for x in own if x[2] == goal or alive[x[2]]] for own in arcs], prices


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> None:
    """Raises ``prices`` until that of ``origin`` is its distance from the goal, the last node, which must be within reach."""
    goal, path = len(arcs) - 1, [origin]
    while path[-1] != goal:
        at = path[-1]
        best, to = min((cost + prices[j], j) for _, cost, j in arcs[at])
        if prices[at] == best:
            path.append(to)
            continue
        prices[at] = best
        if len(path) > 1:
            path.pop()


def trace(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> str:
    """Letters of the path along tight arcs that reads least."""
    goal, letters, seen = len(arcs) - 1, [], {origin}
    stack = [(origin, iter(arcs[origin]))]
    while True:
        at, left = stack[-1]
        for letter, cost, j in left:
            if j not in seen and prices[at] == cost + prices[j]:
                if j == goal:
                    return "".join(letters)
                seen.add(j)
                letters.append(letter)
                stack.append((j, iter(arcs[j])))
                break
        else:  # no tight path leads on from here
            stack.pop()
            letters.pop()


def cheapest(codes: list[Code], origins: Iterable[int], exits: Iterable[tuple[int, ...]]) -> Edits:
    """Cost and letters from each state of ``origins`` to each group of states of ``exits``, named by its last one; what can't be done is left out."""
    found: Edits = {}
    for group in exits:
        arcs, prices = lattice(codes, group)
        for q in origins:
            if arcs[q]:
                auction(arcs, prices, q)
                found[q, group[-1]] = prices[q], trace(arcs, prices, q)
    return found


class Letters:
    """Letters of edits as a chain of pieces, so that long ones share what they begin with."""

    def __init__(self, before: Letters | None, piece: str):
        self.before, self.piece, self.depth = before, piece, before.depth + 1 if before else 0

    def text(self) -> str:
        pieces, at = [], self
        while at:
            pieces.append(at.piece)
            at = at.before
        return "".join(reversed(pieces))

    def reads_before(self, other: Letters) -> bool:
        own, others, a, b = [], [], self, other
        while a is not b:
            if a.depth >= b.depth:
                own.append(a.piece)
                a = a.before
            else:
                others.append(b.piece)
                b = b.before
        return "".join(reversed(own)) < "".join(reversed(others))


class Fold:
    """Segments of one conversation put together: the cheapest edits that lead to each state so far."""

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, Letters]] = {0: (0, Letters(None, ""))}

    def add(self, edits: Edits) -> None:
        new: dict[int, tuple[int, Letters]] = {}
        for (q, to), (cost, letters) in edits.items():
            if q in self.best:
                whole, made = self.best[q][0] + cost, Letters(self.best[q][1], letters)
                if to not in new or whole < new[to][0] or whole == new[to][0] and made.reads_before(new[to][1]):
                    new[to] = whole, made
        self.best = new

    def end(self) -> tuple[int, str]:
        """Only a whole exchange or nothing may end a conversation: behind a system or user row more is inserted."""
        self.add(cheapest([], range(4), [(0, 3)]))
        cost, letters = self.best[3]
        return cost, letters.text()


def solve(codes: list[Code]) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a conversation."""
    if len(codes) <= SEGMENT:
        return cheapest(codes, [0], [(0, 3)])[0, 3]
    fold = Fold()
    for at in range(0, len(codes), SEGMENT):
        fold.add(cheapest(codes[at : at + SEGMENT], fold.best, [(q,) for q in range(4)]))
    return fold.end()


class Repaired:
    """The hash of a repaired conversation, as its rows come in."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state, self.digest, self.lines = letters, 0, 0, hashlib.sha256(), 0

    def _line(self, line: str) -> None:
        self.digest.update(("\n" * bool(self.lines) + line).encode())
        self.lines += 1

    def _insertions(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.state, self.at = NEXT[self.state], self.at + 1
            self._line("user:" if self.state == 2 else "assistant:")

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter, self.at = self.letters[self.at], self.at + 1
        if letter == "R":
            self.state = NEXT[self.state]
            self._line(("user:" if self.state == 2 else "assistant:") + text)
        elif letter == "K":
            self.state = KEPT[role[:1], self.state]
            self._line(f"{role}:{text}")

    def end(self) -> str:
        self._insertions()
        return self.digest.hexdigest()


def fault_of(text: str, seen: bool) -> str:
    if not VISIBLE.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return "" if text.rstrip(BLANKS)[-1] in ".!?" else "truncated"


def unlawful(initials: Iterable[str]) -> int:
    initials = list(initials)
    return sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:], strict=False))


def repair(rows: list[tuple[int | None, str, str]]) -> dict:
    """Counts, cost, letters and hash of one conversation; ``rows``: turn, role, text in order."""
    seen, codes = set(), []
    for _, role, text in rows:
        codes.append((role[:1], fault_of(text, (role, text) in seen)))
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    cost, letters = solve(codes)
    mended = Repaired(letters)
    for _, role, text in rows:
        mended.row(role, text)
    counts = {name: sum(f == name for _, f in codes) for name in ("blank", "duplicate", "truncated")}
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0} | counts | {
        "illegal": unlawful(x for x, _ in codes), "cost": cost, "audit": letters, "repaired_sha256": mended.end(),
    }


RESULTS = [(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", T.StringType()), ("repaired_sha256", T.StringType())]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with their damage: conv_id, turn, role, text. Of a dropped row its id is left, with a null role."""
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).when(F.col("_kind") != 0, F.col("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).when(F.col("_kind") != 0, F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repaired(conversations: DataFrame, *, most_rows: int = MOST_ROWS, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of ``conversations`` (conv_id, turn, role, text), damaged ones as ``damaged`` gives them: a null role marks a dropped row.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc(), F.col("_row").asc()]
    ranged = conversations.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    conv = ranged.schema["conv_id"].dataType
    out = T.StructType([
        T.StructField("conv_id", conv), *(T.StructField(*x) for x in RESULTS), T.StructField("_at", T.LongType()),
        T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations inside this range are solved; rows of its first and last one, and of long ones, are passed on with their order."""
        at, first = TaskContext.get().partitionId() << 40, True
        held: list[tuple] = []
        current, spilling = object(), False
        schema = None

        def passed(rows: list[tuple]) -> list[dict]:
            nonlocal at
            made = [{"conv_id": current, "_at": at + i, "turn": t, "role": r, "text": x} for i, (t, r, x) in enumerate(rows)]
            at += len(rows)
            return made

        for batch in batches:
            schema = schema or pa.schema([batch.schema.field("conv_id"), *((c, pa.int64()) for c, k in RESULTS if k == T.LongType()), ("audit", pa.string()),
                                          ("repaired_sha256", pa.string()), ("_at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                made: list[dict] = []
                for c, *row in zip(*(part.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text")), strict=True):
                    if c != current:
                        if held:
                            made += passed(held) if first or spilling else [{"conv_id": current} | repair([x for x in held if x[1] is not None])]
                            first = False
                        held, current, spilling = [], c, False
                    held.append(tuple(row))
                    if len(held) > most_rows:
                        spilling = True
                        made += passed(held[:-1])
                        held = held[-1:]
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema)
        if held:
            yield pa.RecordBatch.from_pylist(passed(held), schema)

    walked = stored(ranged.mapInArrow(walk, out), "conversation-ranges")
    names = [c for c, _ in RESULTS]
    inside = walked.where("_at is null").select("conv_id", *names)
    return inside.unionByName(_over_ranges(walked.where("_at is not null").select("conv_id", "_at", "turn", "role", "text"), segment).select("conv_id", *names))


def _key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _over_ranges(rows: DataFrame, segment: int) -> DataFrame:
    """The same results for conversations whose rows lie in any number of ranges, in order of ``_at``."""
    rows = rows.withColumn("_key", _key(F.col("conv_id")))
    left = rows.where(F.col("role").isNotNull()).withColumn("_same", F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256))
    again = left.groupBy("_key", "_same").agg(F.min("_at").alias("_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    seen = F.coalesce(F.col("_at") > F.col("_first"), F.lit(False))
    open_end = ~F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).isin(".", "!", "?")
    fault = F.when(~F.col("text").rlike(VISIBLE.pattern), "blank").when(seen, "duplicate").when(open_end, "truncated").otherwise("")
    coded = left.join(again, ["_key", "_same"], "left").select("_key", "_at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    coded = stored(coded, "conversation-codes")

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_at")
        codes = list(zip(rows["initial"], rows["fault"], strict=True))
        # ``segment`` rows at most; fewer where dropped ones lay between.
        edits = [[*pair, *what] for pair, what in cheapest(codes, range(4), [(q,) for q in range(4)]).items()]
        summary = json.dumps({"edits": edits, "illegal": unlawful(rows["initial"]), "first": codes[0][0], "last": codes[-1][0]})
        return pd.DataFrame({"_key": rows["_key"].iloc[:1], "_at": rows["_at"].iloc[:1], "summary": [summary]})

    parts = coded.groupBy("_key", F.expr(f"_at div {int(segment)}").alias("_part")).applyInPandas(summed, "_key string, _at long, summary string")
    none = F.lit(None).cast("string")
    stream = parts.select("_key", F.lit(0).alias("_kind"), "_at", "summary", none.alias("role"), none.alias("text")).unionByName(
        left.select("_key", F.lit(1).alias("_kind"), "_at", none.alias("summary"), "role", "text")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each conversation first the segments, then the rows."""
        current, fold, mended, illegal, cost, last = None, None, None, 0, 0, None
        found: list[dict] = []

        def ended() -> None:
            if current is not None:
                found.append({"_key": current, "illegal": illegal, "cost": cost, "audit": mended.letters, "repaired_sha256": mended.end()})

        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                for key, kind, summary, role, text in zip(*(part.column(c).to_pylist() for c in ("_key", "_kind", "summary", "role", "text")), strict=True):
                    if key != current:
                        ended()
                        current, fold, mended, illegal, last = key, Fold(), None, 0, None
                    if kind == 0:
                        read = json.loads(summary)
                        fold.add({(q, to): (cost_, letters) for q, to, cost_, letters in read["edits"]})
                        illegal += read["illegal"] + (last is not None and last + read["first"] not in LAWFUL)
                        last = read["last"]
                        continue
                    if mended is None:
                        cost, letters = fold.end()
                        mended = Repaired(letters)
                    mended.row(role, text)
            if found:
                yield pa.RecordBatch.from_pylist(found, RESULT_ROWS)
                found = []
        ended()
        if found:
            yield pa.RecordBatch.from_pylist(found, RESULT_ROWS)

    solved = stream.repartition("_key").sortWithinPartitions("_key", "_kind", "_at").mapInArrow(joined, "_key string, illegal long, cost long, audit string, repaired_sha256 string")
    faults = coded.groupBy("_key").agg(*(F.sum((F.col("fault") == c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")))
    here = F.when(F.col("role").isNotNull(), F.col("turn"))
    turns = rows.groupBy("_key").agg(
        F.first("conv_id").alias("conv_id"), (F.max(here) - F.min(here) + 1 - F.count_distinct(here)).alias("gaps"),
    )
    whole = turns.join(faults, "_key", "left").join(solved, "_key", "left")
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return whole.fillna(zero | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})


RESULT_ROWS = pa.schema([("_key", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
