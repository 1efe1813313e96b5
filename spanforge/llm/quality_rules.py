"""Quality rules: learned decision lists, in DataFrame operations only.

Text statistics are Spark expressions. From labelled rows, sequential covering learns an ordered list of
conjunctions of thresholds that tell documents of low quality: each rule grows by the condition of highest
information gain on two thirds of the rows and is pruned on the others. What the learner sees is a table of
counts by threshold cell, so its size is bounded by the number of cells and not by the rows. The list is
returned as text and as one conditional expression.

Cases: a null or empty text has no words (all statistics 0) and fails the base rules; rows without a label
teach nothing; without labels the list is empty and the base rules alone decide; an empty table gives an
empty result; repeated rows are judged alike. Extra columns pass through whatever their names; columns named
as the statistics are replaced. Windows of eight words are compared by 64-bit hashes within a document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.common import SPACE, packed, stored, table, unpacked

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
WINDOW = 8
#: Shares of the rows at which thresholds are set.
SHARES = [0.01, 0.03, 0.1, 0.3, 0.7, 0.9, 0.95, 0.98]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of each whole text."""
    return unpacked(_statistics(packed(docs, F.col(f"`{text}`").alias("_text"))), docs.columns, *STATISTICS)


def _statistics(rows: DataFrame) -> DataFrame:
    """Statistics of ``rows`` (_own, _text) next to ``_own``. Steps that are used twice are columns of their own, so that
    each is computed once."""
    kept = ["_own"]
    step = rows.select(*kept, F.coalesce(F.col("_text").cast("string"), F.lit("")).alias("_text"))
    trimmed = F.btrim("_text", F.lit(" \t\n\x0b\f\r"))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, f"{SPACE}+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = step.select(
        *kept,
        (F.length("_text") - F.regexp_count("_text", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        lines.alias("_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    step = step.select(
        *kept,
        "word_chars",
        "n_symbols",
        "n_upper",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_hashes").cast("long").alias("n_words"),
        F.when(
            F.size("_hashes") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
                lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW))),
            ),
        ).alias("_windows"),
    )
    known = [c for c in step.columns if c != "_windows"]
    step = step.select(*known, F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.col("_windows")).alias("_windows"))
    step = step.select(*known, F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("at")))).alias("_sorted"))
    twice = F.filter(
        F.transform(
            "_sorted",
            lambda x, i: F.when(
                (F.get("_sorted", i - 1)["h"] == x["h"]) | (F.get("_sorted", i + 1)["h"] == x["h"]), x["at"]
            ),
        ),
        lambda x: x.isNotNull(),
    )
    step = step.select(*known, F.sort_array(twice).alias("_at"))
    gaps = F.transform("_at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - x, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    return step.select(*known, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules may ask about, from the statistics."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "upper_share": F.col("n_upper") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, known: dict[str, Column]) -> Column:
        x = known[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int
    rejected: int

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))}: {self.rejected} of {self.covered} rows are of low quality"


def learn(
    labelled: DataFrame, *, doc_id: str = "doc_id", label: str = "quality", most_rules: int = 8, most_conditions: int = 3,
    least_rows: int = 12, least_precision: float = 0.8,
) -> list[Rule]:
    """An ordered list of rules for rows of label 0, from rows with statistics and a label.

    The cells are the products of len(SHARES) + 1 intervals of each feature that occur, at most 9^6; only their
    counts reach the driver.
    """
    known = features()
    rows = labelled.where(F.col(label).isNotNull()).select(
        *(x.alias(k) for k, x in known.items()),
        (F.col(label) == 0).alias("_low"),
        (F.pmod(F.xxhash64(doc_id), F.lit(3)) != 0).alias("_grow"),
    )
    found = rows.agg(*(F.percentile_approx(k, SHARES, 1000).alias(k) for k in known)).first()
    cuts = {k: sorted(set(found[k] or ())) for k in known}
    cell = {k: sum((F.col(k) > c).cast("int") for c in cs) if cs else F.lit(0) for k, cs in cuts.items()}
    counted = rows.groupBy("_grow", *(x.alias(k) for k, x in cell.items())).agg(
        F.sum(F.col("_low").cast("long")).alias("_low"), F.count("*").alias("_rows")
    )
    cells = counted.collect()
    if not cells:
        return []
    tests = [Condition(k, above, c) for k, cs in cuts.items() for c in cs for above in (True, False)]
    place = {(k, c): i + 1 for k, cs in cuts.items() for i, c in enumerate(cs)}
    at = {k: np.array([r[k] for r in cells]) for k in known}
    holds = np.array([(at[t.feature] >= place[t.feature, t.threshold]) == t.above for t in tests])
    low, every = np.array([r["_low"] for r in cells]), np.array([r["_rows"] for r in cells])
    grow = np.array([r["_grow"] for r in cells])
    left = np.ones(len(cells), bool)
    rules: list[Rule] = []
    while len(rules) < most_rules:
        chosen = _grown(holds, low, every, left & grow, most_conditions, least_rows)
        chosen = _pruned(holds, low, every, left & ~grow, chosen)
        if not chosen:
            break
        covered = left & holds[chosen].all(axis=0)
        n, bad = int(every[covered].sum()), int(low[covered].sum())
        checked = covered & ~grow
        if n < least_rows or bad < least_precision * n or low[checked].sum() < least_precision * every[checked].sum():
            break
        rules.append(Rule(tuple(tests[i] for i in chosen), n, bad))
        left &= ~covered
    return _centred(rules, rows)


def _centred(rules: list[Rule], rows: DataFrame) -> list[Rule]:
    """Each threshold moved to the middle of the gap that it lies in, between the values of the rows that its
    rule covers and those on the other side of the condition."""
    if not rules:
        return rules
    known = {c.feature: F.col(c.feature) for r in rules for c in r.conditions}
    edges = []
    for i, r in enumerate(rules):
        covered = reduce(and_, (c.column(known) for c in r.conditions))
        for j, c in enumerate(r.conditions):
            inside, outside = (F.min, F.max) if c.above else (F.max, F.min)
            edges += [
                inside(F.when(covered, known[c.feature])).alias(f"in{i}_{j}"),
                outside(F.when(~c.column(known), known[c.feature])).alias(f"out{i}_{j}"),
            ]
    found = rows.agg(*edges).first()

    def moved(i: int, j: int, c: Condition) -> Condition:
        a, b = found[f"in{i}_{j}"], found[f"out{i}_{j}"]
        return c if a is None or b is None else Condition(c.feature, c.above, (a + b) / 2)

    return [Rule(tuple(moved(i, j, c) for j, c in enumerate(r.conditions)), r.covered, r.rejected) for i, r in enumerate(rules)]


def _grown(holds, low, every, rows, most, least_rows) -> list[int]:
    """Conditions added one by one for the highest gain: low rows covered, times the bits they are surer by."""
    chosen: list[int] = []
    while len(chosen) < most:
        bad, n = low[rows].sum(), every[rows].sum()
        if not bad or bad >= 0.98 * n:
            break
        now_bad, now_n = holds[:, rows] @ low[rows], holds[:, rows] @ every[rows]
        fit = (now_n >= least_rows) & (now_bad > 0)
        gain = np.where(fit, now_bad * (np.log2(np.maximum(now_bad, 1) / np.maximum(now_n, 1)) - log2(bad / n)), 0)
        best = int(gain.argmax())
        if gain[best] <= 1e-9:
            break
        chosen.append(best)
        rows = rows & holds[best]
    return chosen


def _pruned(holds, low, every, rows, chosen: list[int]) -> list[int]:
    """The beginning of the rule that is worth most on rows it did not grow on."""
    def worth(k: int) -> float:
        hit = rows & holds[chosen[:k]].all(axis=0)
        bad, n = low[hit].sum(), every[hit].sum()
        return (bad - (n - bad)) / n if n else -1.0

    return chosen[: max(range(1, len(chosen) + 1), key=worth)] if chosen else []


def verdict(rules: list[Rule]) -> Column:
    """True for rows to keep: the first rule that holds rejects, and the default keeps."""
    known = features()
    out = None
    for rule in rules:
        holds = reduce(and_, (c.column(known) for c in rule.conditions))
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def kept(rules: list[Rule]) -> Column:
    return F.when(base_failed(), F.lit(False)).otherwise(verdict(rules))


def learned_from(docs: DataFrame, labels: DataFrame, *carried: Column) -> tuple[DataFrame, list[Rule]]:
    """Statistics of all documents, stored once next to ``carried`` columns, and the rules that those with a label teach."""
    own = F.struct("doc_id", *carried).alias("_own")
    names = ["doc_id", *docs.select(*carried).columns] if carried else ["doc_id"]
    numbers = stored(unpacked(_statistics(docs.select(own, F.col("text").alias("_text"))), names, *STATISTICS), "quality-statistics")
    marked = numbers.join(labels.where("quality is not null").select("doc_id", "quality"), "doc_id").where(~base_failed())
    return numbers, learn(marked)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that base rules and learned list keep, in their own columns. The documents are stored next to their
    statistics, so that these are computed once and the rules read plain columns."""
    numbers, rules = learned_from(docs, labels, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_own"))
    return numbers.where(kept(rules)).select(*(F.col(f"_own.`{c}`").alias(c) for c in docs.columns))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers, rules = learned_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return numbers.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), kept(rules).alias("kept"),
    )
