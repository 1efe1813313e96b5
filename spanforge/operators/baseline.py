"""Verdicts against a frozen baseline, and what the difference means for a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.operators.sequence import RUN


def paired(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """op_id, agent, now, was: a row for each run of either side, with its verdicts there, one for each check; null on the side where it is missing.
    Each side is read once."""
    key = list(RUN)
    now = current.groupBy(*key).agg(F.collect_list(F.struct("check", "gating", "passed")).alias("now"))
    was = baseline.groupBy(*key).agg(F.collect_list(F.struct("check", "passed")).alias("was"))
    return now.join(was, key, "full")


def differences(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """op_id, agent, check, gating, was, now, change: regression, fix, lost, or same for runs in both; new or missing
    for runs in one only (one row each, check null). Checks are those of the current run."""
    return changes(paired(current, baseline))


def changes(pairs: DataFrame) -> DataFrame:
    """``differences`` from ``paired``, row by row."""
    none = F.lit(None).cast("boolean")

    def row(check: Column, gating: Column, was: Column, now: Column, alone: Column) -> Column:
        return F.struct(check.alias("check"), gating.alias("gating"), was.alias("was"), now.alias("now"), alone.alias("_alone"))

    def alone(name: str) -> Column:
        return F.array(row(F.lit(None).cast("string"), none, none, none, F.lit(name)))

    def compared(x: Column) -> Column:
        before = F.transform(F.filter("was", lambda w: w["check"] == x["check"]), lambda w: w["passed"])
        before = F.when(F.size(before) > 0, before).otherwise(F.array(none))
        return F.transform(before, lambda w: row(x["check"], x["gating"], w, x["passed"], F.lit(None).cast("string")))

    both = F.flatten(F.transform("now", compared))
    rows = pairs.select(*RUN, F.inline(F.when(F.col("was").isNull(), alone("new")).when(F.col("now").isNull(), alone("missing")).otherwise(both)))
    change = (
        F.when(F.col("_alone").isNotNull(), F.col("_alone"))
        .when(F.col("was") & ~F.col("now"), "regression").when(~F.col("was") & F.col("now"), "fix")
        .when(F.col("was").isNotNull() & F.col("now").isNull(), "lost").otherwise("same")
    )
    return rows.select(*RUN, "check", "gating", "was", "now", change.alias("change"))


def gating_only(changes: DataFrame) -> DataFrame:
    return changes.where("gating")


def strict_failures(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """reason, n: why a strict comparison fails; no rows if every run was compared."""
    key = list(RUN)
    return strict(current.select(*key).distinct().withColumn("now", F.lit(1)).join(baseline.select(*key).distinct().withColumn("was", F.lit(1)), key, "full"))


def strict(pairs: DataFrame) -> DataFrame:
    """``strict_failures`` from ``paired``."""
    n = pairs.agg(
        F.count("now").alias("scored"), F.count_if(F.col("was").isNull()).alias("new"), F.count_if(F.col("now").isNull()).alias("missing")
    )
    reasons = {
        "no run was scored": F.when(F.col("scored") == 0, F.lit(1).cast("long")),
        "scored without a baseline": F.nullif(F.col("new"), F.lit(0)),
        "in the baseline, not scored": F.nullif(F.col("missing"), F.lit(0)),
        "nothing was compared": F.when((F.col("scored") > 0) & (F.col("new") == F.col("scored")), F.col("new")),
    }
    rows = F.array(*(F.struct(F.lit(k).alias("reason"), x.alias("n")) for k, x in reasons.items()))
    return n.select(F.inline(rows)).where("n is not null")


def decision(changes: DataFrame, failures: DataFrame | None = None, *, allow_lost: bool = False) -> DataFrame:
    """One row: passed is false with gating regressions, gating lost coverage (unless allowed), or rows in ``failures`` (reason, n)."""
    held = gating_only(changes).where(F.col("change").isin("regression", *(() if allow_lost else ("lost",)))).agg(F.count("*").alias("held_back"))
    other = failures.agg(F.count("*").alias("strict")) if failures is not None else held.select(F.lit(0).cast("long").alias("strict"))
    return held.join(other).withColumn("passed", (F.col("held_back") == 0) & (F.col("strict") == 0))


def exit_code(runs: DataFrame, *, below: DataFrame | None = None, decided: DataFrame | None = None) -> DataFrame:
    """exit_code (0 or 1) and reason of a build. A rate below its threshold (``below``) comes first; then a comparison with a baseline decides
    alone (``decided``: of ``decision``), so runs that failed before hold nobody up; without one, all ``runs`` (passed) must pass."""
    missed = below.agg((F.count("*") > 0).alias("missed")) if below is not None else runs.agg(F.lit(False).alias("missed"))
    if decided is not None:
        rest = decided.select((~F.col("passed")).alias("failed"), F.lit("worse than the baseline").alias("why"))
    else:
        rest = runs.agg(F.coalesce(F.max(~F.col("passed")), F.lit(False)).alias("failed")).withColumn("why", F.lit("a run failed"))
    reason = F.when(F.col("missed"), "below a threshold").when(F.col("failed"), F.col("why"))
    return missed.join(rest).select(F.when(reason.isNotNull(), 1).otherwise(0).alias("exit_code"), reason.alias("reason"))


def verdicts_equal(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of verdicts that are not the same in both, with the side they are from; none if nothing changed."""
    columns = [*RUN, "check", "passed"]
    a, b = before.select(*columns), after.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("before")).union(b.exceptAll(a).withColumn("side", F.lit("after")))
