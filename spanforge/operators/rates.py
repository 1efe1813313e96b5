"""Reports over verdicts and runs. What reaches the driver is as small as the number of checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators.sequence import RUN


def check_rates(verdict: DataFrame) -> DataFrame:
    """check, place, gating, passed, applied, skipped, rate: a null verdict is outside the rate, which is null if none
    applied. Gating checks first, then the lowest rates, those without a rate last."""
    found = verdict.groupBy("check", "place", "gating").agg(
        F.count_if("passed").alias("passed"), F.count("passed").alias("applied"), F.count_if(F.col("passed").isNull()).alias("skipped"),
        F.avg(F.col("passed").cast("int")).alias("rate"),
    )
    return found.orderBy(F.desc("gating"), F.asc_nulls_last("rate"), "place")


def overall_rate(scored: DataFrame) -> DataFrame:
    """passed, total, rate (0 if there are no runs)."""
    return scored.agg(
        F.count_if("passed").alias("passed"), F.count("*").alias("total"), F.coalesce(F.avg(F.col("passed").cast("int")), F.lit(0.0)).alias("rate")
    )


def below_floor(rates: DataFrame, least: float) -> DataFrame:
    """Gating checks whose rate is below ``least``; without a rate, none is."""
    return rates.where(F.col("gating") & (F.col("rate") < least))


def not_scored(verdict: DataFrame) -> DataFrame:
    """check, reason, n of verdicts that did not apply."""
    return verdict.where("passed is null").groupBy("check", "reason").agg(F.count("*").alias("n"))


def tracking(runs: DataFrame, *keys: str) -> DataFrame:
    """Calls, tokens and milliseconds by ``keys`` and over all (keys null)."""
    return runs.rollup(*keys).agg(
        F.count("*").alias("runs"), F.sum("n_calls").alias("calls"), F.sum("uncached_input_tokens").alias("uncached_input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.max("peak_input_tokens").alias("peak_input_tokens"), F.max("duration_ms").alias("longest_ms"),
    )


def seeded_sample(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` rows by a hash of their keys, all if there are no more; the same ones in every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def report(runs: DataFrame, verdict: DataFrame) -> dict[str, DataFrame]:
    """The sections of a report on scored runs: ``runs`` (a line for each run, with what it failed), ``detail`` (each failed verdict),
    ``not_scored`` and ``summary`` (each check, gating ones first). ``runs``: op_id, agent, traj_key, started, n_calls.

    Lines come in the order of runs: when they started, then by agent, then by operation."""
    key, order = list(RUN), ["started", "agent", "op_id"]
    failed = verdict.where(~F.col("passed"))
    flags = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "check"))), lambda x: x["check"]), ", ")
    gating = F.coalesce(F.max(F.col("gating") & ~F.col("passed")), F.lit(False))
    told = verdict.groupBy(*key).agg((~gating).alias("passed"))
    lines = runs.join(told, key, "left").join(failed.groupBy(*key).agg(flags.alias("failed")), key, "left")
    detail = failed.join(runs.select(*key, "traj_key", "started"), key).select(*order, "traj_key", "place", "gating", "check", "reason")
    tally = check_rates(verdict).select("check", "gating", "passed", F.col("applied").alias("scored"), "skipped")
    return {
        "runs": lines.select(*order, "traj_key", "n_calls", "passed", F.coalesce("failed", F.lit("all clear")).alias("failed")).orderBy(*order),
        "detail": detail.orderBy(*order, "place"), "not_scored": not_scored(verdict).orderBy("check", "reason"), "summary": tally,
    }
