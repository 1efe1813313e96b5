"""Checks: a registry of pass, fail and does-not-apply rules over one row of facts for each run.

A verdict is true, false or null, and null means that the check did not apply; it is never replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import bare_tool
from spanforge.operators.sequence import RUN


@dataclass(frozen=True)
class Check:
    """``rule`` gives (passed, reason, score); ``threshold`` is the least score that passes where scores are compared."""

    name: str
    rule: Callable[[EngineConfig], tuple[Column, Column, Column]]
    threshold: float = 1.0


def share_good(bad: Column, total: Column) -> Column:
    """1 - bad / total, not below 0; 1 where there is nothing."""
    return F.when(total > 0, F.greatest(F.lit(0.0), 1 - bad / total)).otherwise(F.lit(1.0))


def _wasted(c: EngineConfig):
    bad = F.col("n_wasted")
    return bad == 0, F.when(bad > 0, F.concat(bad, F.lit(" avoidable call(s): "), F.col("wasted"))), share_good(bad, F.col("n_calls"))


def _errors(c: EngineConfig):
    n, total = F.col("n_errors"), F.col("n_calls")
    reason = F.when(total == 0, "no tool calls").when(n > 0, F.concat(n, F.lit("/"), total, F.lit(" tool calls errored")))
    return F.when(total > 0, n == 0), reason, share_good(n, total)


def _dead_ends(c: EngineConfig):
    n, total = F.col("n_empty"), F.col("n_calls")
    passed = F.when(total > 0, n / total <= c.most_empty)
    reason = F.when(total == 0, "no tool calls").when(~passed, F.concat(n, F.lit("/"), total, F.lit(" calls returned nothing ("), F.col("empty_tools"), F.lit(")")))
    return passed, reason, share_good(n, total)


def _cascade(c: EngineConfig):
    n, total = F.coalesce("n_cascades", F.lit(0)), F.col("n_calls")
    told = F.concat(n, F.lit(" cascade(s), longest "), F.col("longest"), F.lit("x "), bare_tool(F.col("worst_tool"), c))
    return F.when(total > 0, n == 0), F.when(total == 0, "no tool calls").when(n > 0, told), share_good(F.coalesce("longest", F.lit(0)), total)


def _trajectory(c: EngineConfig):
    wanted, matched = F.col("n_wanted"), F.col("n_matched")
    extra = F.col("n_calls") - matched
    reason = (
        F.when(wanted.isNull(), "no expected actions").when(matched < wanted, F.concat(F.lit("missing "), wanted - matched, F.lit(" step(s)")))
        .when(extra > 0, F.concat(F.lit("matched, "), extra, F.lit(" extra step(s)"))).otherwise("exact")
    )
    return matched == wanted, reason, F.coalesce(matched / wanted, F.lit(1.0))


def _truncation(c: EngineConfig):
    n, skills = F.col("n_truncated"), F.col("n_truncated_skills")
    told = F.concat(n, F.lit(f" tool result(s) truncated at {c.truncated_at} chars"), F.when(skills > 0, F.concat(F.lit(", skills: "), skills)).otherwise(""))
    return n == 0, F.when(n > 0, told), share_good(n, F.col("n_calls"))


def _cost(c: EngineConfig):
    """A budget of 0 is none. The score falls in proportion to what is over budget."""
    tokens = F.coalesce("uncached_input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))
    budgets = [(x, F.lit(float(most))) for x, most in ((tokens, c.most_tokens), (F.col("duration_ms"), c.most_ms)) if most]
    if not budgets:
        return F.lit(None).cast("boolean"), F.lit("no budget is set"), F.lit(1.0)
    scores = [F.when(x <= most, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - (x - most) / most)) for x, most in budgets]
    passed = budgets[0][0] <= budgets[0][1]
    for x, most in budgets[1:]:
        passed = passed & (x <= most)
    told = F.concat(tokens, F.lit(" tokens, "), F.format_number(F.col("duration_ms") / 1000, 1), F.lit("s"))
    return passed, told, F.least(*scores) if len(scores) > 1 else scores[0]


def _arguments(c: EngineConfig):
    checked, bad = F.col("n_args_checked"), F.col("n_args_bad")
    applies = F.coalesce(checked, F.lit(0)) > 0
    reason = F.when(~applies, "no schema matched").when(bad > 0, F.concat(bad, F.lit("/"), checked, F.lit(" calls with invalid arguments")))
    return F.when(applies, bad == 0), reason, F.when(applies, share_good(bad, checked)).otherwise(1.0)


def _ready(c: EngineConfig):
    names = ("query", "response", "definitions")
    missing = F.filter(F.array(*(F.when(~F.coalesce(f"has_{n}", F.lit(False)), F.lit(n)) for n in names)), lambda x: x.isNotNull())
    return F.size(missing) == 0, F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))), 1 - F.size(missing) / 3


CHECKS = (
    Check("no_wasted_calls", _wasted), Check("valid_tool_args", _arguments), Check("no_tool_errors", _errors), Check("no_dead_ends", _dead_ends, 0.75),
    Check("no_search_cascade", _cascade), Check("trajectory", _trajectory), Check("no_truncation", _truncation), Check("cost_latency", _cost),
    Check("evaluator_ready", _ready),
)
# Facts that checks read, with the types they have where nothing provides them.
FACTS = {
    "n_calls": "bigint", "n_errors": "bigint", "n_wasted": "bigint", "wasted": "string", "n_empty": "bigint", "empty_tools": "string", "n_truncated": "bigint",
    "n_truncated_skills": "bigint", "duration_ms": "double", "n_cascades": "bigint", "longest": "bigint", "worst_tool": "string", "n_wanted": "int", "n_matched": "int",
    "uncached_input_tokens": "bigint", "output_tokens": "bigint", "n_args_checked": "bigint", "n_args_bad": "bigint", "has_query": "boolean",
    "has_response": "boolean", "has_definitions": "boolean",
}


def verdicts(facts: DataFrame, config: EngineConfig = DEFAULT, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """op_id, agent, check, place, gating, passed, reason, score: a row for each run and check, from one pass over ``facts``."""
    facts = facts.withColumns({n: F.lit(None).cast(t) for n, t in FACTS.items() if n not in facts.columns})
    rows = []
    for place, check in enumerate(checks):
        passed, reason, score = check.rule(config)
        rows.append(
            F.struct(
                F.lit(check.name).alias("check"), F.lit(place).alias("place"), F.lit(check.name in config.gating).alias("gating"),
                passed.alias("passed"), reason.cast("string").alias("reason"), score.cast("double").alias("score"),
            )
        )
    return facts.select(*RUN, F.inline(F.array(*rows)))


def scored_runs(verdict: DataFrame) -> DataFrame:
    """op_id, agent, passed, failed_gating: a run passes if no gating check is false."""
    failed = F.filter(F.array_sort(F.collect_set(F.when(F.col("gating") & ~F.col("passed"), F.col("check")))), lambda x: x.isNotNull())
    return verdict.groupBy(*RUN).agg(F.array_join(failed, ",").alias("failed_gating")).withColumn("passed", F.col("failed_gating") == "")


def above_threshold(verdict: DataFrame, checks: tuple[Check, ...] = CHECKS, only: tuple[str, ...] | None = None) -> DataFrame:
    """Verdicts by score: whether it reaches the threshold of its check. A check that did not apply scores 1."""
    table = [F.struct(F.lit(c.name).alias("check"), F.lit(c.threshold).alias("threshold")) for c in checks if only is None or c.name in only]
    least = F.map_from_entries(F.array(*table))
    return verdict.withColumn("threshold", F.try_element_at(least, F.col("check"))).where("threshold is not null").withColumn("reached", F.col("score") >= F.col("threshold"))
