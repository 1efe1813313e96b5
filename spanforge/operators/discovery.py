"""Which operations of a trace are worth scoring. Names are compared without case here, as in the query language that these stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.functions.text import filled

#: Ids that a condition names one by one.
MOST_IDS = 1000


def whole_operations(spans: DataFrame, agents: tuple[str, ...]) -> DataFrame:
    """All spans of operations in which one of ``agents`` took part."""
    wanted = spans.where(F.col("agent").isin(*agents)).select("op_id").distinct()
    return spans.join(wanted, "op_id", "left_semi")


def named_operations(spans: DataFrame, ids: Sequence[str], agents: tuple[str, ...] = ()) -> DataFrame:
    """All spans of the operations with these ids, or, where none is given, of those in which one of ``agents`` took part. Ids go into the condition of
    the scan; more than ``MOST_IDS`` are joined instead."""
    wanted = list(dict.fromkeys(x.strip() for x in ids if x and x.strip()))
    if not wanted:
        return whole_operations(spans, agents)
    if len(wanted) <= MOST_IDS:
        return spans.where(F.col("op_id").isin(*wanted))
    return spans.join(spans.sparkSession.createDataFrame([(x,) for x in wanted], "op_id string"), "op_id", "left_semi")


def candidates(spans: DataFrame, *, least_calls: int = 1, only_single: bool = False) -> DataFrame:
    """op_id, started, agents, agent_count, spans, tool_calls, has_tool_defs, usable. ``spans``: op_id, agent, ts, name, definitions."""
    found = spans.groupBy("op_id").agg(
        F.min("ts").alias("started"), F.array_join(F.array_sort(F.collect_set("agent")), ",").alias("agents"),
        F.count_distinct(filled(F.col("agent"))).alias("agent_count"), F.count("*").alias("spans"),
        F.count_if(F.col("name").ilike("execute\\_tool%")).alias("tool_calls"), F.count_if(filled(F.col("definitions")).isNotNull()).alias("has_tool_defs"),
    )
    called, defined = F.col("tool_calls") > 0, F.col("has_tool_defs") > 0
    usable = (
        F.when((F.col("agent_count") > 1) & called & defined, "1-full").when(called & defined, "2-single agent")
        .when(called, "3-no tool defs").otherwise("4-thin")
    )
    found = found.where(F.col("tool_calls") >= least_calls).withColumn("usable", usable)
    return found.where("agent_count = 1") if only_single else found


def top_candidates(found: DataFrame, n: int = 25) -> DataFrame:
    """The most usable, then the latest."""
    return found.orderBy("usable", F.desc("started"), "op_id").limit(n)


def clean_operations(spans: DataFrame, least: int = 3, most: int = 40) -> DataFrame:
    """op_id, started, tool_calls of operations of one agent without failed spans, error results or repeated calls."""
    is_tool = F.col("name").ilike("execute\\_tool%")
    failed = F.col("result").ilike('%"isError":true%') | F.col("result").ilike('%"isError": true%') | F.col("result").ilike('{"error"%')
    found = spans.groupBy("op_id").agg(
        F.min("ts").alias("started"), F.count_distinct(filled(F.col("agent"))).alias("agents"), F.count_if(is_tool).alias("tool_calls"),
        F.count_distinct(F.when(is_tool, F.concat("tool", F.lit("|"), "arguments"))).alias("distinct_calls"),
        F.count_if(~F.col("success")).alias("failed_spans"), F.count_if(is_tool & failed).alias("error_results"),
    )
    clean = found.where("agents = 1 and failed_spans = 0 and error_results = 0 and tool_calls = distinct_calls")
    return clean.where(F.col("tool_calls").between(least, most)).select("op_id", "started", "tool_calls")


def with_content(spans: DataFrame, content: DataFrame) -> DataFrame:
    """``spans`` with the arguments and result of ``content`` (id, arguments, result) laid over their own. A span without
    content survives, and one with several rows of content is not multiplied: the greatest row is taken."""
    one = content.groupBy("id").agg(F.max(F.struct("arguments", "result")).alias("_c"))
    joined = spans.join(one, "id", "left")
    return joined.withColumns({c: F.coalesce(filled(F.col(f"_c.{c}")), c) for c in ("arguments", "result")}).drop("_c")


def outcomes_of(runs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Runs with the reviews of their operation. A review id that comes twice is an error, since the join would count runs twice."""
    reviews = reviews.groupBy("op_id").agg(F.count("*").alias("_n"), F.first("review_id").alias("review_id"), F.first("outcome").alias("outcome"))
    checked = reviews.withColumn("review_id", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("several reviews of "), "op_id"))).otherwise(F.col("review_id")))
    return runs.join(checked.drop("_n"), "op_id", "left")
