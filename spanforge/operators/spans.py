"""Spans to tool steps: one row for each tool call of an agent."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import bare_tool, canonical_json, error_kind, filled, is_empty


def is_tool_span(name: Column) -> Column:
    """A call leaves a parent span and an empty child with the same attributes; only the parent has this name."""
    return F.startswith(name, F.lit("execute_tool"))


def agents_seen(spans: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """Names of all agents of the trace and of the configuration."""
    seen = spans.select(filled(F.col("d")["gen_ai.agent.name"]).alias("agent")).where("agent is not null")
    given = spans.sparkSession.createDataFrame([(a,) for a in config.agents], "agent string")
    return seen.union(given).distinct()


def unwrapped(tool: Column, arguments: Column, config: EngineConfig = DEFAULT) -> Column:
    """(tool, arguments, unwrapped): the inner call of a wrapper, if it names one."""
    inner = filled(F.get_json_object(arguments, "$.name"))
    is_wrapper = (bare_tool(tool, config) == "call_tool") & inner.isNotNull()
    own = F.coalesce(F.get_json_object(arguments, "$.arguments"), F.lit("{}"))
    return F.struct(
        F.when(is_wrapper, inner).otherwise(tool).alias("tool"),
        F.when(is_wrapper, own).otherwise(arguments).alias("arguments"),
        F.coalesce(is_wrapper, F.lit(False)).alias("unwrapped"),
    )


def classified(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """``steps`` (tool, result, success) with bare_tool, error_kind, errored, empty and truncated."""
    length = F.length(F.coalesce("result", F.lit("")))
    return steps.withColumns(
        {
            "bare_tool": bare_tool(F.col("tool"), config),
            "error_kind": error_kind(F.col("result"), F.col("success"), config),
            "empty": is_empty(F.col("result"), config),
            "truncated": length == config.truncated_at,
        }
    ).withColumn("errored", F.col("error_kind").isNotNull())


def tool_steps(spans: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """Steps of all agents of ``spans``; spans without an agent are left out, an empty operation id is kept."""
    d = F.col("d")
    rows = spans.where(is_tool_span(F.col("name")) & filled(d["gen_ai.agent.name"]).isNotNull()).select(
        "op_id", d["gen_ai.agent.name"].alias("agent"), "ord", "ts", "duration", "success", d["gen_ai.tool.call.id"].alias("call_id"),
        unwrapped(F.coalesce(d["gen_ai.tool.name"], F.lit("")), F.coalesce(d["gen_ai.tool.call.arguments"], F.lit("")), config).alias("_call"),
        F.coalesce(d["gen_ai.tool.call.result"], F.lit("")).alias("result"), "content_missing",
    )
    rows = classified(rows.select("*", "_call.*").drop("_call"), config)
    names = agents_seen(spans, config).select(F.col("agent").alias("tool"), F.lit(True).alias("is_a2a"))
    return rows.join(names, "tool", "left").withColumn("is_a2a", F.coalesce("is_a2a", F.lit(False)))


def parsed_arguments(steps: DataFrame) -> DataFrame:
    """``steps`` with parsed (variant, null where the text is no JSON) and canonical arguments."""
    return steps.withColumns({"parsed": F.try_parse_json("arguments"), "canonical": canonical_json(F.col("arguments"))})


def write_calls(steps: DataFrame, tools: DataFrame | None = None, config: EngineConfig = DEFAULT) -> DataFrame:
    """``steps`` with is_write: by the manifest's hints, else by configured names, else by prefixes.

    ``tools``: tool (bare), read_only, destructive, idempotent; of the size of a manifest.
    """
    name = F.col("bare_tool")
    by_name = name.isin(*config.write_tools) if config.write_tools else F.lit(False)
    guess = reduce(or_, (F.startswith(name, F.lit(p)) for p in config.write_prefixes), by_name)
    if tools is None:
        return steps.withColumn("is_write", guess)
    hints = tools.groupBy(F.col("tool").alias("bare_tool")).agg(
        F.max("read_only").alias("_read"), F.max("destructive").alias("_destroys"), F.max("idempotent").alias("_repeats")
    )
    told = F.when(F.col("_read").isNotNull(), ~F.col("_read")).when(
        F.col("_destroys").isNotNull() | F.col("_repeats").isNotNull(), F.coalesce("_destroys", F.lit(False)) | ~F.coalesce("_repeats", F.lit(True))
    )
    return steps.join(hints, "bare_tool", "left").withColumn("is_write", F.coalesce(told, guess)).drop("_read", "_destroys", "_repeats")
