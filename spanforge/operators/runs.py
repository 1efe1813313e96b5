"""Runs: one row for each agent of an operation, and the facts that are picked or summed over its spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import INTENT, as_count, bare_tool, filled, first_intent, front_matter_name
from spanforge.operators.messages import message_text
from spanforge.operators.sequence import ORDER, RUN, cascades


def run_facts(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """Counts and times of each run, in one aggregation that combines before its shuffle. ``duration_ms`` is that of
    the longest span, ``tool_ms`` a sum. ``wasted`` lists avoidable errors by kind, most frequent first, then first seen."""
    at = F.struct(*ORDER)
    kinds = [
        F.struct(
            (-F.count_if(F.col("error_kind") == k)).alias("n"), F.min(F.when(F.col("error_kind") == k, at)).alias("at"), F.lit(k).alias("kind")
        )
        for k in config.avoidable
    ]
    listed = F.filter(F.array_sort(F.array(*kinds)), lambda x: x["n"] < 0)
    skill = bare_tool(F.col("tool"), config) == "load_skill"
    return steps.groupBy(*RUN).agg(
        F.min("ts").alias("started"),
        F.max("duration").alias("duration_ms"),
        F.sum("duration").alias("tool_ms"),
        F.count("*").alias("n_calls"),
        F.count_if("errored").alias("n_errors"),
        F.count_if(F.col("error_kind").isin(*config.avoidable)).alias("n_wasted"),
        F.count_if("empty").alias("n_empty"),
        F.count_if("truncated").alias("n_truncated"),
        F.count_if(F.col("truncated") & skill).alias("n_truncated_skills"),
        F.array_join(F.transform(listed, lambda x: F.concat(x["kind"], F.lit("x"), -x["n"])), ", ").alias("wasted"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.when(F.col("empty"), F.col("tool")))), 1, 3), ", ").alias("empty_tools"),
    )


def run_details(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """What a run did, call by call, in order: tool_names, a2a_calls, tool_errors (tool, kind, args), empty_results (tool, args), search_cascades
    (tool, length, args) and actions (calls as messages of the assistant). Arguments are cut, but for those of actions.

    The arrays are the result, so they are gathered by run; all of them come from one list."""
    cut = F.substring("arguments", 1, config.head_arguments)
    call = F.struct(*ORDER, "tool", "is_a2a", "error_kind", "empty", "arguments", cut.alias("args"))
    rows = steps.groupBy(*RUN).agg(F.array_sort(F.collect_list(call)).alias("_calls"))
    only = lambda test, make: F.transform(F.filter("_calls", test), make)
    made = lambda x: F.struct(F.lit("function_call").alias("type"), x["tool"].alias("name"), x["arguments"].alias("arguments"))
    told = rows.select(
        *RUN, F.transform("_calls", lambda x: x["tool"]).alias("tool_names"), only(lambda x: x["is_a2a"], lambda x: x["tool"]).alias("a2a_calls"),
        only(lambda x: x["error_kind"].isNotNull(), lambda x: F.struct(x["tool"].alias("tool"), x["error_kind"].alias("kind"), x["args"].alias("args"))).alias("tool_errors"),
        only(lambda x: x["empty"], lambda x: F.struct(x["tool"].alias("tool"), x["args"].alias("args"))).alias("empty_results"),
        F.transform("_calls", lambda x: F.struct(F.lit("assistant").alias("role"), F.array(made(x)).alias("content"))).alias("actions"),
    )
    found = cascades(steps, config, args=config.head_arguments).groupBy(*RUN).agg(F.array_sort(F.collect_list(F.struct("first_ord", "tool", "length", "args"))).alias("_c"))
    kind = "array<struct<tool: string, length: bigint, args: array<string>>>"
    listed = found.select(*RUN, F.transform("_c", lambda x: F.struct(x["tool"].alias("tool"), x["length"].alias("length"), x["args"].alias("args"))).alias("search_cascades"))
    return told.join(listed, list(RUN), "left").withColumn("search_cascades", F.coalesce("search_cascades", F.array().cast(kind)))


def run_rows(steps: DataFrame, *parts: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """The whole row of each run: its facts, its details, and what each of ``parts`` (op_id, agent, ...) tells of it, such as usage, skills,
    the picked span, or intents; parts without the run leave nulls."""
    rows = run_facts(steps, config).join(run_details(steps, config), list(RUN))
    for part in parts:
        rows = rows.join(part, list(RUN), "left")
    return rows


def trajectories(steps: DataFrame) -> DataFrame:
    """op_id, agent, trajectory: the tools of each run, as text for reports."""
    calls = F.array_sort(F.collect_list(F.struct(*ORDER, "tool")))
    return steps.groupBy(*RUN).agg(F.array_join(F.transform(calls, lambda x: x["tool"]), " -> ").alias("trajectory"))


def usage(spans: DataFrame) -> DataFrame:
    """Tokens of each run, from chat spans, or from roll-ups where no chat span carries any. ``spans``: op_id, agent,
    name, and token counts as text (input, cache_read, cache_write, output, reasoning)."""
    rolled = F.startswith("name", F.lit("invoke_agent"))
    rows = spans.where("input is not null or output is not null")
    rows = rows.select(
        *RUN, rolled.alias("_rolled"), *(as_count(F.col(c)).alias(c) for c in ("input", "cache_read", "cache_write", "output", "reasoning"))
    )
    sums = {
        "prompt_tokens_sum": (F.sum, F.col("input")),
        "uncached_input_tokens": (F.sum, F.greatest(F.col("input") - F.col("cache_read"), F.lit(0))),
        "cache_read_tokens": (F.sum, F.col("cache_read")),
        "cache_write_tokens": (F.sum, F.col("cache_write")),
        "output_tokens": (F.sum, F.col("output")),
        "reasoning_tokens": (F.sum, F.col("reasoning")),
        "peak_input_tokens": (F.max, F.col("input")),
    }
    chats = F.count_if(~F.col("_rolled"))

    def chosen(how, x: Column) -> Column:
        return F.when(chats > 0, how(F.when(~F.col("_rolled"), x))).otherwise(how(F.when(F.col("_rolled"), x)))

    return rows.groupBy(*RUN).agg(
        chats.alias("llm_calls"), *(chosen(how, x).alias(name) for name, (how, x) in sums.items()),
        F.when(chats > 0, F.lit("chat_spans")).otherwise(F.lit("rollup")).alias("usage_source"),
    )


def run_span(spans: DataFrame) -> DataFrame:
    """op_id, agent, ord of the span that speaks for a run: with messages, the agent's invocation before others, the
    longest output, then the first. ``spans``: op_id, agent, ts, ord, name, input_text, output_text."""
    has = filled(F.col("input_text")).isNotNull() | filled(F.col("output_text")).isNotNull()
    rank = Window.partitionBy(*RUN).orderBy(*ORDER)
    rows = spans.where(has).withColumn("_rank", F.row_number().over(rank))
    best = F.struct(F.startswith("name", F.lit("invoke_agent")), F.length(F.coalesce("output_text", F.lit(""))), -F.col("_rank"))
    return rows.groupBy(*RUN).agg(F.max_by("ord", best).alias("ord"))


def longest_definitions(spans: DataFrame) -> DataFrame:
    """op_id, agent, definitions: the longest text of tool definitions, the first of equals."""
    rank = Window.partitionBy(*RUN).orderBy(*ORDER)
    rows = spans.where(filled(F.col("definitions")).isNotNull()).withColumn("_rank", F.row_number().over(rank))
    return rows.groupBy(*RUN).agg(F.max_by("definitions", F.struct(F.length("definitions"), -F.col("_rank"))).alias("definitions"))


def toolboxes(spans: DataFrame) -> DataFrame:
    """op_id, agent, toolbox, version, place, from span names, in the order in which they are first met."""
    pattern = "/toolboxes/([^/]+)/versions/([^/]+)/"
    rows = spans.select(*RUN, F.struct(*ORDER).alias("_at"), F.regexp_extract("name", pattern, 1).alias("toolbox"), F.regexp_extract("name", pattern, 2).alias("version"))
    firsts = rows.where("toolbox <> ''").groupBy(*RUN, "toolbox", "version").agg(F.min("_at").alias("_at"))
    return firsts.withColumn("place", F.row_number().over(Window.partitionBy(*RUN).orderBy("_at")) - 1).drop("_at")


def tool_definitions(boxes: DataFrame, manifests: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """op_id, agent, tool, source, schema: definitions of telemetry (``known``), then of manifests of the toolboxes that a
    run used; the first definition of a name holds.

    Toolbox names join by equality, versions are a condition on the joined rows: equal, or the manifest has ``*``.
    """
    m = manifests.select(F.col("toolbox").alias("_box"), "versions", F.col("ord").alias("_ord"), "tool", "schema")
    applies = (F.col("toolbox") == F.col("_box")) & (F.array_contains("versions", "*") | F.array_contains("versions", F.col("version")))
    found = boxes.join(m, applies).select(*RUN, "tool", "schema", F.concat(F.lit("manifest:"), "toolbox", F.lit("@"), "version").alias("source"), "place", "_ord")
    if known is not None:
        found = found.union(known.select(*RUN, "tool", "schema", F.lit("telemetry"), F.lit(-1), F.lit(0)))
    first = F.min_by(F.struct("source", "schema"), F.struct("place", "_ord", "source"))
    return found.groupBy(*RUN, "tool").agg(first.alias("_first")).select(*RUN, "tool", "_first.*")


def skills(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, ts, ord, skill_name, sha256, chars, truncated, errored, body of every load of a skill."""
    name = F.coalesce(filled(F.get_json_object("arguments", "$.skill_name")), front_matter_name(F.col("result")), F.lit(""))
    return steps.where(bare_tool(F.col("tool"), config) == "load_skill").select(
        *RUN, "ts", "ord", name.alias("skill_name"), F.sha2(F.col("result").cast("binary"), 256).alias("sha256"), F.length("result").alias("chars"),
        "truncated", "errored", F.col("result").alias("body"),
    )


def skill_drift(loads: DataFrame) -> DataFrame:
    """skill_name, versions, hashes of skills that came with more than one body; cut or failed loads do not count."""
    found = loads.where("not truncated and not errored").groupBy("skill_name").agg(F.collect_set(F.substring("sha256", 1, 12)).alias("_h"))
    return found.where(F.size("_h") > 1).select("skill_name", F.size("_h").cast("long").alias("versions"), F.array_join(F.array_sort("_h"), ",").alias("hashes"))


def inbound_intents(steps: DataFrame, config: EngineConfig = DEFAULT, *, only_first: bool = True) -> DataFrame:
    """op_id, agent, inbound: the intent of the first hand-off to an agent that shows one. Callers come in the order in
    which they are first met, their hand-offs in order. By default a hand-off whose first mention names no known
    intent ends the search (``only_first``); else later mentions and hand-offs are asked too."""
    callers = steps.groupBy("op_id", F.col("agent").alias("_caller")).agg(F.min(F.struct(*ORDER)).alias("_since"))
    calls = steps.where("is_a2a").select("op_id", F.col("agent").alias("_caller"), F.col("tool").alias("agent"), F.struct(*ORDER).alias("_at"), "arguments")
    mention = F.regexp_extract("arguments", INTENT, 1) != ""
    intent = first_intent(F.col("arguments"), config, only_first=only_first)
    calls = calls.join(callers, ["op_id", "_caller"]).where(mention if only_first else intent.isNotNull())
    return calls.groupBy("op_id", "agent").agg(F.min_by(intent, F.struct("_since", "_at")).alias("inbound"))


def delegated_intents(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, delegated: the first known intent that a run's own hand-offs name, in order."""
    intent = first_intent(F.col("arguments"), config)
    calls = steps.where("is_a2a").select(*RUN, F.struct(*ORDER).alias("_at"), intent.alias("_intent")).where("_intent is not null")
    return calls.groupBy(*RUN).agg(F.min_by("_intent", "_at").alias("delegated"))


def resolved_intents(asked: DataFrame, steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, intent, intent_source, traj_key of runs, from what they were asked (``asked``: op_id, agent, messages as JSON text), what
    others handed them, and what they handed on, in this order."""
    declared = asked.select(*RUN, first_intent(message_text(F.col("messages")), config).alias("declared"))
    runs = declared.join(inbound_intents(steps, config), list(RUN), "left").join(delegated_intents(steps, config), list(RUN), "left")
    found = intents(runs).select(*RUN, "intent", "intent_source")
    return found.withColumn("traj_key", F.concat_ws("|", "agent", "intent"))


def intents(runs: DataFrame) -> DataFrame:
    """``runs`` with intent and intent_source: declared, else inbound, else delegated, else unknown."""
    return runs.withColumns(
        {
            "intent": F.coalesce("declared", "inbound", "delegated"),
            "intent_source": F.when(F.col("declared").isNotNull(), "declared").when(F.col("inbound").isNotNull(), "inbound")
            .when(F.col("delegated").isNotNull(), "delegated").otherwise("unknown"),
        }
    )


def expectations(runs: DataFrame, expected: DataFrame) -> DataFrame:
    """op_id, agent, want: expectation by agent and intent, else by agent. An empty list counts as none."""
    key = F.concat_ws("|", "agent", "intent")
    table = expected.where(F.size("want") > 0).select("key", "want")
    first = table.select(F.col("key").alias("_key"), F.col("want").alias("_by_key"))
    second = table.select(F.col("key").alias("agent"), F.col("want").alias("_by_agent"))
    joined = runs.select(*RUN, key.alias("_key")).join(first, "_key", "left").join(second, "agent", "left")
    return joined.select(*RUN, F.coalesce("_by_key", "_by_agent").alias("want")).where("want is not null")


def counters(runs: DataFrame) -> DataFrame:
    """One row on the whole export: operations, runs, operations of several agents, runs with calls, with errors."""
    per_op = runs.groupBy("op_id").agg(F.count("*").alias("agents"), F.count_if(F.col("n_calls") > 0).alias("called"), F.count_if(F.col("n_errors") > 0).alias("failed"))
    return per_op.agg(
        F.count("*").alias("operations"), F.sum("agents").alias("runs"), F.count_if(F.col("agents") > 1).alias("several_agents"),
        F.sum("called").alias("runs_with_calls"), F.sum("failed").alias("runs_with_errors"),
    )


def tool_skeletons(steps: DataFrame) -> DataFrame:
    """tool (bare), description, argument_names of the tools of ``steps`` (with bare_tool, description, arguments, is_a2a) that aren't agents:
    the first description that holds anything, and all names that calls have given. Schemas are not made up."""
    rows = steps.where("not is_a2a").select("bare_tool", filled(F.col("description")).alias("_d"), F.struct(*ORDER).alias("_at"), F.explode_outer(F.json_object_keys("arguments")).alias("_name"))
    return rows.groupBy(F.col("bare_tool").alias("tool")).agg(
        F.coalesce(F.min_by("_d", F.when(F.col("_d").isNotNull(), F.col("_at"))), F.lit("")).alias("description"), F.array_sort(F.collect_set("_name")).alias("argument_names")
    )
