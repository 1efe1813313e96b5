"""Recordings of tool calls, and their replay: the k-th call of a key gets its k-th recorded answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import filled, interaction_key, protocol_date
from spanforge.operators.sequence import numbered


def interactions(steps: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, seq, agent, tool, key, result, error_kind, is_write, truncated of a recording. ``seq`` counts all tool
    calls of the operation, and calls of other agents are then left out, so it has gaps."""
    rows = numbered(steps, "op_id").where("not is_a2a")
    return rows.select(
        "op_id", "seq", "agent", "tool", interaction_key(F.col("tool"), F.col("arguments"), config).alias("key"), "result", "error_kind", "is_write", "truncated"
    )


def recordings(rows: DataFrame) -> DataFrame:
    """op_id, agents (in order), interactions, lossy: a header for each recording."""
    first = rows.groupBy("op_id", "agent").agg(F.min("seq").alias("_first"), F.count("*").alias("_n"), F.max("truncated").alias("_lossy"))
    order = F.array_sort(F.collect_list(F.struct("_first", "agent")))
    return first.groupBy("op_id").agg(
        F.array_join(F.transform(order, lambda x: x["agent"]), ",").alias("agents"), F.sum("_n").alias("interactions"), F.max("_lossy").alias("lossy")
    )


def replayed(calls: DataFrame, recorded: DataFrame, *, exhausted: str = "repeat") -> DataFrame:
    """The journal of ``calls`` (session, op_id, seq, key, tool) against ``recorded`` (op_id, seq, key, is_write, truncated):
    outcome is matched, repeated (the last answer again) or diverged, with the recorded seq. Nothing is made up."""
    w = Window.partitionBy("op_id", "key").orderBy("seq")
    answers = recorded.select("op_id", "key", F.row_number().over(w).alias("_k"), F.col("seq").alias("recorded_seq"), "is_write", "truncated")
    sizes = recorded.groupBy("op_id", "key").agg(F.count("*").alias("_n"))
    own = Window.partitionBy("session", "op_id", "key").orderBy("seq")
    asked = calls.select("session", "op_id", "seq", "tool", "key").withColumn("_asked", F.row_number().over(own)).join(sizes, ["op_id", "key"], "left")
    asked = asked.withColumn("_k", F.least("_asked", F.col("_n").cast("int")) if exhausted == "repeat" else F.col("_asked"))
    outcome = (
        F.when(F.col("recorded_seq").isNull(), "diverged").when(F.col("_asked") <= F.col("_n"), "matched").otherwise("repeated")
    )
    return asked.join(answers, ["op_id", "key", "_k"], "left").select(
        "session", "op_id", "seq", "tool", "key", outcome.alias("outcome"), "recorded_seq", F.coalesce("is_write", F.lit(False)).alias("is_write"), "truncated"
    )


def journal_summary(journal: DataFrame) -> DataFrame:
    """session, op_id, calls, matched, repeated, diverged, writes, matched_prefix, first_divergence (its key)."""
    gone = F.col("outcome") == "diverged"
    return journal.groupBy("session", "op_id").agg(
        F.count("*").alias("calls"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("matched", "repeated", "diverged")),
        F.count_if("is_write").alias("writes"), F.coalesce(F.min(F.when(gone, F.col("seq"))).cast("long"), F.count("*")).alias("matched_prefix"),
        F.min_by(F.when(gone, F.col("key")), F.when(gone, F.col("seq"))).alias("first_divergence"),
    )


def tools_called(journal: DataFrame, *, only_diverged: bool = False) -> DataFrame:
    """session, tool (bare), n."""
    rows = journal.where("outcome = 'diverged'") if only_diverged else journal
    return rows.groupBy("session", F.substring_index("tool", "___", -1).alias("tool")).agg(F.count("*").alias("n"))


def local_tools(rows: DataFrame, given: tuple[str, ...] = (), config: EngineConfig = DEFAULT) -> DataFrame:
    """agent, tool that an agent runs itself: recorded without a server prefix and not writing, or given."""
    found = rows.where(~F.contains("tool", F.lit(config.prefix)) & ~F.col("is_write")).select("agent", "tool")
    return found.union(rows.select("agent").distinct().select("agent", F.explode(F.array(*map(F.lit, given)).cast("array<string>")).alias("tool"))).distinct()


def protocol_versions(spans: DataFrame) -> DataFrame:
    """op_id, protocol: the first that any span of the operation carries, as a date."""
    raw = filled(F.col("d")["mcp.protocol.version"])
    return spans.where(raw.isNotNull()).groupBy("op_id").agg(protocol_date(F.min_by(raw, "ord")).alias("protocol"))


def recorded_queries(spans: DataFrame) -> DataFrame:
    """op_id, query: what the user asked in the earliest span that has any text of theirs. ``spans``: op_id, ts, ord, messages (JSON)."""
    kind = "array<struct<role:string,content:string,parts:array<struct<type:string,content:string>>>>"
    mine = F.filter(F.from_json("messages", kind), lambda m: m["role"] == "user")
    said = F.transform(mine, lambda m: F.coalesce(m["content"], F.array_join(F.transform(m["parts"], lambda p: p["content"]), "\n")))
    text = F.btrim(F.array_join(said, "\n"))
    return spans.withColumn("_q", text).where("_q <> ''").groupBy("op_id").agg(F.min_by("_q", F.struct("ts", "ord")).alias("query"))


def offered_tools(recorded: DataFrame, contract: DataFrame) -> DataFrame:
    """op_id, tool, place: recorded tools, then those of the contract, if both have a tool in common; else the recorded ones.
    ``contract``: tool, place; of the size of a manifest."""
    own = recorded.groupBy("op_id", F.substring_index("tool", "___", -1).alias("tool")).agg(F.min("seq").alias("_at"))
    known = own.join(contract.select("tool"), "tool", "left_semi").select("op_id").distinct()
    more = known.join(contract.select(F.col("tool"), F.col("place").alias("_at")))
    rows = own.withColumn("_turn", F.lit(0)).unionByName(more.withColumn("_turn", F.lit(1)))
    first = rows.groupBy("op_id", "tool").agg(F.min(F.struct("_turn", "_at")).alias("_at"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("op_id").orderBy("_at", "tool")) - 1).drop("_at")
