"""Evaluation datasets: a row for each run with its messages and outcomes, the schema of a dataset, and scores lined up by index."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import filled
from spanforge.operators.arguments import json_type
from spanforge.operators.messages import message_text, plain_messages  # noqa: F401
from spanforge.operators.sequence import ORDER, RUN
from spanforge.operators.spans import classified
from spanforge.storage import Scratch


def final_answer(messages: Column) -> Column:
    """The last text that isn't blank, tools aside, or an empty string. ``messages``: as ``plain_messages`` gives."""
    said = F.filter(messages, lambda m: (F.coalesce(m["role"], F.lit("")) != "tool") & (F.btrim(m["content"]) != ""))
    return F.coalesce(F.try_element_at(said, F.lit(-1))["content"], F.lit(""))


def actions(steps: Column) -> Column:
    """Calls (tool, arguments) as messages of the assistant, arguments as JSON text."""
    call = lambda s: F.struct(F.lit("function_call").alias("type"), s["tool"].alias("name"), s["arguments"].alias("arguments"))
    return F.transform(steps, lambda s: F.struct(F.lit("assistant").alias("role"), F.array(call(s)).alias("content")))


def call_pairs(steps: Column) -> Column:
    """For each call a message with it and one with its result; a call without id is named by its place."""
    def pair(s: Column, i: Column) -> Column:
        name = F.coalesce(filled(s["call_id"]), F.concat(F.lit("call_"), i))
        made = F.struct(F.lit("assistant").alias("role"), name.alias("call_id"), F.lit("tool_call").alias("type"), s["tool"].alias("name"), s["arguments"].alias("content"))
        got = F.struct(F.lit("tool").alias("role"), name.alias("call_id"), F.lit("tool_result").alias("type"), s["tool"].alias("name"), s["result"].alias("content"))
        return F.array(made, got)

    return F.flatten(F.transform(steps, pair))


def dataset_rows(steps: DataFrame, runs: DataFrame | None = None, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, messages, tool_outcomes, expected_actions of each run: what graders read, no more of a result than its
    head and length. ``runs``: op_id, agent, query, response (JSON text), expected."""
    call = F.struct(*ORDER, "tool", "arguments", "call_id", F.col("result"), "success")
    calls = F.array_sort(F.collect_list(call))
    rows = steps.groupBy(*RUN).agg(calls.alias("_steps"))
    outcome = lambda s: F.struct(
        s["tool"].alias("tool"), s["arguments"].alias("arguments"), F.substring(s["result"], 1, config.head).alias("result_head"),
        F.length(s["result"]).alias("result_len"), s["success"].alias("success"),
    )
    out = rows.select(*RUN, call_pairs(F.col("_steps")).alias("_pairs"), F.transform("_steps", outcome).alias("tool_outcomes"), F.size("_steps").cast("long").alias("n_steps"))
    if runs is None:
        return out.withColumnRenamed("_pairs", "messages")
    blank = F.lit(None).cast("string")
    said = lambda role, text: F.struct(role.alias("role"), blank.alias("call_id"), F.lit("text").alias("type"), blank.alias("name"), text.alias("content"))
    asked = F.transform(F.filter(plain_messages("query"), lambda m: m["content"] != ""), lambda m: said(m["role"], m["content"]))
    answer = final_answer(plain_messages("response"))
    last = F.when(answer != "", F.array(said(F.lit("assistant"), answer))).otherwise(F.filter(F.array(said(F.lit(""), answer)), lambda m: F.lit(False)))
    joined = runs.select(*RUN, asked.alias("_asked"), last.alias("_last"), "expected").join(out, list(RUN), "left")
    return joined.select(
        *RUN, F.concat("_asked", F.coalesce("_pairs", F.slice("_asked", 1, 0)), "_last").alias("messages"), "tool_outcomes",
        F.coalesce("expected", F.array().cast("array<string>")).alias("expected_actions"), F.coalesce("n_steps", F.lit(0)).alias("n_steps"),
    )


def outcome_steps(rows: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """Steps of a dataset's ``tool_outcomes`` again, classified by heads; the length tells truncation."""
    s = rows.select(*RUN, F.posexplode("tool_outcomes").alias("ord", "o")).select(*RUN, "ord", F.col("ord").alias("ts"), "o.*")
    s = classified(s.withColumnRenamed("result_head", "result").withColumn("success", F.coalesce("success", F.lit(True))), config)
    return s.withColumn("truncated", F.coalesce("result_len", F.length("result")) == config.truncated_at)


def refused_columns(df: DataFrame) -> list[str]:
    """Columns whose values are objects, which the datasets of graders don't take."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "map")]


def largest_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.max(F.length(F.to_json(F.struct(*df.columns)))).alias("largest"))


def inferred_schema(objects: DataFrame, text: str = "json") -> DataFrame:
    """name, types, required, n of the top-level names of JSON objects: required are those that are never null where they occur.

    An exploded variant per row and one aggregation by name: what is kept is as large as the number of names."""
    v = objects.select(F.try_parse_json(text).alias("_v"))
    fields = v.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("_v").outer())).select("key", json_type(F.col("value")).alias("type"))
    found = fields.where("key is not null").groupBy(F.col("key").alias("name")).agg(F.collect_set("type").alias("_t"), F.count_if(F.col("type") == "null").alias("_null"), F.count("*").alias("n"))
    return found.select("name", F.array_join(F.array_sort("_t"), ",").alias("types"), (F.col("_null") == 0).alias("required"), "n")


def nested_schema(objects: DataFrame, text: str = "json") -> DataFrame:
    """path (names from the outside in), types, required, n of all names in JSON objects, at any depth; names are told of an object only
    where all values at its path are objects, and arrays stay closed.

    One level after another: the values of a level are exploded into names and values, these are summed by path, and the paths whose
    values are all objects, which are no more than there are names, open the next level. Each level is stored, and the one before dropped."""
    scratch = Scratch(objects.sparkSession, "schema")
    level = objects.select(F.array().cast("array<string>").alias("path"), F.col(text).alias("value"))
    found = None
    while True:
        v = level.select("path", F.try_parse_json("value").alias("_v")).where(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")))
        fields = v.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("_v").outer())).where("key is not null")
        names = scratch.stored(fields.select(
            F.concat("path", F.array("key")).alias("path"), json_type(F.col("value")).alias("type"), F.when(json_type(F.col("value")) == "object", F.to_json("value")).alias("value")
        ))
        if scratch.n > 2:
            scratch.drop(scratch.n - 2)
        told = names.groupBy("path").agg(
            F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), (F.count_if(F.col("type") == "null") == 0).alias("required"), F.count("*").alias("n")
        )
        told = scratch.stored(told)
        found = told if found is None else found.unionByName(told)
        if told.where("types = 'object'").isEmpty():
            return found
        level = names.join(told.where("types = 'object'").select("path"), "path", "left_semi").select("path", "value")


def json_schema(found: list) -> dict:
    """The JSON schema that rows of ``nested_schema`` (collected: they are as many as there are names) tell."""
    whole: dict = {"type": "object", "properties": {}, "required": []}
    for row in sorted(found, key=lambda r: (len(r["path"]), r["path"])):
        at = whole
        for name in row["path"][:-1]:
            at = at["properties"][name]
        types = row["types"].split(",")
        at["properties"][row["path"][-1]] = {"type": types[0] if len(types) == 1 else types} | ({"properties": {}, "required": []} if types == ["object"] else {})
        at["required"] += [row["path"][-1]] if row["required"] else []
    return whole


def aligned(local: DataFrame, scored: DataFrame) -> DataFrame:
    """``local`` (index, ...) with score of ``scored`` (index, score). No rows if an index is null, repeated or out of range, or one is
    missing. There is no pairing by position, since rows have none after a shuffle."""
    both = local.join(scored.select(F.col("index"), F.col("score"), F.lit(1).alias("_s")), "index", "full")
    n = scored.agg(F.count("*").alias("_rows"), F.count_distinct("index").alias("_distinct"))
    fits = both.agg(F.count_if(F.col("_s").isNull()).alias("_absent"), F.count("*").alias("_all")).crossJoin(n).crossJoin(local.agg(F.count("*").alias("_local")))
    ok = fits.where("_absent = 0 and _rows = _distinct and _all = _local").select(F.lit(1).alias("_ok"))
    return both.join(F.broadcast(ok)).drop("_s", "_ok")


def columns_in_order(objects: DataFrame, text: str = "json") -> DataFrame:
    """name, place, n of the columns of a dataset in JSON lines, in the order in which they are first met: by row, then by place in the row.
    ``objects`` is read in the order of its files."""
    rows = objects.select(F.monotonically_increasing_id().alias("_row"), F.posexplode(F.json_object_keys(text)).alias("_at", "name"))
    found = rows.groupBy("name").agg(F.min(F.struct("_row", "_at")).alias("_first"), F.count("*").alias("n"))
    # As many rows as there are names.
    return found.select("name", (F.row_number().over(Window.orderBy("_first")) - 1).cast("long").alias("place"), "n").orderBy("place")


def dataset_summary(rows: DataFrame, largest: int = 1_000_000) -> DataFrame:
    """One row on a dataset before it is handed on: rows, calls, rows with expectations, the length of the largest row, whether it is above
    ``largest``, and the keys of trajectories (traj_key, if there is one) in which a token of a scrub stands, each once."""
    marks = "|".join(rf"{re.escape(k)}_" for k in ("NAME?", "PERSON", "VALUE", "COMPANY"))
    scrubbed = F.when(F.col("traj_key").rlike(marks), F.col("traj_key")) if "traj_key" in rows.columns else F.lit(None).cast("string")
    size = F.max(F.length(F.to_json(F.struct(*rows.columns))))
    return rows.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.greatest(F.size("tool_outcomes"), F.lit(0))), F.lit(0)).alias("calls"),
        F.count_if(F.size("expected_actions") > 0).alias("with_expectations"), size.alias("largest"), F.coalesce(size > largest, F.lit(False)).alias("too_large"),
        F.array_sort(F.collect_set(scrubbed)).alias("scrubbed_keys"),
    )


def judged_rows(rows: DataFrame) -> DataFrame:
    """Rows under the names that judging graders ask for."""
    return rows.select(F.concat_ws("|", *RUN).alias("id"), F.to_json("messages").alias("response"), F.to_json("expected_actions").alias("ground_truth"))
