"""Arguments of tool calls against the JSON Schema of their tools, in one pass over the calls.

Judged are required names, unexpected names (``additionalProperties`` is false), types and enums of top-level
properties. Text that is no JSON object is a problem of its own. Placeholders are not judged. A type outside the known seven,
or a property without one, is not judged either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import bound
from spanforge.operators.sequence import RUN


def json_type(value: Column) -> Column:
    """JSON Schema's name of the type of a variant. 1.0 and 1e2 are numbers, not integers."""
    return bound(F.schema_of_variant(value), _named)


def _named(kind: Column) -> Column:
    whole = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    return (
        F.when(whole, "integer").when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean").when(kind.rlike("^ARRAY"), "array").when(kind.rlike("^OBJECT"), "object").otherwise("null")
    )


def schema_properties(tools: DataFrame) -> DataFrame:
    """tool, closed, required, names, spec (name to {types, enum}) of tools (tool, schema, ord) whose schema has
    properties; of definitions of one name the last holds."""
    last = tools.where(F.get_json_object("schema", "$.properties").isNotNull()).groupBy("tool").agg(F.max_by("schema", "ord").alias("schema"))
    one = "struct<type:string,enum:string>"
    read = last.select(
        "tool",
        (F.get_json_object("schema", "$.additionalProperties") == "false").alias("closed"),
        F.coalesce(F.from_json(F.get_json_object("schema", "$.required"), "array<string>"), F.array().cast("array<string>")).alias("required"),
        F.from_json(F.get_json_object("schema", "$.properties"), f"map<string,{one}>").alias("p"),
    )
    types = lambda t: F.when(F.startswith(t, F.lit("[")), F.from_json(t, "array<string>")).when(t.isNotNull(), F.array(t))
    spec = F.transform_values("p", lambda _, v: F.struct(types(v["type"]).alias("types"), F.from_json(v["enum"], "array<string>").alias("enum")))
    return read.select("tool", F.coalesce("closed", F.lit(False)).alias("closed"), "required", F.map_keys("p").alias("names"), spec.alias("spec"))


def problems(steps: DataFrame, tools: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, ord, tool, problem, name: one row for each problem. ``steps``: with bare_tool and arguments;
    ``tools``: tool (bare), schema, ord, and op_id and agent too if definitions differ by run."""
    return judged(steps, tools, config).select(*RUN, "ord", "tool", F.inline(found()))


def found() -> Column:
    """problem and name of all that is wrong with a call, from the columns of ``judged``."""
    def told(problem: str, name: Column) -> Column:
        return F.struct(F.lit(problem).alias("problem"), name.alias("name"))

    def wrong_type(name: Column) -> Column:
        def wrong(wanted: Column, kind: Column) -> Column:
            unknown = F.array_except(wanted, F.array(*(F.lit(t) for t in ("string", "number", "integer", "boolean", "object", "array", "null"))))
            fits = F.array_contains(wanted, kind) | (F.array_contains(wanted, "number") & (kind == "integer")) | (F.size(unknown) > 0)
            return F.coalesce(wanted.isNotNull() & ~fits, F.lit(False))

        return bound(json_type(F.try_element_at("values", name)), lambda kind: wrong(F.try_element_at("spec", name)["types"], kind))

    # Of enums, a null is the text null.
    def outside(name: Column) -> Column:
        allowed = F.try_element_at("spec", name)["enum"]
        return F.coalesce(allowed.isNotNull() & ~F.array_contains(allowed, F.coalesce(F.try_element_at("plain", name), F.lit("null"))), F.lit(False))

    none = F.array().cast("array<string>")
    specified = F.array_intersect("given", "names")
    every = F.concat(
        F.transform(F.array_except("required", "given"), lambda n: told("missing", n)),
        F.transform(F.when(F.col("closed"), F.array_except("given", "names")).otherwise(none), lambda n: told("unexpected", n)),
        F.transform(F.filter(specified, wrong_type), lambda n: told("type", n)),
        F.transform(F.filter(specified, outside), lambda n: told("enum", n)),
    )
    return F.when(F.col("is_object"), every).otherwise(F.array(told("not an object", F.lit(None).cast("string"))))


def judged(steps: DataFrame, tools: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """The calls that have a schema, with it, whether they are objects, the names given, and their values as variants and as text."""
    schema = schema_properties(tools)
    rows = steps.select(*RUN, "ord", F.col("bare_tool").alias("tool"), F.when(F.col("arguments") == "", "{}").otherwise(F.coalesce("arguments", F.lit("{}"))).alias("arguments"))
    rows = rows.where(~F.startswith("arguments", F.lit(config.placeholder))).join(schema, "tool")
    rows = rows.withColumn("_v", F.try_parse_json("arguments"))
    return rows.withColumns({
        "is_object": F.coalesce(json_type(F.col("_v")) == "object", F.lit(False)), "given": F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>")),
        "values": F.try_variant_get("_v", "$", "map<string,variant>"), "plain": F.from_json("arguments", "map<string,string>"),
    }).drop("_v")


def argument_facts(steps: DataFrame, tools: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """op_id, agent, n_args_checked (calls), n_args_bad (problems)."""
    return judged(steps, tools, config).groupBy(*RUN).agg(F.count("*").alias("n_args_checked"), F.sum(F.size(found()).cast("long")).alias("n_args_bad"))
