"""Readers: rows of any export become spans; manifests, baselines and review outcomes become tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig
from spanforge.functions.text import filled, parsed_timestamp
from spanforge.sources import split_json

# Names of the columns of exports, by what they hold.
ALIASES = {
    "timestamp": ("timestamp", "TimeGenerated"),
    "id": ("id", "Id"),
    "op_id": ("operation_Id", "OperationId"),
    "parent": ("operation_ParentId", "ParentId"),
    "name": ("name", "Name"),
    "duration": ("duration", "DurationMs"),
    "success": ("success", "Success"),
    "d": ("customDimensions", "Properties"),
}
# Columns of joined content, with the attributes that they stand for.
CONTENT = {
    "InputMessages": "gen_ai.input.messages",
    "OutputMessages": "gen_ai.output.messages",
    "SystemInstructions": "gen_ai.system_instructions",
    "ToolDefinitions": "gen_ai.tool.definitions",
    "ToolCallArguments": "gen_ai.tool.call.arguments",
    "ToolCallResult": "gen_ai.tool.call.result",
}


def json_rows(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array, object or envelope (``value``, else ``rows``) a file, with ``_ord`` as the place in its file. A file is read in
    one task as one string of at most 2 GB, and one that is no JSON is an error; ``split_json.array_rows`` is for larger arrays."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), F.regexp_replace("value", "^﻿", "").alias("value"))
    inner = F.coalesce(F.get_json_object("value", "$.value"), F.get_json_object("value", "$.rows"), F.col("value"))
    text = F.when(F.startswith(F.btrim(inner), F.lit("[")), inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    read = F.coalesce(F.from_json(text, "array<map<string,string>>"), F.raise_error(F.concat(F.lit("not JSON: "), "_file")))
    rows = files.select("_file", F.posexplode(read).alias("_at", "_row"))
    return rows.select("_file", F.col("_at").cast("long").alias("_ord"), "_row")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    return rows.withColumns({"_file": F.input_file_name(), "_ord": F.monotonically_increasing_id()})


def rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an export, whatever its form, by the first character of its first file: an array is split, an object is read as one envelope
    a file, and anything else is CSV."""
    head = spark.read.option("lineSep", "}").text(path).select(F.substring(F.regexp_replace("value", "^[﻿\\s]+", ""), 1, 1).alias("c")).first()
    if head is None or head.c not in ("[", "{"):
        return csv_rows(spark, path)
    return split_json.array_rows(spark, path) if head.c == "[" else json_rows(spark, path)


def line_rows(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, which split and scale where one array a file does not."""
    return spark.read.json(path)


def aliased(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of the columns that holds something: exact names, then any case, then ``name [zone]``."""
    found = [c for n in names for c in df.columns if c == n]
    found += [c for n in names for c in df.columns if c.lower() == n.lower()]
    found += [c for n in names for c in df.columns if c.lower().startswith(n.lower() + " [")]
    columns = [filled(F.col(f"`{c}`").cast("string")) for c in dict.fromkeys(found)]
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def from_map(row: Column, names: tuple[str, ...]) -> Column:
    """As ``aliased`` for rows whose columns are known only from their keys."""
    def one(name: str, how) -> Column:
        return filled(F.get(F.map_values(F.map_filter(row, lambda k, v: how(F.lower(k), F.lit(name)) & (F.coalesce(v, F.lit("")) != ""))), 0))

    same = lambda k, name: k == name
    return F.coalesce(*(filled(row[n]) for n in names), *(one(n.lower(), same) for n in names), *(one(n.lower() + " [", F.startswith) for n in names))


def bag(text: Column) -> Column:
    """Attributes from JSON text; an empty map if it is none. Nested values stay text."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>"))


def overlaid(d: Column, content: dict[str, Column]) -> Column:
    """Attributes with those of the joined content that hold something laid over them."""
    def without(name: str) -> Column:
        return F.map_filter(d, lambda k, _: k != name)

    for name, value in content.items():
        d = F.when(filled(value).isNull(), d).otherwise(F.map_concat(without(name), F.create_map(F.lit(name), value)))
    return d


def content_missing(d: Column, content: dict[str, Column], config: EngineConfig = DEFAULT) -> Column:
    """Neither joined content, nor real values: a placeholder or a pointer is all there is. Ask this before overlaying."""
    joined = F.coalesce(*(filled(x) for x in content.values()), F.lit(None).cast("string")).isNotNull()
    values = F.filter(F.array(*(d[n] for n in content)), lambda v: F.coalesce(v, F.lit("")) != "")
    placeholder = F.exists(values, lambda v: F.startswith(v, F.lit(config.placeholder)))
    pointer = F.exists(F.map_keys(d), lambda k: F.endswith(k, F.lit(".reference"))) & (F.size(values) == 0)
    return ~joined & (placeholder | pointer)


def spans(rows: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """ord, ts, ts_raw, id, op_id, parent, name, duration, success, d, content_missing of exported rows: either in
    columns, or as ``_row`` maps of ``json_rows``."""
    by_map = "_row" in rows.columns
    pick = (lambda names: from_map(F.col("_row"), names)) if by_map else (lambda names: aliased(rows, names))
    field = {k: pick(names) for k, names in ALIASES.items()}
    content = {attribute: pick((column,)) for column, attribute in CONTENT.items()}
    read = rows.select(
        F.col("_ord").alias("ord") if "_ord" in rows.columns else F.monotonically_increasing_id().alias("ord"),
        *(x.alias(k) for k, x in field.items() if k != "d"), bag(field["d"]).alias("d"), F.struct(*(x.alias(f"c{i}") for i, x in enumerate(content.values()))).alias("_c"),
    )
    over = {a: F.col(f"_c.c{i}") for i, a in enumerate(content)}
    return read.select(
        "ord", parsed_timestamp(F.col("timestamp")).alias("ts"), F.col("timestamp").alias("ts_raw"), "id", F.coalesce("op_id", F.lit("")).alias("op_id"),
        "parent", F.coalesce("name", F.lit("")).alias("name"), F.coalesce(F.col("duration").try_cast("double"), F.lit(0.0)).alias("duration"),
        F.coalesce(F.lower("success") != "false", F.lit(True)).alias("success"), overlaid(F.col("d"), over).alias("d"),
        content_missing(F.col("d"), over, config).alias("content_missing"),
    )


def manifests(spark: SparkSession, path: str, toolbox: str | None = None) -> DataFrame:
    """toolbox, versions, ord, tool, schema, read_only, destructive, idempotent: one row a tool of each manifest file. A file is an object
    with its tools, the answer of a server that lists them, or the bare list; names lose the server before them. Where a file names no toolbox, it is
    ``toolbox``, or else the name of the file up to its first dot. A file without a list of tools is an error, an empty list gives no rows."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"), F.col("_metadata.file_name").alias("_name"))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    bare = F.startswith(F.btrim("value", F.lit(" \t\r\n")), F.lit("["))
    box = F.coalesce(F.when(~bare, field("toolbox")), F.lit(toolbox), F.substring_index("_name", ".", 1))
    versions = F.coalesce(F.from_json(field("versions"), "array<string>"), F.when(field("version").isNotNull(), F.array(field("version"))), F.array(F.lit("*")))
    given = F.when(bare, F.col("value")).otherwise(F.coalesce(field("result.tools"), F.when(F.startswith(field("result"), F.lit("[")), field("result")), field("tools")))
    tools = F.coalesce(F.from_json(given, "array<map<string,string>>"), F.raise_error(F.concat(F.lit("a manifest lists no tools: "), "_name")))
    read = files.select(box.alias("toolbox"), versions.alias("versions"), F.posexplode(tools).alias("ord", "t"))
    hints = F.from_json(F.col("t.annotations"), "readOnlyHint boolean, destructiveHint boolean, idempotentHint boolean")
    return read.select(
        "toolbox", "versions", "ord", F.substring_index("t.name", "___", -1).alias("tool"), F.coalesce(F.col("t.parameters"), F.col("t.inputSchema")).alias("schema"),
        hints["readOnlyHint"].alias("read_only"), hints["destructiveHint"].alias("destructive"), hints["idempotentHint"].alias("idempotent"),
    )


def baselines(spark: SparkSession, path: str) -> DataFrame:
    """file, op_id, agent, row of all frozen rows. Files that hold something else than a list are left out, a list that is no JSON or holds
    other things than objects is an error. ``hits`` counts a key's rows."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lists = files.where(F.startswith(F.btrim("value", F.lit(" \t\r\n﻿")), F.lit("[")))
    read = F.from_json(F.regexp_replace("value", "^﻿", ""), "array<map<string,string>>")
    bad = F.raise_error(F.concat(F.lit("not a list of rows: "), "file"))
    rows = lists.select("file", F.explode(F.when(F.forall(read, lambda x: x.isNotNull()), read).otherwise(bad)).alias("row"))
    rows = rows.select("file", F.col("row.orchestration_id").alias("op_id"), F.col("row.run_agent").alias("agent"), "row")
    return rows.join(rows.groupBy("op_id", "agent").agg(F.count("*").alias("hits")), ["op_id", "agent"])


def outcomes(reviews: DataFrame, names: dict[str, str]) -> DataFrame:
    """Review outcomes under the names of ``names`` (ours to theirs); what a table lacks is null."""
    return reviews.select(*(F.col(f"`{theirs}`").alias(ours) if theirs in reviews.columns else F.lit(None).cast("string").alias(ours) for ours, theirs in names.items()))


def matching_table(spark: SparkSession, guesses: list[str]) -> str | None:
    """The first guess that is a table, else the first table whose name holds a guess."""
    tables = [t.name for t in spark.catalog.listTables()]
    whole = [t for g in guesses for t in tables if t.lower() == g.lower()]
    return next(iter(whole + [t for g in guesses for t in tables if g.lower() in t.lower()]), None)
