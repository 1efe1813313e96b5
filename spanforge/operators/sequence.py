"""Ordered operators over the steps of a run. The order is (ts, ord); windows spill, so no run is held in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig

RUN = ("op_id", "agent")
ORDER = ("ts", "ord")


def in_order(*keys: str) -> Window:
    return Window.partitionBy(*(keys or RUN)).orderBy(*ORDER)


def cascades(steps: DataFrame, config: EngineConfig = DEFAULT, *, args: int = 0) -> DataFrame:
    """op_id, agent, tool, length, first_ord of maximal runs of fruitless calls to one tool, of ``cascade_from`` calls at
    least. A good call or another tool ends one; the fruitless call that ends one begins the next. With ``args``, also so many characters of the
    arguments of each call, in order."""
    w = in_order()
    fruitless = F.col("errored") | F.col("empty")
    begins = fruitless & (~F.coalesce(F.lag(fruitless).over(w), F.lit(False)) | (F.lag("tool").over(w) != F.col("tool")))
    more = [F.substring("arguments", 1, args).alias("_args")] if args else []
    rows = steps.select(*RUN, "ts", "ord", "tool", *more, fruitless.alias("_fruitless"), F.coalesce(begins, fruitless).alias("_begins"))
    rows = rows.withColumn("_island", F.count_if("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_fruitless")
    listed = [F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, "_args"))), lambda x: x["_args"]).alias("args")] if args else []
    found = rows.groupBy(*RUN, "_island").agg(F.first("tool").alias("tool"), F.count("*").alias("length"), F.min("ord").alias("first_ord"), *listed)
    return found.where(F.col("length") >= config.cascade_from).drop("_island")


def worst_cascades(found: DataFrame) -> DataFrame:
    """op_id, agent, n_cascades, longest, worst_tool (the first of the longest)."""
    return found.groupBy(*RUN).agg(
        F.count("*").alias("n_cascades"), F.max("length").alias("longest"),
        F.max_by("tool", F.struct("length", -F.col("first_ord"))).alias("worst_tool"),
    )


def matched_prefixes(steps: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """op_id, agent, n_wanted, n_matched: how many of the wanted tools (``want``, an array of bare names, one row a run)
    were called in this order, others in between allowed.

    Each wanted tool is looked for behind the place of the one before: ``most`` minima over one window, which
    need no array of a whole run. ``most`` is the length of the longest expectation.
    """
    w = Window.partitionBy(*RUN)
    rows = steps.select(*RUN, "bare_tool", F.struct(*ORDER).alias("_at")).join(wanted.select(*RUN, "want"), list(RUN))
    rows = rows.withColumns({"_matched": F.lit(0), "_last": F.lit(None).cast(rows.schema["_at"].dataType)})
    for i in range(most):
        hit = (F.get("want", i) == F.col("bare_tool")) & (F.col("_matched") == i) & (F.col("_last").isNull() | (F.col("_at") > F.col("_last")))
        rows = rows.withColumn("_next", F.min(F.when(hit, F.col("_at"))).over(w))
        rows = rows.withColumns({"_matched": F.col("_matched") + F.col("_next").isNotNull().cast("int"), "_last": F.coalesce("_next", "_last")}).drop("_next")
    found = rows.groupBy(*RUN).agg(F.max("_matched").alias("_n"))
    return wanted.select(*RUN, F.size("want").alias("n_wanted")).join(found, list(RUN), "left").select(*RUN, "n_wanted", F.coalesce("_n", F.lit(0)).alias("n_matched"))


def numbered(rows: DataFrame, *keys: str, name: str = "seq") -> DataFrame:
    """``rows`` with their place within ``keys``, from 0."""
    return rows.withColumn(name, F.row_number().over(in_order(*keys)) - 1)


def first_seen(rows: DataFrame, value: Column, *keys: str) -> DataFrame:
    """``keys``, value, place: distinct values in the order in which they are first met."""
    firsts = rows.select(*keys, value.alias("value"), F.struct(*ORDER).alias("_at")).where("value is not null")
    firsts = firsts.groupBy(*keys, "value").agg(F.min("_at").alias("_at"))
    return firsts.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1).drop("_at")


def prefix_length(journal: DataFrame, *keys: str) -> DataFrame:
    """``keys``, matched_prefix: calls before the first that diverged. ``journal``: keys, seq, outcome."""
    diverged = F.min(F.when(F.col("outcome") == "diverged", F.col("seq")))
    return journal.groupBy(*keys).agg(F.coalesce(diverged, F.count("*")).alias("matched_prefix"))
