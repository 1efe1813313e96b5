"""One large JSON array in one file, read by many tasks.

The text reader cuts files at ``}`` instead of at line ends, so its byte ranges split a file whatever its lines are, in any store. What a piece means
depends on whether it begins inside a string and how deep, which only all pieces before it tell. So each piece first says what it
does in both cases: whether it turns inside and outside about, and by how much it goes deeper. These are summed for each range, the sums of
ranges (some thousand for a terabyte) are put in order, and every piece then knows where it stands. Elements are the pieces between two
returns to the depth of the array; each is put together from its pieces.

Errors, never missing rows: text that is no array of objects, or breaks off, raises ``not JSON``. An empty file has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanforge.storage import Scratch

RANGE = ("_file", "_block")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """_file, _block (where its range begins), _id (order in the range), t (text up to a brace), turns (quotes, odd or even), and down0, down1: by
    how much it goes deeper outside of strings, if it begins outside or inside of one."""
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(path).select(
        meta["file_path"].alias("_file"), meta["file_block_start"].alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("t"),
        meta["file_size"].alias("_size"),
    )
    rows = rows.withColumn("_plain", F.regexp_replace("t", r"(?s)\\.", ""))
    outside = lambda x: F.regexp_replace(x, r'"[^"]*+(?:"|\z)', "")
    deeper = lambda x: F.regexp_count(x, F.lit(r"[\[{]")) - F.regexp_count(x, F.lit(r"\]"))
    rows = rows.withColumns({"_out0": outside(F.col("_plain")), "_out1": outside(F.regexp_replace("_plain", r'\A[^"]*+(?:"|\z)', ""))})
    turns = F.regexp_count("_plain", F.lit('"')) % 2
    return rows.select(*RANGE, "_id", "t", "_size", F.octet_length("t").alias("_bytes"), turns.alias("turns"), deeper(F.col("_out0")).alias("down0"), deeper(F.col("_out1")).alias("down1"))


def _before(value: Column, order: Window) -> Column:
    return F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def elements(spark: SparkSession, path: str) -> DataFrame:
    """_file, _ord and value: the JSON text of each object of the array that each file holds."""
    scratch = Scratch(spark, "split-json")
    pieces = scratch.stored(_pieces(spark, path))
    inside = Window.partitionBy(*RANGE).orderBy("_id")
    ranges = Window.partitionBy("_file").orderBy("_block")
    slim = pieces.drop("t").withColumn("_turned", _before(F.col("turns"), inside) % 2)

    def down(begins: Column) -> Column:
        """Of a piece in a range that begins inside (1) or outside (0): the brace behind it closes if it ends outside."""
        at = (begins + F.col("_turned")) % 2
        return F.when(at == 0, F.col("down0")).otherwise(F.col("down1")) - F.when((at + F.col("turns")) % 2 == 0, 1).otherwise(0)

    sums = slim.groupBy(*RANGE).agg(F.sum("turns").alias("turns"), F.sum(down(F.lit(0))).alias("d0"), F.sum(down(F.lit(1))).alias("d1"))
    begins = sums.withColumn("_begins", _before(F.col("turns"), ranges) % 2)
    begins = begins.select(*RANGE, "_begins", _before(F.when(F.col("_begins") == 0, F.col("d0")).otherwise(F.col("d1")), ranges).alias("_depth"))
    known = slim.join(begins, list(RANGE)).withColumn("_down", down(F.col("_begins")))
    depth = F.sum("_down").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_depth")
    ends_outside = (F.col("_begins") + F.col("_turned") + F.col("turns")) % 2 == 0
    ended = known.select(*RANGE, "_id", (ends_outside & (depth == 1)).cast("int").alias("_ends"))
    ended = scratch.stored(ended)
    number = ended.groupBy(*RANGE).agg(F.sum("_ends").alias("n")).select(*RANGE, _before(F.col("n"), ranges).alias("_first"))
    placed = ended.join(number, list(RANGE)).select(*RANGE, "_id", "_ends", (F.col("_first") + _before(F.col("_ends"), inside)).alias("_ord"))
    parts = pieces.select(*RANGE, "_id", "t").join(placed, [*RANGE, "_id"])
    whole = parts.groupBy("_file", "_ord").agg(F.sort_array(F.collect_list(F.struct("_block", "_id", "t"))).alias("_parts"), F.max("_ends").alias("_ends"))
    text = F.array_join(F.transform("_parts", lambda x: x["t"]), "}")
    first = F.col("_ord") == 0
    text = F.when(first, F.regexp_replace(text, "^﻿", "")).otherwise(text)
    bad = F.raise_error(F.concat(F.lit("not JSON: "), "_file"))
    opens = F.when(first, text.rlike(r"\A\s*\[\s*\{")).otherwise(text.rlike(r"\A\s*,\s*\{"))
    # Behind the last element only the bracket is left; an array without elements is one piece.
    closes = F.when(first, text.rlike(r"\A\s*\[\s*\]\s*\z")).otherwise(text.rlike(r"\A\s*\]\s*\z"))
    value = F.when(F.col("_ends") == 1, F.when(opens, F.concat(F.regexp_replace(text, r"\A\s*[\[,]\s*", ""), F.lit("}"))).otherwise(bad)).otherwise(F.when(closes, F.lit("")).otherwise(bad))
    # Every file ends in a piece that is no element, or it broke off behind a brace.
    tails = placed.groupBy("_file").agg(F.max("_ord").alias("_last"), F.sum("_ends").alias("_all"))
    # All bytes but those of the pieces are braces between them, and those of a mark that the reader skips.
    braces = pieces.groupBy("_file").agg((F.max("_size") - F.sum("_bytes") - F.count("*") + 1).alias("_more"))
    sound = (F.col("_last") == F.col("_all")) & F.col("_more").isin(0, 3)
    rows = whole.join(tails.join(braces, "_file"), "_file").select("_file", F.col("_ord").cast("long").alias("_ord"), F.when(sound, value).otherwise(bad).alias("value"))
    return rows.where("value <> ''")


def array_rows(spark: SparkSession, path: str) -> DataFrame:
    """_file, _ord and _row (a map of strings), as ``readers.json_rows`` gives them for small files."""
    row = F.coalesce(F.from_json("value", "map<string,string>"), F.raise_error(F.concat(F.lit("not JSON: "), "_file")))
    return elements(spark, path).select("_file", "_ord", row.alias("_row"))
