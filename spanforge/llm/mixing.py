"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets an exponential key: ``-ln(u) / quality``, ``u`` a hash of its id and text. Sorted
by that key, a prefix of a source is a weighted sample without replacement. A source whose target is
above its size first gives complete epochs; the rest is the prefix whose words come nearest to what is
missing. The place where the prefix ends is found from sums, by coarse buckets of the key, fine ones, the key itself and, as
repeated rows share a key, by buckets of a hash of their number in the stored table. So no task ever sorts a source or a
group of copies, however large it is.

Cases: a null or empty text has size 0 and takes 0 words; a null source is a source of its own, ordered
last; a null id is hashed as null; rows equal in id and text share a key, and as many of them are chosen as come nearest to the
target; an empty table gives an empty result. Extra columns pass through whatever their names; ``mix`` replaces those named as its
results, ``repeated`` gives all columns back as they were. Sources are named: the two windows that set their targets and order
them run over one row for each source in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanforge.llm.common import WORD, packed, stored, table, unpacked

#: Key buckets to a unit of ln(key), parts of each bucket that holds the end of a prefix, and parts of the rows of one key.
COARSE, FINE, SALTS = 64, 4096, 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """A weight from 0.05 to 1 that falls with the share of symbols in the text."""
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>{}=@\\^~]"))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 5 * share), F.lit(1.0))


def exponential_key(seed: int, weight: Column, *columns: Column) -> Column:
    """ln of an exponential variate divided by the weight; the smallest come first."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    uniform = (bits.cast("double") + 0.5) / float(2**53)
    return F.log(-F.log(uniform)) - F.log(weight)


def targets(sizes: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """Words that each source shall give. ``sizes``: source, source_size; one row a source.

    Shares by weight, none above ``most`` times its size: the level at which the capped shares add up to
    the whole is the highest of the levels that follow when sources are capped in order of cap / weight.
    The windows run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    capped = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) - before) / rest
    return (
        capped.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def _end_bucket(sums: DataFrame, bucket: str) -> DataFrame:
    """Of sums by source and bucket, the bucket in which each source's prefix ends; what is still needed
    there replaces ``need``. Sources that need more than they have end after their last bucket."""
    order = Window.partitionBy("source").orderBy(bucket)
    before = F.sum("words").over(order) - F.col("words")
    return (
        sums.withColumn("before", before)
        .where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("words")))
        .select("source", bucket, (F.col("need") - F.col("before")).alias("need"))
    )


def mixed(
    docs: DataFrame,
    *,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = (5, 2, 1),
    most: float = 3,
    quality: Column | None = None,
    seed: int = 20011,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` in the struct ``_own``, with size, source_size, target, copies and taken."""
    body, named = F.col(f"`{text}`"), F.col(f"`{source}`").cast("string")
    weight = text_quality(body) if quality is None else quality
    key = exponential_key(seed, weight, F.col(f"`{doc_id}`"), body)
    rows = packed(docs, named.alias("source"), key.alias("key"), n_words(body).alias("words"))
    if not keep_text:
        rows = rows.withColumn("_own", F.col("_own").dropFields(f"`{text}`"))
    # The number of a row is stored with it: copies of a row are told apart by it, here and in what follows.
    rows = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "mix-rows")
    salt = F.pmod(F.xxhash64(F.lit(seed), "tie"), F.lit(SALTS))
    position = F.col("key") * COARSE
    keyed = rows.drop("_own").withColumns({"bucket": F.floor(position), "part": F.floor((position - F.floor(position)) * FINE), "salt": salt})
    wanted = targets(keyed.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    wanted = stored(
        wanted.withColumn("epochs", epochs).withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size")),
        "mix-targets",
    )

    def with_source(rows: DataFrame, small: DataFrame, *also: str) -> DataFrame:
        named = small.withColumnsRenamed({c: f"_{c}" for c in ("source", *also)})
        on = rows["source"].eqNullSafe(named["_source"])
        for c in also:
            on = on & (rows[c] == named[f"_{c}"])
        return rows.join(named, on).drop("_source", *(f"_{c}" for c in also))

    ends, near = wanted.select("source", "need"), keyed
    for level in ("bucket", "part", "key", "salt"):
        sums = near.groupBy("source", level).agg(F.sum("words").alias("words"))
        ends = stored(_end_bucket(with_source(sums, ends.select("source", "need")), level), f"mix-end-{level}")
        near = stored(with_source(near, ends.select("source", level), level), f"mix-near-{level}")
    order = Window.partitionBy("source").orderBy("tie")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words") / 2
    last = with_source(near, ends.select("source", "need")).withColumn("near", before <= F.col("need"))
    # Where nothing of the last rows is near, the prefix ends just before them.
    cuts = last.groupBy("source").agg(
        F.first("key").alias("_cut"), F.first("salt").alias("_cut_salt"), F.coalesce(F.max(F.when(F.col("near"), F.col("tie"))), F.lit(-1)).alias("_cut_tie")
    )
    cuts = stored(
        wanted.join(cuts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").select(
            F.col("source").alias("_source"), "source_size", "target", F.col("epochs").cast("int").alias("_epochs"), "_cut", "_cut_salt", "_cut_tie"
        ),
        "mix-cuts",
    )
    in_ties = (salt < F.col("_cut_salt")) | (salt == F.col("_cut_salt")) & (F.col("tie") <= F.col("_cut_tie"))
    chosen = F.coalesce(((F.col("key") < F.col("_cut")) | (F.col("key") == F.col("_cut")) & in_ties).cast("int"), F.lit(0))
    taken = rows.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).withColumn("copies", F.col("_epochs") + chosen).withColumnRenamed("words", "size")
    return taken.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs``, without their text if not ``keep_text``, with size, source_size, target, copies (how often the mix repeats a
    document) and taken (copies times size). Options: those of ``mixed``."""
    columns = [c for c in docs.columns if options.get("keep_text", True) or c != options.get("text", "text")]
    return unpacked(mixed(docs, **options), columns, "size", "source_size", "target", "copies", "taken")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, in the columns of ``docs``."""
    chosen = mixed(docs, **options).where("copies > 0").select("_own", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return unpacked(chosen, docs.columns)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken", "copies")
