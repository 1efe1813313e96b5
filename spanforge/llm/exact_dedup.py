"""Exact duplicates by an extendible-hash index on shared files, in DataFrame operations only.

Every text is normalised (A-Z lower-cased, null as empty) and gets a 64-bit key. The index holds one record for each key and digest:
how many rows have them, and the last of these rows. A directory of ``2**depth`` entries, addressed by the first bits of the key,
says in which bucket a record lies. A bucket with more than its capacity is split by one more bit, and where that bucket had but
one entry of the directory, the directory doubles. Owner tasks get ranges of buckets, chain the records of one key, and write them
in order. Then the texts of all keys that more than one row has are read again and compared byte by byte: grouped by key, digest and text, so
that copies combine before they are shuffled. Records that turn out to hold different texts leave the index, and their rows are grouped
by the texts themselves.

Cases: a null text equals an empty one; the row with the largest id stays, a null id is smaller than any other; of rows equal in id and
text the last one of the stored table stays, so exactly one row of each group is kept; an empty table gives an empty result. Extra columns
pass through whatever their names, but for those named as the results.

Scale: only keys, digests and ids are shuffled for all rows, texts only for keys that repeat, found by a bitmap of at most ``2**(BITS - 6)``
rows that is broadcast; where it fills up, it lets more texts through and nothing is lost. A group of at least a thousandth of all rows
is looked up in a broadcast list, of which there are a thousand at most; all others are joined by key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanforge.llm.common import packed, stored, table, unpacked

#: Bits of the map of repeated keys, as a power of two.
BITS = 26
#: Records of a bucket, and buckets at most where records are spread evenly: beyond them the capacity grows instead.
CAPACITY, BUCKETS = 65_536, 16_384
#: The directory doubles so often at most; a bucket that is overfull then has long chains.
MOST_DEPTH = 20
#: A group of a share of 1 / HOT of all rows or more is joined by broadcast.
HOT = 1000


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty. Where all is ASCII, the quick ``lower`` does the same."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(body) == F.octet_length(body), F.lower(body)).otherwise(F.translate(body, upper, lower))


def _key(text: Column, bits: int) -> Column:
    """A hash of which the first ``bits`` bits count."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - bits), 64 - bits)


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("_key", 64 - depth) if depth else F.lit(0).cast("long")


def directory(records: DataFrame, capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """The depth of the directory, and its buckets as (depth, prefix), in order of their keys.

    It begins as large as evenly spread records need. Each round counts the records of the buckets that were split.
    """
    spark, total = records.sparkSession, records.count()
    capacity = max(capacity, total // BUCKETS)
    depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(total, 1) / capacity))))
    counted = {r.prefix: r.n for r in records.groupBy(_prefix(depth).alias("prefix")).agg(F.count("*").alias("n")).collect()}
    buckets = []
    open_ = {p: counted.get(p, 0) for p in range(1 << depth)}
    while open_:
        over = [p for p, n in open_.items() if n > capacity and depth < MOST_DEPTH]
        buckets += [(depth, p) for p in open_ if p not in set(over)]
        if not over:
            break
        split = spark.createDataFrame([(p,) for p in over], "prefix long")
        depth += 1
        halves = records.join(F.broadcast(split), _prefix(depth - 1) == F.col("prefix"), "left_semi").groupBy(_prefix(depth).alias("prefix"))
        counted = {r.prefix: r.n for r in halves.agg(F.count("*").alias("n")).collect()}
        open_ = {2 * p + b: counted.get(2 * p + b, 0) for p in over for b in (0, 1)}
    return max(d for d, _ in buckets), sorted(buckets, key=lambda x: x[1] / (1 << x[0]))


def build_index(entries: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """One record for each key and digest of ``entries`` (_key, _digest, _id, _row), with rows n, the last row (_id, _row), the
    bucket, and its place in the chain of the key; stored by ranges of buckets, in order of key and place."""
    combined = entries.groupBy("_key", "_digest").agg(F.count("*").alias("n"), F.max(F.struct("_id", "_row")).alias("last"))
    records = stored(combined, "exact-records")
    depth, buckets = directory(records, capacity)
    rows = [(i, p << (depth - d), ((p + 1) << (depth - d)) - 1) for i, (d, p) in enumerate(buckets)]
    listed = records.sparkSession.createDataFrame(rows, "_bucket int, first long, last_entry long")
    places = listed.select("_bucket", F.explode(F.sequence("first", "last_entry")).alias("_entry"))
    found = records.join(F.broadcast(places), _prefix(depth) == F.col("_entry")).drop("_entry")
    owned = found.repartitionByRange(F.col("_bucket"))
    place = F.row_number().over(Window.partitionBy("_bucket", "_key").orderBy("_digest"))
    return stored(owned.withColumn("_place", place).sortWithinPartitions("_bucket", "_key", "_place"), "exact-index")


def _bit_of(bits: int) -> tuple[Column, Column]:
    """The word of the map and the bit in it that stand for a key."""
    place = F.shiftrightunsigned("_key", 64 - bits)
    return F.shiftrightunsigned(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def _repeated(index: DataFrame, bits: int) -> DataFrame:
    """The map of keys that more than one row has: _word, _bits. As many rows as it has words, at most."""
    word, bit = _bit_of(bits)
    several = index.groupBy("_key").agg(F.sum("n").alias("n")).where("n > 1")
    return several.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def groups(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True, capacity: int = CAPACITY, bits: int = BITS, key_bits: int = 64, digest_chars: int = 64
) -> DataFrame:
    """``docs``, without their text if not ``keep_text``, with keep_id (the id of the row of the group that stays), group_size, kept
    (one row of each group) and text_sha256 (of the normalised text).

    ``key_bits`` and ``digest_chars`` shorten the key and the digest, so that tests can make them collide.
    """
    columns = [c for c in docs.columns if keep_text or c != text]
    results = ["keep_id", "group_size", "kept", "text_sha256"]
    body, digest = normalised(F.col(f"`{text}`")), F.substring("_sha", 1, digest_chars) if digest_chars < 64 else F.col("_sha")
    rows = packed(docs, F.col(f"`{doc_id}`").alias("_id"), body.alias("_text"))
    if not keep_text:
        rows = rows.withColumn("_own", F.col("_own").dropFields(f"`{text}`") if len(docs.columns) > 1 else F.struct(F.lit(0).alias("_none")))
    rows = rows.withColumns({"_key": _key(F.col("_text"), key_bits), "_sha": F.sha2(F.col("_text").cast("binary"), 256)}).withColumn("_digest", digest)
    entries = stored(rows.drop("_text", "_digest").withColumn("_row", F.monotonically_increasing_id()), "exact-entries").withColumn("_digest", digest)
    index = build_index(entries, capacity=capacity)
    word, bit = _bit_of(bits)
    repeated = F.broadcast(stored(_repeated(index, bits), "exact-map"))

    # Bytes are compared: each key and digest, by the texts that it stands for.
    again = rows.select("_key", "_digest", "_text", word.alias("_word")).join(repeated, "_word").where(F.getbit("_bits", bit) == 1)
    texts = again.groupBy("_key", "_digest", "_text").agg(F.lit(1).alias("one")).groupBy("_key", "_digest").agg(F.count("*").alias("texts"))
    mixed = stored(texts.where("texts > 1").select("_key", "_digest"), "exact-collisions")

    parts = []
    if not mixed.isEmpty():
        parts.append(_by_text(rows, mixed))
        entries, index = (x.join(mixed, ["_key", "_digest"], "left_anti") for x in (entries, index))
    groups_ = index.where("n > 1").select("_key", "_digest", "n", "last")
    share = F.lit(entries.count() / HOT)
    hot = groups_.where(F.col("n") >= share)
    maybe = entries.withColumn("_word", word).join(repeated, "_word", "left").withColumn("_maybe", F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False)))
    maybe = maybe.join(F.broadcast(hot), ["_key", "_digest"], "left")
    done = maybe.where(~F.col("_maybe") | F.col("n").isNotNull())
    rest = maybe.where(F.col("_maybe") & F.col("n").isNull()).drop("n", "last").join(groups_.where(F.col("n") < share), ["_key", "_digest"], "left")
    for found in (done, rest):
        parts.append(found.select(
            "_own", F.when(F.col("n").isNull(), F.col("_id")).otherwise(F.col("last._id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("last._row") == F.col("_row"), F.lit(True)).alias("kept"), F.col("_sha").alias("text_sha256"),
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return unpacked(whole, columns, *results)


def _by_text(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of records that hold different texts, grouped by the texts themselves."""
    own = stored(rows.join(mixed, ["_key", "_digest"], "left_semi").select("_own", "_id", "_text", "_sha").withColumn("_row", F.monotonically_increasing_id()), "exact-mixed")
    last = own.groupBy("_text").agg(F.count("*").alias("group_size"), F.max(F.struct("_id", "_row")).alias("last"))
    found = own.join(last, "_text")
    return found.select("_own", F.col("last._id").alias("keep_id"), "group_size", (F.col("last._row") == F.col("_row")).alias("kept"), F.col("_sha").alias("text_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return groups(docs, keep_text=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY t)
"""
