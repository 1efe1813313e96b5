"""Importance resampling towards a target distribution, with weights summed over bit slices.

Features are runs of words, hashed into ``BUCKETS`` buckets. A bucket's gain says by how much the target texts prefer it
to the corpus; a document's weight is the floored mean of its features' gains. Instead of looking up a gain for every feature, the
counts of a document become planes of ``BUCKETS`` bits, one for each power of two, and so do the gains, in two's complement.
Each pair of planes is ANDed, its bits are counted, and the counts, scaled by the product of both powers, add up to the exact sum:
the plane of the sign counts as a negative power. Documents with the highest sums of weight and Gumbel noise are drawn.

Cases: a null or empty text has no features and weight 0; a text shorter than ``least`` words is never drawn; a null id is hashed as
an empty one and comes last among equal scores; rows equal in id and text have equal scores, and each of them has a rank of its own; an
empty table gives an empty result; an empty target leaves gains by the corpus alone. Extra columns pass through whatever their names, but
for those named as the results.

Scale: one scan cuts texts into buckets and stores these; corpus counts combine before their shuffle and end as ``BUCKETS``
rows. Only rows that may be drawn are shuffled again, by range, so ranks need neither one task nor a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm.common import packed, stored, table, unpacked

BUCKETS = 10_000
#: Everything in ASCII but digits and letters separates words; all other characters belong to them.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Documents whose planes are in memory at once.
BLOCK = 64


def words(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))
    return F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(WORD), F.lit(0))


def feature_buckets(found: Column, longest: int, buckets: int) -> Column:
    """The bucket of every run of 1 to ``longest`` words, repeats included."""
    def bucket(feature: Column) -> Column:
        return (F.crc32(feature.cast("binary")) % buckets).cast("int")

    runs, run = [F.transform(found, bucket)], found
    for n in range(2, longest + 1):
        # Whole arrays beside each other: a word looked up by its place in a lambda would cut the text again for each place.
        left = F.greatest(F.size(found) - (n - 1), F.lit(0))
        run = F.zip_with(F.slice(run, 1, left), F.slice(found, n, left), lambda a, b: F.concat_ws(" ", a, b))
        runs.append(F.transform(run, bucket))
    return F.concat(*runs)


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """1000 times the logarithm of how much likelier a bucket is in the target, counts raised by one, floored."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    return np.array(
        [math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + buckets) / ((corpus.get(b, 0) + 1) * (t_all + buckets)))) for b in range(buckets)], np.int64
    )


def _plane(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed_bits = np.packbits(bits, axis=-1)
    short = -packed_bits.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed_bits, [(0, 0)] * (packed_bits.ndim - 1) + [(0, short)])).view(np.uint64)


def gain_planes(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Planes of ``values`` in two's complement, each with its power of two; that of the sign is negative."""
    width = max(int(np.abs(values).max(initial=0)).bit_length(), 1)
    return [(1 << j, _plane((values >> j) & 1 == 1)) for j in range(width)] + [(-(1 << width), _plane(values < 0))]


def sliced_sums(offsets: np.ndarray, found: np.ndarray, planes: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """For each document, the sum of gains over its buckets ``found[offsets[i]:offsets[i + 1]]``."""
    sums = np.zeros(len(offsets) - 1, np.int64)
    for at in range(0, len(sums), BLOCK):
        ends = offsets[at : at + BLOCK + 1]
        n = len(ends) - 1
        place = np.repeat(np.arange(n, dtype=np.int64) * buckets, np.diff(ends)) + found[ends[0] : ends[-1]]
        counts = np.bincount(place, minlength=n * buckets).reshape(n, buckets).astype(np.uint32)
        for k in range(int(counts.max(initial=0)).bit_length()):
            bits = counts & np.uint32(1 << k) != 0
            some = np.flatnonzero(bits.any(axis=1))
            plane = _plane(bits[some])
            for power, gain in planes:
                sums[at + some] += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (power << k)
    return sums


def _counts(rows: DataFrame) -> dict[int, int]:
    """Features by bucket; no more rows than there are buckets."""
    return {r.bucket: r.n for r in rows.select(F.explode("_buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect()}


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate made of a hash of the id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame, *, text: str = "text", longest: int = 1, buckets: int = BUCKETS, keep_text: bool = True) -> DataFrame:
    """``docs`` in the struct ``_own``, with n_features, weight and _words, the number of words."""
    def cut(rows: DataFrame) -> DataFrame:
        found = packed(rows, words(F.col(f"`{text}`").cast("string")).alias("_found"))
        return found if keep_text else found.withColumn("_own", F.col("_own").dropFields(f"`{text}`") if len(rows.columns) > 1 else F.struct(F.lit(0).alias("_none")))

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_words": F.size("_found"), "_buckets": feature_buckets(F.col("_found"), longest, buckets)}).drop("_found")

    corpus = stored(bucketed(cut(docs)), "importance-buckets")
    planes = gain_planes(gains(_counts(corpus), _counts(bucketed(cut(target))), buckets))
    out = T.StructType([corpus.schema["_own"], T.StructField("_words", T.IntegerType()), T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_buckets")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            n = np.diff(offsets)
            sums = sliced_sums(offsets, lists.values.to_numpy(), planes, buckets)
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("_own"), batch.column("_words"), pa.array(n), pa.array(weight)], names=out.names)

    return corpus.mapInArrow(weigh, out)


def resample(
    docs: DataFrame, target: DataFrame, *, text: str = "text", doc_id: str = "doc_id", longest: int = 1, buckets: int = BUCKETS, least: int = 20, percent: int = 10,
    seed: int = 2024, keep_text: bool = True,
) -> DataFrame:
    """``docs``, without their text if not ``keep_text``, with n_features, weight, score and rank: 1, 2, 3 ... among the
    ``percent`` of the texts of ``least`` words that have the highest scores, null for all others."""
    found = weighted(docs, target, text=text, longest=longest, buckets=buckets, keep_text=keep_text)
    columns = [c for c in docs.columns if keep_text or c != text]
    named = F.col(f"_own.`{doc_id}`")
    scored = found.select("_own", "_words", "n_features", "weight", (F.col("weight") + noise(named, seed)).alias("score"))
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    scored = scored.withColumn("_may", F.col("_words") >= least)
    # Scores are whole numbers between bounds set by the gains and the noise, so there are some 100,000 different ones at most.
    levels = scored.where("_may").groupBy("score").agg(F.count("*").alias("n"))
    draw = (levels.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n * percent) // 100
    above = F.sum("n").over(Window.orderBy(F.col("score").desc()))
    cut = levels.withColumn("above", above).where(F.col("above") >= draw).agg(F.max("score").alias("cut")).first().cut
    results = ["n_features", "weight", "score", "rank"]
    if not draw:
        return unpacked(scored.withColumn("rank", F.lit(None).cast("long")), columns, *results)
    near = F.col("_may") & (F.col("score") >= cut)
    order = [F.col("score").desc(), named.asc_nulls_last(), F.col("_row").asc()]
    drawn = scored.where(near).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    drawn = stored(drawn.withColumn("_part", F.shiftright("_at", 33)), "importance-drawn")
    # One row for each partition of the table just stored.
    parts = drawn.groupBy("_part").agg(F.count("*").alias("n"))
    parts = parts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranks = drawn.join(F.broadcast(parts), "_part").withColumn("rank", F.when(place <= draw, place))
    rest = scored.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return unpacked(ranks.select("_own", *results).unionByName(rest.select("_own", *results)), columns, *results)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"), keep_text=False).select("doc_id", "n_features", "weight", "score", "rank")


#: The checksum of a word by the table of its 256 remainders, in DuckDB.
ORACLE_SQL = """
WITH remainders AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
), words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM documents
), goals AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM benchmark
), hashed AS (
  SELECT w, xor(list_reduce([4294967295] || list_transform(range(0, octet_length(encode(w))), lambda k: ('0x' || substr(hex(encode(w)), (2 * k + 1)::INT, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM words UNION SELECT w FROM goals), remainders
), corpus AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (w) GROUP BY bucket
), target AS (SELECT bucket, count(*) AS t FROM goals JOIN hashed USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM corpus) + 10000) / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM target) + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket)
), weights AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS w FROM words JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(w, 0)::BIGINT AS weight,
    coalesce(w, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= (10 * n) // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""
