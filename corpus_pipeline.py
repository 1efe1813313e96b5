"""A corpus from raw documents: clean, good, distinct, mixed to target weights, and encoded.

Each stage works on all that the one before has kept; all but the last return the columns of ``documents``.

Cases: a null or empty text has no toxic feature, fails the base rules of quality and goes there; rows without a label teach nothing, and without
labels the toxicity stage keeps all and the base rules alone decide; of rows equal in text one stays, that with the smallest id, null ids last; a null
source is a source of its own; what the mix takes several times is encoded as often; an empty table gives an empty result, as does a stage that leaves
nothing; extra columns pass through whatever their names, but for the text, which the last stage replaces by its digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanforge.llm import byte_bpe, mixing, near_dedup, quality_rules, toxicity
from spanforge.llm.common import stored, table

#: Learned stages have no counterpart in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or meet a learned rule go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, in place of the text."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
