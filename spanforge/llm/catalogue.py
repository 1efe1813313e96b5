"""Queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanforge.llm import byte_bpe, conversation_repair, exact_dedup, importance, language, lm_scoring, media, mixing, near_dedup, quality_rules, toxicity, weak_quality, word_pieces


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": lm_scoring.op1_lm_scoring,
        "op2_weak_quality": weak_quality.op2_weak_quality,
        "op3_mix_sources": mixing.op3_mix_sources,
        "op4_quality_rules": quality_rules.op4_quality_rules,
        "op5_byte_bpe": byte_bpe.op5_byte_bpe,
        "op6_media": media.op6_media,
        "op7_near_dedup": near_dedup.op7_near_dedup,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_token_counts": word_pieces.op9_token_counts,
        "op10_language": language.op10_language,
        "op11_conversation_repair": conversation_repair.op11_conversation_repair,
        "op12_importance": importance.op12_importance,
        "op13_exact_dedup": exact_dedup.op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_importance": importance.ORACLE_SQL, "op13_exact_dedup": exact_dedup.ORACLE_SQL}
