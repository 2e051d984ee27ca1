"""Queries of this subpackage and the checking SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm import (
    align,
    byte_bpe,
    chat,
    exact_dedup,
    language,
    lattice,
    negatives,
    packing,
    quality,
    simhash,
    suffix_dedup,
    tokens,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": tokens.op1_token_counts,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_language": language.op4_language,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_simhash": simhash.op8_simhash,
    "op9_chat_format": chat.op9_chat_format,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_align": align.op11_align,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_lattice": lattice.op13_lattice,
}
SQL: dict[str, str] = {"op9_chat_format": chat.OP9_SQL, "op10_exact_dedup": exact_dedup.OP10_SQL, "op12_hard_negatives": negatives.OP12_SQL}
