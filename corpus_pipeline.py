"""The corpus pipeline: stages over ``documents``, each written and read again as the next one's input.

Toxic documents go, then exact copies (the largest id stays), then near copies (the smallest id of each component stays),
then repeated byte strings are cut out of the texts that are left, and these are packed into sequences. All stages but
the last return the columns of ``documents``; a text that loses all its bytes stays as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.exact_dedup import without_copies
from stocktide.llm.packing import best_fit_packing
from stocktide.llm.simhash import without_near_copies
from stocktide.llm.suffix_dedup import without_repeated_strings
from stocktide.llm.toxicity import without_toxic
from stocktide.storage import discard, staged


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_strings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: SQL cannot express the learned and iterative stages; the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir))
        discard(before)  # the stage's result is stored; the first input is no staged table and stays
    return STAGES[-1][1](spark, docs, sf_dir)
