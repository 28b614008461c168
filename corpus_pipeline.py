"""From raw documents to packed training sequences, one stage after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads: all stages but the last
return the columns of ``documents`` they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import decontaminate, language, minhash, packing, substring
from tillstar.llm.common import stored, table
from tillstar.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go."""
    return language.with_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, on shingles of five words."""
    return minhash.without_near_duplicates(docs, shingle_words=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of later ones."""
    return substring.without_repeats(docs, stored(substring.repeats(docs), "repeats"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Learned, hashed and aligned stages cannot be said in SQL; tests/llm/test_pipeline.py replays them plainly.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
