"""Training corpus from `documents`: language, quality, near duplicates, benchmark passages, packing.

STAGES are applied in order; each result is written as Parquet and read again for the next stage.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelake.llm import (
    decontaminate, language, near_duplicates, packing, quality, tables, tokens,
)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network knows (a letter, and a score of at least one half)."""
    return language.keep_known(docs, language.fit(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are probably good."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of `benchmark`."""
    return decontaminate.keep_clean(docs, tables.read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids as boundary records with their ids."""
    return packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"), "byte", 1, with_ids=True)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: A trained network, MinHash and alignment are not SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
