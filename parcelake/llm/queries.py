"""Registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelake.llm import (
    decontaminate, hard_negatives, html_text, language, licenses, near_duplicates, packing, preference, quality,
    source_divergence, tables, token_files, tokens, url_rules, warc,
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_all(tables.read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(tables.read(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(tables.read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(tables.read(spark, sf_dir, "documents"),
                                       tables.read(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.scratch_path(spark, "token-files")
    token_files.write_ordered(tables.read(spark, sf_dir, "documents"), path,
                              tokens.vocabulary("word_bpe_49k.json"), "word", 2)
    return token_files.digests(spark, path)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tables.read(spark, sf_dir, "documents"),
                        tokens.vocabulary("byte_bpe_50k.json"), "byte", 1,
                        cache_pieces=token_files.CACHE_PIECES)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.scratch_path(spark, "warc")
    warc.write(tables.read(spark, sf_dir, "pages"), path)
    return warc.read(spark, path)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(tables.read(spark, sf_dir, "pages"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.join(tables.read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.relabelled(tables.read(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(hard_negatives.whole_numbers(rows), F.col("vec_id") % 100 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(tables.read(spark, sf_dir, "documents"))


def op13_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    return preference.score_all(docs, preference.fit(docs, tables.read(spark, sf_dir, "labels")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_token_files": op6_token_files,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_html_text": op9_html_text,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_quality_ranking": op13_quality_ranking,
}

ORACLES = {
    "op3_url_filter": url_rules.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_source_divergence": source_divergence.ORACLE,
}
