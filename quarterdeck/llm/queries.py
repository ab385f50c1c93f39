"""Registered queries of the corpus operators: name -> (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import (
    classifier,
    conversations,
    decontamination,
    licenses,
    lm,
    mixing,
    packing,
    quality_rules,
    secrets,
    sharding,
    simhash,
    url_rules,
    whitening,
)
from quarterdeck.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_pages(table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op11_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_sharding": (op1_sharding, None),
    "op2_quality_rules": (op2_quality_rules, quality_rules.SQL),
    "op3_secret_scans": (op3_secret_scans, None),
    "op4_simhash_near_dedup": (op4_simhash_near_dedup, None),
    "op5_url_filters": (op5_url_filters, url_rules.SQL),
    "op6_best_fit_packing": (op6_best_fit_packing, None),
    "op7_quality_classifier": (op7_quality_classifier, None),
    "op8_benchmark_decontamination": (op8_benchmark_decontamination, None),
    "op9_license_scans": (op9_license_scans, None),
    "op10_lm_scoring": (op10_lm_scoring, None),
    "op11_conversation_structure_repair": (op11_conversation_structure_repair, None),
    "op12_embedding_whitening": (op12_embedding_whitening, None),
    "op13_mixing": (op13_mixing, None),
}
