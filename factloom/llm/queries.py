"""The corpus operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, hard_negatives, html_text, near_dedup, packing, personal_data, quality, resampling, secrets, sentence_dedup, toxicity, url_filters
from .common import read_table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies; the files belong to the machine, not to this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, read_table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read_table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read_table(spark, sf_dir, "pages"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.expr("vec_id % 100 = 0"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scan(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_url_filters": op6_url_filters,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_html_extraction": op8_html_extraction,
    "op9_secret_scans": op9_secret_scans,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL: dict[str, str] = {"op6_url_filters": url_filters.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE}
