"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat, exact_dedup, filter_audit, html_extract, minhash, mixing, quality_gbdt, quality_rules,
               secret_scan, source_divergence, substring, toxicity)
from .common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digests
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbdt.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.report(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_extract": op4_html_extract,
    "op5_minhash": op5_minhash,
    "op6_substring": op6_substring,
    "op7_chat": op7_chat,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_divergence": op11_divergence,
    "op12_filter_audit": op12_filter_audit,
    "op13_secret_scan": op13_secret_scan,
}

SQL: dict[str, str] = {
    "op5_minhash": minhash.REPORT_SQL,
    "op6_substring": substring.REPORT_SQL,
    "op7_chat": chat.REPORT_SQL,
    "op8_exact_dedup": exact_dedup.REPORT_SQL,
    "op11_divergence": source_divergence.REPORT_SQL,
    "op12_filter_audit": filter_audit.REPORT_SQL,
    "op13_secret_scan": secret_scan.REPORT_SQL,
}
