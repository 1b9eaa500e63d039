"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, html_text, licenses, mixing, near_dups, personal_data, quality, source_drift, token_counts,
    token_files, token_links, topk_search, web_archive,
)
from .shared import table
from .sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "tokenizer_path"]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_web_archive(spark: SparkSession, d: str) -> DataFrame:
    return web_archive.archive_and_read_back(table(spark, d, "pages"))


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = token_counts.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, d, "documents"), vocabulary)


def op3_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, d, "documents"))


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    verdicts = quality.quality_verdicts(table(spark, d, "documents"), table(spark, d, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", "base_failed", "kept")


def op5_main_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, d, "pages"))


def op6_token_planes(spark: SparkSession, d: str) -> DataFrame:
    return token_files.encode_and_read_back(table(spark, d, "documents"), tokenizer_path())


def op7_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, d, "documents"))


def op8_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, d, "documents"), table(spark, d, "benchmark")).drop("row_key")


def op9_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.license_scan(table(spark, d, "documents"))


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return source_drift.source_divergence(table(spark, d, "documents"))


def op12_topk_search(spark: SparkSession, d: str) -> DataFrame:
    return topk_search.top_k(table(spark, d, "embeddings"), F.col("vec_id") % topk_search.EVERY == 0)


def op13_token_links(spark: SparkSession, d: str) -> DataFrame:
    return token_links.token_links(
        table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_web_archive, op2_token_counts, op3_personal_data, op4_quality_rules, op5_main_text, op6_token_planes,
        op7_near_duplicates, op8_decontamination, op9_source_mix, op10_license_scan, op11_source_divergence,
        op12_topk_search, op13_token_links,
    )
}
