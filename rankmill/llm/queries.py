"""The registered queries: each operator over its whole table, with the digests of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.llm import (
    decontam,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    pii,
    quality,
    quality_model,
    secret_scan,
    simhash,
    substring_dedup,
    token_alignment,
    warc,
)
from rankmill.llm.common import ROW, documents, sha256, span_text


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate_lines(documents(spark, sf_dir)).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256")
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir)).select(
        "doc_id",
        *[f"n_{kind}" for kind in pii.KINDS],
        sha256(span_text(F.col("base"))).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256")
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", sha256(F.col("base")).alias("base_sha256"), "spans"
    )


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(documents(spark, sf_dir)).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines_removed",
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.scaled_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return hard_negatives.mine_hard_negatives(hard_negatives.moved_labels(vectors), F.col("id") % 100 == 0)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(documents(spark, sf_dir), token_alignment.Vocabularies.read())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_license_scan,
        op3_pii,
        op4_substring_dedup,
        op5_secret_scan,
        op6_source_mix,
        op7_decontamination,
        op8_warc,
        op9_quality_rules,
        op10_simhash,
        op11_hard_negatives,
        op12_quality_classifier,
        op13_tokenizer_alignment,
    )
}
