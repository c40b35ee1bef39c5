"""The dealt operators as queries over the given tables: opN_<name>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gradewell.llm import (
    decontamination, fill_middle, licenses, near_dup, packing, quality, resampling, secret_scan, token_counts, toxicity,
    url_filter, vector_dup, warc,
)
from gradewell.llm.common import table


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("matches")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secret_scan.written(secret_scan.base_only(F.col("spans"))), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


#: What the counted edits take out: long numbers, and runs of marks.
EDITED = r"[0-9]{6,}|[#*$%&]{3}"


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.apply_edits(docs, token_counts.Masking(EDITED), with_texts=False).drop("text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.vote_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


def op11_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resampling.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_curve_packing, op2_license_scan, op3_decontamination, op4_url_filter, op5_superminhash, op6_secret_scan,
        op7_token_counts, op8_toxicity, op9_quality_votes, op10_warc, op11_rotated_codes, op12_resampling, op13_fill_middle,
    )
}
