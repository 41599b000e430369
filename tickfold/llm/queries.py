"""The registered query of each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold.llm import alignment, divergence, html_text, licenses, lm_score, mixing, packing, quality_rules
from tickfold.llm import sharding, simhash, substring_dedup, warc
from tickfold.llm.common import table, text_or_empty
from tickfold.llm.exact_dedup import DigestIndex


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with DigestIndex(spark) as index:
        decided = index.add(table(spark, sf_dir, "documents"))
        return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.label(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return warc.with_payloads(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.document_size().alias("size"),
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"))
    return sharding.assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (
        op1_warc, op2_mixing, op3_licenses, op4_html_text, op5_exact_dedup, op6_lm_score, op7_packing,
        op8_substring_dedup, op9_simhash, op10_quality_rules, op11_sharding, op12_divergence, op13_alignment)}
