"""One query per operator, and the pipeline; each reads the supplied tables whole."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from telcolake.llm import alignment, decontaminate, host_rules, jaccard_join, line_dedup, merkle, oracle, packing, quality, secret_scan, token_files, toxicity, url_filter, warc
from telcolake.llm.common import fresh_path, remove, table


def op1_secret_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.sha2(secret_scan.span_list(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base.alias("base_sha256"), secret_scan.span_list(F.col("spans")).alias("spans"))


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    rows = warc.page_digests(spark, path)
    remove(spark, path)
    return rows


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


def op5_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = line_dedup.drop_lines(docs)
    return lines.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


def op6_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "evidence", "site_rate", "posterior", "kept")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")


def op8_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_sets(table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read_token_files(spark, path, keep_ids=False)
    remove(spark, path)
    return rows


def op11_merkle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaves = merkle.manifest(docs, also=merkle.tampered(docs))
    folded = merkle.fold(F.col("tampered_leaf"), F.col("path"))
    rows = leaves.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_exact_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = alignment.alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", *alignment.MEASURES)


def op13_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_tests": op1_secret_tests,
    "op7_host_rules": op7_host_rules,
    "op8_string_kernel": op8_string_kernel,
    "op9_jaccard_join": op9_jaccard_join,
    "op3_positional_index": op3_positional_index,
    "op6_empirical_bayes": op6_empirical_bayes,
    "pipeline": corpus_pipeline.run,
    "op2_warc_transactions": op2_warc_transactions,
    "op5_line_bitmaps": op5_line_bitmaps,
    "op4_mixture_packing": op4_mixture_packing,
    "op10_token_files": op10_token_files,
    "op11_merkle_windows": op11_merkle_windows,
    "op12_exact_text_alignment": op12_exact_text_alignment,
    "op13_boosted_urls": op13_boosted_urls,
}

ORACLE: dict[str, str] = dict(oracle.SQL)
