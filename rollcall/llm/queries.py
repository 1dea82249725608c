"""The operators as queries over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import alignment, bpe, exact_dedup, lattice, licenses, line_dedup, merkle, mixing, near_dedup
from rollcall.llm import ngram_quality, quality, toxicity, url_rules


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(_documents(spark, folder))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(_documents(spark, folder), bpe.word_bpe_path())


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return quality.judged(docs, {"doc_id": docs["doc_id"]})


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digests(_documents(spark, folder))


def op6_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score_texts(_documents(spark, folder), lattice.pieces_path())


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(_documents(spark, folder))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(_documents(spark, folder))


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = url_rules.bad_labels(spark.read.parquet(f"{folder}/labels.parquet"))
    judged = url_rules.judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_copies(_documents(spark, folder), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_digests(_documents(spark, folder), alignment.byte_bpe_path(),
                                       alignment.piece_bpe_path())


def op12_ngram_quality(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_quality.score_documents(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(_documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_bpe, op3_quality_rules, op4_toxicity, op5_license_scan, op6_lattice_lm, op7_exact_dedup,
        op8_line_dedup, op9_url_rules, op10_near_dedup, op11_token_alignment, op12_ngram_quality,
        op13_merkle_manifest)}

ORACLES: dict[str, str] = {
    "op1_mix_sources": mixing.SQL, "op3_quality_rules": quality.SQL, "op7_exact_dedup": exact_dedup.SQL,
    "op8_line_dedup": line_dedup.SQL, "op13_merkle_manifest": merkle.SQL}
