"""Documents to tokens: quality rules, line dedup, near-dedup, mixing of sources, BPE.

Each stage reads what the stage before kept, from Parquet in the shared folder, and all but the last return the
columns of documents. Stages that run Python bound the session's batches, so that workers hold little beside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import bpe, line_dedup, mixing, near_dedup, quality
from rollcall.session import size_batches
from rollcall.sources import Store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    size_batches(spark)
    return quality.kept_documents(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep; n_chars follows."""
    cleaned = line_dedup.clean_lines(docs.select("doc_id", "text", F.struct("*").alias("row")))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cleaned.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles and a similarity of 0.8."""
    size_batches(spark)
    return near_dedup.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids as little-endian unsigned 32-bit integers."""
    size_batches(spark)
    return bpe.encode(docs, bpe.word_bpe_path(), keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", drop_shared_lines), ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources), ("bpe", encode_bpe)]

#: The tokenizer of the last stage is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = spark.read.parquet(f"{sf_dir}/documents.parquet"), Store(spark, "corpus_pipeline")
    for name, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
