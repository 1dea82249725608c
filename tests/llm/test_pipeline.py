"""The pipeline against a plain version: SQL for the first stages, all pairs for near copies, the library for tokens."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import connect
from rollcall.llm import bpe, line_dedup, mixing, quality
from rollcall.session import BATCH_BYTES, BYTES_PER_BATCH, size_batches

from . import brute
from .helpers import SF


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_plain_version(spark, sql_over):
    rows = connect(SF).execute("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()
    kept = {r["doc_id"] for r in sql_over(quality.SQL, rows) if r["kept"]}
    rows = [r for r in rows if r[0] in kept]
    texts = {r["doc_id"]: r["t"] for r in sql_over(
        line_dedup.SQL.replace("sha256(coalesce(", "(coalesce(").replace("AS kept_sha256", "AS t"), rows)}
    rows = [(r[0], texts[r[0]], r[2], r[3], len(texts[r[0]])) for r in rows]
    rows = [r for r, found in zip(rows, brute.near(rows, 5, 80)) if found[3]]
    taken = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in sql_over(mixing.SQL, rows)}
    own, want = Tokenizer.from_file(bpe.word_bpe_path()), Counter()
    for doc_id, text, lang, source, _ in rows:
        ids = own.encode(text, add_special_tokens=False).ids
        want[doc_id, lang, source, len(ids), np.array(ids, "<u4").tobytes()] += taken[doc_id]
    got = Counter((r.doc_id, r.lang, r.source, r.n_tokens, bytes(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want and len(got) > 50


def test_stages_keep_the_columns_and_survive_odd_rows(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_workers_take_few_bytes_at_once(spark):
    """Batches of up to 64 MB made the workers and the JVM beside them grow from stage to stage."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    wide = spark.range(2000, numPartitions=1).select(F.lit("x" * 10_000).alias("text"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = spark.conf.get(BYTES_PER_BATCH)
    try:
        for stage in (corpus_pipeline.quality_rules, corpus_pipeline.encode_bpe):
            spark.conf.set(BYTES_PER_BATCH, "64m")
            stage(spark, docs, SF)
            found = [r.bytes for r in wide.mapInArrow(sizes, "bytes long").collect()]
            assert sum(found) >= 20_000_000 and max(found) < 1.1 * BATCH_BYTES
        spark.conf.set(BYTES_PER_BATCH, "100000")
        size_batches(spark)
        assert spark.conf.get(BYTES_PER_BATCH).rstrip("bB") == "100000"  # a session that asks for less keeps it
    finally:
        spark.conf.set(BYTES_PER_BATCH, before)


def test_clean_documents_stay(spark):
    """Documents labelled as good and long enough pass the quality stage."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, folder).select("doc_id").collect()}
    judged = {r.doc_id: r.base_failed for r in quality.judged(docs, {"doc_id": docs["doc_id"]}).collect()}
    good = connect(folder).execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()
    bad = connect(folder).execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()
    assert all(i in kept for (i,) in good if not judged[i])
    assert sum(i in kept for (i,) in bad) < 0.1 * len(bad)
