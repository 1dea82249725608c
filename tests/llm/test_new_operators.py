"""Token alignment, the n-gram classifier and the Merkle manifest, against plain versions and on odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import connect
from rollcall.llm import alignment, merkle, ngram_quality
from rollcall.sources import Store

from . import brute
from .helpers import SCHEMA, SF, prose, table

POOL = "abcXYZ ΣςİıßéÉñ́ \t\n\x0b\x85\xa0 ²½٣漢字カ🙂‍'sS12.!?ﬁ​﻿\x00~_-▁<>|"


# --- alignment

@pytest.fixture(scope="module")
def encoders():
    """Both libraries, each token with its bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(alignment.byte_bpe_path())
    own.encode_special_tokens = True
    first, second = alignment.sides(alignment.byte_bpe_path(), alignment.piece_bpe_path())
    pieces = sentencepiece.SentencePieceProcessor(model_file=alignment.piece_bpe_path())
    return (lambda t: [(i, first.strings[i]) for i in own.encode(" " + t, add_special_tokens=False).ids],
            lambda t: [(i, second.strings[i]) for i in pieces.encode(t)])


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def digests(df):
    return table(alignment.alignment_digests(df, alignment.byte_bpe_path(), alignment.piece_bpe_path()), *COLUMNS)


def test_alignment_on_the_given_table(spark, encoders):
    rows = connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    got = entry.queries()["op11_token_alignment"](spark, SF)
    assert table(got, *COLUMNS) == sorted(brute.aligned(rows, *encoders), key=repr)


def test_alignment_on_odd_rows(odd, odd_rows, empty, encoders):
    assert digests(odd) == sorted(brute.aligned(odd_rows, *encoders), key=repr)
    assert digests(empty) == []


def test_specials_marks_and_rewritten_characters(spark, encoders):
    texts = ["<|endoftext|> and <s> </s> <unk>", "a ▁ mark", "<0x41> A", "ﬁ ½", " leading", "trailing ", "\n", "x"]
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate(texts)]
    got = digests(spark.createDataFrame(rows, SCHEMA))
    assert got == sorted(brute.aligned(rows, *encoders), key=repr)
    assert next(r for r in got if r[0] == 1)[1:] == (0, 0, 0, 0, 0, 0, "")
    assert next(r for r in got if r[0] == 0)[1] > 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(POOL, max_size=25), min_size=1, max_size=5))
def test_chunks_equal_the_libraries(encoders, texts):
    first, second = alignment.sides(alignment.byte_bpe_path(), alignment.piece_bpe_path())
    rows, links = alignment.aligned_chunk(first, second, texts)
    want = brute.aligned([(None, t) for t in texts], *encoders)
    assert [(*r[:4], r[4]) for r in rows] == [(*w[1:5], w[7]) for w in want]
    assert list(map(len, links)) == [w[4] for w in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=8), st.randoms()), min_size=1, max_size=4))
def test_overlaps_equal_all_pairs(documents):
    """Both sides of a document have as many bytes; the second is cut at random."""
    frames = []
    for side in range(2):
        doc, lengths = [], []
        for k, (cuts, draw) in enumerate(documents):
            left = sum(cuts)
            own = cuts if side == 0 else []
            while side and left:
                own.append(draw.randint(1, left))
                left -= own[-1]
            doc += [k] * len(own)
            lengths += own
        ends = np.cumsum(lengths)
        frames.append(pd.DataFrame({"doc": doc, "start": ends - lengths, "end": ends, "number": range(len(doc))}))
    a, b = frames
    want = {(i, j) for i in range(len(a)) for j in range(len(b))
            if a.start[i] < b.end[j] and b.start[j] < a.end[i]}
    got = alignment.overlaps(a, b)
    assert len(got) == len(want) and set(zip(got.a, got.b)) == want


def test_groups_are_written_without_python_steps_per_token(encoders, monkeypatch):
    """Ids are looked up, compared and written for a whole chunk at once; a text that fails leaves the others whole."""
    first, second = alignment.sides(alignment.byte_bpe_path(), alignment.piece_bpe_path())
    texts = [prose(4000, 1), "", "ﬁ ½", prose(4000, 2), "a ▁ mark", "one"]
    want = brute.aligned([(None, t) for t in texts], *encoders)
    seen = []

    class Counted(list):
        def __getitem__(self, at):
            seen.append(at)
            return super().__getitem__(at)

    for side in (first, second):
        for name, value in list(vars(side).items()):
            if isinstance(value, list):
                monkeypatch.setattr(side, name, Counted(value))
    rows, links = alignment.aligned_chunk(first, second, texts)
    assert [(*r[:4], r[4]) for r in rows] == [(*w[1:5], w[7]) for w in want]
    assert list(map(len, links)) == [w[4] for w in want] and not seen


def test_pair_counts_read_the_aligned_rows_once(spark):
    aligned = spark.createDataFrame([([1, 1, 11],), ([21, 2],), ([12, 12],)], "links array<int>")
    found = alignment.pair_counts(aligned, 10)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    assert table(found, "link", "count", "best") == sorted(
        [(1, 2, True), (11, 1, False), (21, 1, False), (2, 1, False), (12, 2, True)], key=repr)


def test_a_long_text_is_a_chunk_of_its_own(spark):
    docs = spark.createDataFrame([(1, "ab " * 200_000), (2, "one"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.align(docs, alignment.byte_bpe_path(), alignment.piece_bpe_path()).collect()}
    assert got[1].n_groups > 100_000 and len(got[1].links) == got[1].n_links
    assert got[2].n_a and not got[3].n_a


# --- n-gram classifier

@settings(max_examples=200, deadline=None)
@given(st.text("ab Ü!%\n\x00", max_size=30))
def test_ngrams_equal_counting(text):
    slots, counts = ngram_quality.ngrams(text.encode())
    want = brute.gram_slots(text.encode(), ngram_quality.BITS)
    assert dict(zip(slots.tolist(), counts.tolist())) == want
    assert ngram_quality.values(counts).tolist() == pytest.approx(
        [brute.gram_values(want)[s] for s in slots.tolist()])


def test_updates_equal_the_textbook():
    texts = [prose(30, k).encode() + (b" !!" * 5 if k % 3 == 0 else b"") for k in range(40)]
    leader, rows = ngram_quality.Leader.start(), []
    for k, text in enumerate(texts):
        label, importance = int(k % 3 > 0), 1.5 if k % 3 else 0.75
        slots, counts = ngram_quality.ngrams(text)
        leader.learn(slots, ngram_quality.values(counts), label, importance)
        rows.append((brute.gram_values(brute.gram_slots(text, ngram_quality.BITS)), label, importance))
    want = brute.follow_the_leader(rows, ngram_quality.ALPHA, ngram_quality.BETA, ngram_quality.L1, ngram_quality.L2)
    slots = np.array(sorted(want))
    assert leader.weights(slots).tolist() == pytest.approx([want[s] for s in slots.tolist()])
    assert np.count_nonzero(leader.weights()) == sum(w != 0 for w in want.values())


def test_a_round_averages_shards(spark):
    """One shard per row: the state is the mean of what each row alone would do."""
    texts = [(k, k % 2, f"{prose(20, k)} {'!!' if k % 2 else '??'}".encode()) for k in range(4)]
    found = [(k, 0, k, q, *(x.tobytes() for x in ngram_quality.ngrams(t))) for k, q, t in texts]
    rows = spark.createDataFrame(found, "shard int, place long, doc_id long, label int, slots binary, counts binary")
    got = ngram_quality.one_round(rows, ngram_quality.Leader.start(), {0: 1.0, 1: 1.0})
    want = ngram_quality.Leader.start()
    for _, q, t in texts:
        own = ngram_quality.Leader.start()
        slots, counts = ngram_quality.ngrams(t)
        own.learn(np.append(slots, len(own.z) - 1), np.append(ngram_quality.values(counts), ngram_quality.BIAS), q, 1.0)
        want.z += own.z / 4
        want.n += own.n / 4
    assert got.z == pytest.approx(want.z) and got.n == pytest.approx(want.n)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in entry.queries()["op12_ngram_quality"](spark, folder).collect()}
    labels = connect(folder).execute("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL").fetchall()
    held = [(got[i].predicted, y) for i, y in labels if brute.fold(i, 5) == 0]
    assert all(got[i].held_out == (brute.fold(i, 5) == 0) for i, _ in labels)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.99
    assert sum(not p for p, y in held if not y) / sum(not y for _, y in held) > 0.95


def test_quality_on_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame(
        [(5, 1, 0), (6, 0, 0), (7, 1, 0), (7, 1, 0), (8, None, 0), (9, 0, 1), (13, 2, 0), (None, 1, 0), (40, 0, 0)],
        "doc_id long, quality int, toxic int")
    got = ngram_quality.score_documents(odd, labels)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in odd_rows)
    again = ngram_quality.score_documents(odd.repartition(7), labels)
    assert table(got, *got.columns) == table(again, *again.columns)
    assert ngram_quality.score_documents(empty, labels).count() == 0
    alone = ngram_quality.score_documents(odd, labels.where("quality = 1"))
    assert {r.score for r in alone.collect()} == {0.5}


def test_learning_is_bounded_whatever_repeats(spark):
    """3000 rows of one id are one text to learn from; no more than the sample of each label is taken."""
    docs = spark.range(3200).select(
        F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("doc_id"),
        F.concat_ws(" ", F.lit("word"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).union(
        spark.createDataFrame([(1, 1)] * 5, "doc_id long, quality int"))
    taken = ngram_quality.sampled(docs, labels, 20)
    per = {r.quality: r["count"] for r in taken.groupBy("quality").count().collect()}
    assert per == {0: 20, 1: 20} and taken.select("doc_id", "quality").distinct().count() == 40


# --- Merkle manifest

HASHED = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_layout_is_a_permutation_that_keeps_subtrees_together():
    for levels in range(1, 7):
        places = [merkle.address(levels, d, i) for d in range(levels) for i in range(merkle.FAN ** d)]
        assert sorted(places) == list(range(merkle.size_of(levels)))
    # five levels: two on top, then nine trees of three levels each in one piece
    upper, lower = merkle.size_of(2), merkle.size_of(3)
    for k in range(9):
        own = {merkle.address(5, 2 + d, k * 3 ** d + i) for d in range(3) for i in range(3 ** d)}
        assert own == set(range(upper + k * lower, upper + (k + 1) * lower))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 3))
def test_blocks_and_paths_equal_a_plain_tree(n, seed):
    leaves = [brute.digest(str(seed), str(k)) for k in range(n)]
    root, ways = brute.tree(leaves)
    nodes, height = merkle.lay_out(0, list(map(bytes.fromhex, leaves))), merkle.climbs(0, n)
    assert nodes[:32].hex() == root
    for k in {0, n // 2, n - 1}:
        path = merkle.siblings(nodes, height, n, k)
        assert merkle.fold(bytes.fromhex(leaves[k]), path).hex() == root
        assert [(p, [d.hex() for d in o]) for p, o in merkle.steps(path)] == [
            (p, run[:p] + run[p + 1:]) for p, run in ways[k]]


def test_manifest_on_odd_rows(odd, odd_rows, empty):
    assert table(merkle.audit(odd), *HASHED) == sorted(brute.merkle(odd_rows), key=repr)
    got = merkle.audit(empty)
    assert got.count() == 0 and set(got.columns) == set(HASHED)


def test_manifest_of_several_tiers(spark):
    """Small blocks, so that trees of sources and the tree over them have several tiers; one source holds a third."""
    sizes = {"hot": 130, None: 9, "": 10, "ä": 1, "z": 28} | {f"s{k}": 1 + k % 4 for k in range(90)}
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((k, f"line {k}\nand {k % 7}" if k % 11 else None, "en" if k % 3 else None, source, k * 7))
            k += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert table(merkle.audit(docs, 2), *HASHED) == sorted(brute.merkle(rows), key=repr)
    kept = merkle.manifest(docs.select("source", "doc_id", merkle.leaf_digest().alias("leaf"), F.lit(1).alias("item")),
                           Store(spark, "merkle_test"), 2)
    assert len(kept.rows) == 3 and len(kept.sources) == 3
    assert kept.root().first().root == brute.merkle(rows)[0][3]
    assert {r.n for r in kept.rows[0].select("n").collect()} <= set(range(1, 10))


# --- adaptive limits of the quality rules

def test_cells_are_near_their_values_and_merge(spark):
    from rollcall.llm import quality

    values = [*range(0, 2000), *(7 ** k for k in range(2, 20))]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.cell_of("v").alias("cell")).collect()
    assert all(r.cell <= r.v and 128 * (r.v - r.cell) <= max(r.v, 1) for r in got)
    assert all(r.cell == r.v for r in got if r.v < 256)


def test_limits_equal_quantiles_of_the_merged_group(spark):
    """Every signal can reject, limits differ between groups, and a long unspaced word is no end of the scale."""
    from rollcall.llm import quality

    def text(k, symbols, width, capitals=0):
        words = [chr(97 + j % 26) * 3 + f"{k}x{j}" + "y" * width for j in range(60)]
        words = [w.upper() if j < capitals else w for j, w in enumerate(words)]
        return " ".join(words) + " " + "#" * symbols

    rows = [(k, text(k, k % 3, 2), "en", "plain", 0) for k in range(300)]
    rows += [(1000 + k, text(k, 40 + k % 5, 3), "en", "code", 0) for k in range(300)]
    rows += [(2000 + k, text(k, 0, 110 + k % 3), "zh", "long", 0) for k in range(60)]
    odd = [(5000, text(1, 45, 2), "en", "plain", 0), (5001, text(1, 45, 3), "en", "code", 0),
           (5002, text(1, 0, 3000), "zh", "long", 0), (5003, text(1, 1, 2, 60), "en", "plain", 0)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    kept = {r.doc_id for r in quality.kept_documents(docs).select("doc_id").collect()}
    assert kept == {r[0] for r in rows} | {5001}


def test_quality_on_held_out_rows_of_each_label(spark):
    """Nothing here is learnt from labels: clean rows stay but for the base rules, labelled junk goes."""
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in entry.queries()["op3_quality_rules"](spark, folder).collect()}
    labels = connect(folder).execute("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL").fetchall()
    clean, junk = ([got[i] for i, y in labels if y == k and not got[i].base_failed] for k in (1, 0))
    assert sum(r.kept for r in clean) / len(clean) > 0.98
    assert sum(r.kept for r in junk) / len(junk) < 0.05
