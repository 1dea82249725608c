"""Operators on nulls, odd texts, ties, repeated rows, empty tables and clashing columns; and their inner parts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import (
    bpe, common, exact_dedup, lattice, licenses, line_dedup, mixing, near_dedup, quality, toxicity, url_rules)
from rollcall.sources import Store

from . import brute
from .helpers import SCHEMA, prose, table


# --- mixing

def test_mix_writes_its_rows_twice_at_most(odd, monkeypatch):
    """Every file written takes its executor processes, so rows are kept as units and in ranges, and not in between."""
    kept, keep = {}, Store.keep

    def counted(self, df, name):
        kept[name] = keep(self, df, name)
        return kept[name]

    monkeypatch.setattr(Store, "keep", counted)
    mixing.mix(odd).collect()
    assert len(kept) == 5
    assert [n for n, df in kept.items() if "doc_id" in df.columns] == ["units", "ranged_before"]


def test_mix_matches_sql_on_odd_rows(odd, odd_rows, sql_over):
    # repeated rows are one unit; SQL has no units, so it sees one of each with an id
    rows = list(dict.fromkeys(r for r in odd_rows if r[0] != 40))
    df = odd.where("doc_id IS NULL OR doc_id != 40").dropDuplicates(["doc_id", "text"])
    got = mixing.mixed_sizes(df)
    want = sql_over(mixing.SQL, rows)
    key = lambda r: (repr(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"])
    assert sorted(key(r.asDict()) for r in got.collect()) == sorted(map(key, want))


def test_units_match_no_words_and_translate_no_characters(odd, odd_rows):
    """Both leave objects behind for every word or character read; the words and symbols are those of the contract."""
    found = mixing.units(odd, "s")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and r"[^\x20" not in plan and "split(" in plan
    sizes = Counter({(i, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))) for i, text, _, source, _ in odd_rows})
    assert Counter({(r.doc_id, r.source, r.size) for r in found.collect()}) == sizes
    text = "\n a#b\x0b$|$ \x85é\u2028 a#b "
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    weigh = lambda t: mixing.quality_weight(mixing.words_of(t), t)
    df = odd.sparkSession.createDataFrame([(text,)], "text string")
    row = df.select(mixing.words_of(F.col("text")).alias("words"), weigh(F.col("text")).alias("weight")).first()
    assert row.words == words and row.weight == pytest.approx(3 / math.sqrt(4) / (1 + 5 / 4))


def test_mix_keeps_every_row_and_its_bounds(odd, odd_rows):
    rows = mixing.mixed_sizes(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in rows)
    twins = [r for r in rows if r.doc_id == 7]
    assert twins[0] == twins[1]
    assert sum({r.source_size: r.target for r in rows}.values()) <= 1.5 * sum(r.size for r in rows) + 1e-6


def test_mixed_rows_repeat_whole_rows(odd):
    times = {(r.doc_id, r.text_hash): r.times for r in mixing.mix(odd).collect()}
    out = mixing.mixed_rows(odd)
    assert out.columns == odd.columns
    got = Counter((r.doc_id, r.h) for r in out.select("doc_id", F.xxhash64("text").alias("h")).collect())
    copies = Counter((r.doc_id, r.h) for r in odd.select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert got == Counter({k: n * times[k] for k, n in copies.items() if n * times[k]})


def test_mix_follows_target_and_weight(spark):
    """Many documents in a hot source: the words taken come near the target, better documents are taken more often."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5))
        .alias("source"),
        F.when(F.col("id") % 2 == 0, F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(20)),
                                                                  lambda i: i.cast("string"))))
        .otherwise(F.repeat(F.lit("same "), 20)).alias("text"))
    mixed = mixing.mix(docs, weights=(1, 1, 1), share=0.5)
    per = mixed.groupBy("source").agg(F.sum(F.col("times") * F.col("size")).alias("taken"), F.max("target").alias("t"))
    assert all(abs(r.taken - r.t) <= 20 for r in per.collect())
    share = {r.even: r.m for r in mixed.where("source = 'hot'").groupBy((F.col("doc_id") % 2 == 0).alias("even"))
             .agg(F.avg("times").alias("m")).collect()}
    assert share[True] > 2 * share[False]


def test_levels_reshare_what_is_capped(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    rows = {r.source: r for r in mixing.source_targets(sizes, Store(spark, "t"), (3, 1, 2), 1.5, 2).collect()}
    assert rows["a"].target == 20 and rows[None].target == 0 and rows[None].source_index == 3
    assert sum(r.target for r in rows.values()) == pytest.approx(1.5 * 2010)
    assert rows["c"].target == pytest.approx(2 * rows["b"].target) or rows["c"].target == 2000


# --- BPE

POOL = "abcXYZ ΣσςİıßéÉäÑñ\u0301\u0300 \t\n\x0b\x1c\x85\xa0\u2003\u3000²½٣Ⅷ漢字カ🙂\u200d👩🚀'sS12.!?ᄀ\uac00ﬁǅ\u200b\ufeff\x00\x7f~_-"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.word_bpe_path())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(POOL, max_size=12),
                          st.sampled_from(["<|endoftext|>", "'ll", "ΑΣ", "e\u0301", "don't"])), max_size=6))
def test_encode_equals_the_library(library, parts):
    text, own = "".join(parts), bpe.codec(bpe.word_bpe_path())
    ids = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text.encode())
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_merge_skips_stale_pairs_and_takes_the_leftmost():
    ranks = {(1, 1): (0, 2), (2, 2): (1, 3), (2, 1): (2, 4)}
    assert bpe.merge([1, 1, 1, 1, 1], ranks) == [3, 1]
    assert bpe.merge([1, 1, 1], ranks) == [4]
    assert bpe.merge([], ranks) == []


def test_encode_odd_rows(odd, odd_rows, empty, library):
    got = table(bpe.encode(odd, bpe.word_bpe_path(), texts=True), "doc_id", "n_tokens", "decoded")
    want = []
    for i, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    assert bpe.token_digests(empty, bpe.word_bpe_path()).count() == 0


# --- quality rules

def test_measures_equal_sql_on_odd_rows(odd, odd_rows, sql_over, empty):
    rows = [r for r in odd_rows if r[0] not in (7, 40, None)]  # SQL joins by doc_id
    columns = ["doc_id", *quality.COUNTS, "base_failed"]
    got = quality.judged(odd, {"doc_id": F.col("doc_id")})
    assert got.count() == len(odd_rows)
    want = sql_over(quality.SQL, rows)
    assert table(got.where("doc_id NOT IN (7, 40)"), *columns) == sorted(
        (tuple(r[c] for c in columns) for r in want), key=repr)
    assert quality.judged(empty, {"doc_id": F.col("doc_id")}).count() == 0
    assert quality.kept_documents(odd).columns == odd.columns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_repeated_words(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    assert quality.repeated_words(words) == len(covered)


def test_limits_follow_the_group(spark):
    """A share that is usual in one source is an outlier in another; a small group uses its language's limit."""
    def rows(source, share, n, start):
        return [(start + i, " ".join("#" * (k < share) + f"w{start + i}x{k}" for k in range(100)), "en", source, 0)
                for i in range(n)]
    docs = spark.createDataFrame(rows("code", 60, 300, 0) + rows("prose", 0, 300, 1000) + rows("prose", 60, 5, 2000)
                                 + rows("tiny", 0, 5, 3000), SCHEMA)
    kept = {r.doc_id for r in quality.kept_documents(docs).select("doc_id").collect()}
    assert {*range(300), *range(1000, 1300), *range(3000, 3005)} == kept


# --- toxicity

def test_toxicity_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (None, 1, 1), (8, 1, None), (99, 1, 7)],
                                   "doc_id long, quality int, toxic int")
    for docs, n in ((odd, len(odd_rows)), (empty, 0)):
        rows = toxicity.score_documents(docs, labels).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)


def test_counterfactuals_spare_neutral_mentions(spark):
    """Toxic texts mention one group only. The penalty moves the blame from its name to the insults."""
    draw = random.Random(5)

    def text(*extra):
        words = [prose(1, draw.randint(0, 400)).strip(".").lower() for _ in range(30)] + list(extra)
        draw.shuffle(words)
        return " ".join(words)

    rows = [(i, text("muslims", draw.choice(["scum", "vermin", "filth"]) if i % 4 else "grmpf"), 1) for i in range(400)]
    rows += [(1000 + i, text(*(["christians"] if i % 8 == 0 else [])), 0) for i in range(400)]
    neutral = [(5000 + i, text("muslims"), 0) for i in range(100)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t, _ in rows + neutral], SCHEMA)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    wrong, found = {}, {}
    for penalty in (0.0, 4.0):
        model = toxicity.train(docs, labels, counterfactual=penalty)
        scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        wrong[penalty] = sum(scores[i] for i, *_ in neutral) / len(neutral)
        found[penalty] = sum(scores[i] >= 0.5 for i, *_ in rows[:400])
    assert wrong[4.0] < wrong[0.0] - 0.2 and found[4.0] >= 390


def test_toxic_terms_late_in_an_unspaced_run_count(spark, monkeypatch):
    """Text without ASCII spaces is one word, and read to its end; counts passed on in parts are the same."""
    draw = random.Random(7)

    def run(*extra):
        return "".join(chr(draw.randint(0x4E00, 0x4EFF)) for _ in range(200)) + "".join(extra) + "\u3002"

    rows = [(i, run("\u5783\u573e\u4eba\u6e23"), 1) for i in range(100)] + [(1000 + i, run(), 0) for i in range(100)]
    docs = spark.createDataFrame([(i, t, "zh", "a", 0) for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, labels).collect()}
    assert all(scored[i] == y for i, _, y in rows)
    texts = docs.join(labels, "doc_id").select("toxic", F.expr(common.TEXT_BYTES).alias("body")).coalesce(1)
    whole = table(toxicity.associations(texts), "feature", "pos", "neg")
    assert ("\u5783\u573e\u4eba\u6e23", 100, 0) in whole
    monkeypatch.setattr(toxicity, "MOST_COUNTED", 1000)
    assert table(toxicity.associations(texts), "feature", "pos", "neg") == whole


@pytest.mark.parametrize("penalty", [0.0, 3.0])
def test_fit_reaches_the_least_of_the_written_loss(penalty):
    draw = random.Random(11)
    held = [sorted(draw.sample(range(6), draw.randint(0, 4))) for _ in range(60)]
    labels = [int(draw.random() < (0.8 if 0 in h else 0.2)) for h in held]
    pairs = [([0, 1], [0, 2]), ([3], [4]), ([1, 5], [2, 5])]
    w, b = toxicity.fit(np.array(labels, dtype=float), held, pairs, 6, penalty, 0.01, 4000)
    at = [*w, b]

    def loss(x):
        return brute.toxicity_loss(labels, held, pairs, x[:6], x[6], penalty, 0.01)

    for i in range(7):
        up, down = (loss([v + d * (i == j) for j, v in enumerate(at)]) for d in (1e-4, -1e-4))
        assert abs(up - down) / 2e-4 < 1e-4
    assert not penalty or abs(w[3] - w[4]) < 0.5


def test_repeated_ids_do_not_widen_the_sample(spark):
    """3000 rows of one doc_id with three label rows, and ids without copies."""
    texts = [(5, f"text number {i}") for i in range(3000)] + [(i, f"other {i}") for i in range(10, 60)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in texts], SCHEMA)
    labels = spark.createDataFrame([(5, 1, 1)] * 3 + [(5, 1, 0)] + [(i, 1, i % 2) for i in range(10, 60)],
                                   "doc_id long, quality int, toxic int")
    learnt = table(toxicity.sampled(docs, labels, 20), "toxic", "body")
    least = min((t for i, t in texts if i == 5), key=lambda t: hashlib.sha256(t.encode()).hexdigest()).encode()
    everything = table(toxicity.sampled(docs, labels, 1000), "toxic", "body")
    used = [i for i in range(10, 60) if brute.fold(i, 5)]
    assert brute.fold(5, 5) and sorted((y, bytes(t)) for y, t in everything) == sorted(
        [(0, least), (1, least)] + [(i % 2, f"other {i}".encode()) for i in used])
    assert len([y for y, _ in learnt if y]) == 20 and {(y, bytes(t)) for y, t in learnt} <= {(y, bytes(t)) for y, t in everything}


def test_names_are_put_into_a_share_of_the_texts():
    swap = toxicity.swaps()
    bodies = [f"sentence {i} about rivers".encode() for i in range(2000)]
    pairs = [toxicity.pair_of(b, toxicity.words_of(b), swap) for b in bodies]
    put_in = [(left - toxicity.words_of(b), right - toxicity.words_of(b)) for b, p in zip(bodies, pairs) if p
              for left, right in [p]]
    assert 400 < len(put_in) < 600
    assert all(len(x) == len(y) == 1 and swap[min(x)] == min(y) for x, y in put_in)
    named = b"all women here"
    assert toxicity.pair_of(named, toxicity.words_of(named), swap) == ({b"all", b"women", b"here"},
                                                                      {b"all", b"men", b"here"})
    assert toxicity.pair_of(b"", set(), {}) is None


def test_texts_in_every_language_have_twins(spark):
    names = [n for row in toxicity.GROUPS for n in row]
    assert len(names) == len(set(names))
    texts = ["all women here", "Die Frauen, hier", "les étrangers ici", "las mujeres de allí", "nobody at all", ""]
    bodies = spark.createDataFrame([(t.encode(),) for t in texts], "body binary").coalesce(1)
    assert toxicity.differing_twins(bodies) == 4
    assert toxicity.differing_twins(bodies, toxicity.GROUPS[:1]) == 1


# --- licences

@pytest.mark.parametrize("expression, value", [
    ("mit", 1.0), ("mit or gpl-2.0", 1.0), ("mit and gpl-2.0-only", 0.3), ("gpl-2.0 with classpath-exception-2.0", 0.65),
    ("(mit or gpl-2.0) and mpl-2.0", 0.6), ("mit or gpl-2.0 and mpl-2.0", 1.0), ("gpl-3.0 or nonsense-1", 0.5),
    ("mit or", None), ("or mit", None), ("(mit", None), ("mit)", None), ("mit gpl", None), ("()", None), ("", None),
    ("mit (gpl)", None)])
def test_expressions(expression, value):
    items = licenses.postfix(expression)
    assert (items is None) == (value is None)
    assert value is None or licenses.freedom(items) == pytest.approx(value)


def test_scan_finds_phrases_tags_and_overlaps():
    own = licenses.automaton()
    text = ("The MIT-License, mit license; Mit\nlicense.\n// SPDX-License-Identifier: (Apache-2.0 OR GPL-2.0-only) AND BSD\n"
            "CC BY-NC, all rights reserved").encode()
    n, places, base, labels, score = licenses.scan(text, own)
    assert places == [1, 3, 5, 15] or (n, len(places)) == brute.license_base(text.decode())[:2]
    assert base == {"mit", "cc-by"}
    assert labels == {"mit", "cc-by", "cc-by-nc", "apache", "gpl", "bsd", "proprietary"} and score == 0.0
    assert licenses.scan(b"submit licenses", own) == (2, [], set(), set(), licenses.UNKNOWN)


TAG = "SPDX-License-Identifier:"


@pytest.mark.parametrize("text, labels, score", [
    (f"/* {TAG} GPL-2.0 OR MIT */", {"gpl", "mit"}, 1.0), (f"/* {TAG} GPL-2.0*/ int mit;", {"gpl"}, 0.3),
    (f"<!-- {TAG} GPL-2.0 -->", {"gpl"}, 0.3), (f"<!--{TAG}AGPL-3.0-only--><p>apache mit</p>", {"agpl"}, 0.2),
    (f"x {TAG} (GPL-2.0+ AND MIT) WITH Foo. Then prose on apache and mit", {"gpl", "mit"}, 0.65),
    (f"{TAG} MIT is what this is under, not Apache", {"mit"}, 1.0), (f"{TAG} MIT, see apache", {"mit"}, 1.0),
    (f"{TAG} MIT {TAG} GPL-2.0 or apache tail {TAG}", {"mit", "gpl", "apache"}, 1.0),
    (f"{TAG} MIT OR {TAG} GPL-2.0", {"mit", "gpl"}, 0.3), (f'"{TAG[:-1]}": "MPL-2.0", "x": "mit"', {"mpl"}, 0.6),
    (f"{TAG} (MIT OR GPL-2.0 */ apache", {"mit", "gpl"}, 0.5), (f"{TAG} */ apache\nmit", set(), 0.5),
    (f"{TAG} GPL-2.0 OR\nMIT", {"gpl"}, 0.3)])
def test_what_follows_an_expression_is_not_part_of_it(text, labels, score):
    found = licenses.scan(text.encode(), licenses.automaton())
    assert found[3] == labels and found[4] == pytest.approx(score)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["mit", "gpl-2.0", "or", "and", "with", "(", ")"]), max_size=12))
def test_leading_expressions_are_the_longest(tokens):
    text = " ".join(tokens)
    whole = max((k for k in range(len(tokens) + 1) if licenses.postfix(" ".join(tokens[:k]))), default=0)
    assert licenses.leading(text, 0, len(text))[1] == whole


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["gnu", "general", "public", "license", "Apache", "cc", "by", "MIT", "é", "-"]), max_size=30),
       st.sampled_from([" ", "\n", ", ", "{"]))
def test_places_equal_plain_search(words, gap):
    text = gap.join(words)
    n, places, base, *_ = licenses.scan(text.encode(), licenses.automaton())
    want = brute.license_base(text)
    assert (n, len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(base))) == want


def test_licenses_odd_rows(odd, odd_rows, empty):
    got = table(licenses.license_digests(odd), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((r[0], *brute.license_base(r[1])) for r in odd_rows), key=repr)
    assert licenses.license_digests(empty).count() == 0


# --- lattice

def all_segmentations(own, text):
    if not text:
        return [0.0]
    out = [own.pieces[text[:k]] + rest for k in range(1, len(text) + 1) if text[:k] in own.pieces
           for rest in all_segmentations(own, text[k:])]
    return out + [own.byte * len(text[0].encode()) + rest for rest in all_segmentations(own, text[1:])]


@settings(max_examples=60, deadline=None)
@given(st.text("abé", min_size=1, max_size=6))
def test_marginal_sums_over_all_segmentations(word):
    own = lattice.Lattice({p: math.log(0.1) for p in ("▁", "▁a", "a", "b", "ab", "ba", "aba", "é")}, math.log(0.001))
    terms = all_segmentations(own, lattice.WORD_START + word)
    assert own.log_marginal(word) == pytest.approx(math.log(sum(map(math.exp, terms))))
    into: dict = {}
    own.expect(word, into)
    assert all(v > 0 for v in into.values())
    # the expected characters of a segmentation are those of the word
    assert sum(v * len(p) for p, v in into.items() if p) + into.get("", 0) == pytest.approx(len(word) + 1)


@pytest.mark.parametrize("length", [1, 10, 45, 46, 47, 48, 200, 5000])
def test_products_and_logarithms_meet(length, monkeypatch):
    """Products serve words that they cannot leave the range of doubles in, logarithms the others."""
    own = lattice.Lattice.from_file(lattice.pieces_path())
    word = "".join(random.Random(length).choice("abé\U0001f600etinq") for _ in range(length))
    short, into, logs = own.log_marginal(word), {}, {}
    own.expect(word, into, 3.0)
    assert own._is_long(lattice.WORD_START + word) == (len((lattice.WORD_START + word).encode()) > own.longest)
    monkeypatch.setattr(own, "longest", 0)
    assert math.isfinite(short) and short == pytest.approx(own.log_marginal(word), rel=1e-12)
    own.expect(word, logs, 3.0)
    assert {p: into.get(p, 0.0) for p in into | logs} == {p: pytest.approx(logs.get(p, 0.0), abs=1e-7) for p in into | logs}


def test_usual_words_are_summed_without_logarithms(monkeypatch):
    """One logarithm for a word, where there was one for each place in it and an exponential for each piece."""
    own, calls = lattice.Lattice.from_file(lattice.pieces_path()), Counter()

    class Counted:
        def __getattr__(self, name):
            calls[name] += 1
            return getattr(math, name)

    monkeypatch.setattr(lattice, "math", Counted())
    own.log_marginal("interesting")
    own.expect("interesting", {})
    assert calls == {"log": 1}


def test_refitted_weights_sum_to_at_most_one():
    own = lattice.lattice(lattice.pieces_path())
    assert sum(map(math.exp, own.pieces.values())) == pytest.approx(1 - lattice.BYTE_SHARE)
    into: dict = {}
    for word in ("thation", "erble", "thation"):
        own.expect(word, into)
    fitted = own.refitted(into)
    assert sum(map(math.exp, fitted.pieces.values())) <= 1.000001
    assert fitted.log_marginal("thation") > own.log_marginal("thation")


def test_lattice_odd_rows(odd, odd_rows, empty):
    rows = lattice.score_texts(odd, lattice.pieces_path(), frequent=10).collect()
    assert len(rows) == len(odd_rows) and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    unique = [r for r in odd_rows if r[0] not in (7, 40)]
    assert {(r.doc_id, r.n_tokens) for r in rows if r.doc_id not in (7, 40)} == {
        (i, v[1]) for i, v in brute.base_scores(unique).items()}
    assert lattice.score_texts(empty, lattice.pieces_path()).count() == 0


def test_frequent_words_do_not_change_scores(spark, odd):
    few, all_ = (table(lattice.score_texts(odd, lattice.pieces_path(), frequent=k), "doc_id", "n_known", "base_score",
                       "score", "mixture_score") for k in (1, 100_000))
    assert [x[:2] for x in few] == [x[:2] for x in all_]
    assert [y for x in few for y in x[2:]] == pytest.approx([y for x in all_ for y in x[2:]], abs=1e-4)


def test_scores_sum_over_all_splits_of_the_texts(spark):
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choice("aeinsté") for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(0, 9)))
             for _ in range(40)] + [None, "", "\U0001f600 tea", "Tea tEA\ttea"]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    path = lattice.pieces_path()
    own = lattice.lattice(path)
    want = brute.lattice_scores(rows, {p: math.exp(w) for p, w in own.pieces.items()}, math.exp(own.byte),
                                lattice.SCORE_PIECES, lattice.END_SHARE)
    for frequent in (5, 1000):
        got = lattice.score_texts(spark.createDataFrame(rows, SCHEMA), path, frequent).collect()
        assert {r.doc_id: (r.score, r.mixture_score) for r in got} == {
            i: pytest.approx(v, abs=1e-4) for i, v in want.items()}


# --- exact dedup

@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 40), min_size=1, max_size=60), st.integers(0, 40))
def test_golomb_round_trip(values, k):
    k = max(k, max(values).bit_length() - 12)  # a quotient is spelled in unary
    gaps = np.array(values, dtype=np.uint64)
    assert exact_dedup.golomb_decode(exact_dedup.golomb_encode(gaps, k), len(gaps), k).tolist() == values


def test_a_partition_sends_a_text_once(spark, monkeypatch):
    """Copies within one partition, across partitions and both; an owner gets one entry per text and partition."""
    texts = ["hot"] * 3000 + ["pair", "pair"] + [f"t{i}" for i in range(500)]
    parts = [list(enumerate(texts)), [(9000, "hot"), (9001, "t7"), (9002, "new")]]
    docs = spark.createDataFrame(spark.sparkContext.union([spark.sparkContext.parallelize(p, 1) for p in parts]),
                                 "doc_id long, text string")
    bodies = docs.select("doc_id", F.expr(common.TEXT_BYTES).alias("body"))
    sent = bodies.mapInArrow(exact_dedup._fingerprint(3), exact_dedup.ROWS).where("kind = 1")
    assert sent.agg(F.sum("n")).first()[0] == 502 + 3
    holders = {}
    for r in docs.collect():
        holders.setdefault(r.text, []).append(r.doc_id)
    want = sorted((i, min(ids), len(ids), i == min(ids)) for ids in holders.values() for i in ids)
    monkeypatch.setattr(exact_dedup, "OWNED", 100)
    assert exact_dedup.owners_for(1001, 4) == 11 and exact_dedup.owners_for(10, 4) == 4
    assert table(exact_dedup.find_copies(docs), "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)


def test_copies_on_odd_rows(odd, odd_rows, sql_over, empty):
    got = exact_dedup.find_copies(odd, owners=5, filter_bits=8)
    want = sql_over(exact_dedup.SQL, odd_rows)
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert table(got, *columns) == sorted((tuple(r[c] for c in columns) for r in want), key=repr)
    groups = Counter(r.text_sha256 for r in got.where("kept").collect())
    assert set(groups.values()) == {1} and len(groups) == len({r["text_sha256"] for r in want})
    assert exact_dedup.find_copies(empty).count() == 0


# --- line dedup

def test_lines_on_odd_rows(odd, odd_rows, sql_over, empty):
    rows = [r for r in odd_rows if r[0] not in (7, 40, None)]
    columns = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    got = line_dedup.line_digests(odd)
    assert got.count() == len(odd_rows)
    assert table(got.where("doc_id NOT IN (7, 40)"), *columns) == sorted(
        (tuple(r[c] for c in columns) for r in sql_over(line_dedup.SQL, rows)), key=repr)
    assert sum(r.n_dropped for r in got.collect()) == 5
    assert line_dedup.line_digests(empty).count() == 0
    assert set(odd.columns) <= set(line_dedup.clean_lines(odd).columns)


def test_a_line_that_repeats_in_its_holder_stays(spark):
    line = "a line of more than forty characters, seen in several documents"
    docs = spark.createDataFrame([(i, f"{line}\nx\n{line}", "en", "a", 0) for i in range(5)] +
                                 [(None, line, "en", "a", 0)], SCHEMA)
    kept = {r.doc_id: r.kept_text for r in line_dedup.clean_lines(docs).collect()}
    assert kept == {0: "x", 1: "x", 2: "x", 3: "x", 4: f"{line}\nx\n{line}", None: ""}


def test_line_keys_fold_what_translate_folds(spark):
    """Latin-1 lower-casing turns C3 into E3 and so on; no two lines may meet by that."""
    ends = ["", " ", "\t", "\x0b", "\r", "\x0c ", "\x1f", "\xa0"]
    middle = ["A", "a", "É", "é", "ß", "Σ", "σ", "ς", "İ", "i̇", "k", "\u212a", "\u3042", "\xc2", "\u2080", "𐐀", "𐐨", "ab", "aB"]
    lines = spark.createDataFrame([(a + m + b,) for a in ends for m in middle for b in ends] + [("",), (" \r",)], "line string")
    keys = lines.select(F.expr("line").alias("line"), line_dedup._folded(line_dedup._stripped(F.col("line"))).alias("own"),
                        common.lower_ascii(F.btrim("line", F.lit(line_dedup.STRIPPED))).alias("plain")).collect()
    both = {(r.own, r.plain) for r in keys}
    assert len(both) == len({r.own for r in keys}) == len({r.plain for r in keys})


def test_lines_are_folded_whole_and_texts_pass_unsorted(spark, monkeypatch):
    """A text was an object for each character, was sorted, and was met by positions from a table of many files."""
    made, keep = {}, Store.keep

    def noted(self, df, name):
        made[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(self, df, name)

    monkeypatch.setattr(Store, "keep", noted)
    docs = spark.createDataFrame([(i, "a line of more than forty characters, seen in several documents", "en", "a", 0)
                                  for i in range(6)], SCHEMA)
    cleaned = line_dedup.clean_lines(docs)
    assert set(made) == {"keys", "shared"} and "translate(" not in made["keys"]
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


# --- URL rules

URLS = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Net/x"), (5, "http://net"), (6, "x://www.example.net/en/1?a=b"),
        (7, "http://example.com/de/2#f"), (8, "http://notexample.com/de/2"), (9, "http://o.ORG/fr/"), (9, "http://o.ORG/fr/"),
        (None, "http://a.b?x=/"), (11, "a://b://c/d"), (12, "http://" + "h" * 40_000 + "/p"), (13, "http://internet/")]


def test_urls_on_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in URLS], "page_id long, url string, host string, bad string")
    labels = spark.createDataFrame([(1, None, 1), (2, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = url_rules.judge_urls(pages, url_rules.bad_labels(labels))
    assert table(got, "page_id", "host", "path", "rule") == sorted(((i, *brute.url_parts(u)) for i, u in URLS), key=repr)
    assert {r.verdict for r in got.where("rule IS NULL").collect()} == {"allow"}
    assert url_rules.judge_urls(pages.limit(0), url_rules.bad_labels(labels)).count() == 0
    assert url_rules.judge_urls(pages, url_rules.bad_labels(labels.limit(0))).count() == len(URLS)


def test_mined_rules_equal_plain_counts(spark):
    """Hosts by themselves say nothing; a host with a certain section is bad."""
    draw = random.Random(3)
    pages, labels = [], []
    for i in range(2000):
        host, section = draw.choice("pqr") + ".example.com", draw.choice(["en", "shop", "blog"])
        bad = draw.random() < (0.9 if (host[0], section) == ("p", "shop") else 0.1)
        pages.append((i, f"http://{host}/{section}/{i}.html"))
        labels.append((i, 0 if bad else 1, 0))
    pages = spark.createDataFrame(pages, "page_id long, url string")
    bad = url_rules.bad_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = url_rules.judge_urls(pages, bad).collect()
    assert all((r.verdict == "block") == (r.host[0] == "p" and r.path.startswith("/shop")) for r in got)

    host, path = url_rules.host_and_path(F.col("url"))
    read = pages.select("page_id", url_rules.url_tokens(F.col("url"), host, path).alias("tokens"))
    joined = read.join(bad, read["page_id"] == bad["doc_id"]).select("tokens", "bad")
    rules = {tuple(r.tokens): round(r.confidence, 9) for r in url_rules.mine_rules(joined).collect()}
    rows = [(set(r.tokens), r.bad) for r in joined.collect()]
    tokens = sorted(set().union(*(t for t, _ in rows)))
    want = {}
    for k in (1, 2):
        for c in combinations(tokens, k):
            hits = [b for t, b in rows if t.issuperset(c)]
            if sum(hits) >= 20 and sum(hits) / len(hits) >= 0.6:
                want[c] = round(sum(hits) / len(hits), 9)
    assert rules == want


def test_rules_of_three_tokens(spark):
    """Host, section and query key imply the label only together. Verdicts are those of all combinations of any size."""
    draw = random.Random(4)
    pages, labels = [], []
    for i in range(3000):
        host, section, key = draw.choice("pq"), draw.choice(["en", "shop"]), draw.choice("ab")
        bad = draw.random() < (0.9 if host + section + key == "pshopa" else 0.1)
        pages.append((i, f"http://{host}.com/{section}/{i}?{key}=1"))
        labels.append((i, 0 if bad else 1, 0))
    pages = spark.createDataFrame(pages, "page_id long, url string")
    bad = url_rules.bad_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    host, path = url_rules.host_and_path(F.col("url"))
    read = pages.select("page_id", url_rules.url_tokens(F.col("url"), host, path).alias("tokens"))
    joined = read.join(bad, read["page_id"] == bad["doc_id"]).select("page_id", "tokens", "bad").collect()
    hits = {}
    for r in joined:
        for k in range(1, len(r.tokens) + 1):
            for c in combinations(sorted(r.tokens), k):
                hits.setdefault(c, []).append(r.bad)
    rules = {c: sum(h) / len(h) for c, h in hits.items() if sum(h) >= 20 and sum(h) / len(h) >= 0.6}
    assert min(map(len, rules)) == 3
    want = {r.page_id: max((v for c, v in rules.items() if set(c) <= set(r.tokens)), default=None) for r in joined}
    got = {r.page_id: (r.verdict, r.bad_confidence) for r in url_rules.judge_urls(pages, bad).collect()}
    assert got == {i: ("allow" if v is None else "block", v) for i, v in want.items()}
    assert any(v is not None for v in want.values())


def test_the_pages_a_rule_needs_do_not_grow_with_the_table(spark):
    hosts = ["bad.com"] * 20 + ["few.com"] * 19 + ["good.com"] * 12_000
    pages = spark.createDataFrame([(i, f"http://{h}/{i}") for i, h in enumerate(hosts)], "page_id long, url string")
    bad = spark.createDataFrame([(i, h != "good.com") for i, h in enumerate(hosts)], "doc_id long, bad boolean")
    got = url_rules.judge_urls(pages, bad).groupBy("host", "verdict").count()
    assert table(got, "host", "verdict", "count") == [
        ("bad.com", "block", 20), ("few.com", "allow", 19), ("good.com", "allow", 12_000)]


# --- near copies

def test_near_copies_on_odd_rows(odd, odd_rows, empty):
    columns = ["doc_id", "n_shingles", "component_id"]
    for width, percent in ((3, 85), (5, 80)):
        got = near_dedup.near_copies(odd, width, percent)
        assert table(got, *columns) == sorted((r[:3] for r in brute.near(odd_rows, width, percent)), key=repr)
    assert near_dedup.near_copies(empty).count() == 0
    assert near_dedup.kept_documents(odd).columns == odd.columns


def test_large_groups_in_blocks(spark, monkeypatch):
    """Chains and crowds of near copies, with blocks so small that every way through them is taken."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    draw, rows = random.Random(11), []
    for g in range(3):
        words = prose(120, 900 + g).split()
        for k in range(25):
            if g == 0:  # a chain: every text differs a little more from the first
                words = [*words[:4 * k], f"n{k}a", f"n{k}b", *words[4 * k + 2:]]
                rows.append((len(rows), " ".join(words)))
            else:
                own = list(words) + [f"x{j}" for j in range(draw.randint(0, 25))]
                for _ in range(draw.randint(0, 6)):
                    own[draw.randrange(len(own))] = f"y{draw.randint(0, 99)}"
                rows.append((len(rows), " ".join(own)))
    rows = [(i, t, "en", "a", 0) for i, t in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_dedup.near_copies(docs, 3, 85)
    assert table(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near(rows, 3, 85), key=repr)


def test_pruning_keeps_what_may_reach_the_threshold():
    least = near_dedup.least_matches(85, 80)
    assert len(least) == 10 and list(least) == sorted(least)
    # at a similarity of 0.85, a pair falls below some bound with a chance of about MISS at each step
    from math import comb
    for k, m in zip(range(8, 81, 8), least):
        assert sum(comb(k, i) * 0.85 ** i * 0.15 ** (k - i) for i in range(m)) < 1e-7
    assert least[-1] > 30  # and far pairs are dropped


def test_components_equal_union_find(spark):
    draw = random.Random(2)
    links = [(f"{i:04d}", f"{i + 1:04d}") for i in range(60)] + [("9000", f"{i}") for i in range(9001, 9200)]
    links += [(f"{draw.randint(5000, 5200)}", f"{draw.randint(5000, 5200)}") for _ in range(150)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = common.components(spark.createDataFrame(links, "a string, b string"), Store(spark, "c"))
    assert dict(map(tuple, got.collect())) == {x: find(x) for x in nodes}


def test_running_sums_of_several_columns(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("o"), (F.col("id") % 7).alias("x"), F.lit(0.5).alias("y"))
    a = b = 0
    for r in sorted(common.running(df, Store(spark, "r"), [], ["o"], ["x", "y"], ["a", "b"]).collect(),
                    key=lambda r: r.o):
        assert (r.a, r.b) == (a, b)
        a, b = a + r.x, b + r.y


def test_running_sums_with_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("g"),
                                  F.xxhash64("id").alias("o"), F.lit(1).alias("one"))
    got = common.running(df, Store(spark, "r"), ["g"], ["o"], "one", "before").collect()
    groups: dict = {}
    for r in sorted(got, key=lambda r: (r.g, r.o)):
        assert r.before == groups.get(r.g, 0)
        groups[r.g] = r.before + 1
    assert len(got) == 5000
