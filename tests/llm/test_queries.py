"""Registered queries against their SQL, or against plain versions."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import __spark_entry__ as entry
from pyspark.sql import functions as F

from checks.compare import connect, rows_of
from rollcall.llm import toxicity
from rollcall.llm.queries import ORACLES

from . import brute
from .helpers import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id").fetchall()


def result(spark, name):
    return {r[0]: r for r in entry.queries()[name](spark, SF).collect()}


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())


def test_bpe_equals_the_library(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = result(spark, "op2_bpe")
    for doc_id, text, *_ in documents:
        ids = own.encode(text or "", add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        assert tuple(got[doc_id]) == (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                      hashlib.sha256(decoded.encode()).hexdigest())


def test_toxicity_on_held_out_rows(spark):
    """Held-out accuracy, where there are labels enough to learn from."""
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in entry.queries()["op4_toxicity"](spark, folder).collect()}
    labels = connect(folder).execute("SELECT doc_id, toxic FROM labels").fetchall()
    held = [(got[i].predicted, y, got[i].score) for i, y in labels if brute.fold(i, 5) == 0]
    assert all(got[i].held_out == (brute.fold(i, 5) == 0) for i, _ in labels)
    assert all(0 <= s <= 1 and p == (s >= 0.5) for p, _, s in held)
    assert sum(p == y for p, y, _ in held) / len(held) > 0.97
    assert sum(p == y == 1 for p, y, _ in held) / sum(y for _, y, _ in held) > 0.9


def test_names_of_groups_hardly_move_held_out_scores(spark):
    """Each held-out text is read with one group's name and with another's put in."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    swap = toxicity.swaps()
    names = list(swap)
    held = [(n, r.text or "") for n, r in enumerate(
        docs.where(toxicity.held_out(F.col("doc_id"))).orderBy("doc_id").select("text").collect())]
    probes = [(2 * n + k, f"{t} {name.decode()}", "en", "a", 0) for n, t in held
              for k, name in enumerate((names[n % len(names)], swap[names[n % len(names)]]))]
    probes = spark.createDataFrame(probes, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    moved = {}
    for penalty in (0.0, toxicity.COUNTERFACTUAL):
        model = toxicity.train(docs, labels, counterfactual=penalty)
        scores = {r.doc_id: r.score for r in toxicity.score(probes, model).collect()}
        moved[penalty] = [abs(scores[2 * n] - scores[2 * n + 1]) for n, _ in held]
    got, without = moved[toxicity.COUNTERFACTUAL], moved[0.0]
    assert max(got) < 0.05 and sum(got) < sum(without) / 4


def test_licenses(spark, documents):
    got = result(spark, "op5_license_scan")
    for doc_id, text, *_ in documents:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_lattice_base(spark, documents):
    got, want = result(spark, "op6_lattice_lm"), brute.base_scores(documents)
    for doc_id, (held, n, known, train, base) in want.items():
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base, abs=1e-4) and r.score < 0


def test_urls(spark, con):
    got = result(spark, "op9_url_rules")
    verdicts = {h + p: v for h, p, v in brute.RULES}
    pages = con.execute("SELECT page_id, url FROM pages").fetchall()
    assert len(got) == len(pages)
    for page_id, url in pages:
        host, path, rule = brute.url_parts(url)
        assert tuple(got[page_id])[1:4] == (host, path, rule)
        assert got[page_id].verdict == verdicts[rule] if rule else got[page_id].verdict in ("allow", "block")


def test_near_copies(spark, documents):
    got = result(spark, "op10_near_dedup")
    assert sorted(tuple(r) for r in got.values()) == sorted(brute.near(documents, 3, 85))


@pytest.mark.parametrize("name", ["op8_line_dedup", "op9_url_rules"])
def test_native_plans_hold_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("InArrow", "InPandas", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
