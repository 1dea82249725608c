"""Exact order statistics, encoded categories and the ordered funnel, against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from rollcall.operators import encoding, kpis, ranking
from rollcall.sources import Store


@pytest.fixture
def store(spark, request):
    return Store(spark, "test-" + request.node.name.replace("[", "-").replace("]", ""))


# --- running totals and AUC

def test_running_total_over_many_ranges(spark, store):
    df = spark.range(2000).select(F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("k"), "id", (F.col("id") % 7).alias("v"))
    got = ranking.running_total(df.repartition(9), store, ["k", "id"], "v", "before").orderBy("k", "id").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.v


def plain_auc(pairs):
    pos, neg = ([s for s, y in pairs if y == k] for k in (1, 0))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("levels", [1, 5, 10_000])
def test_auc_equals_all_pairs(spark, store, levels):
    draw = random.Random(levels)
    pairs = [(draw.randrange(levels) / levels, int(draw.random() < 0.2)) for _ in range(600)]
    df = spark.createDataFrame([*pairs, (None, 1), (0.5, None)], "score double, label int")
    r = ranking.roc_auc(df, store).first()
    assert r.roc_auc == pytest.approx(plain_auc(pairs), abs=1e-12)
    assert (r.positives, r.negatives) == (sum(y for _, y in pairs), sum(1 - y for _, y in pairs))
    binned = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        df.dropna().withColumn("label", F.col("label").cast("double")))
    assert r.roc_auc == pytest.approx(binned, abs=1e-3)


def test_auc_of_one_class_or_nothing_is_null(spark, store):
    one = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert tuple(ranking.roc_auc(one, store).first()) == (None, 2, 0)
    assert tuple(ranking.roc_auc(one.limit(0), store).first()) == (None, 0, 0)


# --- split

@pytest.mark.parametrize("share", [0, 1, 75, 100])
def test_split_is_exact_in_every_class(spark, store, share):
    data = [(k, None if k % 50 == 0 else float(k % 13 == 0)) for k in range(1, 2001)] + [(9999, 7.0)]
    df = spark.createDataFrame(data, "matricula long, label double")
    got = ranking.stratified_split(df.repartition(7), store, share=share).collect()
    assert len(got) == len(data)
    groups = defaultdict(list)
    for r in got:
        groups[r.label].append((hashlib.sha256(f"42|{r.matricula}".encode()).hexdigest(), r.in_train))
    for members in groups.values():
        taken = len(members) * share // 100
        assert [t for _, t in sorted(members)] == [True] * taken + [False] * (len(members) - taken)


# --- open categories

def labelled(spark):
    draw = random.Random(5)
    data = [(k, draw.choice(["a", "b", "c", None, f"own {k}"]), float(draw.random() < 0.3)) for k in range(1, 400)]
    return data, spark.createDataFrame(data, "matricula long, cidade string, label double")


def test_means_leave_out_the_rows_own_fold(spark):
    data, df = labelled(spark)
    fold = {k: int(hashlib.sha256(f"42|{k}".encode()).hexdigest()[:8], 16) % 5 for k, _, _ in data}
    got = {r.matricula: r.m for r in encoding.encode_out_of_fold(df.repartition(5), "cidade", "m").collect()}
    for k, city, _ in data:
        others = [(c, y) for j, c, y in data if fold[j] != fold[k]]
        prior = sum(y for _, y in others) / len(others)
        same = [y for c, y in others if c == city]
        assert got[k] == pytest.approx((sum(same) + 20 * prior) / (len(same) + 20))


def test_a_fold_never_sees_its_own_labels(spark):
    """Changing all labels of a fold leaves the numbers of that fold as they are."""
    data, df = labelled(spark)
    fold = encoding.fold_of("matricula", 5, 42)
    changed = df.withColumn("label", F.when(fold == 2, 1 - F.col("label")).otherwise(F.col("label")))
    before, after = (rows(encoding.encode_out_of_fold(d, "cidade", "m").where(fold == 2), "matricula", F.round("m", 12))
                     for d in (df, changed))
    assert before == after and len(before) > 50


def test_unseen_values_get_the_mean_of_all(spark):
    data, df = labelled(spark)
    means = encoding.category_means(df, "cidade")
    odd = spark.createDataFrame([("never",), (None,), ("a",)], "cidade string")
    got = {r.cidade: r.m for r in encoding.encode(odd, means, "cidade", "m").collect()}
    overall = sum(y for *_, y in data) / len(data)
    for city in (None, "a"):
        same = [y for _, c, y in data if c == city]
        assert got[city] == pytest.approx((sum(same) + 20 * overall) / (len(same) + 20))
    assert got["never"] == pytest.approx(overall)
    assert encoding.encode(odd, encoding.category_means(df.limit(0), "cidade"), "cidade", "m").where("m = 0").count() == 3


# --- funnel

EVENTS = "user_id long, event_type string, ts string"
STAGES = ("view", "click", "purchase")


def funnel(spark, store, events, people=None, keys=()):
    df = spark.createDataFrame(events, EVENTS).withColumn("ts", F.to_timestamp("ts"))
    return kpis.ordered_funnel(df, STAGES, store, people, keys)


def test_stages_count_in_order_only_and_across_midnight(spark, store):
    events = [
        (1, "view", "2024-01-31 23:00:00"), (1, "click", "2024-02-01 01:00:00"), (1, "purchase", "2024-02-01 23:00:00"),
        (2, "purchase", "2024-01-05 00:00:00"),                                                # never began
        (3, "click", "2024-01-05 00:00:00"), (3, "view", "2024-01-06 00:00:00"),               # clicked too early
        (4, "view", "2024-01-01 00:00:00"), (4, "purchase", "2024-01-02 00:00:00"),            # left a stage out
        (5, "view", "2024-02-01 00:00:00"), (5, "click", "2024-02-01 00:00:00"),               # at the same moment
        (5, "view", "2024-02-09 00:00:00"), (None, "view", "2024-01-01 00:00:00"), (6, "error", "2024-01-01 00:00:00")]
    got = funnel(spark, store, events)
    assert rows(got, "competencia", *STAGES, "view_to_click", "mean_days") == [
        ("2024-01", 3, 1, 1, 0.3333, 1.0), ("2024-02", 1, 1, 0, 1.0, None)]
    assert funnel(spark, store, [], None).count() == 0


def test_funnel_equals_a_fold_over_sorted_events(spark, store):
    """Also with a person who has a third of all events."""
    draw = random.Random(11)
    events = [(0 if draw.random() < 0.33 else draw.randrange(1, 60), draw.choice([*STAGES, "error"]),
               f"2024-0{draw.randrange(1, 4)}-{draw.randrange(10, 29)} {draw.randrange(10, 24)}:00:00") for _ in range(1500)]
    people = spark.createDataFrame([(u, "even" if u % 2 == 0 else "odd") for u in range(50)], "user_id long, kind string")
    reached = defaultdict(lambda: [0] * len(STAGES))
    own = defaultdict(list)
    for user, stage, ts in events:
        own[user].append((ts, STAGES.index(stage) if stage in STAGES else len(STAGES)))
    for user, listed in own.items():
        at, begun = 0, None
        for ts, stage in sorted(listed):
            if at < len(STAGES) and stage == at:
                begun, at = begun or ts, at + 1
        if begun:
            kind = None if user >= 50 else "even" if user % 2 == 0 else "odd"
            for k in range(at):
                reached[begun[:7], kind][k] += 1
    got = funnel(spark, store, events, people, ["kind"])
    assert rows(got, "competencia", "kind", *STAGES) == sorted(((*k, *v) for k, v in reached.items()), key=repr)
