from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import kpis, model, repair
from rollcall.operators.quality import GateFailed
from rollcall.plans import attrition
from rollcall.plans.silver import silver
from rollcall.sources import Store

REF = "2021-06-30"


@pytest.fixture(scope="module")
def table(spark):
    """People with low engagement tend to leave within the year after the reference date."""
    from rollcall.schema import BRONZE
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        score = round(rnd.uniform(1, 10), 1)
        leaves = rnd.random() < (0.45 if score < 4 else 0.03)
        end = (dt.date(2021, 7, 1) + dt.timedelta(days=rnd.randrange(360))).isoformat() if leaves else None
        data.append((
            i + 1, f"Colaborador_{i}", rnd.choice(["RH", "Marketing", "Tecnologia"]), "Cargo", "Júnior/Pleno",
            (dt.date(2016, 1, 1) + dt.timedelta(days=rnd.randrange(1800))).isoformat(), 10, rnd.randrange(20, 60),
            rnd.choice(["a", "b"]), "c", f"Cidade {rnd.randrange(40)}", float(rnd.randrange(3000, 9000)), score,
            rnd.randrange(2, 11) / 2, float(rnd.randrange(40, 150)), None, "Desligado" if end else "Ativo", end,
            "Voluntário" if end else None, "x" if end else None))
    return silver(spark.createDataFrame(data, BRONZE)).persist()


@pytest.fixture(scope="module")
def fitted(table):
    labelled = model.label_attrition(table, REF)
    train, test = model.split_by_key(labelled)
    return model.train_attrition(train, trees=30), train, test


def test_labels(people):
    gone = {"status": "Desligado", "tipo_desligamento": "Voluntário"}
    df = repair.parse_dates(people(
        {"matricula": 1}, {"matricula": 2, **gone, "data_desligamento": REF},
        {"matricula": 3, **gone, "data_desligamento": "2021-07-01"},
        {"matricula": 4, **gone, "data_desligamento": "2022-06-30"},
        {"matricula": 5, **gone, "data_desligamento": "2022-07-01"},
        {"matricula": 6, **gone, "data_desligamento": "2021-07-01", "tipo_desligamento": "Involuntário"},
        {"matricula": 7, "data_admissao": "2021-07-01"}))
    assert rows(model.label_attrition(df, REF), "matricula", "label") == [
        (1, 0.0), (3, 1.0), (4, 1.0), (5, 0.0), (6, 0.0)]


def test_tenure_rounds_half_to_even(spark):
    df = spark.createDataFrame([("2021-06-15",), ("2021-05-16",), ("2021-04-16",)], "d string")
    got = df.select(model.tenure_at(F.lit(dt.date(2021, 6, 30)), F.col("d").cast("date"))).collect()
    assert [float(r[0]) for r in got] == [0.0, 2.0, 2.0]  # 15, 45 and 75 days


def test_split_is_stable_and_complete(table):
    labelled = model.label_attrition(table, REF)
    train, test = model.split_by_key(labelled)
    again, _ = model.split_by_key(labelled.repartition(7))
    assert rows(train, "matricula") == rows(again, "matricula")
    assert train.count() + test.count() == labelled.count()
    assert 0.70 < train.count() / labelled.count() < 0.80


def test_class_weights_balance(table):
    weighted = model.with_class_weight(model.label_attrition(table, REF))
    sums = [r["w"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert sums[0] == pytest.approx(sums[1])


def test_model_finds_the_cause(table, fitted, tmp_path):
    forest, train, test = fitted
    assert model.importances(forest, table).first()["feature"] == "engajamento_score_base"
    scores = model.score_attrition(forest, table, "2022-06-30").persist()
    metrics = model.model_metrics(forest, train, test, scores, REF)
    row = metrics.first()
    assert row["roc_auc"] > 0.65 and len(row["fatores_risco_top5"]) == 5
    banded = [row[f"colaboradores_risco_{b}"] for b in ("alto", "medio", "baixo")]
    assert sum(banded) == scores.where("faixa_risco is not null").count()
    verdict = {r["check"]: r["passed"] for r in model.model_gate(metrics, scores).collect()}
    assert all(verdict.values()), verdict
    strict = model.model_gate(metrics, scores, min_scores=10**6, leading="idade").where("not passed")
    assert rows(strict, "check") == [("leading_factor:idade",), ("scored_rows",)]
    model.save_model(forest, str(tmp_path / "m"))
    again = model.score_attrition(model.load_model(table.sparkSession, str(tmp_path / "m")), table, "2022-06-30")
    assert rows(again, "matricula", "risco_attrition_score") == rows(scores, "matricula", "risco_attrition_score")


def test_unseen_category_is_scored(table, fitted):
    odd = table.where("status = 'Ativo'").limit(5).withColumn("cidade", F.lit("Nova cidade"))
    assert model.score_attrition(fitted[0], odd, "2022-06-30").where("risco_attrition_score is null").count() == 0


def test_rankings(spark):
    scores = spark.createDataFrame(
        [(1, "a", 0.2, "Médio"), (2, "a", 0.5, "Alto"), (3, "b", 0.5, "Alto")],
        "matricula long, area string, risco_attrition_score double, faixa_risco string")
    assert rows(kpis.risk_by_area(scores), "area", "headcount", "risco_medio", "qtd_alto_risco") == [
        ("a", 2, 0.35, 1), ("b", 1, 0.5, 1)]
    full = scores.select("*", *[F.lit(0).alias(c) for c in (
        "cargo", "senioridade", "tempo_casa_meses_ref", "engajamento_score_base", "performance_score")])
    assert [r["matricula"] for r in kpis.top_risk(full, 2).collect()] == [2, 3]


def test_temporal_holdout_needs_a_gap(table):
    with pytest.raises(ValueError):
        model.temporal_holdout(table, "2021-06-30", "2022-01-01")
    train, test = model.temporal_holdout(table, "2020-06-30", "2021-06-30")
    assert train.count() > 0 and test.count() > 0


def test_retrain_on_first_monday(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-08",), ("2024-02-05",), ("2024-02-06",)], "d string")
    got = days.where(model.is_retrain_day(F.col("d").cast("date")))
    assert rows(got, "d") == [("2024-01-01",), ("2024-02-05",)]


def test_a_category_may_have_any_number_of_values(table):
    """A city of its own for everyone: nothing is indexed, nothing is refused, unseen cities are scored."""
    labelled = model.label_attrition(table, REF).withColumn("cidade", F.col("matricula").cast("string"))
    forest = model.train_attrition(labelled, trees=2)
    assert set(forest.means) == {"cidade"} and "cidade_mean" in forest.stages[-2].getInputCols()
    assert model.score_attrition(forest, table, "2022-06-30").where("risco_attrition_score is null").count() == 0


def test_metrics_take_exact_shares_of_each_class(table):
    labelled = model.label_attrition(table, REF)
    train, test = model.split_rows(labelled, Store(table.sparkSession, "test-split"))
    all_of, taken = ({r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
                     for df in (labelled, train))
    assert taken == {label: n * 75 // 100 for label, n in all_of.items()}
    assert train.count() + test.count() == labelled.count()


def test_daily_step_trains_on_the_first_monday_only(spark, table, tmp_path):
    store, path = Store(spark, "test-attrition"), str(tmp_path / "model")
    monday, tuesday = dt.date(2022, 7, 4), dt.date(2022, 7, 5)
    trained = attrition.run(table, monday, path, store, ref=dt.date(2021, 6, 30), trees=20)
    assert trained.metrics.first()["roc_auc"] > 0.6
    scored = attrition.run(table, tuesday, path, store)
    assert scored.metrics is None and scored.scores.count() == trained.scores.count()
    assert scored.top_risk.count() == 20 and scored.risk_by_area.count() == 3


def test_rejected_model_is_not_saved(spark, table, tmp_path):
    path = tmp_path / "model"
    nobody = table.withColumn("engajamento_score_base", F.rand(1) * 0 + 5)
    with pytest.raises(GateFailed):
        attrition.run(nobody, dt.date(2022, 7, 5), str(path), Store(spark, "test-reject"), ref=dt.date(2021, 6, 30),
                      train=True, trees=5)
    assert not path.exists()


def test_forest_does_not_depend_on_the_input_partitions(spark, table):
    labelled = model.label_attrition(table, REF)
    one, many = (model.importances(model.train_attrition(labelled.repartition(n), trees=8), labelled).collect()
                 for n in (2, 7))
    assert one == many


def test_only_what_the_trees_see_is_shuffled(table, monkeypatch):
    seen, spread = [], model.spread
    monkeypatch.setattr(model, "spread", lambda df, *more: seen.append(df.columns) or spread(df, *more))
    model.train_attrition(model.label_attrition(table, REF), trees=2)
    assert [set(c) for c in seen] == [
        {"matricula", "label", "weight", "cidade_mean", *model.NUMERIC, *model.CATEGORICAL}]
