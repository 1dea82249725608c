from __future__ import annotations

import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import quality
from rollcall.plans.silver import silver


def verdicts(df):
    return {r["check"]: (r["observed"], r["passed"]) for r in df.collect()}


def test_gate_counts_and_raises(people):
    df = people({"matricula": 1}, {"matricula": 1}, {"matricula": None, "salario_mensal": 1319.99},
                {"matricula": 2, "engajamento_score_base": 10.01, "data_admissao": "2000-01-01"})
    gate = quality.bronze_gate(df, min_rows=4)
    assert verdicts(gate) == {
        "min_rows": (4.0, True), "key_nulls": (1.0, False), "copies_share": (0.25, False),
        "salary_range": (1.0, False), "engagement_range": (1.0, False), "start_date": (1.0, False)}
    with pytest.raises(quality.GateFailed, match="key_nulls"):
        quality.require(gate)


def test_gate_passes_clean_rows_and_tolerates_what_it_is_told_to(people):
    df = people({"matricula": 1}, {"matricula": 2, "salario_mensal": 500000.0})
    quality.require(quality.bronze_gate(df, min_rows=2, max_out_of_range=1))
    with pytest.raises(quality.GateFailed):
        quality.require(quality.bronze_gate(df, min_rows=2))


def test_gate_on_an_empty_table(people):
    assert not verdicts(quality.bronze_gate(people(), min_rows=1))["min_rows"][1]


def test_sla_has_three_states(people):
    df = people(*[{"matricula": i, "engajamento_score_base": 11.0 if i == 0 else 7.0} for i in range(150)], {"matricula": 5})
    got = {r["metric"]: r["state"] for r in quality.quality_sla(df, auc=0.55).collect()}
    assert got == {"key_completeness": "ok", "copies_share": "warn", "engagement_in_range": "warn", "model_auc": "alert"}


def test_expectations_on_bronze(people):
    df = people({"matricula": 0, "area": "Nova"}, {"matricula": 2, "area": "TECNOLOGIA "})
    assert verdicts(quality.expectations_bronze(df, min_rows=2)) == {
        "min_rows": (2.0, True), "not_null:matricula": (0.0, True), "positive:matricula": (1.0, False),
        "domain_share:area": (0.5, False), "columns": (0.0, True), "copies_share": (0.0, True)}
    assert verdicts(quality.expect_columns(df.drop("area"), quality.REQUIRED_BRONZE))["columns"] == (1.0, False)


def test_expectations_on_silver(people):
    bronze = people(*[{"matricula": i, "senioridade": s} for i, s in enumerate(["Liderança"] * 7 + ["Júnior/Pleno"] * 3)])
    good = verdicts(quality.expectations_silver(silver(bronze), bronze))
    assert all(passed for _, passed in good.values()) and good["max_share:senioridade"] == (0.7, True)
    doubled = silver(bronze).unionAll(silver(bronze).withColumn("area", F.lit("RH ")))
    bad = verdicts(quality.expectations_silver(doubled, bronze))
    assert bad["unique:matricula"] == (10.0, False) and bad["trimmed:area"] == (10.0, False)


def test_keys_and_references(people):
    df = people({"matricula": 1}, {"matricula": 1}, {"matricula": None}, {"matricula": 3, "gestor_matricula": 9},
                {"matricula": 4, "gestor_matricula": 9}, {"matricula": 5, "gestor_matricula": 3})
    assert rows(quality.check_pk(df, ["matricula"]), "matricula", "rows") == [(1, 2), (None, 1)]
    assert rows(quality.check_fk(df, "gestor_matricula", df, "matricula"), "gestor_matricula", "rows") == [(9, 2)]
    nulls = {r["column"]: r["nulls"] for r in quality.check_not_null(df, ["matricula", "area"]).collect()}
    assert nulls == {"matricula": 1, "area": 0}


def test_counts(people):
    df = people({"area": "Nova", "cargo": None, "gestor_matricula": None}, {"area": None})
    assert quality.unexpected_nulls(df).first()[0] == 2
    assert quality.count_unknown(df).first()[0] == 1
    assert rows(quality.values_outside(df, "area", ["RH"]), "area") == [("Nova",)]
    assert rows(quality.dimension_members(df, ["area", "genero"]), "dimension", "member") == [
        ("area", "Nova"), ("genero", "Feminino")]


def test_personal_data(people):
    df = people({"matricula": 7, "gestor_matricula": 8}, {"matricula": 8, "gestor_matricula": None})
    got = quality.protect_pii(df, "s")
    assert not {"genero", "raca_cor", "salario_mensal"} & set(got.columns)
    seven, eight = (hashlib.sha256(f"s{k}".encode()).hexdigest() for k in (7, 8))
    assert set(rows(got, "matricula", "gestor_matricula", "nome_ficticio")) == {
        (seven, eight, "***"), (eight, None, "***")}


def test_small_cells_are_hidden(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("b", 5, 2.0)], "g string, n long, m double")
    assert rows(quality.suppress_small_cells(df, "n", 5, ["m"]), "g", "n", "m") == [("a", None, None), ("b", 5, 2.0)]
