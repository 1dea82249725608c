from __future__ import annotations

import datetime as dt
import math

from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import repair
from rollcall.plans.silver import quality_log, silver, staged_silver
from rollcall.sources import Store


def test_category_spellings(people):
    df = people(*[{"area": a} for a in (" operações ", "OPERACOES", "TECNOLOGIA ", " Outra ", None)])
    assert rows(repair.normalize_category(df), "area") == [
        ("Operações",), ("Operações",), ("Outra",), ("Tecnologia",), (None,)]


def test_out_of_range_becomes_null(people):
    values = (0.0, 10.0, -1.0, 10.01, math.nan, None)
    df = people(*[{"matricula": i, "engajamento_score_base": v} for i, v in enumerate(values)])
    got = rows(repair.null_out_of_range(df, "engajamento_score_base", 0, 10), "matricula", "engajamento_score_base")
    assert got == [(0, 0.0), (1, 10.0), (2, None), (3, None), (4, None), (5, None)]


def test_scale_error(people):
    cases = [("Júnior/Pleno", 27000.0), ("Júnior/Pleno", 27000.01), ("Desconhecida", 500000.0), ("Liderança", None)]
    df = people(*[{"matricula": i, "senioridade": s, "salario_mensal": v} for i, (s, v) in enumerate(cases)])
    got = rows(repair.fix_scale(df, "salario_mensal", "senioridade"), "matricula", "salario_mensal")
    assert got == [(0, 27000.0), (1, 270.0001), (2, 500000.0), (3, None)]


def test_missing_demographics_are_labelled(people):
    assert rows(repair.label_missing(people({"genero": None}), ["genero", "raca_cor"]), "genero", "raca_cor") == [
        ("Não informado", "Parda")]


def test_unreadable_dates_become_null(people):
    df = people(*[{"matricula": i, "data_desligamento": d} for i, d in enumerate(("xx", "", "2021-02-30", "2021-02-01"))])
    got = rows(repair.parse_dates(df), "matricula", "data_desligamento")
    assert got == [(0, None), (1, None), (2, None), (3, dt.date(2021, 2, 1))]


def test_interval_repair(people):
    left = {"status": "Desligado", "tipo_desligamento": "Voluntário", "motivo_desligamento": "m"}
    df = people({"matricula": 1, "data_desligamento": "2020-01-15", **left},
                {"matricula": 2, "data_desligamento": "2020-01-14", **left},
                {"matricula": 3, "data_desligamento": None, **left})
    got = repair.repair_interval(repair.parse_dates(df))
    assert rows(got, "matricula", F.col("data_desligamento").cast("string"), "motivo_desligamento", "status") == [
        (1, "2020-01-15", "m", "Desligado"), (2, None, None, "Ativo"), (3, None, "m", "Desligado")]


DEFECTS = [
    {"matricula": 1}, {"matricula": 1}, {"matricula": 1, "data_admissao": "2019-01-15"},
    {"matricula": 2, "area": "RH ", "engajamento_score_base": 99.0},
    {"matricula": 3, "area": "Nova", "salario_mensal": 500000.0, "genero": None, "raca_cor": None},
    {"matricula": 4, "salario_mensal": None, "engajamento_score_base": None},
    {"matricula": 5, "status": "Desligado", "data_desligamento": "2018-01-01", "tipo_desligamento": "Voluntário"},
    {"matricula": 6, "status": "Desligado", "data_desligamento": "xx"},
    {"matricula": 7, "status": "Ativo (corrigido)", "engajamento_score_base": math.nan},
]


def test_silver_and_its_log(spark, people):
    staged = staged_silver(people(*DEFECTS), Store(spark, "test-silver"))
    log = {r["step"]: r["rows"] for r in quality_log(staged).collect()}
    assert log == {
        "exact_duplicates_removed": 1, "key_duplicates_removed": 1, "area_normalized": 1, "area_unknown": 1,
        "engagement_out_of_range": 1, "engagement_imputed": 3, "salary_scale_fixed": 1, "salary_imputed": 1,
        "gender_labelled": 1, "race_labelled": 1, "date_unreadable": 1, "interval_repaired": 1,
        "left_without_end_date": 1, "silver_rows": 7}


def test_silver_rows(people):
    got = silver(people(*DEFECTS))
    assert got.columns == people().columns
    assert rows(got, "matricula", "area", "salario_mensal", "engajamento_score_base", "status") == [
        (1, "RH", 5000.0, 7.0, "Ativo"), (2, "RH", 5000.0, 7.0, "Ativo"), (3, "Nova", 5000.0, 7.0, "Ativo"),
        (4, "RH", 5000.0, 7.0, "Ativo"), (5, "RH", 5000.0, 7.0, "Ativo"), (6, "RH", 5000.0, 7.0, "Desligado"),
        (7, "RH", 5000.0, 7.0, "Ativo")]


def test_silver_is_the_same_with_and_without_a_store(spark, people):
    bronze = people(*DEFECTS)
    assert rows(silver(bronze), "*") == rows(silver(bronze, Store(spark, "test-same")), "*")
    assert rows(silver(bronze), "*") == rows(silver(bronze, approx=True), "*")


def test_cleaning_silver_again_changes_nothing(people):
    once = silver(people(*DEFECTS))
    text = once.withColumns({c: F.col(c).cast("string") for c in ("data_admissao", "data_desligamento")})
    assert rows(silver(text), "*") == rows(once, "*")
