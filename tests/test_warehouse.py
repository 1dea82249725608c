from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from rollcall.functions import age_band, risk_band, salary_band
from rollcall.operators import repair, warehouse
from rollcall.plans.silver import silver


def history(spark, *data):
    return spark.createDataFrame(data, "k long, a string, day string").withColumn("day", F.col("day").cast("date"))


def test_versions_open_and_close(spark):
    df = history(spark, (1, "A", "2020-01-01"), (1, "B", "2020-02-01"), (1, "A", "2020-03-01"), (1, "A", "2020-04-01"),
                 (2, None, "2020-01-01"), (2, None, "2020-02-01"), (2, "A", "2020-03-01"))
    got = warehouse.scd2(df, ["k"], "day", ["a"])
    assert rows(got, "k", "version", "a", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"),
                "is_current") == [
        (1, 1, "A", "2020-01-01", "2020-01-31", False), (1, 2, "B", "2020-02-01", "2020-02-29", False),
        (1, 3, "A", "2020-03-01", None, True), (2, 1, None, "2020-01-01", "2020-02-29", False),
        (2, 2, "A", "2020-03-01", None, True)]


def test_repeated_snapshot_rows_make_no_version(spark):
    df = history(spark, (1, "A", "2020-01-01"), (1, "A", "2020-01-01"), (1, "A", "2020-02-01"))
    assert warehouse.scd2(df, ["k"], "day", ["a"]).count() == 1


def test_hot_key_in_snapshots(spark):
    df = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("A").alias("a"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 5).cast("int")).alias("day"))
    got = warehouse.scd2(df, ["k"], "day", ["a"])
    assert got.count() == 6001 and got.where("k = -1").count() == 1


def test_departure_meets_the_version_of_its_day(spark, people):
    left = {"status": "Desligado", "tipo_desligamento": "Voluntário", "motivo_desligamento": "Aposentadoria"}
    table = silver(people(
        {"matricula": 1, "data_desligamento": "2020-02-29", **left}, {"matricula": 2, "data_desligamento": "2020-03-01", **left},
        {"matricula": 3, "data_desligamento": "2020-01-20", **left, "motivo_desligamento": "Novo"}, {"matricula": 4}))
    days = F.explode(F.array(*[F.lit(dt.date(2020, m, 1)) for m in (2, 3)]))
    snaps = table.withColumn("snapshot_date", days).withColumn(
        "cargo", F.when(F.month("snapshot_date") == 3, F.lit("Novo cargo")).otherwise(F.col("cargo")))
    areas, reasons = warehouse.dim_area(spark), warehouse.dim_reason(spark)
    employees = warehouse.dim_employee(snaps, areas)
    fact = warehouse.fact_departure(table, employees, areas, reasons)
    assert rows(fact, "sk_colaborador", "sk_area", "sk_motivo", "sk_data_deslig", "tempo_casa_dias") == [
        ("1-1", 7, 8, 20200229, 45), ("2-2", 7, 8, 20200301, 46), ("3-1", 7, None, 20200120, 5)]
    assert float(fact.first()["custo_estimado_turnover"]) == 7500.0
    costs = warehouse.turnover_cost_ltm(fact, warehouse.dim_date(spark, "2020-01-01", "2020-12-31"), areas, "2020-02-29")
    assert [(r["area"], r["total_desligamentos"], float(r["custo_total_turnover"])) for r in costs.collect()] == [
        ("RH", 2, 15000.0)]


def test_departures_of_any_date_and_value_have_keys_of_their_own(spark, people):
    left = {"status": "Desligado", "data_admissao": "1960-01-01", "performance_score": 10.0, "salario_mensal": 90000.0}
    table = repair.parse_dates(people(
        {"matricula": 101, "data_desligamento": "1969-12-31", **left},
        {"matricula": 100, "data_desligamento": "2243-10-16", **left}))
    areas, reasons = warehouse.dim_area(spark), warehouse.dim_reason(spark)
    employees = warehouse.dim_employee(table.withColumn("snapshot_date", F.lit(dt.date(2020, 1, 1))), areas)
    fact = warehouse.fact_departure(table, employees, areas, reasons)
    assert rows(fact, "sk_desligamento", F.col("performance_ultimo").cast("double")) == [
        ("100-2243-10-16", 10.0), ("101-1969-12-31", 10.0)]


def test_calendar(spark):
    got = {r["sk_data"]: r for r in warehouse.dim_date(spark, "2023-12-30", "2024-01-01").collect()}
    day = got[20231231]
    assert (day["dia_semana"], day["nome_dia_semana"], day["e_fim_de_semana"]) == (1, "Domingo", True)
    assert (day["nome_mes"], day["semestre"], day["trimestre"], day["semana_ano"]) == ("Dezembro", 2, 4, 52)
    assert got[20240101]["competencia"] == "2024-01" and not got[20240101]["e_feriado_nacional"]


def test_calendar_spans_all_dates(spark, people):
    df = repair.parse_dates(people({"data_admissao": "2020-01-02", "data_desligamento": None},
                                   {"data_admissao": "2020-01-05", "data_desligamento": "2020-01-09"}))
    assert warehouse.dim_date_for(df).count() == 8


def test_seeded_dimensions(spark):
    assert warehouse.dim_area(spark).count() == 10 and warehouse.dim_reason(spark).count() == 9


def test_facts_of_cells_without_people(people, spark):
    df = repair.parse_dates(people({"data_admissao": "2020-01-10", "data_desligamento": "2020-02-10",
                                    "tipo_desligamento": "Voluntário"}))
    fact = warehouse.fact_headcount(df, warehouse.dim_area(spark), "2020-01-01", "2020-04-30")
    assert rows(fact, "competencia", "headcount", "desligamentos", "turnover_mensal_pct") == [
        ("2020-01", 1, 0, 0), ("2020-02", 0, 1, 100)]


def test_keys_of_cells_with_nulls_and_separators(people, spark):
    names = ("a", 'b","c'), ('a","b', "c"), (None, "a"), ("a", None), ("", "a")
    df = repair.parse_dates(people(*[{"matricula": i, "area": a, "senioridade": s} for i, (a, s) in enumerate(names)]))
    fact = warehouse.fact_headcount(df, warehouse.dim_area(spark), "2020-01-01", "2020-01-31")
    assert rows(fact, "sk_headcount") == sorted(
        [('["2020-01","a","b\\",\\"c"]',), ('["2020-01","a\\",\\"b","c"]',), ('["2020-01",null,"a"]',),
         ('["2020-01","a",null]',), ('["2020-01","","a"]',)], key=repr)


def test_turnover_of_thirteen_months(spark):
    fact = spark.createDataFrame(
        [(7, "2019-12", "x", 10, 5, 5), (7, "2020-01", "x", 10, 1, 0), (7, "2020-01", "y", 30, 1, 1),
         (7, "2021-01", "x", 20, 2, 0)],
        "sk_area int, competencia string, senioridade string, headcount long, desligamentos long, desligamentos_vol long")
    got = warehouse.turnover_ltm(fact, warehouse.dim_area(spark), "2021-01-31").collect()
    assert [(r["total_desligamentos"], r["headcount_medio"], r["turnover_ltm_pct"], r["turnover_ltm_pct_area"],
             r["pct_voluntario"]) for r in got] == [(4, 20.0, 20.0, 13.3, 25.0)]


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.15,), (0.1501,), (0.35,), (1.0,), (1.01,)], "s double")
    assert [r[0] for r in df.select(risk_band(F.col("s"))).collect()] == [None, "Baixo", "Médio", "Médio", "Alto", None]
    ages = spark.createDataFrame([(17,), (18,), (24,), (25,), (54,), (55,), (None,)], "a int")
    assert [r[0] for r in ages.select(age_band(F.col("a"))).collect()] == [
        None, "18-24", "18-24", "25-34", "45-54", "55+", None]
    pay = spark.createDataFrame([(5000.0,), (5000.01,), (10000.0,), (20000.0,), (None,)], "p double")
    assert [r[0] for r in pay.select(salary_band(F.col("p"))).collect()] == [
        "Até 5k", "5-10k", "10-20k", "20k+", None]
