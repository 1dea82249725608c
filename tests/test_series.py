from __future__ import annotations

import calendar
import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import kpis, planning, repair, series


def dated(df):
    return repair.parse_dates(df)


def person(i, start, end=None, kind="Voluntário", **more):
    gone = {"data_desligamento": end, "tipo_desligamento": kind, "status": "Desligado"} if end else {}
    return {"matricula": i, "data_admissao": start, **gone, **more}


def month_rows(df, start, end):
    return {r["competencia"]: r.asDict() for r in series.monthly_series(dated(df), start, end).collect()}


def test_spine_starts_at_the_first_month_start_on_or_after():
    assert series.spine_bounds("2023-07-16", "2026-06-30") == (dt.date(2023, 8, 1), dt.date(2026, 6, 1))
    assert series.spine_bounds("2023-07-01", "2023-07-02") == (dt.date(2023, 7, 1), dt.date(2023, 7, 1))


def test_exit_on_first_and_last_day(people):
    df = people(person(1, "2019-05-10", "2020-03-01"), person(2, "2019-05-10", "2020-03-31"), person(3, "2019-01-01"))
    got = month_rows(df, "2020-02-01", "2020-04-30")
    assert got["2020-02"]["headcount_total"] == 3
    # Who leaves on day 1 is out of that month's opening headcount; who leaves on the last day is out at its close.
    assert got["2020-03"]["turnover_mensal_pct"] == 100.0
    assert [got[m]["headcount_total"] for m in ("2020-03", "2020-04")] == [1, 1]
    assert got["2020-03"]["desligamentos"] == 2


def test_in_and_out_within_a_month(people):
    got = month_rows(people(person(1, "2020-03-05", "2020-03-20")), "2020-02-01", "2020-04-30")
    assert [(got[m]["headcount_total"], got[m]["admissoes"], got[m]["desligamentos"]) for m in sorted(got)] == [
        (0, 0, 0), (0, 1, 1), (0, 0, 0)]
    assert got["2020-03"]["engajamento_medio"] is None and got["2020-03"]["enps"] is None


def test_missing_measures_are_left_out_of_means(people):
    df = people(person(1, "2019-01-01", engajamento_score_base=None), person(2, "2019-01-01", engajamento_score_base=6.0))
    got = month_rows(df, "2020-01-01", "2020-01-31")["2020-01"]
    assert (got["engajamento_medio"], got["enps"], got["custo_folha_total"]) == (6.0, 22.0, 10000.0)


def test_trend_by_year(people):
    df = people(person(1, "2019-01-01", engajamento_score_base=6.0))
    got = month_rows(df, "2023-12-01", "2026-01-31")
    assert [got[m]["enps"] for m in ("2023-12", "2024-01", "2025-01", "2026-01")] == [22.0, 15.0, 18.0, 22.0]


def brute(data, start, end, dims):
    """The range join, person by person and month by month."""
    out = {}
    first, last = series.spine_bounds(start, end)
    m = first
    while m <= last:
        close = m.replace(day=calendar.monthrange(m.year, m.month)[1])
        for p in data:
            s = dt.date.fromisoformat(p["data_admissao"])
            e = p.get("data_desligamento") and dt.date.fromisoformat(p["data_desligamento"])
            key = (m, *[p[d] for d in dims])
            cell = out.setdefault(key, [0, 0, 0, 0, 0])
            cell[0] += s <= close and (e is None or e > close)
            cell[1] += s <= m and (e is None or e > m)
            cell[2] += (s.year, s.month) == (m.year, m.month)
            cell[3] += bool(e) and (e.year, e.month) == (m.year, m.month)
            cell[4] += int(p["salario_mensal"]) * (s <= close and (e is None or e > close))
        m = dt.date(m.year + m.month // 12, m.month % 12 + 1, 1)
    return {k: tuple(v) for k, v in out.items() if any(v)}


@pytest.mark.parametrize("dims", [[], ["area"], ["area", "genero"]])
def test_running_sums_equal_the_range_join(people, dims):
    rnd = random.Random(7)
    data = []
    for i in range(300):
        s = dt.date(2018, 1, 1) + dt.timedelta(days=rnd.choice([rnd.randrange(1500), 31, 59, 730]))
        e = s + dt.timedelta(days=rnd.randrange(900)) if rnd.random() < 0.6 else None
        data.append(person(
            i, s.isoformat(), e and e.isoformat(), area=rnd.choice(["RH", "Marketing", "RH"]),
            genero=rnd.choice(["a", "b"]), salario_mensal=float(rnd.randrange(1000, 9000))))
    cells = series.headcount_cells(
        dated(people(*data)), dt.date(2019, 1, 1), dt.date(2021, 6, 1), dims, {"salario_mensal": "decimal(18,2)"})
    got = {
        (r["month"], *[r[d] for d in dims]): (
            r["headcount"], r["opening"], r["admissoes"], r["desligamentos"], int(r["sum_salario_mensal"] or 0))
        for r in cells.collect()}
    assert {k: v for k, v in got.items() if any(v)} == brute(data, "2019-01-01", "2021-06-30", dims)


def test_opening_plus_flows_gives_closing(people):
    df = people(*[person(i, f"2020-0{1 + i % 5}-1{i % 9}", f"2020-0{6 + i % 3}-2{i % 9}" if i % 2 else None)
                  for i in range(40)])
    cells = series.headcount_cells(dated(df), dt.date(2020, 1, 1), dt.date(2020, 12, 1), ["area"], {})
    assert cells.where("opening + admissoes - desligamentos <> headcount").count() == 0


def test_end_before_start_never_counts_as_active(people):
    df = people(person(1, "2020-05-10", "2020-02-10"))
    got = month_rows(df, "2020-01-01", "2020-06-30")
    assert {m: (r["headcount_total"], r["desligamentos"]) for m, r in got.items() if r["headcount_total"] or r["desligamentos"]} == {
        "2020-02": (0, 1)}


def test_granular_skips_cells_without_people(people):
    df = people(person(1, "2020-01-10", "2020-02-10", genero="a"), person(2, "2020-01-10", genero="b"))
    got = series.granular_series(dated(df), "2020-01-01", "2020-02-28")
    assert rows(got, "competencia", "genero", "headcount", "desligamentos") == [
        ("2020-01", "a", 1, 0), ("2020-01", "b", 1, 0), ("2020-02", "b", 1, 0)]


def test_cohorts_keep_months_without_admissions(people):
    df = dated(people(person(1, "2020-01-10", "2020-03-10"), person(2, "2020-01-10")))
    a, d = series.admissions_cohort(df), series.departures_by_area(df)
    assert rows(series.cohort_join(a, d), "competencia", "admissoes", "desligamentos", "salario_medio") == [
        ("2020-01", 2, 0, 5000.0), ("2020-03", 0, 1, None)]
    assert rows(series.cohort_join_strict(a, d), "competencia", "admissoes", "desligamentos") == [("2020-01", 2, 0)]


def test_area_of_one_person_has_no_deviation(people):
    got = kpis.area_risk_proxy(dated(people({"engajamento_score_base": 8.0}))).first()
    assert got["engajamento_std"] is None and got["risco_proxy"] == pytest.approx(1.4)


def test_nine_box_edges(people):
    df = people({"performance_score": 4.0, "engajamento_score_base": 7.5, "tempo_casa_meses": 60},
                {"performance_score": 3.0, "engajamento_score_base": 7.5, "tempo_casa_meses": 61},
                {"performance_score": 2.9, "engajamento_score_base": 5.9})
    assert rows(kpis.nine_box(dated(df)), "perf_box", "pot_box", "headcount") == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]


def test_root_cause_ties_and_actions(people):
    r = "Aposentadoria"
    df = dated(people(
        person(1, "2020-01-01", "2021-01-01", area="RH", motivo_desligamento=r),
        person(2, "2020-01-01", "2021-01-01", area="Marketing", motivo_desligamento=r),
        person(3, "2020-01-01", "2021-01-01", area="RH", motivo_desligamento="Novo"),
        person(4, "2020-01-01", "2021-01-01", "Involuntário", area="RH", motivo_desligamento="Baixa performance")))
    causes = kpis.root_cause(df)
    assert rows(causes, "causa_raiz_desc", "area_predominante", "total_desligamentos", "pct_do_total_voluntario") == [
        ("Aposentadoria", "Marketing", 2, 66.7), ("Novo", "RH", 1, 33.3)]
    assert rows(causes.where("causa_raiz_desc = 'Novo'"), "itens_configuracao") == [(["Processo-RH-Generico"],)]
    assert rows(planning.action_plan(causes), "id", "prioridade", "horizonte_dias", "responsavel") == [
        ("PA001", "Alta", 30, "RH Business Partner"), ("PA002", "Alta", 30, "Liderança de Área")]


def test_kpi_cover_uses_the_thirteenth_last_month(spark):
    months = [(f"2020-{m:02d}" if m <= 12 else "2021-01", 100 + m, 2, 10.0, 90.0, 1.0) for m in range(1, 14)]
    df = spark.createDataFrame(
        months, "competencia string, headcount_total long, desligamentos long, enps double, produtividade_index double, "
                "custo_folha_total double")
    assert rows(kpis.kpi_cover(df), "competencia", "headcount_atual", "turnover_ltm_pct") == [
        ("2021-01", 113, 23.8)]
    assert kpis.kpi_cover(df.limit(12)).first()["turnover_ltm_pct"] is None


def test_plan_uses_a_default_for_areas_without_people(spark):
    areas = spark.createDataFrame([("RH",), ("Marketing",)], "area string")
    head = spark.createDataFrame([("RH", 1000)], "area string, headcount long")
    got = planning.workforce_plan(head, areas, "2026-12-01", 2)
    assert rows(got, "competencia", "area", "headcount_planejado") == [
        ("2026-12", "Marketing", 50), ("2026-12", "RH", 1004), ("2027-01", "Marketing", 50), ("2027-01", "RH", 1008)]
    actual = spark.createDataFrame([("2026-12", "RH", 990)], "competencia string, area string, headcount long")
    assert rows(planning.plan_gap(got, actual).where("gap is not null"), "area", "gap") == [("RH", -14)]


def test_funnel_counts_people_once(spark):
    events = spark.createDataFrame(
        [(1, "view", "2024-01-01 00:00:00"), (1, "view", "2024-01-02 00:00:00"), (1, "purchase", "2024-01-03 12:00:00"),
         (2, "view", "2024-01-01 00:00:00"), (3, "error", "2024-01-01 00:00:00")],
        "user_id long, event_type string, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = kpis.funnel(events, ["view", "purchase"], {"mes": F.date_format("ts", "yyyy-MM")})
    assert rows(got, "mes", "view", "purchase", "view_to_purchase", "mean_days") == [("2024-01", 2, 1, 0.5, 2.5)]
