"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.columns import COLUMNS
from checks.spec import shape_frame
from rollcall.fixed_values import (
    ACTIVE, ACTIVE_CORRECTED, AREAS, ENGAGEMENT_SCALE, LEADER, LEFT)
from rollcall.functions import active_at, age_band, month_key, risk_band, salary_band
from rollcall.functions.numbers import MONEY, exact_mean
from rollcall.operators import (
    dedup, encoding, joins, kpis, medians, model, planning, quality, ranking, repair, series, warehouse)
from rollcall.plans import dimension, export
from rollcall.plans.silver import clean_columns, quality_log, repair_rows, silver, staged_silver
from rollcall.schema import END, ENGAGEMENT, KEY, KIND, REASON, SALARY, START
from rollcall.session import partitions_for, size_shuffles
from rollcall.sources import (
    Store, bronze_view, order_count, read_bronze, read_silver, snapshots, write_bucketed, write_csv, write_silver)
from rollcall.sources.trade_view import REFERENCE_DATE, SNAPSHOT_DATES
from rollcall.streaming import clean_exports, current_view, ingest_increment, read_exports, refresh_exports
from rollcall.streaming.intake import EXPORT_DATE, ledger, read_history, read_quarantine

SERIES = ("1998-08-17", REFERENCE_DATE)
LABEL_DATE = "2000-07-31"
PLAN_DATE = "2001-02-28"
STAGES = ("view", "click", "signup", "purchase")
MIN_CELL = 10


class Tables:
    """Tables that several queries read, each built once per session and folder, as the daily job would."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.store = Store(spark, f"checks-{uuid.uuid4().hex[:8]}")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def bronze(self) -> DataFrame:
        tasks = partitions_for(self.people)
        return bronze_view(
            self.spark, self.folder, tasks if tasks > self.spark.sparkContext.defaultParallelism else 0)

    @cached_property
    def people(self) -> int:
        """One per order. Shuffles of this session are sized by it."""
        n = order_count(self.spark, self.folder)
        size_shuffles(self.spark, n)
        return n

    @cached_property
    def staged(self) -> DataFrame:
        return self.store.keep(staged_silver(self.bronze, self.store), "staged")

    @property
    def silver(self) -> DataFrame:
        return clean_columns(self.staged)

    @property
    def areas(self) -> DataFrame:
        return warehouse.dim_area(self.spark)

    @property
    def reasons(self) -> DataFrame:
        return warehouse.dim_reason(self.spark)

    @cached_property
    def employees(self) -> DataFrame:
        return self.store.keep(warehouse.dim_employee(snapshots(self.silver), self.areas, unique=True), "dim_employee")

    @cached_property
    def departures(self) -> DataFrame:
        return self.store.keep(_fact_departure(self), "fct_desligamento")

    @cached_property
    def careers(self) -> DataFrame:
        """Departures with careers, from tables placed by person."""
        buckets = size_shuffles(self.spark, self.people)
        placed = [write_bucketed(df, self.store.path(f"placed_{name}"), "nk_matricula", buckets)
                  for name, df in (("fct_desligamento", self.departures), ("dim_colaborador", self.employees))]
        return warehouse.departure_careers(*placed)

    @cached_property
    def headcount(self) -> DataFrame:
        return self.store.keep(_fact_headcount(self), "fct_headcount_mensal")

    @property
    def labelled(self) -> DataFrame:
        return model.label_attrition(self.silver, LABEL_DATE)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return model.split_rows(self.labelled, self.store)

    @cached_property
    def forest(self):
        path = self.store.path("attrition_model")
        model.save_model(model.train_attrition(self.split[0], store=self.store), path)
        return model.load_model(self.spark, path)

    @cached_property
    def scores(self) -> DataFrame:
        return self.store.keep(model.score_attrition(self.forest, self.silver, REFERENCE_DATE), "scores")

    @cached_property
    def metrics(self) -> DataFrame:
        return self.store.keep(
            model.model_metrics(self.forest, *self.split, self.scores, LABEL_DATE), "metrics")

    def scratch(self, name: str) -> Store:
        return Store(self.spark, f"{name}-{uuid.uuid4().hex[:8]}")


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, folder)
    return _TABLES[key]


# --- quality -------------------------------------------------------------------------------------------

def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in (START, END)})


def _impute_engagement(t: Tables) -> DataFrame:
    rows = repair.normalize_category(t.bronze)
    rows = repair.null_out_of_range(rows, ENGAGEMENT, *ENGAGEMENT_SCALE)
    return medians.impute_median(rows, ENGAGEMENT, ["area"], t.scratch("impute"))


def _impute_salary(t: Tables) -> DataFrame:
    rows = repair.fix_scale(repair.normalize_category(t.bronze), SALARY, "senioridade")
    return medians.impute_median(rows, SALARY, ["area", "senioridade"], t.scratch("impute"))


def _repair_interval(t: Tables) -> DataFrame:
    return repair.repair_interval(repair.parse_dates(t.bronze))


def _replace_status(t: Tables) -> DataFrame:
    """Rows of repaired intervals carry the provisional status first, as an upstream system would send it."""
    broken = repair.ends_before_start(F.col(START), F.col(END))
    marked = repair.parse_dates(t.bronze).withColumn(
        "status", F.when(broken, F.lit(ACTIVE_CORRECTED)).otherwise(F.col("status")))
    return dedup.replace_values(marked, "status", {ACTIVE_CORRECTED: ACTIVE})


def _bronze_gate(t: Tables) -> DataFrame:
    return quality.bronze_gate(t.bronze)


def _suppressed(t: Tables) -> DataFrame:
    return quality.sensitive_aggregate(
        t.silver.where(F.col("status") == LEFT), ["area", "raca_cor"],
        {"salario_medio": exact_mean(F.col(SALARY), MONEY)}, MIN_CELL)


def _check_fk(t: Tables) -> DataFrame:
    """Managers named who are not leaders."""
    leaders = t.silver.where(F.col("senioridade") == LEADER)
    return quality.check_fk(t.silver, "gestor_matricula", leaders, KEY)


def _group_median(t: Tables) -> DataFrame:
    return medians.group_median(repair.normalize_category(t.bronze), ["area", "senioridade"], SALARY)


# --- series, indicators, planning ----------------------------------------------------------------------

def _cohorts(t: Tables, join: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    return join(series.admissions_cohort(t.silver), series.departures_by_area(t.silver))


def _root_cause(t: Tables) -> DataFrame:
    causes = kpis.root_cause(t.silver)
    return causes.withColumn("itens_configuracao", F.array_join("itens_configuracao", "|"))


def _workforce_plan(t: Tables) -> DataFrame:
    return planning.workforce_plan(series.headcount_by_area(t.silver), t.areas, dt.date(2001, 9, 1))


def _plan_gap(t: Tables) -> DataFrame:
    base = series.active(t.silver, PLAN_DATE).groupBy("area").agg(F.count(F.lit(1)).alias("headcount"))
    plan = planning.workforce_plan(base, t.areas, dt.date(2001, 3, 1))
    return planning.plan_gap(plan, series.productivity_by_area(t.silver, *SERIES))


# --- warehouse -----------------------------------------------------------------------------------------

def _dim_area(t: Tables) -> DataFrame:
    counts = series.headcount_by_area(t.silver)
    return t.areas.join(counts, "area", "left").fillna(0, ["headcount"])


def _dim_reason(t: Tables) -> DataFrame:
    counts = t.silver.where(F.col(END).isNotNull()).groupBy(F.col(REASON).alias("motivo")).agg(
        F.count(F.lit(1)).alias("desligamentos"))
    return t.reasons.join(counts, "motivo", "left").fillna(0, ["desligamentos"])


def _fact_departure(t: Tables) -> DataFrame:
    return warehouse.fact_departure(t.silver, t.employees, t.areas, t.reasons)


def _fact_headcount(t: Tables) -> DataFrame:
    return warehouse.fact_headcount(t.silver, t.areas, *SERIES)


def _scd2(t: Tables) -> DataFrame:
    return warehouse.scd2(snapshots(t.silver), [KEY], "snapshot_date", warehouse.TRACKED)


def _dim_employee_incremental(t: Tables) -> DataFrame:
    """The second snapshot first, then the first, which is late, then the third."""
    root, loaded = t.store.path(f"dimension-{uuid.uuid4().hex[:12]}"), []
    history = snapshots(t.silver).select(*warehouse.DESCRIBED, "snapshot_date")
    for n in (1, 0, 2):
        loaded.append(SNAPSHOT_DATES[n])
        dimension.load_snapshots(
            history.where(F.col("snapshot_date") == loaded[-1]), history.where(F.col("snapshot_date").isin(loaded)),
            root, [KEY], "snapshot_date", warehouse.TRACKED)
    return warehouse.dim_employee_of(dimension.read_dimension(t.spark, root), t.areas)


def _star_constraints(t: Tables) -> DataFrame:
    fact, dates = t.departures, warehouse.dim_date_for(t.silver)

    def violations(name: str, found: DataFrame) -> DataFrame:
        return found.agg(F.lit(name).alias("constraint_name"), F.count(F.lit(1)).alias("violations"))

    def nulls(name: str, df: DataFrame) -> DataFrame:
        return quality.check_not_null(df, df.columns).agg(
            F.lit(name).alias("constraint_name"), F.sum("nulls").alias("violations"))

    parts = [
        violations("pk_dim_colaborador", quality.check_pk(t.employees, ["sk_colaborador"])),
        violations("pk_fct_desligamento", quality.check_pk(fact, ["sk_desligamento"])),
        violations("fk_colaborador", quality.check_fk(fact, "sk_colaborador", t.employees, "sk_colaborador")),
        violations("fk_area", quality.check_fk(fact, "sk_area", t.areas, "sk_area")),
        violations("fk_motivo", quality.check_fk(fact, "sk_motivo", t.reasons, "sk_motivo")),
        violations("fk_data_deslig", quality.check_fk(fact, "sk_data_deslig", dates, "sk_data")),
        violations("fk_data_admissao", quality.check_fk(fact, "sk_data_admissao", dates, "sk_data")),
        violations("fk_colaborador_area", quality.check_fk(t.employees, "sk_area", t.areas, "sk_area")),
        violations("fk_headcount_area", quality.check_fk(t.headcount, "sk_area", t.areas, "sk_area")),
        violations("pk_dim_data", quality.check_pk(dates, ["sk_data"])),
        violations("pk_dim_area", quality.check_pk(t.areas, ["sk_area"])),
        violations("pk_dim_motivo", quality.check_pk(t.reasons, ["sk_motivo"])),
        violations("pk_fct_headcount", quality.check_pk(t.headcount, ["sk_headcount"])),
        *[nulls(f"not_null_{name}", df) for name, df in (
            ("dim_colaborador", t.employees.select("nk_matricula", "sk_area", "data_inicio_vigencia")),
            ("fct_desligamento", fact.select("sk_colaborador", "sk_area", "sk_motivo", "sk_data_deslig",
                                             "sk_data_admissao")),
            ("fct_headcount", t.headcount.select("sk_area", "competencia", "senioridade", "headcount")))],
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def _funnel(t: Tables) -> DataFrame:
    return kpis.funnel(t.raw("events"), STAGES, {"dia": F.to_date("ts")})


def _funnel_by_cohort(t: Tables) -> DataFrame:
    """By the month in which people began, and their market segment."""
    people = t.raw("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segmento"))
    return kpis.ordered_funnel(t.raw("events"), STAGES, t.scratch("funnel"), people, ["segmento"])


# --- model ---------------------------------------------------------------------------------------------

def _risk_band(t: Tables) -> DataFrame:
    """Bands of a score that takes the edges too: tenths of the engagement scale."""
    score = F.round((10 - F.col(ENGAGEMENT)) / 20, 4)
    return t.silver.select(KEY, score.alias("score"), risk_band(score).alias("faixa_risco"))


def _rule_auc(t: Tables) -> DataFrame:
    """How well engagement alone tells who leaves: scores in tenths, so nearly all of them are tied."""
    rated = t.labelled.select("label", F.round((10 - F.col(ENGAGEMENT)) / 20, 4).alias("score"))
    return ranking.roc_auc(rated, t.scratch("auc"))


def _sla_with_model(t: Tables) -> DataFrame:
    return quality.quality_sla(t.bronze, auc=_rule_auc(t).first()["roc_auc"])


def _rule_scores(t: Tables) -> DataFrame:
    """Active people with a score that follows from engagement alone, shaped as the model's scores are."""
    score = F.round((10 - F.col(ENGAGEMENT)) / 20, 4)
    return t.silver.where(F.col("status") == ACTIVE).withColumns({
        "risco_attrition_score": score, "faixa_risco": risk_band(score),
        "tempo_casa_meses_ref": F.col("tempo_casa_meses")})


def _person_bands(t: Tables) -> DataFrame:
    return t.silver.select(
        KEY, age_band(F.col("idade")).alias("faixa_etaria"), salary_band(F.col(SALARY)).alias("faixa_salarial"))


def _retrain_days(t: Tables) -> DataFrame:
    days = t.silver.select(F.col(START).alias("dia")).distinct()
    return days.where(model.is_retrain_day(F.col("dia"))).select(month_key(F.col("dia")).alias("competencia"), "dia")


def _metrics(t: Tables) -> DataFrame:
    return t.metrics.withColumn("fatores_risco_top5", F.to_json("fatores_risco_top5"))


# --- sources and streams -------------------------------------------------------------------------------

def _csv_roundtrip(t: Tables) -> DataFrame:
    path = t.scratch("csv").path("bronze")
    write_csv(t.bronze, path)
    return read_bronze(t.spark, path)


def _silver_partitions(t: Tables) -> DataFrame:
    path = t.scratch("silver").path("colaboradores")
    write_silver(t.silver, path)
    return quality.value_counts(read_silver(t.spark, path), "area")


EXPORTS = ("2001-07-30", "2001-07-31", "2001-08-01")


def _write_export(t: Tables, landing: str, day: str) -> None:
    """The bronze rows as an export of `day`. Promotions of every seventh person appear from the second one on."""
    rows = t.bronze
    if day != EXPORTS[0]:
        senior = F.when((F.col(KEY) - 100000) % 7 == 0, F.lit("Liderança")).otherwise(F.col("senioridade"))
        rows = rows.withColumn("senioridade", senior)
    write_csv(rows, f"{landing}/export_date={day}")


def _incremental_ingest(t: Tables) -> DataFrame:
    """Two exports taken in by two runs of the stream, then cleaned per export."""
    work = t.scratch("intake")
    landing, history = work.path("landing"), work.path("history")
    for day in EXPORTS[:2]:
        _write_export(t, landing, day)
        ingest_increment(t.spark, landing, history, work.path("progress"))
    return _dates_as_text(clean_exports(read_history(t.spark, history), work))


def _intake_quarantine(t: Tables) -> DataFrame:
    """An export with unreadable salaries and keys: what came in, what is in quarantine, what is clean."""
    work = t.scratch("quarantine")
    landing, history = work.path("landing"), work.path("history")
    order = F.col(KEY) - 100000
    pay, key = F.col(SALARY).cast("string"), F.col(KEY).cast("string")
    spoilt = {SALARY: F.when(order % 29 == 0, F.concat(pay, F.lit("x"))).otherwise(pay),
              KEY: F.when(order % 31 == 0, F.concat(F.lit("k"), key)).otherwise(key)}
    for day, rest in ((EXPORTS[0], 0), (EXPORTS[1], 1)):
        write_csv(t.bronze.where(order % 2 == rest).withColumns(spoilt), f"{landing}/export_date={day}")
        ingest_increment(t.spark, landing, history, work.path("progress"))
    refresh_exports(t.spark, history, work.path("cleaned"), work)
    clean = read_exports(t.spark, work.path("cleaned")).groupBy(EXPORT_DATE).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.sum(F.col(SALARY).cast(MONEY)).alias("folha"))
    taken = ledger(t.spark, history).groupBy(EXPORT_DATE).agg(
        F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"))
    held = read_quarantine(t.spark, history).groupBy(EXPORT_DATE).agg(
        F.count_if(F.col("record").startswith("k")).alias("bad_keys"))  # the key is the first field
    return taken.join(clean, EXPORT_DATE).join(held, EXPORT_DATE)


def _late_export(t: Tables) -> DataFrame:
    """The newest export arrives first, an older one late: the current view keeps the newest rows."""
    work = t.scratch("late")
    landing, history = work.path("landing"), work.path("history")
    for day in (EXPORTS[2], EXPORTS[0]):
        _write_export(t, landing, day)
        ingest_increment(t.spark, landing, history, work.path("progress"), files_per_batch=2)
    return current_view(clean_exports(read_history(t.spark, history), work))


def _export_document(t: Tables) -> DataFrame:
    gold = {
        "serie_mensal_geral": series.monthly_series(t.silver, *SERIES),
        "workforce_planning": _workforce_plan(t),
        "produtividade_area": series.productivity_by_area(t.silver, *SERIES),
        "risco_por_area": kpis.risk_by_area(t.scores),
        "causa_raiz_ranking": kpis.root_cause(t.silver),
        "planos_acao": planning.action_plan(kpis.root_cause(t.silver)),
        "dimensoes": quality.dimension_members(t.silver, ["area", "senioridade", "genero"]),
        "log_qualidade": quality_log(t.staged),
    }
    kept = {name: t.store.keep(table, name) for name, table in gold.items()}
    order = {"causa_raiz_ranking": [-F.col("total_desligamentos")], "risco_por_area": [-F.col("risco_medio")]}
    return export.full_document(export.export_document(kept, order=order))


def _attach_departures(t: Tables) -> DataFrame:
    """The employee table and the departures table as the two exports they are upstream, joined again."""
    described = [END, KIND, REASON]
    people = dedup.dedup_latest(t.bronze, [KEY], [F.col(START)])
    gone = t.bronze.where(F.col(END).isNotNull()).select(KEY, *described)
    return joins.attach_departures(people.drop(*described), gone)


def _action_details(t: Tables) -> DataFrame:
    return planning.action_details(kpis.root_cause(t.silver))


def _improvement_cycles(t: Tables) -> DataFrame:
    return planning.improvement_cycles(kpis.root_cause(t.silver))


def _refreshed_exports(t: Tables) -> DataFrame:
    """Exports cleaned as they land: the second run of the refresh touches only the export that grew or came."""
    work = t.scratch("refresh")
    landing, history, cleaned = work.path("landing"), work.path("history"), work.path("cleaned")
    for day in EXPORTS[:2]:
        _write_export(t, landing, day)
        ingest_increment(t.spark, landing, history, work.path("progress"))
        refresh_exports(t.spark, history, cleaned, work)
    return read_exports(t.spark, cleaned).groupBy(EXPORT_DATE, "senioridade").agg(
        F.count(F.lit(1)).alias("headcount"), F.sum(F.col(SALARY).cast(MONEY)).alias("folha"))


Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {
    "bronze_profile": lambda t: quality.check_not_null(t.bronze, t.bronze.columns),
    "attach_departures": _attach_departures,
    "dedup_exact": lambda t: dedup.dedup_exact(t.bronze),
    "dedup_latest": lambda t: dedup.dedup_latest(t.bronze, [KEY], [F.col(START)]),
    "dedup_first": lambda t: dedup.dedup_key(t.bronze, [KEY], [F.col(START)], keep="first"),
    "normalize_area": lambda t: repair.normalize_category(t.bronze),
    "count_unknown_area": lambda t: quality.count_unknown(t.bronze),
    "null_out_of_range": lambda t: repair.null_out_of_range(t.bronze, ENGAGEMENT, *ENGAGEMENT_SCALE),
    "impute_engagement": _impute_engagement,
    "impute_salary": _impute_salary,
    "fix_salary_scale": lambda t: repair.fix_scale(t.bronze, SALARY, "senioridade"),
    "label_missing": lambda t: repair.label_missing(t.bronze, ["genero", "raca_cor"]),
    "parse_dates": lambda t: repair.parse_dates(t.bronze),
    "repair_interval": _repair_interval,
    "replace_status": _replace_status,
    "silver": lambda t: silver(t.bronze, t.scratch("silver")),
    "quality_log": lambda t: quality_log(repair_rows(t.bronze)),
    "unexpected_nulls": lambda t: quality.unexpected_nulls(t.bronze),
    "status_counts": lambda t: quality.value_counts(t.silver, "status"),
    "bronze_gate": _bronze_gate,
    "quality_sla": lambda t: quality.quality_sla(t.bronze),
    "expectations_bronze": lambda t: quality.expectations_bronze(t.bronze),
    "expectations_silver": lambda t: quality.expectations_silver(t.silver, t.bronze),
    "protect_pii": lambda t: quality.protect_pii(t.silver, "salt"),
    "suppress_small_cells": _suppressed,
    "check_pk": lambda t: quality.check_pk(t.bronze, [KEY]),
    "check_fk": _check_fk,
    "values_outside": lambda t: quality.values_outside(t.bronze, "area", AREAS),
    "group_median": _group_median,
    "active_at": lambda t: t.silver.where(active_at(F.lit(dt.date(2000, 6, 30)), F.col(START), F.col(END))),
    "monthly_series": lambda t: series.monthly_series(t.silver, *SERIES),
    "granular_series": lambda t: series.granular_series(t.silver, *SERIES),
    "headcount_by_area": lambda t: series.headcount_by_area(t.silver),
    "productivity_by_area": lambda t: series.productivity_by_area(t.silver, *SERIES),
    "admissions_cohort": lambda t: series.admissions_cohort(t.silver),
    "departures_by_area": lambda t: series.departures_by_area(t.silver),
    "cohort_join": lambda t: _cohorts(t, series.cohort_join),
    "cohort_join_strict": lambda t: _cohorts(t, series.cohort_join_strict),
    "area_risk_proxy": lambda t: kpis.area_risk_proxy(t.silver),
    "nine_box": lambda t: kpis.nine_box(t.silver),
    "nine_box_view": lambda t: warehouse.nine_box_view(t.employees, t.areas),
    "root_cause": _root_cause,
    "action_plan": lambda t: planning.action_plan(kpis.root_cause(t.silver)),
    "action_details": _action_details,
    "improvement_cycles": _improvement_cycles,
    "kpi_cover": lambda t: kpis.kpi_cover(series.monthly_series(t.silver, *SERIES)),
    "monthly_kpis": lambda t: kpis.monthly_kpis(series.monthly_series(t.silver, *SERIES), "2001-07"),
    "dimension_members": lambda t: quality.dimension_members(t.silver, ["area", "senioridade", "genero"]),
    "workforce_plan": _workforce_plan,
    "plan_gap": _plan_gap,
    "dim_date": lambda t: warehouse.dim_date_for(t.silver),
    "dim_area": _dim_area,
    "dim_motivo": _dim_reason,
    "scd2_employee": _scd2,
    "dim_employee": lambda t: warehouse.dim_employee(snapshots(t.silver), t.areas, unique=True),
    "dim_employee_incremental": _dim_employee_incremental,
    "fact_departure": _fact_departure,
    "fact_headcount": _fact_headcount,
    "turnover_ltm": lambda t: warehouse.turnover_ltm(t.headcount, t.areas, REFERENCE_DATE),
    "turnover_cost_ltm": lambda t: warehouse.turnover_cost_ltm(
        t.departures, warehouse.dim_date_for(t.silver), t.areas, REFERENCE_DATE),
    "departure_careers": lambda t: t.careers,
    "departure_profiles": lambda t: warehouse.departure_profiles(t.careers, t.reasons),
    "star_constraints": _star_constraints,
    "funnel": _funnel,
    "funnel_by_cohort": _funnel_by_cohort,
    "stratified_split": lambda t: ranking.stratified_split(t.labelled, t.scratch("split")),
    "encode_city": lambda t: encoding.encode_out_of_fold(t.labelled, "cidade", "cidade_mean"),
    "city_means": lambda t: encoding.category_means(t.labelled, "cidade"),
    "rule_auc": _rule_auc,
    "quality_sla_model": _sla_with_model,
    "attrition_labels": lambda t: t.labelled,
    "base_rate": lambda t: model.base_rate(t.labelled),
    "risk_band": _risk_band,
    "rule_risk_by_area": lambda t: kpis.risk_by_area(_rule_scores(t)),
    "rule_top_risk": lambda t: kpis.top_risk(_rule_scores(t)),
    "rule_band_counts": lambda t: quality.value_counts(_rule_scores(t), "faixa_risco"),
    "person_bands": _person_bands,
    "retrain_days": _retrain_days,
    "csv_roundtrip": _csv_roundtrip,
    "silver_partitions": _silver_partitions,
    "incremental_ingest": _incremental_ingest,
    "intake_quarantine": _intake_quarantine,
    "late_export": _late_export,
    "refreshed_exports": _refreshed_exports,
    # No SQL counterpart: results of a trained forest, and one JSON text.
    "attrition_scores": lambda t: t.scores,
    "risk_by_area": lambda t: kpis.risk_by_area(t.scores),
    "top_risk": lambda t: kpis.top_risk(t.scores),
    "importances": lambda t: model.importances(t.forest, t.silver),
    "model_metrics": _metrics,
    "model_gate": lambda t: model.model_gate(t.metrics, t.scores),
    "export_document": _export_document,
}


def _bind(name: str, query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = query(tables(spark, folder))
        return shape_frame(result, COLUMNS[name]) if name in COLUMNS else result

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(name, query) for name, query in QUERIES.items()}
