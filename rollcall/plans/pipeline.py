"""The daily job: bronze export to silver, gold, warehouse."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rollcall.operators import kpis, planning, quality, series, warehouse
from rollcall.operators.dedup import count_copies
from rollcall.plans.silver import clean_columns, impute, quality_log, repair_rows
from rollcall.sources.buckets import write_bucketed
from rollcall.sources.files import (
    read_bronze, read_malformed, read_silver, write_json, write_silver, write_table)
from rollcall.sources.store import Store


@dataclass(frozen=True)
class Paths:
    root: str

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/colaboradores"

    @property
    def malformed(self) -> str:
        return f"{self.root}/quarantine/malformed"

    @property
    def quality_log(self) -> str:
        return f"{self.root}/silver/quality_log"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def star(self, table: str) -> str:
        return f"{self.root}/star/{table}"


def bronze_to_silver(spark: SparkSession, bronze: DataFrame, paths: Paths, store: Store) -> DataFrame:
    """Write the clean table and its quality log. Both read the stored repaired rows; what is left to do for the clean
    table is a join with the few medians, and the log needs no median at all."""
    repaired = store.keep(repair_rows(bronze), "repaired")
    write_silver(clean_columns(impute(repaired, store)), paths.silver)
    write_json(quality_log(repaired).coalesce(1), paths.quality_log)
    return read_silver(spark, paths.silver)


def gold_tables(silver: DataFrame, start: str, end: str, as_of: str) -> dict[str, DataFrame]:
    """Every gold table that needs no model. Small results; each reads only the columns it uses."""
    spark = silver.sparkSession
    admissions, departures = series.admissions_cohort(silver), series.departures_by_area(silver)
    causes = kpis.root_cause(silver)
    first_planned = (dt.date.fromisoformat(as_of).replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    return {
        "monthly_series": series.monthly_series(silver, start, end),
        "granular_series": series.granular_series(silver, start, end),
        "productivity_by_area": series.productivity_by_area(silver, start, end),
        "cohorts": series.cohort_join(admissions, departures),
        "area_risk": kpis.area_risk_proxy(silver),
        "nine_box": kpis.nine_box(silver),
        "root_cause": causes,
        "action_plan": planning.action_plan(causes),
        "workforce_plan": planning.workforce_plan(
            series.headcount_by_area(silver), warehouse.dim_area(spark), first_planned),
    }


def star_tables(silver: DataFrame, snapshots: DataFrame, start: str, end: str) -> dict[str, DataFrame]:
    spark = silver.sparkSession
    areas, reasons = warehouse.dim_area(spark), warehouse.dim_reason(spark)
    employees = warehouse.dim_employee(snapshots, areas)
    return {
        "dim_area": areas,
        "dim_motivo_saida": reasons,
        "dim_data": warehouse.dim_date_for(silver),
        "dim_colaborador": employees,
        "fct_desligamento": warehouse.fact_departure(silver, employees, areas, reasons),
        "fct_headcount_mensal": warehouse.fact_headcount(silver, areas, start, end),
    }


SORT = {
    "dim_data": ("data_completa",),
    "dim_colaborador": ("nk_matricula", "data_inicio_vigencia"),
    "fct_desligamento": ("sk_data_deslig", "sk_area"),
    "fct_headcount_mensal": ("competencia", "sk_area"),
}


def run(spark: SparkSession, bronze_path: str, root: str, start: str, end: str, as_of: str,
        min_rows: int = 4000, max_out_of_range: int = 0) -> Paths:
    """Read the export, check it, and write silver and gold. Raises before writing if the bronze gate fails.

    Rows that do not parse are written to a quarantine folder, so every row of the export is in one of the two.

    The export is scanned and shuffled once: gate and cleaning both start from its counted distinct rows.
    """
    paths, store = Paths(root), Store(spark, "pipeline")
    bronze = store.keep(count_copies(read_bronze(spark, bronze_path)), "counted")
    quality.require(quality.bronze_gate(bronze, min_rows, max_out_of_range=max_out_of_range))
    write_json(read_malformed(spark, bronze_path), paths.malformed)
    silver = bronze_to_silver(spark, bronze, paths, store)
    for name, table in gold_tables(silver, start, end, as_of).items():
        write_table(table, paths.gold(name))
    return paths


#: Tables with few rows per person, joined on the person.
PLACED = ("dim_colaborador", "fct_desligamento")


def write_star(tables: dict[str, DataFrame], paths: Paths, buckets: int | None = None) -> None:
    """With `buckets`, versions and departures of a person lie in buckets of the same number, for joins without a
    shuffle, and are read by `read_bucketed`; otherwise rows are ranged for skipping by date."""
    for name, table in tables.items():
        if buckets and name in PLACED:
            write_bucketed(table, paths.star(name), "nk_matricula", buckets, SORT[name])
        else:
            write_table(table, paths.star(name), sort=SORT.get(name, ()))
