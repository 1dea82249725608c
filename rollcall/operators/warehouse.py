"""Star schema: dimensions, facts, reporting views.

Surrogate keys are the parts of the natural key as text: key-version, key-date, and for headcount cells a list in JSON,
where neither a separator inside a name nor a NULL makes two of them equal.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    DIM_AREA, DIM_REASON, HIGH_SALARY_BANDS, LEADER, MONTH_NAMES, POTENTIAL_BY_AGE_BAND, SENIOR, TURNOVER_COST_FACTOR,
    WEEKDAY_NAMES)
from rollcall.functions import (
    age_band, literal_table, lookup, month_key, months_between_calendar, percent, salary_band)
from rollcall.functions.numbers import MONEY
from rollcall.operators.dedup import dedup_latest
from rollcall.operators.kpis import performance_box, potential_box
from rollcall.operators.series import (
    MEASURES, cell_mean, enps, headcount_cells, monthly_turnover, spine_bounds)
from rollcall.schema import END, ENGAGEMENT, KEY, PERFORMANCE, REASON, SALARY, START

TRACKED = ("cargo", "senioridade", "area")
#: What the employee dimension is made of: versions need no other columns of a snapshot.
DESCRIBED = (KEY, *TRACKED, "genero", "raca_cor", "cidade", "idade", SALARY)


def date_key(date: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def _joined_key(first: str, second: str) -> Column:
    """Both parts as text; NULL if one is."""
    return F.concat(F.col(first).cast("string"), F.lit("-"), F.col(second).cast("string"))


def _name(names: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index)


def dim_date(spark: SparkSession, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """One row per day. The holiday flag is FALSE until a calendar is supplied."""
    bounds = [F.lit(dt.date.fromisoformat(d) if isinstance(d, str) else d) for d in (first, last)]
    day = F.col("data_completa")
    weekday = F.dayofweek(day)
    return spark.range(1).select(F.explode(F.sequence(*bounds)).alias("data_completa")).select(
        date_key(day).cast("int").alias("sk_data"),
        day,
        F.year(day).cast("smallint").alias("ano"),
        F.when(F.month(day) <= 6, 1).otherwise(2).cast("smallint").alias("semestre"),
        F.quarter(day).cast("smallint").alias("trimestre"),
        F.month(day).cast("smallint").alias("mes"),
        _name(MONTH_NAMES, F.month(day)).alias("nome_mes"),
        F.weekofyear(day).cast("smallint").alias("semana_ano"),
        F.dayofmonth(day).cast("smallint").alias("dia_mes"),
        weekday.cast("smallint").alias("dia_semana"),
        _name(WEEKDAY_NAMES, weekday).alias("nome_dia_semana"),
        weekday.isin(1, 7).alias("e_fim_de_semana"),
        F.lit(False).alias("e_feriado_nacional"),
        month_key(day).alias("competencia"),
    )


def dim_date_for(df: DataFrame, columns: Sequence[str] = (START, END)) -> DataFrame:
    """The calendar from the first to the last date found in `columns`."""
    ends = df.agg(
        F.min(F.least(*columns)).alias("first"), F.max(F.greatest(*columns)).alias("last")).first()
    return dim_date(df.sparkSession, ends["first"], ends["last"])


def dim_area(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DIM_AREA, {
        "sk_area": "smallint", "area": "string", "diretoria": "string", "vice_presidencia": "string",
        "centro_de_custo": "string", "classificacao_risco": "string"})


def dim_reason(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DIM_REASON, {
        "sk_motivo": "smallint", "motivo": "string", "categoria_rca": "string", "tipo_desligamento": "string",
        "e_retencao_possivel": "boolean"})


def scd2(snapshots: DataFrame, keys: Sequence[str], date: str, tracked: Sequence[str],
         unique: bool = False) -> DataFrame:
    """Versions of each key: a new one whenever a tracked attribute differs from the snapshot before.

    Adds `valid_from`, `valid_to` (last day, NULL while current), `is_current` and `version` (from 1). Other columns
    are those of the version's first snapshot. Copies are merged before the windows, so that a window holds at most
    one row per snapshot date; `unique` says that the rows come merged already, as clean exports do, and saves that
    shuffle.
    """
    rows = snapshots if unique else dedup_latest(snapshots, [*keys, date], [])
    history = Window.partitionBy(*keys).orderBy(date)
    state = F.struct(*tracked)
    versions = (
        rows.withColumn("before", F.lag(state).over(history))
        .where(~state.eqNullSafe(F.col("before")))
        .drop("before")
    )
    following = F.lead(date).over(history)
    return versions.select(
        *[c for c in versions.columns if c != date],
        F.col(date).alias("valid_from"),
        F.date_sub(following, 1).alias("valid_to"),
        following.isNull().alias("is_current"),
        F.row_number().over(history).alias("version"),
    )


def dim_employee(snapshots: DataFrame, areas: DataFrame, date: str = "snapshot_date",
                 unique: bool = False) -> DataFrame:
    """Employee dimension, type 2 on position, seniority and area."""
    return dim_employee_of(scd2(snapshots, [KEY], date, TRACKED, unique), areas)


def dim_employee_of(versions: DataFrame, areas: DataFrame) -> DataFrame:
    """Employee dimension from its versions."""
    return versions.join(areas.select("sk_area", "area"), "area", "left").select(
        _joined_key(KEY, "version").alias("sk_colaborador"),
        F.col(KEY).alias("nk_matricula"),
        "cargo", "senioridade", "sk_area", "genero", "raca_cor", "cidade",
        age_band(F.col("idade")).alias("faixa_etaria"),
        salary_band(F.col(SALARY)).alias("faixa_salarial"),
        F.col("valid_from").alias("data_inicio_vigencia"),
        F.col("valid_to").alias("data_fim_vigencia"),
        F.col("is_current").alias("e_registro_atual"),
        F.col("version").alias("versao"),
    )


def turnover_cost(salary: Column, factor: float = TURNOVER_COST_FACTOR) -> Column:
    return salary.cast(MONEY) * F.lit(factor).cast("decimal(6,2)")


def fact_departure(silver: DataFrame, employees: DataFrame, areas: DataFrame, reasons: DataFrame) -> DataFrame:
    """One row per departure, tied to the employee version valid on that day (the first version if earlier). Measures
    are wider than a warehouse would declare them, so that one value out of range does not end the load."""
    gone = silver.where(F.col(END).isNotNull())
    version = employees.select(
        F.col("nk_matricula").alias(KEY), "sk_colaborador", "data_inicio_vigencia", "data_fim_vigencia", "versao")
    valid = (
        (gone[KEY] == version[KEY])
        & ((F.col(END) >= F.col("data_inicio_vigencia")) | (F.col("versao") == 1))
        & (F.col("data_fim_vigencia").isNull() | (F.col(END) <= F.col("data_fim_vigencia")))
    )
    joined = (
        gone.join(version, valid, "left").drop(version[KEY])
        .join(areas.select("sk_area", "area"), "area", "left")
        .join(reasons.select("sk_motivo", F.col("motivo").alias(REASON)), REASON, "left")
    )
    months = months_between_calendar(F.col(START), F.col(END))
    star = (performance_box(F.col(PERFORMANCE)) == 3) & (potential_box(F.col(ENGAGEMENT), months) == 3)
    return joined.select(
        # One departure per person, so person and day identify it.
        _joined_key(KEY, END).alias("sk_desligamento"),
        F.col(KEY).alias("nk_matricula"),
        "sk_colaborador", "sk_area", "sk_motivo",
        date_key(F.col(END)).cast("int").alias("sk_data_deslig"),
        date_key(F.col(START)).cast("int").alias("sk_data_admissao"),
        F.datediff(F.col(END), F.col(START)).alias("tempo_casa_dias"),
        months.cast("int").alias("tempo_casa_meses"),
        F.col(SALARY).cast("decimal(18,2)").alias("salario_na_saida"),
        F.col(ENGAGEMENT).cast("decimal(18,2)").alias("engajamento_ultimo"),
        F.col(PERFORMANCE).cast("decimal(18,2)").alias("performance_ultimo"),
        turnover_cost(F.col(SALARY)).cast("decimal(28,2)").alias("custo_estimado_turnover"),
        (months < 6).alias("e_early_turnover"),
        (months > 48).alias("e_late_turnover"),
        star.alias("e_top_talent"),
    )


def fact_headcount(silver: DataFrame, areas: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Month x area x seniority, every cell with people, admissions or exits. Sums and percentages are wider than a
    warehouse would declare them, since a cell of a very large table overflows 14 digits."""
    cells = headcount_cells(silver, *spine_bounds(start, end), ["area", "senioridade"], MEASURES)
    used = (F.col("headcount") > 0) | (F.col("admissoes") > 0) | (F.col("desligamentos") > 0)
    month = month_key(F.col("month"))
    return cells.where(used).join(areas.select("sk_area", "area"), "area", "left").select(
        F.to_json(F.array(month, "area", "senioridade")).alias("sk_headcount"),
        "sk_area", month.alias("competencia"), "senioridade", "headcount", "admissoes", "desligamentos",
        F.col("desligamentos_voluntarios").alias("desligamentos_vol"),
        monthly_turnover(F.col("desligamentos"), F.col("opening")).cast("decimal(12,2)")
        .alias("turnover_mensal_pct"),
        F.round(cell_mean(ENGAGEMENT), 2).cast("decimal(18,2)").alias("engajamento_medio"),
        F.round(cell_mean(SALARY), 2).cast("decimal(18,2)").alias("salario_medio"),
        F.round(cell_mean(PERFORMANCE), 2).cast("decimal(18,2)").alias("performance_medio"),
        enps(F.year("month")).cast("decimal(5,1)").alias("enps"),
        F.when(F.col("headcount") > 0, F.col(f"sum_{SALARY}")).cast("decimal(28,2)").alias("custo_folha"),
    )


def departure_careers(fact: DataFrame, employees: DataFrame) -> DataFrame:
    """Departures with the person's career up to that day: seniority at first and at the end, number of versions, days
    since the last change (NULL without one).

    Every row of the fact stays; one without a known person has 0 versions and NULLs. Versions are grouped and joined
    by the person's key alone, so that tables placed by it (`write_bucketed`) are read without a shuffle. A person has
    at most one version per snapshot.
    """
    version = F.struct("versao", date_key(F.col("data_inicio_vigencia")).alias("since"), "senioridade",
                       "data_inicio_vigencia")
    careers = employees.groupBy("nk_matricula").agg(F.array_sort(F.collect_list(version)).alias("versions"))
    departed = F.col("sk_data_deslig")
    reached = F.filter("versions", lambda v: (v["versao"] == 1) | (v["since"] <= departed))
    first, last = F.get("reached", F.lit(0)), F.get("reached", F.size("reached") - 1)
    day = F.make_date(F.floor(departed / 10000), F.floor(departed / 100) % 100, departed % 100)
    return fact.join(careers, "nk_matricula", "left").withColumn("reached", reached).select(
        *fact.columns,
        first["senioridade"].alias("senioridade_inicial"),
        last["senioridade"].alias("senioridade_na_saida"),
        F.coalesce(F.size("reached"), F.lit(0)).alias("versoes"),
        F.when(F.size("reached") > 1, F.datediff(day, last["data_inicio_vigencia"])).alias("dias_desde_mudanca"),
    )


# --- views ---------------------------------------------------------------------------------------------

def _a_year_before(as_of: str | dt.date) -> tuple[Column, Column]:
    day = F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
    return F.add_months(day, -12), day


def _one_decimal(part: Column, whole: Column) -> Column:
    return F.round(percent(part, whole), 1)


def turnover_ltm(fact: DataFrame, areas: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Turnover since the month twelve back, by area: thirteen months, counting the current one.

    `turnover_ltm_pct` divides by the mean month x seniority row, `turnover_ltm_pct_area` by the area's mean month.
    The months are summed before the area's names are joined on.
    """
    since, day = _a_year_before(as_of)
    exits, months = F.col("total_desligamentos"), F.col("months")
    by_area = fact.where(F.col("competencia").between(month_key(since), month_key(day))).groupBy("sk_area").agg(
        F.sum("desligamentos").alias("total_desligamentos"),
        F.sum("desligamentos_vol").alias("desligamentos_voluntarios"),
        F.avg("headcount").alias("headcount_medio"),
        F.sum("headcount").alias("people_months"),
        F.count_distinct("competencia").alias("months"),
    )
    return by_area.join(areas, "sk_area").select(
        "area", "classificacao_risco", "total_desligamentos", "desligamentos_voluntarios", "headcount_medio",
        _one_decimal(exits, F.col("headcount_medio")).alias("turnover_ltm_pct"),
        _one_decimal(exits * months, F.col("people_months")).alias("turnover_ltm_pct_area"),
        _one_decimal(F.col("desligamentos_voluntarios"), exits).alias("pct_voluntario"),
    )


def nine_box_view(employees: DataFrame, areas: DataFrame) -> DataFrame:
    """Current employee versions by area, seniority and a grid from salary and age bands."""
    well_paid_leader = (F.col("senioridade") == LEADER) & F.col("faixa_salarial").isin(*HIGH_SALARY_BANDS)
    performance = F.when(well_paid_leader, 3).when(F.col("senioridade") == SENIOR, 2).otherwise(1)
    potential = F.coalesce(lookup(F.col("faixa_etaria"), POTENTIAL_BY_AGE_BAND), F.lit(1))
    cells = employees.where("e_registro_atual").groupBy(
        "sk_area", "senioridade", performance.alias("perf_box"), potential.alias("pot_box")
    ).agg(F.count(F.lit(1)).alias("headcount"))
    return cells.join(areas.select("sk_area", "area"), "sk_area").drop("sk_area")


def turnover_cost_ltm(fact: DataFrame, dates: DataFrame, areas: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Sum, number and mean of departure costs of the last twelve months, by area."""
    since, day = _a_year_before(as_of)
    days = dates.where(F.col("data_completa").between(since, day)).select(F.col("sk_data").alias("sk_data_deslig"))
    cost = F.col("custo_estimado_turnover")
    by_area = fact.join(days, "sk_data_deslig").groupBy("sk_area").agg(
        F.sum(cost).alias("custo_total_turnover"),
        F.count(F.lit(1)).alias("total_desligamentos"),
        F.avg(cost).alias("custo_medio_por_desligamento"),
    )
    return by_area.join(areas.select("sk_area", "area"), "sk_area").drop("sk_area")


def departure_profiles(careers: DataFrame, reasons: DataFrame) -> DataFrame:
    """Departures by seniority at first and at the end and by category of the reason: number, how many had changed
    position before, their mean days since, early ones, cost.

    Careers are summed by reason before the categories are joined on; a reason without a category is kept as NULL.
    """
    path, days = ["senioridade_inicial", "senioridade_na_saida"], F.col("dias_desde_mudanca")
    by_reason = careers.groupBy(*path, "sk_motivo").agg(
        F.count(F.lit(1)).alias("n"), F.count(days).alias("changed"), F.sum(days).alias("days"),
        F.count_if("e_early_turnover").alias("early"), F.sum("custo_estimado_turnover").alias("cost"))
    named = by_reason.join(reasons.select("sk_motivo", "categoria_rca"), "sk_motivo", "left")
    return named.groupBy(*path, "categoria_rca").agg(
        F.sum("n").alias("desligamentos"), F.sum("changed").alias("com_mudanca"),
        (F.sum("days") / F.nullif(F.sum("changed"), F.lit(0))).alias("dias_desde_mudanca_medio"),
        F.sum("early").alias("early_turnover"), F.sum("cost").alias("custo_total_turnover"))
