"""Monthly series from employment intervals.

A person is active at a date t when start <= t and (end is NULL or end > t). Asking that of every person for every
month is a range join whose result grows with people x months. Here each person instead adds +1 in the month of the
start and -1 in the month of the end. Those events are summed per (cell, month) before the shuffle, and a running sum
per cell over at most as many rows as there are months gives the headcount. Measures are summed the same way, in
decimals, so that what leaves cancels exactly what came.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    ACTIVE, ENPS_TREND, ENPS_TREND_OTHERWISE, INVOLUNTARY, LEFT, VOLUNTARY)
from rollcall.functions import active_at, clamp, exact_mean, month_key
from rollcall.functions.numbers import MONEY, SCORE
from rollcall.schema import END, ENGAGEMENT, KEY, KIND, PERFORMANCE, PRODUCTIVITY, SALARY, START

MEASURES = {ENGAGEMENT: SCORE, SALARY: MONEY, PERFORMANCE: SCORE, PRODUCTIVITY: SCORE}


def _date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _next_month(month: dt.date, step: int = 1) -> dt.date:
    index = month.year * 12 + month.month - 1 + step
    return dt.date(index // 12, index % 12 + 1, 1)


def spine_bounds(start: str | dt.date, end: str | dt.date) -> tuple[dt.date, dt.date]:
    """First month start on or after `start`, last month start on or before `end`."""
    start, end = _date(start), _date(end)
    first = start if start.day == 1 else _next_month(start)
    return first, end.replace(day=1)


def month_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per month start, column `month`."""
    first, last = spine_bounds(start, end)
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month"))


def active(df: DataFrame, moment: str | dt.date, start: str = START, end: str = END) -> DataFrame:
    return df.where(active_at(F.lit(_date(moment)), F.col(start), F.col(end)))


def headcount_cells(df: DataFrame, first: dt.date, last: dt.date, dims: Sequence[str],
                    measures: Mapping[str, str], start: str = START, end: str = END,
                    kind: str = KIND) -> DataFrame:
    """Per cell and month of [first, last]: closing and opening headcount, admissions, exits, and for each measure
    its sum `sum_x` and its count of values `n_x` over the people active at month end.

    Months before a cell's first event have no row. Rows whose end precedes their start count as exits only.
    """
    before = _next_month(first, -1)  # everything earlier than the series folds into this slot
    s, e = F.col(start), F.col(end)
    sound = s.isNotNull() & (e.isNull() | (e >= s))

    def event(date: Column, sign: int) -> Column:
        on_first_day = sound & (F.dayofmonth(date) == 1)
        return F.struct(
            F.greatest(F.trunc(date, "MM"), F.lit(before)).alias("slot"),
            F.when(sound, F.lit(sign)).otherwise(F.lit(0)).alias("d"),
            F.when(on_first_day, F.lit(sign)).otherwise(F.lit(0)).alias("day1"),
            F.lit(int(sign > 0)).alias("joined"),
            F.lit(int(sign < 0)).alias("left"),
        )

    # greatest() skips NULL, so a missing date must not become an event in the folding slot.
    events = F.array(F.when(s.isNotNull(), event(s, 1)), F.when(e.isNotNull(), event(e, -1)))
    rows = df.select(
        *dims, kind, *[F.col(m).cast(t).alias(m) for m, t in measures.items()], F.inline(events)
    ).where(F.col("slot") <= F.lit(last))

    def signed(m: str) -> Column:
        return F.when(F.col("d") > 0, F.col(m)).when(F.col("d") < 0, -F.col(m))

    sums = [F.sum(signed(m)).alias(f"sum_{m}") for m in measures]
    counts = [F.sum(F.when(F.col(m).isNotNull(), F.col("d"))).alias(f"n_{m}") for m in measures]
    cells = rows.groupBy(*dims, "slot").agg(
        F.sum("d").alias("d"), F.sum("day1").alias("day1"), F.sum("joined").alias("joined"),
        F.sum("left").alias("left"),
        F.sum(F.when(F.col(kind) == VOLUNTARY, F.col("left")).otherwise(0)).alias("left_voluntary"),
        F.sum(F.when(F.col(kind) == INVOLUNTARY, F.col("left")).otherwise(0)).alias("left_involuntary"),
        *sums, *counts)

    # At most one row per month in each window, also when there are no dimensions.
    by_cell = Window.partitionBy(*(dims or [F.lit(0)])).orderBy("slot")
    upto = by_cell.rowsBetween(Window.unboundedPreceding, 0)

    def running(name: str) -> Column:
        return F.coalesce(F.sum(name).over(upto), F.lit(0))

    until = F.coalesce(F.add_months(F.lead("slot").over(by_cell), -1), F.lit(last))
    filled = cells.select(
        *dims, "slot", "day1", "joined", "left", "left_voluntary", "left_involuntary",
        running("d").alias("closing"), (running("d") - F.col("d")).alias("closing_before"),
        *[F.sum(f"sum_{m}").over(upto).alias(f"sum_{m}") for m in measures],
        *[running(f"n_{m}").alias(f"n_{m}") for m in measures],
        until.alias("until"),
    ).withColumn("month", F.explode(F.sequence("slot", "until", F.expr("interval 1 month"))))

    # What happened in the slot's month; the months after it, up to the next event, only carry the state on.
    here = F.col("month") == F.col("slot")

    def flow(name: str) -> Column:
        return F.when(here, F.col(name)).otherwise(F.lit(0)).cast("bigint")

    opening = F.when(here, F.col("closing_before") + F.col("day1")).otherwise(F.col("closing"))
    return filled.where(F.col("month") >= F.lit(first)).select(
        "month", *dims, F.col("closing").cast("bigint").alias("headcount"),
        opening.cast("bigint").alias("opening"), flow("joined").alias("admissoes"),
        flow("left").alias("desligamentos"), flow("left_voluntary").alias("desligamentos_voluntarios"),
        flow("left_involuntary").alias("desligamentos_involuntarios"),
        *[f"sum_{m}" for m in measures], *[f"n_{m}" for m in measures])


def cell_mean(measure: str) -> Column:
    """Mean of a measure in a cell, as a decimal: rounding it is exact. NULL when no active person has a value."""
    return F.col(f"sum_{measure}") / F.nullif(F.col(f"n_{measure}"), F.lit(0))


def rounded_mean(measure: str, places: int) -> Column:
    return F.round(cell_mean(measure), places).cast("double")


def monthly_turnover(exits: Column, opening: Column) -> Column:
    """Departures in percent of the opening headcount, at least 1."""
    share = exits.cast("decimal(20,0)") * 100 / F.greatest(opening, F.lit(1)).cast("decimal(20,0)")
    return F.round(share, 2).cast("double")


def _times_mean(factor: int, measure: str) -> Column:
    """factor * mean, multiplied before the division so that twenty decimals stay exact."""
    total = (F.col(f"sum_{measure}") * factor).cast("decimal(24,6)")
    return total / F.nullif(F.col(f"n_{measure}").cast("decimal(18,0)"), F.lit(0))


def enps(year: Column, measure: str = ENGAGEMENT, trend: Mapping[int, int] = ENPS_TREND,
         otherwise: int = ENPS_TREND_OTHERWISE) -> Column:
    """Promoter score from mean engagement: (mean - 5) * 18 plus the year's trend, within [-100, 100]."""
    shift = F.lit(otherwise)
    for y, value in trend.items():
        shift = F.when(year == y, F.lit(value)).otherwise(shift)
    return F.round(clamp(_times_mean(18, measure) - 90 + shift, -100, 100), 1).cast("double")


def productivity_index(measure: str = PERFORMANCE) -> Column:
    """85 + (mean - 3) * 12, within [60, 135]."""
    return F.round(clamp(_times_mean(12, measure) + 49, 60, 135), 1).cast("double")


def monthly_series(df: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per month: headcount, flows, turnover, payroll, engagement, promoter score, productivity."""
    first, last = spine_bounds(start, end)
    measures = {m: MEASURES[m] for m in (ENGAGEMENT, SALARY, PERFORMANCE)}
    cells = headcount_cells(df, first, last, [], measures)
    months = month_spine(df.sparkSession, first, last).join(cells, "month", "left")

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    payroll = F.when(F.col("headcount") > 0, F.col(f"sum_{SALARY}").cast("double"))
    return months.select(
        month_key(F.col("month")).alias("competencia"),
        count("headcount").alias("headcount_total"),
        *[count(c).alias(c) for c in (
            "admissoes", "desligamentos", "desligamentos_voluntarios", "desligamentos_involuntarios")],
        monthly_turnover(count("desligamentos"), count("opening")).alias("turnover_mensal_pct"),
        F.coalesce(payroll, F.lit(0.0)).alias("custo_folha_total"),
        rounded_mean(ENGAGEMENT, 2).alias("engajamento_medio"),
        enps(F.year("month")).alias("enps"),
        productivity_index().alias("produtividade_index"),
        rounded_mean(PERFORMANCE, 2).alias("performance_medio"),
    )


def granular_series(df: DataFrame, start: str | dt.date, end: str | dt.date,
                    dims: Sequence[str] = ("area", "senioridade", "genero")) -> DataFrame:
    """Month x cell, for cells with anyone active at month end; exits of other cells are not listed."""
    cells = headcount_cells(df, *spine_bounds(start, end), dims, MEASURES)
    return cells.where(F.col("headcount") > 0).select(
        month_key(F.col("month")).alias("competencia"), *dims, "headcount", "desligamentos",
        "desligamentos_voluntarios",
        rounded_mean(ENGAGEMENT, 2).alias("engajamento_medio"),
        rounded_mean(SALARY, 2).alias("salario_medio"),
        rounded_mean(PERFORMANCE, 2).alias("performance_medio"),
        rounded_mean(PRODUCTIVITY, 1).alias("produtividade_medio"),
    )


def productivity_by_area(df: DataFrame, start: str | dt.date, end: str | dt.date, months: int = 18) -> DataFrame:
    """Mean productivity by month and area over the last `months` months of the series."""
    first, last = spine_bounds(start, end)
    first = max(first, _next_month(last, 1 - months))
    cells = headcount_cells(df, first, last, ["area"], {PRODUCTIVITY: SCORE})
    return cells.where(F.col("headcount") > 0).select(
        month_key(F.col("month")).alias("competencia"), "area",
        F.round(clamp(cell_mean(PRODUCTIVITY), 50, 140), 1).cast("double").alias("produtividade_index"), "headcount")


def headcount_by_area(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == ACTIVE).groupBy("area").agg(F.count(F.lit(1)).alias("headcount"))


def admissions_cohort(df: DataFrame) -> DataFrame:
    """Admissions by month and area, with the means of who was admitted."""
    return (
        df.where(F.col("status").isin(ACTIVE, LEFT))
        .groupBy(month_key(F.col(START)).alias("competencia"), "area")
        .agg(
            F.count(KEY).alias("admissoes"),
            exact_mean(F.col(ENGAGEMENT)).alias("engajamento_medio"),
            exact_mean(F.col(SALARY), MONEY).alias("salario_medio"),
            exact_mean(F.col(PERFORMANCE)).alias("performance_medio"),
        )
    )


def departures_by_area(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col(END).isNotNull())
        .groupBy(month_key(F.col(END)).alias("competencia"), "area")
        .agg(F.count(KEY).alias("desligamentos"), F.count_if(F.col(KIND) == VOLUNTARY).alias("voluntarios"))
    )


def cohort_join(admissions: DataFrame, departures: DataFrame) -> DataFrame:
    """Admissions and departures side by side. Every month and area of either is kept; counts are filled with 0,
    unknown means stay NULL."""
    both = admissions.join(departures, ["competencia", "area"], "full")
    return both.fillna(0, ["admissoes", "desligamentos", "voluntarios"])


def cohort_join_strict(admissions: DataFrame, departures: DataFrame) -> DataFrame:
    """Only months and areas with admissions, every missing number a 0."""
    return admissions.join(departures, ["competencia", "area"], "left").fillna(0)
