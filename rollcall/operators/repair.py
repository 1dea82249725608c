"""Row-level repairs. Each is an expression over one row, so they all fuse into one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    ACTIVE, AREA_ALIASES, AREAS, NOT_INFORMED, SALARY_CEILING_DEFAULT, SALARY_RANGE)
from rollcall.functions import lookup, parse_date
from rollcall.schema import END, KIND, REASON, START

AREA_NAMES = {name.upper(): name for name in AREAS} | AREA_ALIASES
SALARY_CEILING = {level: float(high) for level, (_, high) in SALARY_RANGE.items()}


def canonical(column: Column, names: Mapping[str, str]) -> Column:
    """The known spelling of a category, or the trimmed input when it is unknown."""
    trimmed = F.trim(column)
    return F.coalesce(lookup(F.upper(trimmed), names), trimmed)


def normalize_category(df: DataFrame, column: str = "area", names: Mapping[str, str] = AREA_NAMES) -> DataFrame:
    return df.withColumn(column, canonical(F.col(column), names))


def within(column: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else NULL. NaN is greater than any number, so it goes too."""
    return F.when(column.between(low, high), column)


def null_out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(column, within(F.col(column), low, high))


def above_ceiling(value: Column, level: Column, ceilings: Mapping[str, float], times: float,
                  otherwise: float = SALARY_CEILING_DEFAULT) -> Column:
    ceiling = F.coalesce(lookup(level, ceilings), F.lit(float(otherwise)))
    return F.coalesce(value > ceiling * times, F.lit(False))


def fix_scale(df: DataFrame, column: str, key: str, ceilings: Mapping[str, float] = SALARY_CEILING,
              times: float = 3, divisor: float = 100, otherwise: float = SALARY_CEILING_DEFAULT) -> DataFrame:
    """Values above `times` the ceiling of their level were typed without the decimal point: divide them."""
    value = F.col(column)
    typo = above_ceiling(value, F.col(key), ceilings, times, otherwise)
    return df.withColumn(column, F.when(typo, value / divisor).otherwise(value))


def label_missing(df: DataFrame, columns: Sequence[str], label: str = NOT_INFORMED) -> DataFrame:
    """Missing demographics get a label; they are never guessed."""
    return df.fillna({c: label for c in columns})


def parse_dates(df: DataFrame, columns: Sequence[str] = (START, END)) -> DataFrame:
    return df.withColumns({c: parse_date(F.col(c)) for c in columns})


def ends_before_start(start: Column, end: Column) -> Column:
    return F.coalesce(end < start, F.lit(False))


def repair_interval(df: DataFrame, start: str = START, end: str = END, clear: Sequence[str] = (KIND, REASON),
                    status: str = "status", active: str = ACTIVE) -> DataFrame:
    """An end before the start is an error of entry: clear it and what describes it, and set the row active."""
    broken = ends_before_start(F.col(start), F.col(end))
    cleared = {c: F.when(~broken, F.col(c)) for c in (end, *clear)}
    return df.withColumns(cleared | {status: F.when(broken, F.lit(active)).otherwise(F.col(status))})
