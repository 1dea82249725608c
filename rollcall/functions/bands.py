"""Banding of scores, ages and salaries as CASE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def risk_band(score: Column) -> Column:
    """Right-closed bands over (0, 1]: a score of exactly 0 or above 1 has no band."""
    return (
        F.when((score > 0) & (score <= 0.15), F.lit("Baixo"))
        .when((score > 0.15) & (score <= 0.35), F.lit("Médio"))
        .when((score > 0.35) & (score <= 1), F.lit("Alto"))
    )


def age_band(age: Column) -> Column:
    """Lower bound inclusive; below 18 has no band."""
    return (
        F.when(age < 18, F.lit(None))
        .when(age < 25, F.lit("18-24"))
        .when(age < 35, F.lit("25-34"))
        .when(age < 45, F.lit("35-44"))
        .when(age < 55, F.lit("45-54"))
        .when(age >= 55, F.lit("55+"))
    )


def salary_band(salary: Column) -> Column:
    """Upper bound inclusive only for the first band ("up to 5k"), lower bound inclusive from 10k on."""
    return (
        F.when(salary <= 5000, F.lit("Até 5k"))
        .when(salary < 10000, F.lit("5-10k"))
        .when(salary < 20000, F.lit("10-20k"))
        .when(salary >= 20000, F.lit("20k+"))
    )
