"""Bronze to silver: one shuffled pass of repairs, then medians, then the clean table and its quality log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    ACTIVE, ACTIVE_CORRECTED, AREAS, ENGAGEMENT_SCALE, LEFT, NOT_INFORMED)
from rollcall.functions import is_missing, parse_date
from rollcall.operators.dedup import COPIES, VERSIONS, dedup_counted
from rollcall.operators.medians import impute_median, impute_medians
from rollcall.operators.repair import (
    AREA_NAMES, SALARY_CEILING, above_ceiling, canonical, ends_before_start, within)
from rollcall.schema import END, ENGAGEMENT, KEY, KIND, REASON, SALARY, START
from rollcall.sources.store import Store

# Step of the quality log, and the flag column it sums (None: the step is computed from the row counts).
STEPS: tuple[tuple[str, str | None, str], ...] = (
    ("exact_duplicates_removed", None, "rows equal in every column"),
    ("key_duplicates_removed", None, "latest start date kept"),
    ("area_normalized", "q_area", "spelling brought to the known name"),
    ("area_unknown", "q_area_unknown", "left as written"),
    ("engagement_out_of_range", "q_engagement_range", "outside 0-10, set to NULL"),
    ("engagement_imputed", "q_engagement_null", "median of the area"),
    ("salary_scale_fixed", "q_salary_scale", "above 3 x ceiling, divided by 100"),
    ("salary_imputed", "q_salary_null", "median of area and seniority"),
    ("gender_labelled", "q_gender", "missing demographics are never guessed"),
    ("race_labelled", "q_race", "missing demographics are never guessed"),
    ("date_unreadable", "q_date", "set to NULL"),
    ("interval_repaired", "q_interval", "end before start: back to active"),
    ("left_without_end_date", "q_no_end", "reported, not changed"),
    ("silver_rows", None, "rows written"),
)
FLAGS = [flag for _, flag, _ in STEPS if flag]


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def repair_rows(bronze: DataFrame, keys: Sequence[str] = (KEY,), areas: Mapping[str, str] = AREA_NAMES) -> DataFrame:
    """Deduplicate, then apply every row-level rule. Flag columns tell which rules touched a row.

    `bronze` may also be the table of its distinct rows with their counts (`count_copies`).
    """
    rows = dedup_counted(bronze, keys, [parse_date(F.col(START)), F.col(START)])

    area = canonical(F.col("area"), areas)
    engagement = F.when(~is_missing(F.col(ENGAGEMENT)), F.col(ENGAGEMENT))
    in_scale = within(engagement, *ENGAGEMENT_SCALE)
    salary = F.when(~is_missing(F.col(SALARY)), F.col(SALARY))
    typo = above_ceiling(salary, F.col("senioridade"), SALARY_CEILING, 3)
    start, end = parse_date(F.col(START)), parse_date(F.col(END))
    broken = ends_before_start(start, end)
    status = F.when(broken | (F.col("status") == ACTIVE_CORRECTED), F.lit(ACTIVE)).otherwise(F.col("status"))

    repaired = {
        "area": area,
        ENGAGEMENT: in_scale,
        SALARY: F.when(typo, salary / 100).otherwise(salary),
        "genero": F.coalesce(F.col("genero"), F.lit(NOT_INFORMED)),
        "raca_cor": F.coalesce(F.col("raca_cor"), F.lit(NOT_INFORMED)),
        START: start,
        END: F.when(~broken, end),
        KIND: F.when(~broken, F.col(KIND)),
        REASON: F.when(~broken, F.col(REASON)),
        "status": status,
    }
    flags = {
        "q_area": _flag(area != F.col("area")),
        "q_area_unknown": _flag(~area.isin(*AREAS)),
        "q_engagement_range": engagement.isNotNull() & in_scale.isNull(),
        "q_engagement_null": in_scale.isNull(),
        "q_salary_scale": typo,
        "q_salary_null": salary.isNull(),
        "q_gender": F.col("genero").isNull(),
        "q_race": F.col("raca_cor").isNull(),
        "q_date": (F.col(START).isNotNull() & start.isNull()) | (F.col(END).isNotNull() & end.isNull()),
        "q_interval": broken,
        "q_no_end": _flag((status == LEFT) & end.isNull()),
    }
    return rows.select(
        *[repaired.get(c, F.col(c)).alias(c) for c in bronze.columns if c != COPIES],
        COPIES, VERSIONS,
        *[c.alias(name) for name, c in flags.items()],
    )


def impute(rows: DataFrame, store: Store | None = None, within_keys: Sequence[str] = (),
           approx: bool = False) -> DataFrame:
    """Fill engagement by area and salary by area and seniority, inside each of `within_keys` if given."""
    targets = {ENGAGEMENT: [*within_keys, "area"], SALARY: [*within_keys, "area", "senioridade"]}
    if not approx:
        return impute_medians(rows, targets, store)
    for column, keys in targets.items():
        rows = impute_median(rows, column, keys, store, approx=True)
    return rows


def staged_silver(bronze: DataFrame, store: Store | None = None, keys: Sequence[str] = (KEY,),
                  within_keys: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """The clean rows with their flag columns.

    With a `store`, the repaired rows are written once: the medians then read a few narrow columns of that table
    instead of repeating the shuffles, and the last pass is free of shuffles.
    """
    rows = repair_rows(bronze, keys)
    if store is not None:
        rows = store.keep(rows, "repaired")
    return impute(rows, store, within_keys, approx)


def clean_columns(staged: DataFrame) -> DataFrame:
    return staged.drop(COPIES, VERSIONS, *FLAGS)


def silver(bronze: DataFrame, store: Store | None = None, approx: bool = False) -> DataFrame:
    """The clean employee table: one row per key."""
    return clean_columns(staged_silver(bronze, store, approx=approx))


def quality_log(repaired: DataFrame) -> DataFrame:
    """(step, rows, detail) of rows with flag columns, imputed or not: all steps from a single aggregation over the flag columns."""
    counts = {
        "exact_duplicates_removed": F.sum(F.col(COPIES) - F.col(VERSIONS)),
        "key_duplicates_removed": F.sum(F.col(VERSIONS) - 1),
        "silver_rows": F.count(F.lit(1)),
    } | {step: F.count_if(F.col(flag)) for step, flag, _ in STEPS if flag}
    one = repaired.agg(*[F.coalesce(counts[step], F.lit(0)).alias(step) for step, _, _ in STEPS])
    lines = F.array(*[
        F.struct(F.lit(step).alias("step"), F.col(step).cast("bigint").alias("rows"), F.lit(detail).alias("detail"))
        for step, _, detail in STEPS
    ])
    return one.select(F.inline(lines))
