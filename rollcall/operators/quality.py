"""Measuring and gating data quality.

Rules are data. All rules that need only a scan share one aggregation per table; the ones that need a shuffle
(uniqueness, copies, shares) aggregate before they shuffle and end in one row each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import ACTIVE, AREAS, ENGAGEMENT_SCALE, LEFT, SALARY_PLAUSIBLE
from rollcall.functions import parse_date
from rollcall.operators.dedup import COPIES, count_copies
from rollcall.schema import END, ENGAGEMENT, KEY, OPTIONAL, REQUIRED_BRONZE, SALARY, START


class GateFailed(ValueError):
    """A quality gate did not pass."""


def require(gate: DataFrame) -> DataFrame:
    """Raise if any check of a gate failed. A gate has one row per check."""
    failed = [f"{r['check']} (observed {r['observed']})" for r in gate.where(~F.col("passed")).collect()]
    if failed:
        raise GateFailed("quality gate failed: " + "; ".join(sorted(failed)))
    return gate


def share(part: Column, whole: Column) -> Column:
    """part / whole; 0 for an empty table."""
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


# --- counts --------------------------------------------------------------------------------------------

def count_unknown(df: DataFrame, column: str = "area", known: Sequence[str] = AREAS) -> DataFrame:
    """Rows whose value is outside the known set (NULL is not counted)."""
    return df.agg(F.count_if(~F.col(column).isin(*known)).alias("rows"))


def unexpected_nulls(df: DataFrame, optional: Sequence[str] = OPTIONAL) -> DataFrame:
    """Total number of NULLs over the columns that must be filled."""
    required = [c for c in df.columns if c not in optional]
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in required])
    return df.agg(F.coalesce(F.sum(nulls), F.lit(0)).cast("bigint").alias("unexpected_nulls"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def dimension_members(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, member): the distinct values of each column, in order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("member")) for c in columns])
    return df.select(F.inline(pairs)).where(F.col("member").isNotNull()).distinct().orderBy("dimension", "member")


def values_outside(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """The distinct values of a column that are not in the known set."""
    return df.where(~F.col(column).isin(*known)).select(column).distinct()


# --- declared constraints ------------------------------------------------------------------------------

def check_pk(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their number of rows."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | null_key)


def check_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of `column` with no parent, with their number of rows. A repeated value is counted before the join."""
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_column).alias("parent_key"))
    return used.join(known, F.col(column) == F.col("parent_key"), "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls) for columns declared NOT NULL."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return one.select(F.inline(lines))


# --- expectations --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """`observed` is an aggregate over the rows; the rule passes when it compares with `limit` as `op` says."""

    name: str
    observed: Column
    op: str
    limit: float


def expect_min_rows(least: int) -> Rule:
    return Rule("min_rows", F.count(F.lit(1)), ">=", least)


def expect_not_null(column: str) -> Rule:
    return Rule(f"not_null:{column}", F.count_if(F.col(column).isNull()), "==", 0)


def expect_positive(column: str) -> Rule:
    return Rule(f"positive:{column}", F.count_if(F.col(column) <= 0), "==", 0)


def expect_between(column: str, low: float, high: float) -> Rule:
    return Rule(f"between:{column}", F.count_if(~F.col(column).between(low, high)), "==", 0)


def expect_order(first: str, second: str) -> Rule:
    return Rule(f"order:{first}<={second}", F.count_if(F.col(second) < F.col(first)), "==", 0)


def expect_domain(column: str, known: Sequence[str]) -> Rule:
    return Rule(f"domain:{column}", F.count_if(~F.col(column).isin(*known)), "==", 0)


def expect_trimmed(column: str) -> Rule:
    return Rule(f"trimmed:{column}", F.count_if(F.trim(F.col(column)) != F.col(column)), "==", 0)


def expect_domain_share(column: str, known: Sequence[str], below: float) -> Rule:
    outside = F.count_if(~F.trim(F.col(column)).isin(*known))
    return Rule(f"domain_share:{column}", share(outside, F.count(F.lit(1))), "<", below)


_COMPARE = {
    ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "<": lambda a, b: a < b,
    ">": lambda a, b: a > b, "==": lambda a, b: a == b,
}
_LINE = ("check", "observed", "limit", "passed")


def _line(name: str, observed: Column, op: str, limit: float) -> Column:
    value = F.round(observed.cast("double"), 6)
    return F.struct(
        F.lit(name).alias("check"), value.alias("observed"), F.lit(f"{op} {limit:g}").alias("limit"),
        F.coalesce(_COMPARE[op](observed.cast("double"), F.lit(float(limit))), F.lit(False)).alias("passed"))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check, observed, limit, passed): all rules from one aggregation."""
    one = df.agg(*[r.observed.alias(f"r{i}") for i, r in enumerate(rules)])
    lines = F.array(*[_line(r.name, F.col(f"r{i}"), r.op, r.limit) for i, r in enumerate(rules)])
    return one.select(F.inline(lines))


def expect_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Looks at the schema only."""
    missing = len(set(columns) - set(df.columns))
    return df.sparkSession.range(1).select(F.inline(F.array(_line("columns", F.lit(missing), "==", 0))))


def expect_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    extra = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(F.sum("extra").alias("extra"))
    return extra.select(F.inline(F.array(_line(
        f"unique:{','.join(key)}", F.coalesce(F.col("extra"), F.lit(0)), "==", 0))))


def expect_copies_share(df: DataFrame, most: float) -> DataFrame:
    """Share of rows that repeat an earlier row in every column."""
    one = count_copies(df).agg(F.sum(COPIES).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"))
    repeated = share(F.col("rows") - F.col("distinct_rows"), F.col("rows"))
    return one.select(F.inline(F.array(_line("copies_share", repeated, "<=", most))))


def expect_max_share(df: DataFrame, column: str, most: float) -> DataFrame:
    """Share of the most frequent value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    one = counts.agg(F.max("rows").alias("top"), F.sum("rows").alias("rows"))
    return one.select(F.inline(F.array(_line(f"max_share:{column}", share(F.col("top"), F.col("rows")), "<=", most))))


def expect_row_ratio(df: DataFrame, base: DataFrame, least: float) -> DataFrame:
    """Rows of `df` in relation to the rows of `base`."""
    both = (
        df.select(F.lit(1).alias("a"), F.lit(0).alias("b"))
        .unionAll(base.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    return both.select(F.inline(F.array(_line("row_ratio", share(F.col("a"), F.col("b")), ">=", least))))


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [p.select(*_LINE) for p in parts])


def expectations_bronze(df: DataFrame, min_rows: int = 4000, max_unknown: float = 0.05,
                        max_copies: float = 0.05) -> DataFrame:
    spellings = (*AREAS, "TECNOLOGIA", "tecnologia")
    rules = [
        expect_min_rows(min_rows), expect_not_null(KEY), expect_positive(KEY),
        expect_domain_share("area", spellings, max_unknown),
    ]
    return union_checks([
        evaluate(df, rules), expect_columns(df, REQUIRED_BRONZE), expect_copies_share(df, max_copies)])


def expectations_silver(df: DataFrame, bronze: DataFrame, max_share: float = 0.70,
                        min_ratio: float = 0.85) -> DataFrame:
    rules = [
        expect_between(ENGAGEMENT, *ENGAGEMENT_SCALE), expect_not_null(ENGAGEMENT),
        expect_between(SALARY, *SALARY_PLAUSIBLE), expect_order(START, END),
        expect_domain("status", (ACTIVE, LEFT)), expect_trimmed("area"),
        expect_not_null("genero"), expect_not_null("raca_cor"),
    ]
    return union_checks([
        evaluate(df, rules), expect_unique(df, [KEY]), expect_max_share(df, "senioridade", max_share),
        expect_row_ratio(df, bronze, min_ratio)])


def bronze_gate(df: DataFrame, min_rows: int = 4000, max_copies: float = 0.01,
                salary: Sequence[float] = SALARY_PLAUSIBLE, engagement: Sequence[float] = ENGAGEMENT_SCALE,
                earliest: str = "2000-01-01", max_out_of_range: int = 0) -> DataFrame:
    """The six intake checks. Copies are counted first, so one scan and one shuffle serve all of them.

    Silver repairs values out of range, so an export with a few of them can be let in by `max_out_of_range` rows.
    """
    rows = count_copies(df)
    weight = F.col(COPIES)

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    total = F.coalesce(F.sum(weight), F.lit(0))
    started = parse_date(F.col(START))
    rules = [
        Rule("min_rows", total, ">=", min_rows),
        Rule("key_nulls", rows_where(F.col(KEY).isNull()), "==", 0),
        Rule("copies_share", share(total - F.count(F.lit(1)), total), "<=", max_copies),
        Rule("salary_range", rows_where(~F.col(SALARY).between(*salary)), "<=", max_out_of_range),
        Rule("engagement_range", rows_where(~F.col(ENGAGEMENT).between(*engagement)), "<=", max_out_of_range),
        Rule("start_date", rows_where(started.isNull() | (started <= F.lit(earliest).cast("date"))), "==", 0),
    ]
    return evaluate(rows, rules)


def quality_sla(df: DataFrame, key_target: float = 1.0, key_alert: float = 0.995, copies_target: float = 0.005,
                copies_alert: float = 0.01, range_target: float = 1.0, range_alert: float = 0.99,
                auc: float | None = None, auc_target: float = 0.65, auc_alert: float = 0.60) -> DataFrame:
    """(metric, observed, target, alert, state): `ok` on target, `alert` past the alert limit, else `warn`."""
    weight = F.col(COPIES)
    one = count_copies(df).agg(
        F.sum(weight).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.when(F.col(KEY).isNotNull(), weight)).alias("keyed"),
        F.sum(F.when(F.col(ENGAGEMENT).isNotNull(), weight)).alias("scored"),
        F.sum(F.when(F.col(ENGAGEMENT).between(*ENGAGEMENT_SCALE), weight)).alias("in_scale"),
    )

    def line(metric: str, value: Column, target: float, alert: float, higher_is_better: bool) -> Column:
        on_target = value >= target if higher_is_better else value < target
        past_alert = value < alert if higher_is_better else value > alert
        state = F.when(past_alert, F.lit("alert")).when(on_target, F.lit("ok")).otherwise(F.lit("warn"))
        return F.struct(
            F.lit(metric).alias("metric"), F.round(value, 6).alias("observed"), F.lit(float(target)).alias("target"),
            F.lit(float(alert)).alias("alert"), state.alias("state"))

    rows = F.col("rows")
    lines = [
        line("key_completeness", share(F.col("keyed"), rows), key_target, key_alert, True),
        line("copies_share", share(rows - F.col("distinct_rows"), rows), copies_target, copies_alert, False),
        line("engagement_in_range", share(F.col("in_scale"), F.col("scored")), range_target, range_alert, True),
    ]
    if auc is not None:
        lines.append(line("model_auc", F.lit(float(auc)), auc_target, auc_alert, True))
    return one.select(F.inline(F.array(*lines)))


# --- personal data -------------------------------------------------------------------------------------

def protect_pii(df: DataFrame, salt: str, keys: Sequence[str] = (KEY, "gestor_matricula"),
                masked: Sequence[str] = ("nome_ficticio",),
                dropped: Sequence[str] = ("genero", "raca_cor", SALARY)) -> DataFrame:
    """Salted pseudonyms for keys (equal keys stay equal, so joins still work), a fixed mask for names, and no
    sensitive columns: these appear in aggregates only."""
    def treated(name: str) -> Column:
        if name in keys:
            return F.sha2(F.concat(F.lit(salt), F.col(name).cast("string")), 256)
        if name in masked:
            return F.when(F.col(name).isNotNull(), F.lit("***"))
        return F.col(name)

    return df.select(*[treated(c).alias(c) for c in df.columns if c not in dropped])


def suppress_small_cells(table: DataFrame, count: str, least: int, columns: Sequence[str]) -> DataFrame:
    """Hide the measures, and the count, of groups with fewer than `least` people."""
    shown = F.col(count) >= least
    return table.withColumns({c: F.when(shown, F.col(c)) for c in (*columns, count)})


def sensitive_aggregate(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], least: int) -> DataFrame:
    """Aggregate over sensitive columns with small cells hidden."""
    table = df.groupBy(*by).agg(F.count(F.lit(1)).alias("headcount"), *[c.alias(n) for n, c in measures.items()])
    return suppress_small_cells(table, "headcount", least, list(measures))
