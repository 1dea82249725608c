"""Exact medians by group, and imputation with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import is_missing
from rollcall.sources.store import Store

CELLS_PER_OCTAVE = 1024


def _cell(value: Column) -> Column:
    """A coarse position that never decreases as the value grows: about 0.07 % wide, whatever the scale.

    There are at most some four million cells, and a few thousand in practice, so the cells of one group fit one task.
    """
    # Exponents of doubles lie above -1075, so the shifted position is positive; zero lies between the signs, and
    # infinity counts as an exponent of 1025.
    exponent = F.least(F.log2(F.abs(value)), F.lit(1025.0))
    size = F.floor(exponent * CELLS_PER_OCTAVE) + 1075 * CELLS_PER_OCTAVE
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("bigint") * size)


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median of `value` by `keys`: one row per group that has any value.

    Spark's own `median` keeps all distinct values of a group in the memory of one task. Here values are counted by
    (group, value) first, a histogram of cells finds the cell holding the middle, and only that cell's values are
    put in order. No step holds a group's rows in one task, however large the group.
    """
    number = F.col(value).cast("double")
    counts = (
        df.where(~is_missing(number))
        .groupBy(*keys, number.alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cell", _cell(F.col("v")))
    )
    group = Window.partitionBy(*keys)
    cells = counts.groupBy(*keys, "cell").agg(F.sum("n").alias("in_cell"))
    running = F.sum("in_cell").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    # The middle rows, counted from 1: (total + 1) div 2 and total div 2 + 1. They may lie in two cells.
    total = F.sum("in_cell").over(group)
    middle = (
        cells.select(*keys, "cell", (running - F.col("in_cell")).alias("before"), running.alias("upto"),
                     F.floor((total + 1) / 2).alias("lo"), (F.floor(total / 2) + 1).alias("hi"))
        .where((F.col("before") < F.col("hi")) & (F.col("upto") >= F.col("lo")))
    )
    m = middle.select(*[F.col(k).alias(f"m_{k}") for k in keys], F.col("cell").alias("m_cell"), "before", "lo", "hi")
    # Null-safe also for the cell: a plain equality adds a filter to one use of `counts`, and the two uses would no
    # longer share their shuffle.
    same = F.col("cell").eqNullSafe(F.col("m_cell"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"m_{k}"))
    within = Window.partitionBy(*keys, "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.join(m, same).withColumn("upto", F.col("before") + F.sum("n").over(within))
    covers = (F.col("upto") >= F.col("lo")) & (F.col("upto") - F.col("n") < F.col("hi"))
    # One or two values cover the middle: their least and greatest are the two middle rows.
    ends = placed.where(covers).groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return ends.select(*keys, ((F.col("low") + F.col("high")) / 2).alias(out))


def group_medians(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exact medians of several columns, each by keys of its own, from one scan: (metric, k0, k1, ..., median).

    Keys are held as text, so that the targets share the columns; a target with fewer keys leaves the rest NULL.
    """
    width = max(len(keys) for keys in targets.values())
    lines = F.array(*[
        F.struct(
            F.lit(column).alias("metric"),
            *[(F.col(keys[i]) if i < len(keys) else F.lit(None)).cast("string").alias(f"k{i}") for i in range(width)],
            F.col(column).cast("double").alias("value"))
        for column, keys in targets.items()])
    return group_median(df.select(F.inline(lines)), ["metric", *[f"k{i}" for i in range(width)]], "value")


def group_median_approx(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                        accuracy: int = 10000) -> DataFrame:
    """Approximate median by group in a single aggregation."""
    number = F.col(value).cast("double")
    return df.where(~is_missing(number)).groupBy(*keys).agg(F.percentile_approx(number, 0.5, accuracy).alias(out))


def fill_from_group(df: DataFrame, column: str, keys: Sequence[str], table: DataFrame,
                    table_keys: Sequence[str] | None = None, out: str = "median") -> DataFrame:
    """Replace NULLs of `column` by the group's value in `table`. The planner broadcasts `table` if it is small."""
    names = [f"g_{i}" for i in range(len(keys))]
    side = table.select(
        *[F.col(k).alias(g) for k, g in zip(table_keys or keys, names, strict=True)], F.col(out).alias("g_value"))
    same = F.lit(True)
    for k, g in zip(keys, names, strict=True):
        key = F.col(k) if table_keys is None else F.col(k).cast("string")
        same = same & key.eqNullSafe(F.col(g))
    filled = F.coalesce(F.col(column), F.col("g_value")).alias(column)
    return df.join(side, same, "left").select(*[filled if c == column else F.col(c) for c in df.columns])


def impute_median(df: DataFrame, column: str, keys: Sequence[str], store: Store | None = None,
                  approx: bool = False) -> DataFrame:
    """Fill NULLs of `column` with the median of its group; a group without values stays NULL.

    With a `store` the medians are written first, so the join is planned on their real size.
    """
    table = (group_median_approx if approx else group_median)(df, keys, column)
    if store is not None:
        table = store.keep(table, f"median_{column}_{'_'.join(keys)}")
    return fill_from_group(df, column, keys, table)


def impute_medians(df: DataFrame, targets: Mapping[str, Sequence[str]], store: Store | None = None) -> DataFrame:
    """Fill NULLs of several columns, each with the median of a grouping of its own. All medians are of the input."""
    table = group_medians(df, targets)
    if store is not None:
        table = store.keep(table, "medians")
    for column, keys in targets.items():
        of_column = table.where(F.col("metric") == column)
        df = fill_from_group(df, column, keys, of_column, [f"k{i}" for i in range(len(keys))])
    return df
