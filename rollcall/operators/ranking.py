"""Exact order statistics over tables of any size: running totals, ROC-AUC with ties, a split exact in every class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.schema import KEY
from rollcall.sources.store import Store

#: Leading hexadecimal digits of a hash that number its cell.
CELL_DIGITS = 4


def running_total(df: DataFrame, store: Store, order: Sequence[str], column: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `column` over all rows before this one.

    Rows are ranged over tasks, so no task sees them all; the sums of the ranges, one per task, give the offsets.
    `order` must tell rows apart.
    """
    ranged = store.keep(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), f"ranged_{name}")
    total = ranged.groupBy("_range").agg(F.sum(column).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    offset = total.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(offset, "_range")
            .withColumn(name, F.col("_offset") + F.coalesce(F.sum(column).over(inside), F.lit(0)))
            .drop("_range", "_offset"))


def roc_auc(df: DataFrame, store: Store, score: str = "score", label: str = "label") -> DataFrame:
    """One row (roc_auc, positives, negatives): the chance that a positive outranks a negative, ties counting half.

    The rank sum of Mann and Whitney in whole numbers: rows are counted per distinct score first, then every score
    needs the negatives below it. Rows without score or label are left out; with one class only the result is NULL.
    """
    positive = F.col(label) == 1
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    by_score = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    ranked = running_total(by_score, store, ["score"], "neg", "below")
    wins = F.col("pos").cast("decimal(18,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")
    summed = ranked.agg(F.sum(wins).alias("wins"), F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
                        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return summed.select((F.col("wins").cast("double") / F.nullif(2 * pairs, F.lit(0.0))).alias("roc_auc"),
                         "positives", "negatives")


def key_hash(key: str | Column, seed: int) -> Column:
    """A hash that other engines have too, as hexadecimal text."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key) if isinstance(key, str) else key), 256)


def stratified_split(df: DataFrame, store: Store, label: str = "label", key: str = KEY, share: int = 75,
                     seed: int = 42, name: str = "in_train") -> DataFrame:
    """Adds the flag `name`: in every class exactly `share` percent of the rows, rounded down, have it.

    Inside a class the rows with the smallest hashes of the key are taken. The last hash to take is found in two
    steps: a count per class and cell of hashes, at most 65536 cells each, finds the cell; only its rows are put in
    order. The choice hangs on keys alone, so reruns agree. Rows of one key stay together, so a repeated key at the
    border may add rows.
    """
    hashed = df.select("*", key_hash(key, seed).alias("_hash"), F.col(label).alias("_class"))
    cell = F.substring("_hash", 1, CELL_DIGITS)
    counts = store.keep(hashed.groupBy("_class", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")), "cells")
    of_class = Window.partitionBy("_class")
    spans = counts.select(
        "*", (F.sum("_n").over(of_class.orderBy("_cell")) - F.col("_n")).alias("_before"),
        F.expr(f"sum(_n) OVER (PARTITION BY _class) * {int(share)} DIV 100").alias("_target"))
    cut = store.keep(
        spans.where((F.col("_before") <= F.col("_target")) & (F.col("_target") < F.col("_before") + F.col("_n")))
        .select(F.col("_class").alias("_c"), F.col("_cell").alias("_last"),
                (F.col("_target") - F.col("_before")).alias("_take")), "cut")
    same = F.col("_class").eqNullSafe(F.col("_c"))
    order = F.struct("_hash", key)
    placed = hashed.join(cut, same & (cell == F.col("_last"))).withColumn(
        "_place", F.row_number().over(Window.partitionBy("_c").orderBy("_hash", key)))
    border = placed.where(F.col("_place") <= F.col("_take")).groupBy(F.col("_c").alias("_b")).agg(
        F.max(order).alias("_border"))
    limits = store.keep(cut.join(border, F.col("_c").eqNullSafe(F.col("_b")), "left").drop("_b"), "limits")
    inside = (cell < F.col("_last")) | (cell == F.col("_last")) & F.coalesce(order <= F.col("_border"), F.lit(False))
    return hashed.join(limits, same, "left").select(
        *df.columns, F.coalesce(inside, F.lit(share >= 100)).alias(name))
