"""Categories with any number of values as numbers: smoothed means of the label, out of fold while training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.ranking import key_hash
from rollcall.schema import KEY

FOLDS, SMOOTHING = 5, 20


def fold_of(key: str, folds: int, seed: int):
    return F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint") % folds


def category_means(df: DataFrame, column: str, label: str = "label", smoothing: float = SMOOTHING) -> DataFrame:
    """(column, mean): the label's mean per value, drawn towards the mean of all by `smoothing` rows; plus one row
    for values that do not occur, marked by `other`."""
    per = df.groupBy(column).agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    total = df.agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    prior = F.col("_all") / F.nullif(F.col("_rows"), F.lit(0))
    every = per.select(column, "_s", "_n", F.lit(False).alias("other")).unionByName(
        total.select(F.lit(None).cast(df.schema[column].dataType).alias(column), F.lit(0.0).alias("_s"),
                     F.lit(0).cast("bigint").alias("_n"), F.lit(True).alias("other")))
    known = every.select("*", total.select("_s").scalar().alias("_all"), total.select("_n").scalar().alias("_rows"))
    mean = (F.col("_s") + smoothing * F.coalesce(prior, F.lit(0.0))) / (F.col("_n") + smoothing)
    return known.select(column, "other", mean.alias("mean"))


def encode(df: DataFrame, means: DataFrame, column: str, name: str) -> DataFrame:
    """Adds `name`: the mean of the row's value; values that were not seen get the mean of all."""
    seen = means.where(~F.col("other")).select(F.col(column).alias("_value"), F.col("mean").alias("_mean"))
    rest = means.where("other").select("mean").scalar()
    return (df.join(seen, F.col(column).eqNullSafe(F.col("_value")), "left")
            .withColumn(name, F.coalesce("_mean", rest)).drop("_value", "_mean"))


def encode_out_of_fold(df: DataFrame, column: str, name: str, label: str = "label", key: str = KEY,
                       folds: int = FOLDS, smoothing: float = SMOOTHING, seed: int = 42) -> DataFrame:
    """Adds `name`: the smoothed mean of the row's value over the rows of all other folds.

    No row contributes to its own number, nor does any row of its fold. Labels are summed per value and fold before
    anything is shuffled; a value's total is the sum of its folds, so the table of means has at most as many rows as
    values times folds, and the one join back is on value and fold.
    """
    with_fold = df.withColumn("_fold", fold_of(key, folds, seed))
    cells = with_fold.groupBy(F.col(column).alias("_value"), "_fold").agg(
        F.sum(label).alias("_s"), F.count(label).alias("_n"))
    parts = F.collect_list(F.struct("_fold", "_s", "_n"))  # at most `folds` entries
    totals = cells.groupBy("_value").agg(F.sum("_s").alias("_vs"), F.sum("_n").alias("_vn"), parts.alias("_parts"))
    by_fold = with_fold.groupBy(F.col("_fold").alias("_f")).agg(F.sum(label).alias("_fs"), F.count(label).alias("_fn"))
    overall = df.agg(F.sum(label).alias("_as"), F.count(label).alias("_an"))
    priors = by_fold.select("_f", F.coalesce(
        (overall.select("_as").scalar() - F.col("_fs"))
        / F.nullif(overall.select("_an").scalar() - F.col("_fn"), F.lit(0)), F.lit(0.0)).alias("_prior"))
    others = totals.select("_value", "_vs", "_vn", F.inline("_parts")).join(priors, F.col("_fold") == F.col("_f"))
    mean = ((F.col("_vs") - F.col("_s") + smoothing * F.col("_prior")) / (F.col("_vn") - F.col("_n") + smoothing))
    table = others.select("_value", F.col("_fold").alias("_g"), mean.alias(name))
    return (with_fold.join(table, F.col(column).eqNullSafe(F.col("_value")) & (F.col("_fold") == F.col("_g")), "left")
            .drop("_value", "_g", "_fold"))
