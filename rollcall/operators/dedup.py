"""Removing copies.

Both steps are aggregations, so copies are merged before the shuffle: a key that holds a third of all rows reaches
its reducer as one row per map task, where a `row_number` window would sort all of them in a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "n_copies"
VERSIONS = "n_versions"


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of times each occurs. Rows that are already counted are returned as they are,
    so one counted table can serve the gate and the cleaning."""
    if COPIES in df.columns:
        return df
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str) -> Column:
    rest = [F.col(c) for c in df.columns if c not in keys and c != COPIES]
    if keep == "latest":
        ranked = [o.alias(f"order_{i}") for i, o in enumerate(order)]
        return F.max(F.struct(*ranked, *rest))
    if keep == "first":
        ranked = [x for i, o in enumerate(order) for x in (o.isNull().alias(f"null_{i}"), o.alias(f"order_{i}"))]
        return F.min(F.struct(*ranked, *rest))
    raise ValueError(f"keep must be 'latest' or 'first', not {keep!r}")


def _group(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys; and for a row with an unreadable key, which is NULL, its other columns too, so that rows of different
    people are never merged for want of a key."""
    unreadable = reduce(or_, [F.col(k).isNull() for k in keys])
    rest = [F.col(c) for c in df.columns if c not in keys and c != COPIES]
    return [*[F.col(k) for k in keys], F.when(unreadable, F.struct(*rest)).alias("_unkeyed")]


def dedup_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "latest") -> DataFrame:
    """One row per key: the latest (or first) by `order`, NULLs losing either way.

    Ties go to the greatest (smallest) row by the remaining columns, so the choice does not depend on row order.
    Rows with a NULL key are merged with equal rows only.
    The whole row is the aggregate, hence columns must be orderable (no maps).
    """
    picked = df.groupBy(*_group(df, keys)).agg(_pick(df, keys, order, keep).alias("picked"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"picked.`{c}`") for c in df.columns])


def dedup_counted(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """As `dedup_key` on the distinct rows, with counts of rows and of distinct rows per key for the quality log."""
    distinct = count_copies(df)
    picked = distinct.groupBy(*_group(distinct, keys)).agg(
        _pick(distinct, keys, order, "latest").alias("picked"),
        F.sum(COPIES).alias(COPIES),
        F.count(F.lit(1)).alias(VERSIONS),
    )
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"picked.`{c}`") for c in distinct.columns if c != COPIES],
        COPIES, VERSIONS)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return dedup_key(df, keys, order, "latest")


def replace_values(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(values), subset=[column])
