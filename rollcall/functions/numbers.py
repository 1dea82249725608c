"""Numeric helpers and literal lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCORE = "decimal(18,6)"
MONEY = "decimal(18,2)"


def is_missing(column: Column) -> Column:
    """NULL or NaN, for floating point columns."""
    return column.isNull() | F.isnan(column)


def clamp(column: Column, low: float, high: float) -> Column:
    """Keep within [low, high]; NULL stays NULL (greatest/least alone would skip it)."""
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), column))
    return F.when(column.isNotNull(), bounded)


def exact_mean(column: Column, as_type: str = SCORE) -> Column:
    """Mean over decimals: the sum does not depend on the order in which partitions arrive."""
    value = column.cast(as_type)
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent; NULL when the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value of `key` in a literal map, NULL when absent."""
    entries: list[Column] = []
    for name, value in table.items():
        entries.append(F.lit(name))
        entries.append(F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    return F.try_element_at(F.create_map(*entries), key)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: Mapping[str, str]) -> DataFrame:
    """A small table written out in code, e.g. a seeded dimension. Its size is the code's, not the data's."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, schema.items(), strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
