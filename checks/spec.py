"""Column lists that both sides of a comparison are brought to.

`int` is a 64-bit integer, `dN` a double rounded to N places, `text` also covers dates, `flag` is a boolean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = dict[str, str]


def spec(text: str) -> Spec:
    """Parse `a:int b c:d2`; a column without a type is text."""
    return {n: (t or "text") for n, _, t in (item.partition(":") for item in text.split())}


def _spark_column(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "text":
        return column.cast("string").alias(name)
    if kind == "int":
        return column.cast("bigint").alias(name)
    if kind == "flag":
        return column.cast("boolean").alias(name)
    return F.round(column.cast("double"), int(kind[1:])).alias(name)


def _sql_column(name: str, kind: str) -> str:
    name = f'"{name}"'
    if kind == "text":
        return f"CAST({name} AS VARCHAR) AS {name}"
    if kind == "int":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind == "flag":
        return f"CAST({name} AS BOOLEAN) AS {name}"
    return f"round(CAST({name} AS DOUBLE), {kind[1:]}) AS {name}"


def shape_frame(df: DataFrame, columns: Spec) -> DataFrame:
    return df.select(*[_spark_column(n, k) for n, k in columns.items()])


def shape_sql(ctes: str, query: str, columns: Spec) -> str:
    listed = ", ".join(_sql_column(n, k) for n, k in columns.items())
    return f"{ctes}, answer AS (\n{query}\n)\nSELECT {listed} FROM answer"
