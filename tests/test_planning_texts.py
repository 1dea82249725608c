"""Templates of action texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators.planning import _text


def test_values_are_not_read_as_templates(spark):
    df = spark.createDataFrame([("{b}", "x"), (None, "y"), ("$1\\", "{a}")], "a string, b string")
    values = {"a": F.col("a"), "b": F.col("b")}
    got = df.select(_text("{a} and {b}, {c} {a}", values), _text("none", values), _text("", values), _text("{b}", values))
    assert [tuple(r) for r in got.collect()] == [
        ("{b} and x, {c} {b}", "none", "", "x"), (None, "none", "", "y"), ("$1\\ and {a}, {c} $1\\", "none", "", "{a}")]
