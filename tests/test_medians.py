from __future__ import annotations

import math
import statistics

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rollcall.operators import medians

SCHEMA = "g string, h string, v double"
SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute(data):
    groups = {}
    for g, h, v in data:
        if v is not None and not math.isnan(v):
            groups.setdefault((g, h), []).append(v)
    return {k: statistics.median(v) for k, v in groups.items()}


@SETTINGS
@given(st.lists(st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from(["x", None]),
    st.one_of(st.none(), st.floats(-1e6, 1e6, width=32), st.integers(-5, 5).map(float), st.just(math.nan))),
    min_size=1, max_size=80))
def test_equals_brute_force(spark, data):
    got = medians.group_median(spark.createDataFrame(data, SCHEMA), ["g", "h"], "v").collect()
    assert {(r.g, r.h): r.median for r in got} == brute(data)


def test_even_group_spans_two_cells(spark):
    df = spark.createDataFrame([("a", "x", v) for v in (1.0, 2.0, 1000.0, 1e9)], SCHEMA)
    assert rows(medians.group_median(df, ["g"], "v"), "g", "median") == [("a", 501.0)]


def test_cells_never_decrease(spark):
    values = [-math.inf, -1e308, -2.0, -1.0, -0.3, -5e-324, -0.0, 0.0, 5e-324, 1e-9, 0.3, 1.0, 1.5, 2.0, 1e308, math.inf]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    cells = [r[0] for r in df.orderBy("i").select(medians._cell(df.v)).collect()]
    assert cells == sorted(cells) and cells[6] == cells[7] == 0 and cells[5] < 0 < cells[8]


def test_hot_group(spark):
    """One group holds a third of the rows, in few and in many distinct values."""
    data = [("hot" if i % 3 == 0 else f"g{i % 500}", "x", float((i * 7919) % 10_007) / 8) for i in range(30_000)]
    got = medians.group_median(spark.createDataFrame(data, SCHEMA).repartition(8), ["g", "h"], "v").collect()
    assert {(r.g, r.h): r.median for r in got} == brute(data)


def test_group_without_values_stays_null(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", 1.0), ("b", "x", None), ("b", "x", 4.0)], SCHEMA)
    assert rows(medians.impute_median(df, "v", ["g"]), "g", "v") == [("a", None), ("b", 1.0), ("b", 2.5), ("b", 4.0)]


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, "x", 3.0), (None, "x", None)], SCHEMA)
    assert rows(medians.impute_median(df, "v", ["g"]), "v") == [(3.0,), (3.0,)]


def test_several_targets_use_the_input_medians(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0, 10.0), ("a", "x", None, 20.0), ("a", "y", 5.0, None), ("a", "y", None, 7.0)],
        "g string, h string, v double, w double")
    got = medians.impute_medians(df, {"v": ["g"], "w": ["g", "h"]})
    assert rows(got, "v", "w") == [(1.0, 10.0), (3.0, 20.0), (3.0, 7.0), (5.0, 7.0)]


def test_approximate_median_is_a_value_of_the_group(spark):
    df = spark.createDataFrame([("a", "x", v) for v in (1.0, 2.0, 10.0, 20.0)], SCHEMA)
    assert rows(medians.group_median_approx(df, ["g"], "v"), "median") == [(2.0,)]
