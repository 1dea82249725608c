"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.queries import QUERIES

WITHOUT_SQL = {
    "attrition_scores", "risk_by_area", "top_risk", "importances", "model_metrics", "model_gate", "export_document"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_but_the_listed():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == WITHOUT_SQL
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["competencia", "area", "desligamentos", "voluntarios"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


SLOW_TO_PLAN = {"incremental_ingest", "late_export", "refreshed_exports", "export_document", "intake_quarantine"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW_TO_PLAN])
def test_no_cross_join_and_no_python_in_plans(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad
