"""Shuffles grow with the table, so that a task's share of it does not."""

from __future__ import annotations

import pytest

from checks.queries import Tables
from conftest import SF
from rollcall import session
from rollcall.sources import bronze_view, trade_view


@pytest.fixture
def unsized(spark):
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    spark.conf.unset(session.INITIAL_PARTITIONS)
    yield spark
    spark.conf.unset(session.INITIAL_PARTITIONS)
    if before:
        spark.conf.set(session.INITIAL_PARTITIONS, before)


def test_shuffles_of_a_large_table_start_from_more_partitions(unsized, monkeypatch):
    fixed = int(unsized.conf.get("spark.sql.shuffle.partitions"))
    assert Tables(unsized, SF).bronze.count() == bronze_view(unsized, SF).count()
    assert unsized.conf.get(session.INITIAL_PARTITIONS, None) is None  # a small table leaves the session alone
    monkeypatch.setattr(session, "PARTITION_ROWS", 10)
    large = Tables(unsized, SF)
    assert large.people == trade_view.order_count(unsized, SF) == 1500
    assert int(unsized.conf.get(session.INITIAL_PARTITIONS)) == 150 > fixed
    assert large.bronze.rdd.getNumPartitions() == 150
    assert large.bronze.exceptAll(bronze_view(unsized, SF)).isEmpty()
