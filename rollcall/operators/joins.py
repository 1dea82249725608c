"""Joins of the upstream tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.dedup import dedup_latest
from rollcall.schema import END, KEY, KIND, REASON


def attach_departures(people: DataFrame, departures: DataFrame, key: str = KEY,
                      columns: Sequence[str] = (END, KIND, REASON)) -> DataFrame:
    """Each person with the latest of their departures, NULL where there is none.

    Departures are merged to one row per key first: the join then cannot multiply rows, and a key with very many
    departures is merged before the shuffle.
    """
    latest = dedup_latest(departures.select(key, *columns), [key], [F.col(columns[0])])
    return people.join(latest, key, "left")
