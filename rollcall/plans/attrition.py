"""The daily model step: train on the first Monday of a month, otherwise score with the saved model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rollcall.operators import kpis, model
from rollcall.operators.quality import require
from rollcall.sources.store import Store


@dataclass(frozen=True)
class Outcome:
    scores: DataFrame
    risk_by_area: DataFrame
    top_risk: DataFrame
    metrics: DataFrame | None
    """Quality of a newly trained model; None on days that only score."""


def retrains_on(day: dt.date) -> bool:
    """First Monday of a month, as `model.is_retrain_day`."""
    return day.weekday() == 0 and day.day <= 7


def _outcome(forest: model.AttritionModel, silver: DataFrame, day: dt.date, store: Store,
             metrics: DataFrame | None = None) -> Outcome:
    scores = store.keep(model.score_attrition(forest, silver, day), "scores")
    return Outcome(scores, kpis.risk_by_area(scores), kpis.top_risk(scores), metrics)


def run(silver: DataFrame, day: dt.date, model_path: str, store: Store, ref: dt.date | None = None,
        days: int = 365, train: bool | None = None, gate: bool = True, trees: int = 100) -> Outcome:
    """Train (if `train`, or on a retraining day) or load, then score everyone active.

    A new model replaces the saved one only after it passed the gate.
    """
    if not (retrains_on(day) if train is None else train):
        return _outcome(model.load_model(silver.sparkSession, model_path), silver, day, store)
    ref = ref or day - dt.timedelta(days=days)
    labelled = store.keep(model.label_attrition(silver, ref, days), "labelled")
    fitting, holdout = model.split_rows(labelled, store)
    forest = model.train_attrition(fitting, trees=trees, store=store)
    fresh = _outcome(forest, silver, day, store)
    metrics = store.keep(model.model_metrics(forest, fitting, holdout, fresh.scores, ref, days), "metrics")
    if gate:
        require(model.model_gate(metrics, fresh.scores))
    model.save_model(forest, model_path)
    return Outcome(fresh.scores, fresh.risk_by_area, fresh.top_risk, metrics)
