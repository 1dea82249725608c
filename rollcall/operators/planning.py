"""Workforce plan and action plan."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    ACTION_OWNERS, ANNUAL_GROWTH, HEADCOUNT_WITHOUT_BASE, REASON_ACTION, REASON_ACTION_OTHERWISE)
from rollcall.functions import lookup, month_key
from rollcall.operators.kpis import ranked_causes

#: Texts of our own that state the figures and nothing else; a caller passes what their readers should see.
ACTION_TEXTS = {
    "why": "{share}% dos pedidos de saída: {cause} (mais em {area})", "where": "{area}", "when": "D+{days}",
    "how": "Plano por causa: {cause}"}
CYCLE_TEXTS = {
    "plan": "Causa: {cause} ({share}%)", "do": "Área: {area}", "check": "Indicador: {share}% por {cause}",
    "act": "Decidir em {area}"}


def workforce_plan(headcount: DataFrame, areas: DataFrame, start: str | dt.date, months: int = 6,
                   growth: float = ANNUAL_GROWTH, otherwise: int = HEADCOUNT_WITHOUT_BASE) -> DataFrame:
    """Planned headcount by future month and area: base * (1 + growth / 12) ^ i."""
    first = dt.date.fromisoformat(start) if isinstance(start, str) else start
    base = areas.select("area").join(headcount.select("area", "headcount"), "area", "left")
    steps = base.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(months))))
    planned = F.coalesce("headcount", F.lit(otherwise)) * F.pow(F.lit(1 + growth / 12), F.col("i"))
    return steps.select(
        month_key(F.add_months(F.lit(first), F.col("i") - 1)).alias("competencia"), "area",
        F.round(planned, 0).cast("bigint").alias("headcount_planejado"))


def plan_gap(plan: DataFrame, projected: DataFrame) -> DataFrame:
    """Projected minus planned headcount; a month without a projection has no gap."""
    both = plan.join(projected.select("competencia", "area", F.col("headcount").alias("headcount_projetado")),
                     ["competencia", "area"], "left")
    return both.withColumn("gap", F.col("headcount_projetado") - F.col("headcount_planejado"))


def _deadline(position: Column) -> Column:
    return F.when(position <= 4, 30).when(position <= 7, 60).otherwise(90)


def _plan_id(position: Column) -> Column:
    return F.concat(F.lit("PA"), F.lpad(position.cast("string"), 3, "0"))


def _owner(position: Column, owners: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, owners)), F.pmod(position - 1, F.lit(len(owners))) + 1)


def _action(cause: Column) -> Column:
    return F.coalesce(lookup(cause, REASON_ACTION), F.lit(REASON_ACTION_OTHERWISE))


def action_plan(causes: DataFrame, most: int = 10, owners: Sequence[str] = ACTION_OWNERS) -> DataFrame:
    """One action per cause, by rank: the first four within 30 days, the next three within 60, the rest within 90."""
    position, cause = F.col("position"), F.col("causa_raiz_desc")
    return ranked_causes(causes, most).select(
        _plan_id(position).alias("id"),
        cause.alias("causa_raiz"),
        F.col("area_predominante").alias("area_foco"),
        _action(cause).alias("acao_proposta"),
        _deadline(position).alias("horizonte_dias"),
        F.when(position <= 4, F.lit("Alta")).when(position <= 7, F.lit("Média")).otherwise(F.lit("Baixa"))
        .alias("prioridade"),
        _owner(position, owners).alias("responsavel"),
    )


def _text(template: str, values: Mapping[str, Column]) -> Column:
    """Each {name} of a template replaced by its value, all from the template: a value that looks like a name stays.
    NULL if a value that the template names is NULL."""
    parts = re.split("(" + "|".join(rf"\{{{name}\}}" for name in values) + ")", template)
    return F.concat(F.lit(""), *[
        values[p[1:-1]].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def action_details(causes: DataFrame, most: int = 10, owners: Sequence[str] = ACTION_OWNERS,
                   texts: Mapping[str, str] = ACTION_TEXTS) -> DataFrame:
    """What, why, who, where, when and how of each action. `texts` are templates over {cause}, {share}, {area}, {days}."""
    position, cause = F.col("position"), F.col("causa_raiz_desc")
    values = {"cause": cause, "share": F.col("pct_do_total_voluntario"), "area": F.col("area_predominante"),
              "days": _deadline(position)}
    made = {name: _text(texts[name], values).alias(name) for name in ("why", "where", "when", "how")}
    return ranked_causes(causes, most).select(
        _plan_id(position).alias("plano_id"), _action(cause).alias("what"), made["why"],
        _owner(position, owners).alias("who"), made["where"], made["when"], made["how"])


def improvement_cycles(causes: DataFrame, most: int = 5, texts: Mapping[str, str] = CYCLE_TEXTS) -> DataFrame:
    """Plan, do, check and act for the most frequent causes. `texts` are templates over {cause}, {share}, {area}."""
    values = {"cause": F.col("causa_raiz_desc"), "share": F.col("pct_do_total_voluntario"),
              "area": F.col("area_predominante")}
    return ranked_causes(causes, most).select(
        F.col("causa_raiz_desc").alias("causa_raiz"),
        *[_text(texts[name], values).alias(name) for name in ("plan", "do", "check", "act")])
