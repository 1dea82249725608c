"""Executive indicators, rankings and grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.fixed_values import (
    ACTIVE, AREA_OTHERWISE, KPI_GOALS, LEFT, REASON_ITEMS, REASON_ITEMS_OTHERWISE, VOLUNTARY)
from rollcall.functions import exact_mean, lookup
from rollcall.functions.numbers import MONEY
from rollcall.schema import ENGAGEMENT, KEY, KIND, PERFORMANCE, REASON, SALARY
from rollcall.sources.store import Store


def area_risk_proxy(df: DataFrame) -> DataFrame:
    """Low and uneven engagement as a stand-in for risk: (10 - mean) * 0.7 + deviation * 0.3 by area."""
    by_area = df.where(F.col("status") == ACTIVE).groupBy("area").agg(
        F.count(KEY).alias("headcount"),
        exact_mean(F.col(ENGAGEMENT)).alias("engajamento_medio"),
        exact_mean(F.col(SALARY), MONEY).alias("salario_medio"),
        exact_mean(F.col(PERFORMANCE)).alias("performance_medio"),
        F.stddev_samp(ENGAGEMENT).alias("engajamento_std"),
    )
    spread = F.coalesce(F.col("engajamento_std"), F.lit(0.0))
    return by_area.withColumn("risco_proxy", (10 - F.col("engajamento_medio")) * 0.7 + spread * 0.3)


def performance_box(performance: Column) -> Column:
    return F.when(performance >= 4, F.lit(3)).when(performance >= 3, F.lit(2)).otherwise(F.lit(1))


def potential_box(engagement: Column, tenure_months: Column) -> Column:
    return (
        F.when((engagement >= 7.5) & (tenure_months <= 60), F.lit(3))
        .when(engagement >= 6, F.lit(2))
        .otherwise(F.lit(1))
    )


def nine_box(df: DataFrame) -> DataFrame:
    """Active people by performance box, potential box and area."""
    return (
        df.where(F.col("status") == ACTIVE)
        .groupBy(
            performance_box(F.col(PERFORMANCE)).alias("perf_box"),
            potential_box(F.col(ENGAGEMENT), F.col("tempo_casa_meses")).alias("pot_box"), "area")
        .agg(
            F.count(KEY).alias("headcount"),
            exact_mean(F.col(ENGAGEMENT)).alias("engajamento_medio"),
            exact_mean(F.col(SALARY), MONEY).alias("salario_medio"),
        )
    )


def root_cause(df: DataFrame) -> DataFrame:
    """Reasons of voluntary departures: count, share, the area where the reason is most frequent, items to look at.

    The share counts voluntary departures; the area counts all departures with the reason, the first by name on ties.
    """
    cells = (
        df.where((F.col("status") == LEFT) & F.col(REASON).isNotNull())
        .groupBy(F.col(REASON).alias("reason"), "area")
        .agg(F.count(F.lit(1)).alias("all_exits"), F.count_if(F.col(KIND) == VOLUNTARY).alias("voluntary"))
    )
    # min of (-count, name) is the most frequent area; areas without a name do not compete.
    rank = F.when(F.col("area").isNotNull(), F.struct((-F.col("all_exits")).alias("n"), F.col("area").alias("area")))
    reasons = cells.groupBy("reason").agg(F.sum("voluntary").alias("voluntary"), F.min(rank)["area"].alias("area"))
    # All exits are summed beside the voluntary ones so that both uses of `cells` need the same columns and share one
    # shuffle.
    total = cells.agg(F.struct(F.sum("voluntary").alias("voluntary"), F.sum("all_exits"))).scalar()["voluntary"]
    return reasons.where(F.col("voluntary") > 0).select(
        F.col("reason").alias("causa_raiz_desc"),
        F.coalesce("area", F.lit(AREA_OTHERWISE)).alias("area_predominante"),
        F.col("voluntary").alias("total_desligamentos"),
        F.round(F.col("voluntary").cast("double") / total * 100, 1).alias("pct_do_total_voluntario"),
        F.coalesce(lookup(F.col("reason"), REASON_ITEMS), F.array(*map(F.lit, REASON_ITEMS_OTHERWISE)))
        .alias("itens_configuracao"),
    )


def ranked_causes(causes: DataFrame, most: int = 10) -> DataFrame:
    """The first `most` causes by count (name on ties) with their position from 1."""
    top = causes.orderBy(F.desc("total_desligamentos"), "causa_raiz_desc").limit(most)
    order = Window.orderBy(F.desc("total_desligamentos"), "causa_raiz_desc")  # over the few rows kept above
    return top.withColumn("position", F.row_number().over(order))


def kpi_cover(series: DataFrame) -> DataFrame:
    """The last month of the series: headcount, turnover of twelve months, promoter score, productivity, payroll,
    and the goals they are compared with. The windows run over the months of the series."""
    months = Window.orderBy("competencia")
    exits = F.sum("desligamentos").over(months.rowsBetween(-11, 0))
    base = F.lag("headcount_total", 12).over(months)
    latest = (
        series.select(
            "competencia", "headcount_total", "enps", "produtividade_index", "custo_folha_total",
            F.round(exits.cast("double") / F.greatest(base, F.lit(1)) * 100, 1).alias("turnover"),
            base.alias("base"))
        .orderBy(F.desc("competencia")).limit(1)
    )
    turnover = F.when(F.col("base").isNotNull(), F.col("turnover"))
    return latest.select(
        "competencia",
        F.col("headcount_total").alias("headcount_atual"),
        turnover.alias("turnover_ltm_pct"),
        F.col("enps").alias("enps_atual"),
        F.col("produtividade_index").alias("produtividade_atual"),
        F.col("custo_folha_total").alias("custo_folha_atual"),
        (turnover <= KPI_GOALS["turnover_ltm_pct"]).alias("turnover_na_meta"),
        (F.col("enps") >= KPI_GOALS["enps"]).alias("enps_na_meta"),
    )


def monthly_kpis(series: DataFrame, month: str) -> DataFrame:
    """Headcount, turnover, engagement and promoter score of one month."""
    return series.where(F.col("competencia") == month).select(
        "competencia", F.col("headcount_total").alias("headcount_ativo"), "turnover_mensal_pct",
        "engajamento_medio", "enps")


def risk_by_area(scores: DataFrame) -> DataFrame:
    return scores.groupBy("area").agg(
        F.count(KEY).alias("headcount"),
        F.round(exact_mean(F.col("risco_attrition_score"), "decimal(18,12)"), 3).alias("risco_medio"),
        F.count_if(F.col("faixa_risco") == "Alto").alias("qtd_alto_risco"),
    )


def top_risk(scores: DataFrame, most: int = 20) -> DataFrame:
    """The `most` people at greatest risk, by key on ties."""
    return scores.orderBy(F.desc("risco_attrition_score"), KEY).limit(most).select(
        KEY, "area", "cargo", "senioridade", "tempo_casa_meses_ref", ENGAGEMENT, PERFORMANCE,
        "risco_attrition_score")


def funnel(events: DataFrame, stages: Sequence[str], keys: Sequence[str] | dict[str, Column], who: str = "user_id",
           stage: str = "event_type", at: str = "ts") -> DataFrame:
    """Distinct people per stage, the ratio of each stage to the one before, and the mean number of days from a
    person's first event of the first stage to the first event of the last stage.

    People are merged first, each to one row per key, so nothing needs a distinct count and a person or key with
    very many events reaches the shuffle as one row per map task.
    """
    by = [c.alias(n) for n, c in keys.items()] if isinstance(keys, dict) else [F.col(k) for k in keys]
    names = list(keys)
    people = events.where(F.col(stage).isin(*stages) & F.col(who).isNotNull()).groupBy(*by, who).agg(
        *[F.min(F.when(F.col(stage) == s, F.col(at))).alias(f"t{i}") for i, s in enumerate(stages)])
    last = len(stages) - 1
    days = F.when(
        F.col(f"t{last}") >= F.col("t0"),
        F.timestamp_diff("SECOND", F.col("t0"), F.col(f"t{last}")).cast("decimal(20,0)"))
    counted = people.groupBy(*names).agg(
        *[F.count(f"t{i}").alias(s) for i, s in enumerate(stages)],
        (F.sum(days).cast("double") / F.nullif(F.count(days), F.lit(0)) / 86400).alias("mean_days"))
    ratios = [
        F.round(F.col(b).cast("double") / F.nullif(F.col(a), F.lit(0)), 4).alias(f"{a}_to_{b}")
        for a, b in zip(stages, stages[1:])
    ]
    return counted.select(*names, *stages, *ratios, F.round("mean_days", 4).alias("mean_days"))


def step_times(events: DataFrame, stages: Sequence[str], store: Store, who: str = "user_id", stage: str = "event_type",
               at: str = "ts") -> DataFrame:
    """(who, t0, t1, ...): when each person who began passed each stage, every stage at or after the one before.

    The first event of the first stage begins; then a person moves to stage k with the first event of that stage
    which is not earlier than the move to stage k - 1, so taking the earliest one never costs a later stage. Each
    stage is one join of its events with the people waiting for it and one aggregate, partial before the shuffle:
    every event is shuffled once at most, and the events of a person are never gathered, however many there are.
    """
    def of(name: str) -> DataFrame:
        return events.where((F.col(stage) == name) & F.col(who).isNotNull() & F.col(at).isNotNull()).select(
            F.col(who).alias(who), F.col(at).alias("_at"))

    people = store.keep(of(stages[0]).groupBy(who).agg(F.min("_at").alias("t0")), "step_0")
    for k, name in enumerate(stages[1:], 1):
        waiting = people.where(F.col(f"t{k - 1}").isNotNull()).select(who, F.col(f"t{k - 1}").alias("_from"))
        moved = of(name).join(waiting, who).where(F.col("_at") >= F.col("_from")).groupBy(who).agg(
            F.min("_at").alias(f"t{k}"))
        people = store.keep(people.join(moved, who, "left"), f"step_{k}")
    return people


def ordered_funnel(events: DataFrame, stages: Sequence[str], store: Store, people: DataFrame | None = None,
                   keys: Sequence[str] = (), who: str = "user_id", stage: str = "event_type",
                   at: str = "ts") -> DataFrame:
    """People per stage by the month in which they began and by `keys` of `people`; ratios and mean days to the end.

    A person counts in a stage only after passing all before it, so the counts are nested: none exceeds the one to
    its left. A path may cross midnight or the end of a month; it belongs to the month in which it began. People
    whose keys are unknown form groups of NULLs.
    """
    times = step_times(events, stages, store, who, stage, at)
    if people is not None:
        one = people.groupBy(who).agg(*[F.min(k).alias(k) for k in keys])
        times = times.join(one, who, "left")
    last = f"t{len(stages) - 1}"
    seconds = F.timestamp_diff("SECOND", F.col("t0"), F.col(last)).cast("decimal(20,0)")
    counted = times.groupBy(F.date_format("t0", "yyyy-MM").alias("competencia"), *keys).agg(
        *[F.count(f"t{k}").alias(s) for k, s in enumerate(stages)],
        (F.sum(seconds).cast("double") / F.nullif(F.count(last), F.lit(0)) / 86400).alias("mean_days"))
    ratios = [F.round(F.col(b).cast("double") / F.nullif(F.col(a), F.lit(0)), 4).alias(f"{a}_to_{b}")
              for a, b in zip(stages, stages[1:])]
    return counted.select("competencia", *keys, *stages, *ratios, F.round("mean_days", 4).alias("mean_days"))
