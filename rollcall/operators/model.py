"""Attrition risk: who, active today, is likely to leave of their own accord within a year."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import ACTIVE, VOLUNTARY
from rollcall.functions import active_at, risk_band
from rollcall.operators.encoding import category_means, encode, encode_out_of_fold
from rollcall.operators.quality import Rule, evaluate, union_checks
from rollcall.operators.ranking import roc_auc, stratified_split
from rollcall.schema import END, ENGAGEMENT, KEY, KIND, PERFORMANCE, PRODUCTIVITY, SALARY, START
from rollcall.sources.store import Store

TENURE = "tempo_casa_meses_ref"
NUMERIC = ("idade", TENURE, SALARY, ENGAGEMENT, PERFORMANCE, PRODUCTIVITY)
#: Closed lists are indexed; open ones, with any number of values, become means of the label.
CATEGORICAL = ("area", "senioridade", "genero")
OPEN = ("cidade",)
SCORE = "risco_attrition_score"
SEED = 42


def _date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def tenure_at(moment: Column, start: Column) -> Column:
    """Months of 30 days, half to even."""
    return F.bround(F.datediff(moment, start) / 30, 0)


def label_attrition(df: DataFrame, ref: str | dt.date, days: int = 365) -> DataFrame:
    """People active at `ref`, `label` 1 for those who leave voluntarily within `days`, and their tenure at `ref`."""
    at = F.lit(_date(ref))
    leaves = (F.col(END) > at) & (F.col(END) <= F.date_add(at, days)) & (F.col(KIND) == VOLUNTARY)
    return (
        df.where(active_at(at, F.col(START), F.col(END)))
        .withColumn("label", F.when(leaves, 1.0).otherwise(0.0))
        .withColumn(TENURE, tenure_at(at, F.col(START)))
    )


def split_by_key(df: DataFrame, share: int = 75, key: str = KEY, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """A fixed share of the keys for training. The choice hangs on the key alone, not on partitions or reruns."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.where(bucket < share), df.where(bucket >= share)


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (2 * rows of the class), so both classes weigh the same."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (2 * n)).otherwise(weight)
    return df.withColumn("weight", weight)


@dataclass(frozen=True)
class AttritionModel:
    """A fitted pipeline, and the tables of means by which open categories become numbers."""

    pipeline: PipelineModel
    means: dict[str, DataFrame]

    @property
    def stages(self) -> list:
        return self.pipeline.stages

    def transform(self, df: DataFrame) -> DataFrame:
        for column, table in self.means.items():
            df = encode(df, table, column, f"{column}_mean")
        return self.pipeline.transform(df)


def split_rows(labelled: DataFrame, store: Store, share: int = 75) -> tuple[DataFrame, DataFrame]:
    """Rows to train on and to test with, the same share of each class to one row."""
    both = store.keep(stratified_split(labelled, store, share=share), "split")
    return both.where("in_train").drop("in_train"), both.where("NOT in_train").drop("in_train")


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt out by key and put in order, always alike: trees draw their rows per partition and in its order, so
    the forest would otherwise differ with the cores of the session."""
    return df.repartition(partitions, key).sortWithinPartitions(*[key, *[c for c in df.columns if c != key]])


def train_attrition(labelled: DataFrame, trees: int = 100, depth: int = 6, min_leaf: int = 15,
                    numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
                    seed: int = SEED, key: str = KEY, partitions: int = 32, opened: Sequence[str] = OPEN,
                    store: Store | None = None) -> AttritionModel:
    """Random forest over indexed closed categories and smoothed means of open ones.

    Values of a closed category end up on the driver and as bins of every node, so a column with any number of values
    belongs to `opened`: it is trained on out of fold and scored by the means of all training rows. Unseen values get a
    class of their own, or the mean of all. `partitions` is part of the model: choose it for the size of the table, not
    for the session.
    """
    store = store or Store(labelled.sparkSession, "attrition")
    means = {c: store.keep(category_means(labelled, c), f"means_{c}") for c in opened}
    for c in opened:
        labelled = encode_out_of_fold(labelled, c, f"{c}_mean", key=key)
    numeric = [*numeric, *[f"{c}_mean" for c in opened]]
    # only what the trees see: all of it is shuffled and sorted, by several passes
    labelled = store.keep(labelled.select(*dict.fromkeys([key, "label", *numeric, *categorical])), "encoded")
    indexers: list[StringIndexerModel] = [
        StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
        .fit(labelled)
        for c in categorical
    ]
    assembler = VectorAssembler(
        inputCols=[*numeric, *[f"{c}_idx" for c in categorical]], outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=seed,
        maxBins=max(32, *[len(m.labels) + 1 for m in indexers]))
    rows = spread(with_class_weight(labelled), key, partitions)
    return AttritionModel(Pipeline(stages=[*indexers, assembler, forest]).fit(rows), means)


def auc(model: AttritionModel, labelled: DataFrame, store: Store | None = None) -> float | None:
    """Exact, with ties; None if only one class is there."""
    scored = model.transform(labelled).select(vector_to_array("probability")[1].alias("score"), "label")
    return roc_auc(scored, store or Store(labelled.sparkSession, "auc")).first()["roc_auc"]


def temporal_holdout(df: DataFrame, train_ref: str | dt.date, test_ref: str | dt.date,
                     days: int = 365) -> tuple[DataFrame, DataFrame]:
    """Train on one date, test on a later one; the training window must end before the test begins."""
    if _date(train_ref) + dt.timedelta(days=days) > _date(test_ref):
        raise ValueError("the outcome window of the training date reaches past the test date")
    return label_attrition(df, train_ref, days), label_attrition(df, test_ref, days)


def importances(model: AttritionModel, df: DataFrame) -> DataFrame:
    """(feature, importance) from the forest. One row per feature."""
    assembler, forest = model.stages[-2], model.stages[-1]
    names = [n.removesuffix("_idx").removesuffix("_mean") for n in assembler.getInputCols()]
    values = forest.featureImportances.toArray().tolist()
    rows = [F.struct(F.lit(n).alias("feature"), F.lit(v).alias("importance"))
            for n, v in zip(names, values, strict=True)]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows))).orderBy(F.desc("importance"), "feature")


def score_attrition(model: AttritionModel, df: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Risk score and band of everyone with active status, tenure taken at `as_of`."""
    today = df.where(F.col("status") == ACTIVE).withColumn(TENURE, tenure_at(F.lit(_date(as_of)), F.col(START)))
    scored = model.transform(today).withColumn(SCORE, vector_to_array("probability")[1])
    return scored.select(
        KEY, "area", "cargo", "senioridade", TENURE, ENGAGEMENT, PERFORMANCE, SALARY, SCORE,
        risk_band(F.col(SCORE)).alias("faixa_risco"))


def base_rate(labelled: DataFrame) -> DataFrame:
    """Eligible people, those who left, and the rate in percent."""
    return labelled.agg(
        F.count(F.lit(1)).alias("eligible"),
        F.sum("label").cast("bigint").alias("leavers"),
        F.round(F.sum("label") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 1).alias("taxa_attrition_base"))


def model_metrics(model: AttritionModel, train: DataFrame, test: DataFrame, scores: DataFrame,
                  ref: str | dt.date, days: int = 365) -> DataFrame:
    """One row: quality on the holdout, sizes, base rate, five strongest factors, people per risk band."""
    sizes = train.select("label", F.lit(1).alias("train"), F.lit(0).alias("test")).unionAll(
        test.select("label", F.lit(0).alias("train"), F.lit(1).alias("test")))
    base = sizes.agg(
        F.sum("train").alias("n_treino"), F.sum("test").alias("n_teste"),
        F.round(F.avg("label") * 100, 1).alias("taxa_attrition_base"))
    bands = scores.agg(*[
        F.count_if(F.col("faixa_risco") == band).alias(f"colaboradores_risco_{name}")
        for band, name in (("Alto", "alto"), ("Médio", "medio"), ("Baixo", "baixo"))])
    top = importances(model, train).limit(5).agg(F.map_from_entries(F.collect_list(
        F.struct("feature", F.round("importance", 3)))).alias("fatores_risco_top5"))
    return base.select(
        F.round(F.lit(auc(model, test)).cast("double"), 3).alias("roc_auc"), "*",
        top.scalar().alias("fatores_risco_top5"),
        *[bands.select(c).scalar().alias(c) for c in bands.columns],
        F.lit(str(_date(ref))).alias("data_referencia_treino"),
        F.lit(days).alias("janela_predicao_dias"),
    )


def model_gate(metrics: DataFrame, scores: DataFrame, low: float = 0.60, high: float = 0.97,
               min_train: int = 1000, rate: Sequence[float] = (5, 30), leading: str = "engajamento",
               min_scores: int = 1000) -> DataFrame:
    """Acceptance of a model: (check, observed, limit, passed)."""
    by_weight = F.array_sort(F.transform(
        F.map_entries("fatores_risco_top5"), lambda e: F.struct((-e["value"]).alias("w"), e["key"].alias("k"))))
    leads = F.contains(by_weight[0]["k"], F.lit(leading)).cast("int")

    def only(column: str | Column) -> Column:
        return F.max(column)

    checks = evaluate(metrics, [
        Rule("auc_min", only("roc_auc"), ">=", low),
        Rule("auc_not_suspicious", only("roc_auc"), "<=", high),
        Rule("train_rows", only("n_treino"), ">=", min_train),
        Rule("base_rate_min", only("taxa_attrition_base"), ">=", rate[0]),
        Rule("base_rate_max", only("taxa_attrition_base"), "<=", rate[1]),
        Rule(f"leading_factor:{leading}", only(leads), "==", 1),
    ])
    outside = F.count_if(F.col(SCORE).isNull() | ~F.col(SCORE).between(0, 1))
    return union_checks([checks, evaluate(scores, [
        Rule("scored_rows", F.count(F.lit(1)), ">=", min_scores), Rule("scores_in_range", outside, "==", 0)])])


def is_retrain_day(day: Column) -> Column:
    """First Monday of a month."""
    return (F.weekday(day) == 0) & (F.dayofmonth(day) <= 7)


def load_model(spark: SparkSession, path: str) -> AttritionModel:
    pipeline = PipelineModel.load(f"{path}/pipeline")
    opened = [c.removesuffix("_mean") for c in pipeline.stages[-2].getInputCols() if c.endswith("_mean")]
    return AttritionModel(pipeline, {c: spark.read.parquet(f"{path}/means/{c}") for c in opened})


def save_model(model: AttritionModel, path: str) -> None:
    """Replaces a saved model, which must not be `model` itself as loaded from there."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    for column, table in model.means.items():
        table.write.mode("overwrite").parquet(f"{path}/means/{column}")
