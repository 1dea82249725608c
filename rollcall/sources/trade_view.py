"""A bronze employee table derived from orders, customers and nations: one order stands for one employee.

The defects follow from remainders of the order key, so that every cleaning rule has rows to work on. Repeated rows
and older versions of a row are made by `explode`, which keeps the view at one scan of the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import JUNIOR, LEADER, SENIOR

VIEW = """
WITH base AS (
  SELECT CAST(o_orderkey AS BIGINT) k, CAST(o_custkey AS BIGINT) c, CAST(o_orderdate AS DATE) d, o_orderstatus st,
    n_name cidade,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED','5-LOW') THEN 'Júnior/Pleno'
         WHEN o_orderpriority = '1-URGENT' THEN 'Liderança' ELSE 'Sênior/Especialista' END senioridade,
    CASE o_custkey % 10 WHEN 0 THEN 'Tecnologia' WHEN 1 THEN 'Comercial/Varejo' WHEN 2 THEN 'Operações'
         WHEN 3 THEN 'Risco e Crédito' WHEN 4 THEN 'Atendimento/CX' WHEN 5 THEN 'Financeiro' WHEN 6 THEN 'RH'
         WHEN 7 THEN 'Jurídico/Compliance' WHEN 8 THEN 'Marketing' ELSE 'Produtos Digitais' END area
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey),
ev AS (
  SELECT *, CASE WHEN st = 'F' AND k % 211 = 0 THEN d + CAST(-400 AS INT)
                 WHEN st = 'F' AND d + CAST((k*17) % 1500 AS INT) <= DATE '2001-08-01'
                 THEN d + CAST((k*17) % 1500 AS INT) END dd FROM base),
one AS (
  SELECT k, k + 100000 matricula, 'Colaborador_' || CAST(k + 100000 AS STRING) nome_ficticio,
    CASE WHEN k % 97 = 0 THEN upper(area) || ' ' ELSE area END area,
    'Cargo_' || CAST(c % 4 AS STRING) cargo, senioridade, CAST(d AS STRING) data_admissao,
    CAST((2001 - year(d))*12 + 8 - month(d) AS INT) tempo_casa_meses, CAST(19 + c % 50 AS INT) idade,
    CASE WHEN k % 100 < 49 THEN 'Feminino' WHEN k % 100 < 98 THEN 'Masculino'
         WHEN k % 100 = 98 THEN 'Não-binário/Outro' END genero,
    CASE WHEN k % 50 < 25 THEN 'Branca' WHEN k % 50 < 39 THEN 'Parda' WHEN k % 50 < 46 THEN 'Preta'
         WHEN k % 50 < 48 THEN 'Amarela' END raca_cor,
    cidade,
    CASE WHEN k % 173 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST((CASE senioridade WHEN 'Júnior/Pleno' THEN 5500 WHEN 'Liderança' THEN 22000 ELSE 11000 END
                    + (k*37) % 3000) * (CASE WHEN k % 331 = 0 THEN 100 ELSE 1 END) AS DOUBLE) END salario_mensal,
    CASE WHEN k % 19 = 0 THEN CAST(NULL AS DOUBLE) WHEN k % 311 = 0 THEN CAST(99 AS DOUBLE)
         WHEN k % 409 = 0 THEN CAST(-1 AS DOUBLE)
         ELSE CAST(10 + (c*7 + k*3) % 91 AS DOUBLE) / CAST(10 AS DOUBLE) END engajamento_score_base,
    CAST(2 + (k*3) % 9 AS DOUBLE) / CAST(2 AS DOUBLE) performance_score,
    CAST(40 + (k*13) % 111 AS DOUBLE) produtividade_index_base,
    CASE WHEN senioridade <> 'Liderança' THEN 100000 + k - k % 10 END gestor_matricula,
    CASE WHEN dd IS NULL THEN 'Ativo' ELSE 'Desligado' END status, CAST(dd AS STRING) data_desligamento,
    CASE WHEN dd IS NULL THEN NULL WHEN (k*31) % 100 < 68 THEN 'Voluntário' ELSE 'Involuntário' END
      tipo_desligamento,
    CASE WHEN dd IS NULL THEN NULL ELSE CASE (k*7) % 9 WHEN 0 THEN 'Proposta salarial melhor'
         WHEN 1 THEN 'Falta de plano de carreira' WHEN 2 THEN 'Conflito com liderança' WHEN 3 THEN 'Mudança de cidade'
         WHEN 4 THEN 'Questões de saúde' WHEN 5 THEN 'Reestruturação' WHEN 6 THEN 'Baixa performance'
         WHEN 7 THEN 'Aposentadoria' ELSE 'Insatisfação com cultura' END END motivo_desligamento
  FROM ev)
SELECT matricula, nome_ficticio, area, cargo, senioridade,
  CASE WHEN copy = 'older' THEN CAST(CAST(data_admissao AS DATE) - 365 AS STRING) ELSE data_admissao END data_admissao,
  tempo_casa_meses, idade, genero, raca_cor, cidade, salario_mensal, engajamento_score_base, performance_score,
  produtividade_index_base, gestor_matricula, status, data_desligamento, tipo_desligamento, motivo_desligamento
FROM one LATERAL VIEW explode(array_compact(array(
  'row', CASE WHEN k % 89 = 0 THEN 'repeat' END, CASE WHEN k % 353 = 0 THEN 'older' END))) AS copy
"""

# Declared, so that reading a table does not start with a job to infer its schema.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}
REFERENCE_DATE = "2001-08-01"
SNAPSHOT_DATES = ("2001-06-01", "2001-07-01", "2001-08-01")


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet") for name, schema in TABLES.items()}


def order_count(spark: SparkSession, folder: str) -> int:
    return _tables(spark, folder)["orders"].count()


def bronze_view(spark: SparkSession, folder: str, partitions: int = 0) -> DataFrame:
    """The 20-column bronze table over the Parquet tables in `folder`.

    A few narrow columns of a large file become wide rows, so a split of it can be too many rows for a task:
    `partitions` deals the orders out while they are narrow.
    """
    view = VIEW.replace("SELECT CAST(", f"SELECT /*+ REPARTITION({partitions}, k) */ CAST(", 1) if partitions else VIEW
    return spark.sql(view, **_tables(spark, folder))


def snapshots(silver: DataFrame) -> DataFrame:
    """Three dated copies of the clean table with promotions (second) and moves of area (third)."""
    key = F.col("matricula") - 100000
    promoted = (
        F.when(F.col("senioridade") == JUNIOR, F.lit(SENIOR))
        .when(F.col("senioridade") == SENIOR, F.lit(LEADER))
        .otherwise(F.col("senioridade"))
    )
    dates = F.array(*[F.lit(d).cast("date") for d in SNAPSHOT_DATES])
    second, third = (F.lit(d).cast("date") for d in SNAPSHOT_DATES[1:])
    taken = F.col("snapshot_date")
    return (
        silver.withColumn("snapshot_date", F.explode(dates))
        .withColumn("senioridade", F.when((key % 7 == 0) & (taken >= second), promoted)
                    .otherwise(F.col("senioridade")))
        .withColumn("area", F.when((key % 11 == 0) & (taken >= third), F.lit("Operações")).otherwise(F.col("area")))
    )
