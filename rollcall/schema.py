"""The employee tables: one place for column names and types."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "matricula"
START = "data_admissao"
END = "data_desligamento"
KIND = "tipo_desligamento"
REASON = "motivo_desligamento"
ENGAGEMENT = "engajamento_score_base"
SALARY = "salario_mensal"
PERFORMANCE = "performance_score"
PRODUCTIVITY = "produtividade_index_base"

# Keys are 64-bit: 32 bits do not hold the keys of a 100 TB table.
BRONZE = T.StructType([
    T.StructField(KEY, T.LongType()),
    T.StructField("nome_ficticio", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("cargo", T.StringType()),
    T.StructField("senioridade", T.StringType()),
    T.StructField(START, T.StringType()),
    T.StructField("tempo_casa_meses", T.IntegerType()),
    T.StructField("idade", T.IntegerType()),
    T.StructField("genero", T.StringType()),
    T.StructField("raca_cor", T.StringType()),
    T.StructField("cidade", T.StringType()),
    T.StructField(SALARY, T.DoubleType()),
    T.StructField(ENGAGEMENT, T.DoubleType()),
    T.StructField(PERFORMANCE, T.DoubleType()),
    T.StructField(PRODUCTIVITY, T.DoubleType()),
    T.StructField("gestor_matricula", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField(END, T.StringType()),
    T.StructField(KIND, T.StringType()),
    T.StructField(REASON, T.StringType()),
])

DEPARTURES = T.StructType([f for f in BRONZE if f.name in (KEY, END, KIND, REASON)])

COLUMNS = BRONZE.fieldNames()
OPTIONAL = ("gestor_matricula", END, KIND, REASON)
REQUIRED_BRONZE = (
    KEY, "area", "cargo", "senioridade", START, "idade", "genero", SALARY, ENGAGEMENT, PERFORMANCE, "status")
