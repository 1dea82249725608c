"""Tables placed by person, and what is read from them without a shuffle."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import warehouse
from rollcall.plans import pipeline
from rollcall.sources import read_bucketed, write_bucketed

DIM = "nk_matricula long, versao int, senioridade string, data_inicio_vigencia date, data_fim_vigencia date"


def day(text):
    return dt.date.fromisoformat(text)


def tables(spark):
    dim = spark.createDataFrame([
        (1, 1, "A", day("2020-01-01"), day("2020-01-31")), (1, 2, "B", day("2020-02-01"), day("2020-02-29")),
        (1, 3, "C", day("2020-03-01"), None), (2, 1, "A", day("2020-03-01"), None), (3, 1, None, day("2020-01-01"), None),
        (None, 1, "Z", day("2020-01-01"), None)], DIM)
    fact = spark.createDataFrame([
        ("1-x", 1, 1, 20200229, True, 10), ("2-x", 2, 2, 20200110, False, 20), ("3-x", 3, 9, 20200301, False, 30),
        ("4-x", 4, None, 20200301, True, 40), (None, None, 1, 20200301, False, 50), (None, None, 1, 20200301, False, 50)],
        "sk_desligamento string, nk_matricula long, sk_motivo int, sk_data_deslig int, e_early_turnover boolean, cost int")
    return fact.withColumn("custo_estimado_turnover", F.col("cost").cast("decimal(28,2)")).drop("cost"), dim


@pytest.fixture
def large_tables(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


CAREERS = [
    (None, None, None, 0, None), (None, None, None, 0, None), ("1-x", "A", "B", 2, 28), ("2-x", "A", "A", 1, None),
    ("3-x", None, None, 1, None), ("4-x", None, None, 0, None)]
COLUMNS = ("sk_desligamento", "senioridade_inicial", "senioridade_na_saida", "versoes", "dias_desde_mudanca")


def test_careers_keep_every_departure(spark):
    """Before the first version, at a border, unknown person, no key, repeated rows."""
    assert rows(warehouse.departure_careers(*tables(spark)), *COLUMNS) == sorted(CAREERS, key=repr)


def test_careers_of_empty_tables(spark):
    fact, dim = tables(spark)
    assert warehouse.departure_careers(fact.where("false"), dim).count() == 0
    assert rows(warehouse.departure_careers(fact, dim.where("false")), "versoes") == [(0,)] * 6


def test_no_shuffle_over_placed_tables(large_tables, tmp_path):
    spark = large_tables
    fact, dim = (write_bucketed(df, f"{tmp_path}/{n}", "nk_matricula", 4) for n, df in zip("fd", tables(spark)))
    careers = warehouse.departure_careers(fact, dim)
    assert "Exchange" not in plan(careers)
    assert rows(careers, *COLUMNS) == sorted(CAREERS, key=repr)
    assert "Exchange" in plan(warehouse.departure_careers(*tables(spark)))
    profiles = warehouse.departure_profiles(careers, warehouse.dim_reason(spark))
    assert "hashpartitioning(nk_matricula" not in plan(profiles)
    assert sum(r["desligamentos"] for r in profiles.collect()) == 6


def test_one_file_per_bucket_and_a_new_number_of_buckets(spark, tmp_path):
    people = spark.range(0, 10_000, 1, 8).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    for buckets in (4, 16):
        got = write_bucketed(people, str(tmp_path / "t"), "k", buckets, ["v"])
        files = {Path(f).name for f in got.inputFiles()}
        assert len(files) == buckets
        assert rows(read_bucketed(spark, str(tmp_path / "t"))) == rows(people)


def test_last_load_counts_and_a_broken_one_does_not(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_bucketed(spark, path)
    write_bucketed(spark.range(5), path, "id", 2)
    write_bucketed(spark.range(9), path, "id", 2)
    with pytest.raises(Exception, match="broken"):
        write_bucketed(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path, "id", 2)
    assert read_bucketed(spark, path).count() == 9


def test_a_session_that_does_not_know_the_table(large_tables, tmp_path):
    spark, path = large_tables, str(tmp_path / "it's")
    written = write_bucketed(tables(spark)[1].withColumnRenamed("senioridade", "a b"), path, "nk_matricula", 4)
    want = rows(written, *written.columns)
    for table in spark.catalog.listTables():
        if table.name.startswith("rollcall_"):
            spark.sql(f"DROP TABLE {table.name}")  # the files are outside the warehouse and stay
    read = read_bucketed(spark, path)
    assert rows(read, *read.columns) == want
    assert "Exchange" not in plan(read.groupBy("nk_matricula").count())


def test_star_in_buckets(spark, people, tmp_path):
    from rollcall.plans.silver import silver

    left = {"status": "Desligado", "tipo_desligamento": "Voluntário", "motivo_desligamento": "Aposentadoria",
            "data_desligamento": "2020-03-01"}
    table = silver(people(*[{"matricula": i, **(left if i % 3 == 0 else {})} for i in range(1, 31)]))
    snaps = table.withColumn("snapshot_date", F.lit(day("2020-02-01")))
    paths = pipeline.Paths(str(tmp_path))
    pipeline.write_star(pipeline.star_tables(table, snaps, "2020-01-01", "2020-12-31"), paths, buckets=3)
    fact, dim = (read_bucketed(spark, paths.star(n)) for n in ("fct_desligamento", "dim_colaborador"))
    assert (fact.count(), dim.count()) == (10, 30)
    assert rows(warehouse.departure_careers(fact, dim), "versoes") == [(1,)] * 10
