from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import joins, quality, series
from rollcall.plans import export, pipeline
from rollcall.plans.silver import clean_columns, silver, staged_silver
from rollcall.schema import BRONZE
from rollcall.session import settings
from rollcall.sources import (
    Store, read_bronze, read_malformed, read_metadata, read_silver, write_csv, write_json, write_silver, write_table)
from rollcall.sources.store import shared_folder
from rollcall.streaming import (
    clean_exports, current_view, ingest_increment, read_exports, refresh_exports)

HEADER = ",".join(BRONZE.fieldNames())
LINE = "{key},Nome,{area},Cargo,RH,2020-01-01,12,30,Feminino,Parda,Recife,{pay},7.0,3.0,90.0,{boss},Ativo,,,"


def test_csv_with_bom_and_float_keys(spark, tmp_path):
    path = tmp_path / "a.csv"
    body = [LINE.format(key="100123.0", area="TECNOLOGIA ", pay="5000.5", boss="9007199254740993"),
            LINE.format(key="7", area='"a, b"', pay="NaN", boss="")]
    path.write_text("﻿" + "\n".join([HEADER, *body]) + "\n", encoding="utf-8")
    assert rows(read_bronze(spark, str(path)), "matricula", "area", "salario_mensal", "gestor_matricula") == [
        (100123, "TECNOLOGIA ", 5000.5, 9007199254740993), (7, "a, b", None, None)]


def test_columns_are_found_by_name(spark, tmp_path):
    names = BRONZE.fieldNames()
    swapped = [names[1], names[0], *names[2:], "extra"]
    (tmp_path / "a.csv").write_text(",".join(swapped) + "\nNome,5,RH" + "," * (len(names) - 2) + "\n", encoding="utf-8")
    got = read_bronze(spark, str(tmp_path / "a.csv"))
    assert got.columns == names and rows(got, "matricula", "nome_ficticio", "area") == [(5, "Nome", "RH")]
    (tmp_path / "b.csv").write_text(",".join(names[:-1]) + "\n", encoding="utf-8")
    with pytest.raises(ValueError, match=names[-1]):
        read_bronze(spark, str(tmp_path / "b.csv"))


def test_no_row_of_an_export_disappears(spark, tmp_path):
    good = LINE.format(key="7", area="RH", pay="5000", boss="1")
    bad = [good + ",surplus", "7,short", LINE.format(key="8", area="RH", pay="five", boss="1")]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, good, *bad]) + "\n", encoding="utf-8")
    assert rows(read_bronze(spark, str(tmp_path / "a.csv")), "matricula") == [(7,)]
    assert rows(read_malformed(spark, str(tmp_path / "a.csv")), "record") == sorted((b,) for b in bad)


def test_sorted_tables_are_ranged_over_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), "id")
    write_table(df, str(tmp_path / "t"), sort=("k",))
    spans = sorted((r["lo"], r["hi"]) for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name())
                   .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_csv_round_trip(people, spark, tmp_path):
    df = people({"area": "RH "}, {"genero": None, "nome_ficticio": 'a"b,c\n'})
    write_csv(df, str(tmp_path / "out"))
    back = spark.read.schema(BRONZE).option("header", True).option("multiLine", True).csv(str(tmp_path / "out"))
    assert rows(back.where("area = 'RH '"), "*") == rows(df.where("area = 'RH '"), "*")
    assert read_bronze(spark, str(tmp_path / "out")).columns == df.columns


def test_silver_partitions_with_a_slash(people, tmp_path, spark):
    table = silver(people({"matricula": 1, "area": "Comercial/Varejo"}, {"matricula": 2}))
    write_silver(table, str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("area=*")) == ["area=Comercial%2FVarejo", "area=RH"]
    assert rows(read_silver(spark, str(tmp_path / "s")), *table.columns) == rows(table, "*")


def test_json_metadata(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"data_inicio": "2023-07-16", "areas": ["RH", "Marketing"], "crescimento_anual": 0.045}, indent=2))
    got = read_metadata(spark, str(path), "data_inicio string, areas array<string>, crescimento_anual double").first()
    assert got["areas"] == ["RH", "Marketing"] and got["crescimento_anual"] == 0.045
    write_json(spark.createDataFrame([(1, "a")], "n int, t string"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1


def test_store_is_in_the_shared_folder(spark):
    kept = Store(spark, "test").keep(spark.range(5).toDF("n"), "t")
    folder = shared_folder(spark)  # where the session names none, one folder for all tables of the application
    assert folder == shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", folder)
    assert kept.count() == 5 and all(shared_folder(spark) in f for f in kept.inputFiles())


def test_small_kept_table_is_broadcast_and_large_is_not(spark):
    """The planner decides on the true size of a kept table."""
    store = Store(spark, "test-size")
    small = store.keep(spark.range(10).toDF("k"), "small")
    large = store.keep(spark.range(5_000_000).select("id", F.col("id").alias("k")), "large")
    facts = store.keep(spark.range(6_000_000).select(F.col("id").alias("k"), F.uuid().alias("t")), "facts")
    for side, strategy in ((small, "BroadcastHashJoin"), (large, "SortMergeJoin")):
        assert strategy in facts.join(side, "k", "left")._jdf.queryExecution().executedPlan().toString()


def test_export_document(spark, people):
    table = silver(people({"matricula": 1}, {"matricula": 2, "area": "Marketing"}))
    tables = {"headcount": series.headcount_by_area(table), 'a"b': quality.value_counts(table, "status")}
    document = json.loads(export.full_document(export.export_document(tables)).first()["document"])
    assert document == {
        "headcount": [{"area": "Marketing", "headcount": 1}, {"area": "RH", "headcount": 1}],
        'a"b': [{"status": "Ativo", "rows": 2}]}
    with pytest.raises(ValueError, match="export_tables"):
        export.export_document(tables, most=1)


def test_sections_keep_their_order_and_null_fields(spark):
    causes = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 3)], "cause string, n long")
    got = export.export_document({"causes": causes}, order={"causes": [-F.col("n")]}).first()["document"]
    assert [(r["cause"], r["n"]) for r in json.loads(got)] == [("c", None), ("b", 3), ("d", 3), ("a", 1)]


def test_export_tables(spark, tmp_path):
    export.export_tables({"a": spark.range(3), "b": spark.range(0)}, str(tmp_path))
    assert spark.read.json(str(tmp_path / "a")).count() == 3


def bronze_rows(n=60):
    areas = ("RH", "Marketing", "rh ")
    return [{"matricula": i, "area": areas[i % 3], "engajamento_score_base": None if i % 7 == 0 else float(i % 10),
             "salario_mensal": None if i % 11 == 0 else 3000.0 + i} for i in range(n)]


def test_pipeline_end_to_end(spark, people, tmp_path):
    gone = {"status": "Desligado", "data_desligamento": "2020-06-10", "tipo_desligamento": "Voluntário",
            "motivo_desligamento": "Aposentadoria"}
    df = people(*[{**r, **(gone if r["matricula"] % 5 == 0 else {})} for r in bronze_rows()])
    write_csv(df, str(tmp_path / "bronze"))
    paths = pipeline.run(spark, str(tmp_path / "bronze"), str(tmp_path / "lake"), "2020-01-01", "2020-12-31",
                         "2020-12-31", min_rows=50)
    table = read_silver(spark, paths.silver)
    assert table.count() == 60 and table.where("engajamento_score_base is null").count() == 0
    log = {r["step"]: r["rows"] for r in spark.read.json(paths.quality_log).collect()}
    assert log["silver_rows"] == 60 and log["engagement_imputed"] == 9 and log["area_normalized"] == 20
    month = spark.read.parquet(paths.gold("monthly_series")).where("competencia = '2020-06'").first()
    assert (month["headcount_total"], month["desligamentos"]) == (48, 12)
    assert spark.read.parquet(paths.gold("root_cause")).count() == 1
    with pytest.raises(quality.GateFailed):
        pipeline.run(spark, str(tmp_path / "bronze"), str(tmp_path / "no"), "2020-01-01", "2020-12-31", "2020-12-31")
    assert not (tmp_path / "no").exists()
    snaps = table.withColumn("snapshot_date", F.lit("2020-12-31").cast("date"))
    pipeline.write_star(pipeline.star_tables(table, snaps, "2020-01-01", "2020-12-31"), paths)
    assert spark.read.parquet(paths.star("fct_desligamento")).count() == 12
    assert spark.read.parquet(paths.star("dim_colaborador")).count() == 60


def test_stream_equals_batch(spark, people, tmp_path):
    landing, history, progress = (str(tmp_path / n) for n in ("landing", "history", "progress"))
    first, second = people(*bronze_rows()), people(*[{**r, "cargo": "Novo"} for r in bronze_rows(40)])
    write_csv(first.repartition(3), f"{landing}/export_date=2020-01-01")
    ingest_increment(spark, landing, history, progress, files_per_batch=1)
    write_csv(second, f"{landing}/export_date=2020-01-02")
    ingest_increment(spark, landing, history, progress)
    ingest_increment(spark, landing, history, progress)  # nothing new
    taken = spark.read.parquet(history)
    assert taken.count() == 100
    cleaned = clean_exports(taken)
    for day, df in (("2020-01-01", first), ("2020-01-02", second)):
        assert rows(cleaned.where(F.col("export_date") == day), *df.columns) == rows(clean_columns(staged_silver(df)), *df.columns)
    now = current_view(cleaned)
    assert now.count() == 60 and now.where("cargo = 'Novo'").count() == 40


def test_late_export_does_not_replace_a_newer_one(spark, people, tmp_path):
    landing, history, progress = (str(tmp_path / n) for n in ("landing", "history", "progress"))
    for day, job in (("2020-01-02", "new"), ("2020-01-01", "old")):
        write_csv(people({"matricula": 1, "cargo": job}), f"{landing}/export_date={day}")
        ingest_increment(spark, landing, history, progress)
    assert rows(current_view(clean_exports(spark.read.parquet(history))), "cargo") == [("new",)]


def test_write_table_sorts_inside_files(spark, tmp_path):
    write_table(spark.range(10).orderBy(F.desc("id")), str(tmp_path / "t"), sort=["id"])
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "t")).collect()] == sorted(range(10))


def test_refresh_cleans_only_what_changed(spark, people, tmp_path):
    landing, history, progress, cleaned = (str(tmp_path / n) for n in ("landing", "history", "progress", "cleaned"))
    store = Store(spark, "test-refresh")

    def arrive(day, *data):
        write_csv(people(*data), f"{landing}/export_date={day}/{len(list(tmp_path.rglob('part-*')))}")
        ingest_increment(spark, landing, history, progress)
        return [d.isoformat() for d in refresh_exports(spark, history, cleaned, store)]

    def files(day):
        return {p.name for p in (tmp_path / "cleaned" / f"export_date={day}").glob("*.parquet")}

    assert arrive("2020-01-01", {"matricula": 1}, {"matricula": 1}) == ["2020-01-01"]
    before = files("2020-01-01")
    assert arrive("2020-01-02", {"matricula": 1, "cargo": "Novo"}) == ["2020-01-02"]
    assert files("2020-01-01") == before
    # A second file of the first export arrives late: that export is cleaned again as a whole.
    assert arrive("2020-01-01", {"matricula": 2, "engajamento_score_base": None}) == ["2020-01-01"]
    assert refresh_exports(spark, history, cleaned, store) == []
    got = read_exports(spark, cleaned)
    assert rows(got, "matricula", "cargo", "engajamento_score_base", F.col("export_date").cast("string")) == [
        (1, "Cargo_1", 7.0, "2020-01-01"), (1, "Novo", 7.0, "2020-01-02"), (2, "Cargo_1", 7.0, "2020-01-01")]
    # The view of a view and a new export is the view of all.
    old, new = got.where("export_date = '2020-01-01'"), got.where("export_date = '2020-01-02'")
    assert rows(current_view(current_view(old).unionByName(new)), "*") == rows(current_view(got), "*")


def test_attach_departures(spark, people):
    gone = spark.createDataFrame(
        [(1, "2020-01-01", "Voluntário", "a"), (1, "2021-01-01", "Voluntário", "b"), (9, "2020-01-01", "x", "c")],
        "matricula long, data_desligamento string, tipo_desligamento string, motivo_desligamento string")
    base = people({"matricula": 1}, {"matricula": 2}).drop("data_desligamento", "tipo_desligamento", "motivo_desligamento")
    got = joins.attach_departures(base, gone)
    assert rows(got, "matricula", "data_desligamento", "motivo_desligamento") == [(1, "2021-01-01", "b"), (2, None, None)]


def test_kept_tables_do_not_overwrite_each_other(spark, people):
    store = Store(spark, "test-twice")
    first = silver(people({"matricula": 1}), store)
    second = silver(people({"matricula": 2}), store)
    assert rows(first, "matricula") == [(1,)] and rows(second, "matricula") == [(2,)]


def test_settings_follow_the_input_size():
    small, large = settings(8), settings(8000, 100 * 1024**4)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "409600"
    assert settings(100, 1024**4)["spark.sql.shuffle.partitions"] == "4096"
