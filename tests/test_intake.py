"""The file ledger: nothing is lost, corrections replace, what did not change is not scanned, replays change nothing."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.compare import TABLES, compare, connect
from conftest import SF, rows
from rollcall.schema import BRONZE
from rollcall.sources import Store, read_bronze, read_malformed
from rollcall.streaming import ingest_increment, intake, refresh_exports

NAMES = BRONZE.fieldNames()
HEADER = ",".join(NAMES)
GOOD = "{key},Nome,RH,Cargo,Sênior/Especialista,2020-01-01,12,30,Feminino,Parda,Recife,{pay},7.0,3.0,90.0,1,Ativo,,,"
BAD = [GOOD.format(key=8, pay="12,5a") + ",x", "9,cut,RH", GOOD.format(key="9xx1", pay=5000),
       GOOD.format(key=10, pay="five")]


class Landing:
    def __init__(self, spark, tmp_path: Path):
        self.spark, self.path = spark, tmp_path
        self.landing, self.history, self.progress, self.cleaned = (
            str(tmp_path / n) for n in ("landing", "history", "progress", "cleaned"))
        self.clock = 1_600_000_000

    def put(self, day: str, name: str, lines: list[str], header: str = HEADER) -> Path:
        file = Path(self.landing) / f"export_date={day}" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        self.clock += 60
        os.utime(file, (self.clock, self.clock))
        return file

    def take(self, **more):
        ingest_increment(self.spark, self.landing, self.history, self.progress, **more)

    def refresh(self):
        store = Store(self.spark, "test-intake")
        return [d.isoformat() for d in refresh_exports(self.spark, self.history, self.cleaned, store)]

    def held(self):
        return (rows(intake.read_history(self.spark, self.history), "matricula", F.col("export_date").cast("string")),
                rows(intake.read_quarantine(self.spark, self.history), "record"))


@pytest.fixture
def land(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_rows_read_are_rows_kept_and_quarantined(land):
    land.put("2020-01-01", "a b+c.csv", [GOOD.format(key=k, pay=5000) for k in range(1, 8)] + BAD)
    land.put("2020-01-01", "empty.csv", [])
    land.put("2020-01-02", "a.csv", BAD[:1])
    land.take(files_per_batch=1)
    good, bad = land.held()
    assert good == [(k, "2020-01-01") for k in range(1, 8)] and len(bad) == 5
    assert {BAD[0], BAD[1], BAD[3]} <= {r[0] for r in bad} and any("9xx1" in r[0] for r in bad)
    entries = intake.ledger(land.spark, land.history).orderBy("path").collect()
    assert [(e.rows, e.malformed) for e in entries] == [(7, 4), (0, 0), (0, 1)]
    # the batch reader splits the same rows
    path = f"{land.landing}/export_date=2020-01-01"
    assert (read_bronze(land.spark, path).count(), read_malformed(land.spark, path).count()) == (7, 4)


def test_rows_meet_their_files_without_a_shuffle(land, monkeypatch):
    """The rows of a batch are written once as they were read: the listing of files is what is sent to them."""
    plans = {}
    keep = Store.keep

    def spy(self, df, table):
        plans[table] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, table)

    monkeypatch.setattr(Store, "keep", spy)
    land.put("2020-01-01", "a b+c.csv", [GOOD.format(key=k, pay=5000) for k in range(1, 8)])
    land.put("2020-01-02", "%41.csv", [GOOD.format(key=8, pay=5000)])
    land.take()
    assert "BroadcastHashJoin" in plans["taken"] and "Exchange hashpartitioning" not in plans["taken"]
    assert land.held()[0] == [*[(k, "2020-01-01") for k in range(1, 8)], (8, "2020-01-02")]


def test_columns_are_found_by_name_in_any_order(land):
    swapped = ",".join([NAMES[1], NAMES[0], *NAMES[2:]])
    land.put("2020-01-01", "a.csv", ["Nome,5," + GOOD.split(",", 2)[2].format(pay=1)], header=swapped)
    land.take()
    assert land.held() == ([(5, "2020-01-01")], [])


def test_a_corrected_file_replaces_its_rows(land):
    land.put("2020-01-01", "a.csv", [GOOD.format(key=1, pay=1), BAD[3]])
    land.put("2020-01-01", "b.csv", [GOOD.format(key=2, pay=1)])
    land.take()
    assert land.refresh() == ["2020-01-01"]
    land.put("2020-01-01", "a.csv", [GOOD.format(key=1, pay=9), GOOD.format(key=10, pay=5)])
    land.take()
    good, bad = land.held()
    assert {k for k, _ in good} == {1, 2, 10} and len(good) == 3 and bad == []
    assert land.refresh() == ["2020-01-01"]
    got = rows(intake.read_exports(land.spark, land.cleaned), "matricula", "salario_mensal")
    assert got == [(1, 9.0), (10, 5.0), (2, 1.0)]
    # nothing of the export parses any more: its rows go
    for name in ("a.csv", "b.csv"):
        land.put("2020-01-01", name, BAD[:1])
    land.take()
    assert land.refresh() == ["2020-01-01"] and len(land.held()[1]) == 2
    assert intake.read_exports(land.spark, land.cleaned).count() == 0


def test_what_did_not_change_is_not_scanned(land):
    """The stored rows of the first export are spoilt: a job that read them would fail."""
    land.put("2020-01-01", "a.csv", [GOOD.format(key=1, pay=1)])
    land.take()
    assert land.refresh() == ["2020-01-01"]
    spoilt = [*Path(land.history).glob("export_date=2020-01-01/*/*.parquet"),
              *Path(land.cleaned).glob("export_date=2020-01-01/*.parquet")]
    assert len(spoilt) == 2
    for file in spoilt:
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    land.put("2020-01-02", "a.csv", [GOOD.format(key=2, pay=2)])
    land.take()
    assert land.refresh() == ["2020-01-02"] and land.refresh() == []
    assert rows(land.spark.read.parquet(f"{land.cleaned}/export_date=2020-01-02"), "matricula") == [(2,)]


def test_replays_change_nothing(land):
    land.put("2020-01-01", "a.csv", [GOOD.format(key=k, pay=k) for k in range(1, 5)] + BAD)
    land.take()
    land.refresh()
    before = land.held()
    # the stream's progress is lost: every file is taken once more
    land.progress += "-anew"
    land.take()
    assert land.held() == before and land.refresh() == []
    # the same content under a new time: a new version, but the export is not cleaned again
    land.put("2020-01-01", "a.csv", [GOOD.format(key=k, pay=k) for k in range(1, 5)] + BAD)
    land.take()
    assert land.held() == before and land.refresh() == []


def test_a_batch_that_failed_before_its_ledger_entry_is_repeated(land, monkeypatch):
    land.put("2020-01-01", "a.csv", [GOOD.format(key=1, pay=1), BAD[0]])
    with monkeypatch.context() as broken:
        broken.setattr(intake, "_next", lambda *_: 1 / 0)
        with pytest.raises(Exception):
            land.take()
    assert land.held() == ([], [])
    land.take()
    assert land.held() == ([(1, "2020-01-01")], [(BAD[0],)])


def test_a_file_outside_an_export_is_refused(land):
    file = Path(land.landing) / "stray.csv"
    file.parent.mkdir(parents=True)
    file.write_text(HEADER + "\n", encoding="utf-8")
    with pytest.raises(Exception):
        land.take()
    assert land.held() == ([], [])


def test_bad_keys_are_counted_whatever_their_digits(spark, tmp_path):
    """Keys from 200000 on, which sf0.001 does not have."""
    for name in TABLES:
        if name != "orders":
            os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey") + 150000)
    orders.coalesce(1).write.parquet(str(tmp_path / "written"))
    os.symlink(next((tmp_path / "written").glob("part-*.parquet")), tmp_path / "orders.parquet")
    ok, note = compare(spark, connect(str(tmp_path)), str(tmp_path), "intake_quarantine")
    assert ok, note
