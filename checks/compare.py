"""Run registered queries beside their SQL and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import all_oracles
from checks.queries import all_queries
from rollcall.session import session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations")


def local_session(cpus: int = 8) -> SparkSession:
    spark = session(
        "rollcall", cpus, master=f"local[{cpus}]",
        **{"spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = all_queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    sql = all_oracles().get(name)
    if sql is None:
        return sum(got.values()) > 0, f"{sum(got.values())} rows, no SQL, {took:.1f}s"
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {df.columns} / {names}"
    if got != want:
        return False, (f"{sum(got.values())} / {sum(want.values())} rows; only Spark {list((got - want))[:2]}; "
                       f"only SQL {list((want - got))[:2]}")
    return sum(got.values()) > 0, f"{sum(got.values())} rows, {took:.1f}s"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(folder)
    bad = 0
    for name in sys.argv[2:] or all_queries():
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "BAD ", name, note, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
