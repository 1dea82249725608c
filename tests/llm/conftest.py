from __future__ import annotations

import duckdb
import pytest

from .helpers import CLASHING, SCHEMA, prose


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties and repeated rows."""
    shared = "This very long line stands in quite a few of these documents, word for word."
    texts = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", "en", "b"), (None, prose(80, 1), "en", "a"),
             (5, prose(80, 2), None, "b"), (6, prose(80, 3), "de", None), (7, prose(80, 2), "en", "b"),
             (7, prose(80, 2), "en", "b"), (8, prose(30_000, 4), "en", "a"), (9, "x" * 50_000, "fr", "c"),
             (10, "one", "en", "c"), (11, "one two", "en", "c"), (12, "ONE\ttwo", "en", "c"),
             (13, " one  two", "en", "c"), (14, "Ünïcödé ΣΑΣ İstanbul 🙂 \x00 \u200b", "es", "c")]
    texts += [(20 + k, f"{prose(60, 20 + k)}\n{' ' * k}{shared.upper() if k % 2 else shared}\n{prose(60, 40 + k)}",
               "en", "abc"[k % 3]) for k in range(6)]
    texts += [(40, prose(100, 2) + "\n" + prose(100, 3), "en", "a"), (40, prose(90, 77), "en", "a")]
    return [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows, with further columns whose names clash."""
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in odd_rows],
                                 SCHEMA + "".join(f", `{c}` string" for c in CLASHING))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def sql_over():
    """Rows of a SQL text over rows given for `documents`, as dictionaries."""
    def run(sql: str, rows: list[tuple]) -> list[dict]:
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        if rows:
            con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in rows])
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        return [dict(zip(names, r)) for r in found.fetchall()]

    return run
