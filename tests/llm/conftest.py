"""Fixtures of the training-data operator tests: a small documents table."""

from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def texts(duck) -> dict[int, str]:
    return dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from texts (or (doc_id, text) pairs)."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            i, t = r if isinstance(r, tuple) else (i, r)
            full.append((i, t, "en", f"s{i % 3}" if i is not None else None, len(t) if t else None))
        return spark.createDataFrame(full, DOCS)
    return make
