from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Makes a documents table from (doc_id, text) pairs, with columns of clashing names."""

    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long, _id int, spans string, n_words string"
        full = [(i, t, None, "s", None, 1, "x", None) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def sample():
    """(doc_id, text) of the smallest documents table."""
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    return duckdb.sql(f"SELECT doc_id, text FROM '{path}' ORDER BY doc_id").fetchall()
