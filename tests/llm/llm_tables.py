"""Fixtures over the supplied tables, for the test modules of this folder to import."""

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.fixture(scope="session")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
