"""Every registered query against its SQL, run by DuckDB on the same files."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


#: Queries of the optional package have their own tests.
NAMES = sorted(x for x in registered.queries() if x != "pipeline" and not x.startswith("op"))


def test_every_query_has_sql():
    assert set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    got = registered.queries()[name](spark, SF_DIR).toPandas()
    want = duck.sql(registered.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got = got[columns].sort_values(columns).reset_index(drop=True)
    want = want[columns].sort_values(columns).reset_index(drop=True)
    assert len(got) == len(want) > 0
    for c in columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert np.all(same), c


def test_entry(spark):
    assert registered.entry(spark).columns == ["target_id", "rank", "other_id", "score"]


def test_refresh_reads_the_lines_once_for_each_dump(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    lines = "SELECT id % 5 AS l_partkey, id % 7 AS l_suppkey, 1.0D AS l_quantity FROM range(40)"
    parts = "SELECT id AS p_partkey, 'a b' AS p_name, 'SMALL' AS p_type, 'Brand#7' AS p_brand, 3 AS p_size, 900.0D AS p_retailprice FROM range(5)"
    for name, sql in {"lineitem": lines, "part": parts, "supplier": "SELECT id AS s_suppkey, 'n' AS s_name FROM range(7)"}.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    batch, sides = entry.ingest.run_batch, []

    def seen(spark, store, titles, crew, ratings, names, **options):
        sides.extend([*crew.inputFiles(), *ratings.inputFiles()])
        batch(spark, store, titles, crew, ratings, names, **options)

    monkeypatch.setattr(entry.ingest, "run_batch", seen)
    assert entry.title_refresh(spark, str(tmp_path)).count() == 5
    assert sides and not any("lineitem" in f for f in sides)
