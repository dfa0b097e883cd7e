import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfold import schemas
from nearfold.fixed import PANDAS_NULL_TOKENS
from nearfold.operators.reads import get_row, row_lookup, rows_list, to_json_records
from nearfold.session import Steps
from nearfold.sources import tables, tsv

TITLES = """tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres
tt1\tmovie\t"Quoted\tone\t0\t1920\t\\N\t95\tDrama
tt2\tmovie\tNone\ttwo\t0\t\\N\t\\N\t60\tDrama
tt3\tmovie\tend"\tthree\t0\t1930\t\\N\tReality-TV\tDrama,Comedy
"""
TITLE_COLUMNS = [
    "tconst", "titleType", "primaryTitle", "startYear", "runtimeMinutes", "genres", "isAdult",
]
RATINGS = "tconst\taverageRating\tnumVotes\ntt1\t5.5\t10\ntt2\tbad\t7\ntt3\t\\N\t3\n"


def gz(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_titles(spark, tmp_path):
    path = gz(tmp_path, "titles.tsv.gz", TITLES)
    df = tsv.read_tsv(spark, path, schemas.RAW_TITLES, TITLE_COLUMNS)
    assert df.columns == TITLE_COLUMNS
    assert [(r.tconst, r.primaryTitle, r.startYear) for r in df.collect()] == [
        ("tt1", '"Quoted', "1920"), ("tt2", "None", None), ("tt3", 'end"', "1930"),
    ]
    raw = tsv.read_tsv(spark, path, schemas.RAW_TITLES, null_tokens=[])
    assert raw.filter("tconst = 'tt2'").first().startYear == "\\N"
    wide = tsv.read_tsv(spark, path, schemas.RAW_TITLES, null_tokens=PANDAS_NULL_TOKENS)
    assert wide.filter("tconst = 'tt2'").first().primaryTitle is None
    assert tsv.read_tsv(spark, path, schemas.RAW_TITLES, spread=5).rdd.getNumPartitions() == 5


def test_quotes_can_span_lines(spark, tmp_path):
    path = gz(tmp_path, "quoted.tsv.gz", 'k\tv\n1\t"a\tb\nc"\n2\td\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    got = tsv.read_tsv(spark, path, schema, quote='"').collect()
    assert [tuple(r) for r in got] == [(1, "a\tb\nc"), (2, "d")]


def test_numbers_and_rejects(spark, tmp_path):
    path = gz(tmp_path, "ratings.tsv.gz", RATINGS)
    df = tsv.read_tsv(spark, path, schemas.RAW_RATINGS)
    assert df.schema == schemas.RAW_RATINGS
    assert [tuple(r) for r in df.collect()] == [("tt1", 5.5, 10), ("tt2", None, 7), ("tt3", None, 3)]
    bad = tsv.rejected_rows(spark, path, schemas.RAW_RATINGS).collect()
    assert [r.tconst for r in bad] == ["tt2"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tsv.read_tsv(spark, path, schemas.RAW_RATINGS, strict=True).collect()


def test_many_files_and_normalise(spark, tmp_path):
    a = gz(tmp_path, "a.tsv.gz", RATINGS)
    b = gz(tmp_path, "b.tsv.gz", RATINGS.replace("tt", "uu"))
    out = tsv.normalise_file(spark, [a, b], schemas.RAW_RATINGS, str(tmp_path / "out"))
    assert out.count() == 6 and out.filter("averageRating IS NULL").count() == 4


def test_csv_round_trip(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "ab"] + [T.StructField("c", T.DoubleType())])
    rows = [('say "hi", you', "line\nbreak", 0.1), ("plain", None, 1e-9), ("", "é", None)]
    df = spark.createDataFrame(rows, schema)
    tsv.write_csv(df, str(tmp_path / "csv"))
    back = tsv.read_csv(spark, str(tmp_path / "csv"), schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert list((tmp_path / "csv").glob("*.csv.gz"))


def test_scan_prunes_columns_and_pushes_filters(spark):
    from conftest import plan_of

    part = tables.scan(spark, "/root/testdata/sf0.001/part.parquet", ["p_partkey", "p_name"])
    plan = plan_of(row_lookup(part, "p_partkey", 7))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert "EqualTo(p_partkey,7)" in plan
    assert "TakeOrderedAndProject" in plan_of(rows_list(part, "p_partkey", 5))


def test_table_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    assert tables.read_batches(spark, path, schema).count() == 0
    for batch, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b")]]):
        for _ in range(2):
            tables.append_batch(spark.createDataFrame(rows, schema), path, batch)
    assert tables.read_batches(spark, path, schema).count() == 3
    assert tables.read_batches(spark, path, schema, before=1).count() == 2
    latest = tables.read_latest(spark, path, schema, "k")
    assert sorted(map(tuple, latest.collect())) == [(1, "a"), (2, "b")]


def test_replace_table_by_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path)
    tables.replace(spark.range(5), path)
    for least in (2, 3):
        tables.replace(tables.read_current(spark, path).filter(f"id > {least}"), path)
    assert [r.id for r in tables.read_current(spark, path).collect()] == [4]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["version=1", "version=2"]


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(5), path)
    broken = tables.read_current(spark, path).withColumn("x", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        tables.replace(broken, path)
    assert tables.read_current(spark, path).count() == 5
    tables.replace(spark.range(2), path)  # over what the failed write left behind
    assert tables.read_current(spark, path).count() == 2


def test_steps_stay_after_an_error(spark):
    with pytest.raises(ValueError), Steps(spark) as steps:
        steps.freeze(spark.range(3), "kept")
        raise ValueError
    assert spark.read.parquet(f"{steps.path}/kept").count() == 3


def test_reads(spark):
    df = spark.createDataFrame([("tt1", "it's", 1.5), ("tt'2", None, None)], "k string, t string, v double")
    assert get_row(df, "k", "tt'2").t is None
    with pytest.raises(KeyError, match="Unknown"):
        get_row(df, "k", "tt9' OR '1'='1")
    got = [json.loads(r.json) for r in to_json_records(df).collect()]
    assert got == [{"k": "tt1", "t": "it's", "v": 1.5}, {"k": "tt'2", "t": None, "v": None}]
    assert row_lookup(df, "k", "tt1").select(F.col("t")).first().t == "it's"
