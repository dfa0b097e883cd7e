"""Bucketed tables: touched buckets, merges, failures half way, fingerprints."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from nearfold.sources import buckets
from nearfold.sources.buckets import BucketTable

SCHEMA = "k bigint, v string, w double"


def rows(spark, *values):
    return spark.createDataFrame([(k, v, None) for k, v in values], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return BucketTable(spark, str(tmp_path / "t"), rows(spark).schema, "k", 8)


def listed(df):
    return sorted(tuple(r)[:2] for r in df.collect())


def files_of(df):
    return {f.split("/bucket=")[1].split("/")[0] for f in df.inputFiles()}


def test_empty_table(spark, table):
    assert table.read().count() == 0 and table.latest().count() == 0 and table.next_batch() == 0
    assert table.touched(rows(spark, (1, "a"))) and not table.merge(1)


def test_batches_replace_themselves(spark, table):
    for _ in range(2):
        table.append(rows(spark, (1, "a"), (2, "a"), (None, "x")), 0)
        table.append(rows(spark, (2, "b")), 1)
    assert listed(table.read()) == [(1, "a"), (2, "a"), (2, "b")]
    assert listed(table.read(before=1)) == [(1, "a"), (2, "a")]
    assert listed(table.latest()) == [(1, "a"), (2, "b")] and table.next_batch() == 2


def test_only_touched_buckets_are_read(spark, table):
    table.append(spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(0.5).alias("w")), 0)
    some = rows(spark, (3, ""), (4, ""))
    touched = table.touched(some)
    found = table.read(["k"], touched=touched)
    assert 1 <= len(touched) <= 2 and files_of(found) == {str(b) for b in touched}
    assert found.join(some, "k", "left_semi").count() == 2
    assert f"({len(touched)} paths)" in plan_of(found) and "ReadSchema: struct<k:bigint>" in plan_of(found)
    assert files_of(table.read()) == {str(b) for b in range(8)}


def test_merge_keeps_the_rows(spark, table):
    for batch in range(9):
        table.append(rows(spark, (batch, "a"), (100, f"v{batch}")), batch)
    before = listed(table.read())
    assert table.merge() and not table.merge()
    assert len(table.snapshot().parts) == 1 and listed(table.read()) == before
    assert listed(table.read(before=2)) == [(0, "a"), (1, "a"), (100, "v0"), (100, "v1")]
    assert (100, "v8") in listed(table.latest()) and table.next_batch() == 9
    table.append(rows(spark, (5, "again")), 4)  # a merged batch is finished
    assert listed(table.read()) == before
    table.append(rows(spark, (100, "new")), 9)
    assert not table.merge(2) and table.merge(2, only_latest=True, whole=True) and (100, "new") in listed(table.read())
    assert len(listed(table.read())) == 10


def test_large_folders_are_left_alone(spark, table):
    big = spark.range(50_000).select(F.col("id").alias("k"), F.uuid().alias("v"), F.rand().alias("w"))
    table.append(big, 0)
    for batch in range(1, 9):
        table.append(rows(spark, (batch, "a")), batch)
    assert table.merge()
    assert [(p.first, p.last) for p in table.snapshot().parts] == [(0, 0), (1, 8)]


def test_a_merge_that_fails_half_way(spark, table, monkeypatch):
    for batch in range(8):
        table.append(rows(spark, (batch, "a")), batch)
    state, before = table.snapshot(), listed(table.read())
    reading = table.read()

    def broken(*_):
        raise OSError("no")

    monkeypatch.setattr(BucketTable, "_commit", broken)
    with pytest.raises(OSError):
        table.merge()
    monkeypatch.undo()
    assert table.snapshot() == state and listed(table.read()) == before
    assert table.merge() and listed(table.read()) == before
    assert listed(reading) == before  # its folders stay while its snapshot is one of the last


def test_a_batch_that_fails_half_way(spark, table):
    table.append(rows(spark, (1, "a")), 0)
    bad = rows(spark, (2, "b"), (3, "c")).withColumn("w", F.when(F.col("k") == 3, F.raise_error(F.lit("no")).cast("double")))
    with pytest.raises(Exception, match="no"):
        table.append(bad, 1)
    assert listed(table.read()) == [(1, "a")] and table.next_batch() == 1


def test_two_writers(spark, table):
    table.append(rows(spark, (1, "a")), 0)
    state = table.snapshot()
    table.append(rows(spark, (2, "a")), 1)
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(state, state.parts)


def test_old_folders_go_with_their_snapshots(spark, table, tmp_path):
    for batch in range(20):
        table.append(rows(spark, (batch, "a")), batch)
        table.merge(4)
    kept = {p.folder for n in table._numbers() for p in table._load(n).parts}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == kept and len(kept) < 12
    assert table.read().count() == 20


def test_changes_by_fingerprint(spark, table):
    table.append(rows(spark, (1, "a"), (2, None), (3, "c")), 0)
    table.append(rows(spark, (3, "d")), 1)
    delivered = rows(spark, (1, "a"), (2, ""), (3, "c"), (4, "n"))
    changed = table.changed(delivered)
    assert listed(changed) == [(2, ""), (3, "c"), (4, "n")]
    assert listed(table.changed(rows(spark, (3, "d"), (2, None)))) == []
    assert "ReadSchema: struct<k:bigint,batch_id:bigint,fingerprint:string>" in plan_of(changed)


def test_names_in_use(spark, tmp_path):
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path), spark.createDataFrame([], "k int, Bucket int").schema, "k")
    assert buckets.BUCKETS > 1
