import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from nearfold.operators import joins, keys
from nearfold.operators.counts import stage_counts, union_counts
from nearfold.operators.joins import anti_keys, hot_keys, merge_on_key, salted_join, semi_keys, spread_lookup


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_anti_join_ignores_null_keys(spark):
    df = spark.createDataFrame([("x",), ("y",)], "k string")
    seen = spark.createDataFrame([("x",), (None,)], "k string")
    assert rows(anti_keys(df, seen, "k")) == [("y",)]
    assert rows(semi_keys(df, seen, "k")) == [("x",)]
    assert "LeftAnti" in plan_of(anti_keys(df, seen, "k"))


def test_repeated_keys_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    seen = spark.createDataFrame([(1,)] * 5, "k int")
    assert rows(semi_keys(df, seen, "k")) == [(1, "a"), (1, "b")]


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows share one key; key 7 has no partner."""
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 20).cast("int").alias("k")
    )
    return big, spark.createDataFrame([(k, f"v{k}") for k in range(20) if k != 7], "k int, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", ["k = 0", "k < 5", "false", "true"])
def test_spread_lookup_equals_join(skewed, how, hot):
    big, lookup = skewed
    got = spread_lookup(big, lookup, "k", F.expr(hot), "id", how)
    want = big.join(lookup, "k", how).select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_of_a_hot_key_spread_over_the_shuffle(spark, skewed, monkeypatch):
    big, lookup = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_lookup(big, lookup, "k", F.col("k") == 0, "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == big.filter("k <> 7").count()
    assert max(sizes) < 2 * sum(sizes) / 8


def test_hot_keys(spark, skewed, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    big, _ = skewed
    assert rows(hot_keys(big, "k")) == [(0, True)]


@pytest.mark.parametrize("salts", [[], [(0, 7)], [(0, 5), (2, 3), (99, 4)]])
def test_salted_join_equals_join(spark, skewed, salts):
    big, lookup = skewed
    right = lookup.unionByName(lookup.withColumn("v", F.concat("v", F.lit("b"))))
    table = spark.createDataFrame(salts, "k int, n_salts int")
    got = salted_join(big, right, "k", table, "id").select("id", "k", "v")
    assert rows(got) == rows(big.join(right, "k").select("id", "k", "v"))


def test_merge_keeps_column_order(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3)], "k string, b int")
    c = spark.createDataFrame([("x", 4), ("z", 5)], "k string, c int")
    merged = merge_on_key([a, b, c], "k")
    assert merged.columns == ["k", "a", "b", "c"]
    assert rows(merged) == [("x", 1, 3, 4)]


def test_key_sets(spark):
    crew = spark.createDataFrame([("nm1,nm2", "nm3"), (None, "nm1")], "d string, w string")
    assert rows(keys.packed_keys(crew, ["d", "w"], "n")) == [("nm1",), ("nm2",), ("nm3",)]
    both = keys.distinct_keys([crew.select(F.col("d").alias("n")), crew.select(F.col("w").alias("n"))])
    assert sorted(str(r.n) for r in both.collect()) == ["None", "nm1", "nm1,nm2", "nm3"]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    once = keys.upsert(old, batch, "k")
    assert rows(once) == [(1, "old"), (2, "old"), (3, "new")] == rows(keys.upsert(once, batch, "k"))
    assert rows(keys.upsert(old, batch, "k", refresh=True)) == [(1, "old"), (2, "new"), (3, "new")]


def test_stage_counts(spark):
    df = spark.range(10)
    got = stage_counts(df, {"even": F.col("id") % 2 == 0, "big": F.col("id") > 4}).collect()
    assert [tuple(r) for r in got] == [("input", 10), ("even", 5), ("big", 2)]
    assert rows(union_counts({"a": df, "b": df.limit(3)})) == [("a", 10), ("b", 3)]


def test_one_row_per_key(spark):
    batch = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "z"), (None, 9, "n"), (2, 1, None), (2, 1, "x"), (2, 1, "x")],
        "k int, at int, v string",
    )
    assert rows(keys.one_per_key(batch, "k", "at")) == [(1, 7, "b"), (2, 1, "x")]
    assert rows(keys.one_per_key(batch.select("k"), "k")) == [(1,), (2,)]
    stored = spark.createDataFrame([(1, 1, "old"), (3, 1, "old")], "k int, at int, v string")
    once = keys.upsert(stored, batch, "k", refresh=True, order="at")
    assert rows(once) == [(1, 7, "b"), (2, 1, "x"), (3, 1, "old")]
    assert rows(keys.upsert(once, batch, "k", refresh=True, order="at")) == rows(once)
    assert rows(keys.upsert(stored, batch, "k")) == [(1, 1, "old"), (2, 1, "x"), (3, 1, "old")]
