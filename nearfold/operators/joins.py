"""Joins: by key sets, chains on one key, and joins whose keys may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than this fraction of the rows, so at most HOT_KEYS keys are hot
# and a table of the hot keys can always be broadcast.
HOT_KEYS = 1000
SALTS = 1 << 16


def semi_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `keys`.

    The keys are made distinct first: that happens before the shuffle, uses the partitioning the join
    needs anyway, and leaves skew only on the side Spark's adaptive join can split.
    """
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def anti_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `keys`; nulls among the keys change nothing."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def merge_on_key(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner join chain on one key; columns in table order, key first.

    All joins share the key, so one partitioning per table serves the whole chain.
    """
    return reduce(lambda left, right: left.join(right, key, "inner"), tables)


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys holding more than 1/`HOT_KEYS` of the rows, as `key, hot`: fewer than `HOT_KEYS` rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(F.col("n") * HOT_KEYS > total).select(key, F.lit(True).alias("hot"))


def spread_lookup(
    big: DataFrame, lookup: DataFrame, key: str, is_hot: Column, spread_by: str, how: str = "inner"
) -> DataFrame:
    """Join `big` to `lookup` (one row per key) although a few keys may hold most rows of `big`.

    Lookup rows satisfying `is_hot` are broadcast; the caller's rule must allow at most `HOT_KEYS`
    such rows. All other rows are shuffled by key, and the rows already served by the broadcast are
    scattered by a salt instead of gathering on their key. `big` is read once.
    """
    values = [c for c in lookup.columns if c != key]
    marked = lookup.withColumn("_hot_key", F.coalesce(is_hot, F.lit(False)))
    hot = marked.filter("_hot_key").select(key, F.struct(*values).alias("_hot"))
    cold = marked.filter("NOT _hot_key").select(
        _spot(F.col(key), F.lit(0)).alias("_spot"), F.struct(*values).alias("_cold")
    )
    served = big.join(F.broadcast(hot), key, "left")
    is_served = F.col("_hot").isNotNull()
    joined = (
        served.withColumn(
            "_spot",
            _spot(
                F.when(~is_served, F.col(key)),
                F.when(~is_served, 0).otherwise(F.pmod(F.xxhash64(spread_by), F.lit(SALTS)) + 1),
            ),
        )
        .join(cold, "_spot", "left")
        .withColumn("_found", F.coalesce("_hot", "_cold"))
    )
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    return joined.select(*big.columns, *[F.col("_found")[v].alias(v) for v in values])


def salted_join(
    left: DataFrame, right: DataFrame, key: str, salts: DataFrame, spread_by: str
) -> DataFrame:
    """Inner join on `key` where some keys produce far more pairs than others.

    `salts(key, n_salts)` lists the heavy keys only (the caller's rule must allow at most `HOT_KEYS`
    rows). Left rows of such a key are dealt to `n_salts` slices by the hash of `spread_by`; the right
    rows of that key are repeated once per slice. Every pair still meets exactly once.
    """
    n = F.coalesce("n_salts", F.lit(1))
    left = (
        left.join(F.broadcast(salts), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), n.cast("bigint")).cast("int"))
        .drop("n_salts")
    )
    right = (
        right.join(F.broadcast(salts), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)))
        .drop("n_salts")
    )
    return left.join(right, [key, "_salt"], "inner").drop("_salt")


def _spot(key: Column, salt: Column) -> Column:
    """Key and salt as one join key. As two keys, the constant side would drop out of the shuffle."""
    return F.struct(key.alias("key"), salt.cast("bigint").alias("salt"))
