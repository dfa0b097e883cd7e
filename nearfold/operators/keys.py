"""Key sets: union, distinct, packed lists, and batches of keys not seen yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.operators.joins import anti_keys


def distinct_keys(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of all sources together; null counts as one key.

    Duplicates go before the shuffle too (partial aggregation), so a key that fills a third of the
    rows costs one row per task.
    """
    return reduce(DataFrame.unionByName, sources).distinct()


def packed_keys(df: DataFrame, cols: Sequence[str], name: str, sep: str = ",") -> DataFrame:
    """Distinct single keys found in packed list columns.

    Cells such as `nm1,nm2` give both keys; matching whole cells would find neither.
    """
    packed = F.explode(F.array(*[F.split(F.col(c), sep) for c in cols]))
    return df.select(packed.alias("packed")).select(F.explode("packed").alias(name)).distinct()


def unseen_batch(
    candidates: DataFrame, seen: DataFrame, key: str, limit: int | None = None
) -> DataFrame:
    """Distinct keys of `candidates` that are not in `seen`; with `limit`, the first in key order.

    The limit is the size of one work batch, taken as a distributed top-n.
    """
    fresh = anti_keys(candidates.select(key).distinct(), seen, key)
    return fresh if limit is None else fresh.orderBy(key).limit(limit)


def one_per_key(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each key, rows without a key left out.

    Of several rows the one with the greatest `order` stays (null counts as least); equal ones, and
    all if there is no `order`, go by the greatest values of the other columns from the left. So the
    choice does not depend on partitions. The maximum is taken before the shuffle too, hence a key
    that fills a third of the rows sends one row per task.
    """
    if rows.columns == [key]:
        return rows.filter(F.col(key).isNotNull()).distinct()
    first = [order] if order and order != key else []
    ranked = F.struct(*first, *[c for c in rows.columns if c not in (key, *first)])
    best = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(ranked).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def upsert(
    stored: DataFrame, batch: DataFrame, key: str, refresh: bool = False, order: str | None = None
) -> DataFrame:
    """Stored rows plus the batch rows with new keys.

    Keys already stored keep their row; with `refresh` the batch's row replaces it. Of several batch
    rows with one key one is taken, see `one_per_key`; rows without a key are not taken. Applying the
    same batch again changes nothing.
    """
    batch = one_per_key(batch, key, order)
    if refresh:
        return anti_keys(stored, batch, key).unionByName(batch)
    return stored.unionByName(anti_keys(batch, stored, key))
