"""Incremental loads: work batches of unseen keys, and file streams that feed them.

Every stored table is a `BucketTable`. A batch reads only batches before its own number, of the buckets
of the keys it works on, and replaces its own rows, so Spark may run it again after any failure. The
list of attempted keys is written last: it marks the batch as done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nearfold.fixed import NULL_TOKENS
from nearfold.functions.nulls import normalize_nulls
from nearfold.operators.joins import anti_keys, semi_keys
from nearfold.operators.keys import distinct_keys, one_per_key, unseen_batch, upsert
from nearfold.plans.catalogue import (
    clean_crew,
    clean_names,
    clean_ratings,
    clean_titles,
    merge_content,
    person_keys,
    wanted_titles,
)
from nearfold.schemas import CONTENT, CREW, NAMES, RATINGS, TITLES
from nearfold.session import Steps
from nearfold.sources.buckets import BUCKETS, BucketTable

KEYS = T.StructType([T.StructField("tconst", T.StringType())])
STORED = {
    "attempted": KEYS,
    "titles": TITLES,
    "crew": CREW,
    "ratings": RATINGS,
    "names": NAMES,
    "content": CONTENT,
}


def store_table(spark: SparkSession, store: str, table: str, buckets: int = BUCKETS) -> BucketTable:
    """One of the stored tables, see `STORED`."""
    key = "nconst" if table == "names" else "tconst"
    return BucketTable(spark, f"{store}/{table}", STORED[table], key, buckets)


def stored(spark: SparkSession, store: str, table: str, before: int | None = None) -> DataFrame:
    """All rows of one of the stored tables."""
    return store_table(spark, store, table).read(before=before)


def current(spark: SparkSession, store: str, table: str, before: int | None = None) -> DataFrame:
    """The newest row per key of one of the stored tables."""
    return store_table(spark, store, table).latest(before=before)


def next_batch(spark: SparkSession, store: str) -> int:
    """The number after the last finished batch."""
    return store_table(spark, store, "attempted").next_batch()


def compact(spark: SparkSession, store: str, at_once: int = 2) -> list[str]:
    """Merge small batches of all stored tables; the names of those that were merged."""
    return [table for table in STORED if store_table(spark, store, table).merge(at_once)]


def run_batch(
    spark: SparkSession,
    store: str,
    titles: DataFrame,
    crew: DataFrame,
    ratings: DataFrame,
    names: DataFrame,
    batch: int | None = None,
    limit: int | None = None,
    refresh: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Take all unseen titles through cleaning, crew, ratings, names and merge.

    With `limit` only so many, the first in key order; the rest waits for the next batch. A title
    counts as attempted even if cleaning drops it, so bad rows cannot block the queue. With `refresh`
    the titles tried before whose cleaned row, crew or rating is new or changed in the dumps are
    taken again; `current` then shows each title's newest row. What a dump lacks stays as stored.
    Of several rows with one key a dump gives the one that `one_per_key` names. `buckets` counts for
    a new store. Of the store a batch reads the buckets of its keys, and to find changes the keys and
    fingerprints; enough small batches are merged at the end.
    """
    tables = {t: store_table(spark, store, t, buckets) for t in STORED}
    if batch is None:
        batch = tables["attempted"].next_batch()
    with Steps(spark) as steps:
        wanted = steps.freeze(wanted_titles(titles).select("tconst").distinct(), "wanted")
        seen = tables["attempted"].read(before=batch, touched=tables["attempted"].touched(wanted))
        unseen = steps.freeze(unseen_batch(wanted, seen, "tconst", limit), "unseen")
        delivered = {
            "titles": lambda keys: clean_titles(titles, keys),
            "crew": lambda keys: clean_crew(crew, keys),
            "ratings": lambda keys: clean_ratings(ratings, keys),
        }
        keys = unseen
        if refresh:
            attempted = tables["attempted"].read(before=batch)
            changed = [
                tables[t].changed(one_per_key(rows(attempted), "tconst"), batch).select("tconst")
                for t, rows in delivered.items()
            ]
            keys = steps.freeze(distinct_keys([unseen, *changed]), "keys")
        touched = tables["titles"].touched(keys) if refresh else None
        new = {}
        for table, rows in delivered.items():
            taken = one_per_key(rows(keys), "tconst")
            if refresh:
                before = semi_keys(tables[table].latest(before=batch, touched=touched), keys, "tconst")
                taken = upsert(before, taken, "tconst", refresh=True)
            new[table] = steps.freeze(taken, table)
        persons = steps.freeze(person_keys(new["crew"]), "persons")
        known = tables["names"].read(["nconst"], batch, tables["names"].touched(persons))
        new["names"] = one_per_key(clean_names(names, anti_keys(persons, known, "nconst")), "nconst")
        new["content"] = merge_content(new["titles"], new["crew"], new["ratings"])
        new["attempted"] = unseen
        for table, rows in new.items():
            tables[table].append(rows, batch)
    for table in tables.values():
        table.merge()


def drops(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    files_per_trigger: int = 1,
    null_tokens: list[str] | None = None,
) -> DataFrame:
    """Stream over dated folders `landing/<date>/*` of tab-separated dumps, read as text."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    stream = (
        spark.readStream.schema(text)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("nullValue", "\u0000")
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(f"{landing}/*/")
    )
    return normalize_nulls(stream, schema.names, NULL_TOKENS if null_tokens is None else null_tokens)


def title_stream(
    titles: DataFrame,
    store: str,
    checkpoint: str,
    side_tables: Callable[[], tuple[DataFrame, DataFrame, DataFrame]],
    refresh: bool = False,
) -> StreamingQuery:
    """Run every drop of titles through `run_batch`, then stop when no files are left.

    `side_tables` gives crew, ratings and names as they are when a batch starts. A drop is taken
    whole; `maxFilesPerTrigger` of the stream bounds a batch. With `refresh` a drop also takes up what
    is new or changed in it and the side tables for titles tried before.
    """

    def take(rows: DataFrame, batch: int) -> None:
        run_batch(rows.sparkSession, store, rows, *side_tables(), batch=batch, refresh=refresh)

    return _run(titles, take, checkpoint)


def upsert_stream(
    rows: DataFrame,
    table: str,
    key: str,
    checkpoint: str,
    refresh: bool = False,
    order: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Store every arriving row whose key is not stored yet, then stop when no files are left.

    Of several arriving rows with one key one is stored, that with the greatest `order`; rows without
    a key are not stored. With `refresh`, changed rows are stored as well and `current_rows` shows the
    newest one per key. A batch is written first, so its keys and their buckets are known; of what is
    stored it reads the key column of these buckets, with `refresh` also the fingerprints.
    """
    schema = rows.schema

    def take(batch_rows: DataFrame, batch: int) -> None:
        spark = batch_rows.sparkSession
        store = BucketTable(spark, table, schema, key, buckets)
        with Steps(spark) as steps:
            arrived = steps.freeze(one_per_key(batch_rows, key, order), "arrived")
            touched = store.touched(arrived)
            if refresh:
                fresh = store.changed(arrived, batch, touched)
            else:
                known = store.read([key], batch, touched)
                fresh = anti_keys(arrived, semi_keys(known, arrived, key), key)
            store.append(fresh, batch)
        store.merge()

    return _run(rows, take, checkpoint)


def stored_rows(spark: SparkSession, table: str, schema: T.StructType, key: str) -> DataFrame:
    """All rows that `upsert_stream` has stored."""
    return BucketTable(spark, table, schema, key).read()


def current_rows(
    spark: SparkSession, table: str, schema: T.StructType, key: str, order: str | None = None
) -> DataFrame:
    """The newest stored row per key: with the greatest `order`, else of the latest batch."""
    store = BucketTable(spark, table, schema, key)
    return one_per_key(store.read(), key, order) if order else store.latest()


def dedup_stream(
    rows: DataFrame, table: str, key: str, checkpoint: str, event_time: str | None = None, within: str | None = None
) -> StreamingQuery:
    """Write the first arriving row of every key, then stop when no files are left.

    The keys seen are state of the stream, kept by Spark under `checkpoint` and taken up by the next
    run; nothing stored is read. Without `event_time` the state grows with the keys; with it, a key is
    forgotten once the stream is `within` (such as `2 days`) past its first row, and rows later than
    that are dropped. Which of several rows of one key in one batch counts is open, so they should be
    equal. Rows without a key are dropped. All rows of a key meet in one task of a batch: for keys that
    may hold a large share of a batch, `upsert_stream` takes one per key before the shuffle.
    """
    named = rows.filter(F.col(key).isNotNull())
    if event_time is not None:
        first = named.withWatermark(event_time, within or "0 seconds").dropDuplicatesWithinWatermark([key])
    else:
        first = named.dropDuplicates([key])
    query = (
        first.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _run(
    rows: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    query = (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
