"""Keyed tables in hash buckets: appended in batches, read by bucket, merged behind the readers' back.

A row lies in the bucket of its key. A batch is a folder with a sub-folder for every bucket it has rows
for, so what reads some keys opens the folders of their buckets and no others. Which folders count is
said by a snapshot, a small file that lists them; a new snapshot gets the next number and readers take
the greatest. A batch or a merge that fails half way leaves folders that no snapshot lists, and readers
go on with the old state.

Merging is by size: the newest folders are merged as soon as enough of them are no larger together
than half of the folder before them, so a row is written again only about as often as the table
doubles, however many batches a day bring a few rows each.

Every row also has the number of its batch and a fingerprint of its columns. Whether a delivered row
is new or changed is decided on key and fingerprint; the other columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
#: So many folders at least go into a merge.
MERGED_AT_ONCE = 8
#: Snapshots whose folders stay, for readers that have just begun.
KEPT = 2
BATCH, PRINT, BUCKET = "batch_id", "fingerprint", "bucket"


@dataclass(frozen=True)
class Part:
    """A folder: the batches in it, first to last, its buckets and its size."""

    folder: str
    first: int
    last: int
    buckets: tuple[int, ...]
    size: int


@dataclass(frozen=True)
class Snapshot:
    number: int
    buckets: int
    parts: tuple[Part, ...]


class BucketTable:
    """One table at `path`, with the columns of `schema`, keyed by one of them.

    `buckets` counts when the table is begun; afterwards its snapshots say how many there are. Rows
    without a key are not stored. One process writes at a time, any number may read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> None:
        if taken := {BATCH, PRINT, BUCKET} & {c.lower() for c in schema.names}:
            raise ValueError(f"column names in use: {taken}")
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.begun_with = buckets
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # What is there

    def snapshot(self) -> Snapshot:
        """The state in force; empty before the first batch."""
        numbers = self._numbers()
        return self._load(max(numbers)) if numbers else Snapshot(-1, self.begun_with, ())

    def next_batch(self) -> int:
        return max((p.last for p in self.snapshot().parts), default=-1) + 1

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(self.snapshot().buckets)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of the keys: at most as many numbers as the table has buckets."""
        rows = keys.filter(F.col(self.key).isNotNull()).select(self.bucket_of(F.col(self.key)).alias(BUCKET)).distinct()
        return sorted(r[0] for r in rows.collect())

    def read(
        self, columns: Sequence[str] | None = None, before: int | None = None, touched: Collection[int] | None = None
    ) -> DataFrame:
        """All rows, or those of the `touched` buckets and of the batches `before` one.

        A batch that runs again thus does not see its own half-done work. `columns` may name the hidden
        ones, `batch_id` and `fingerprint`.
        """
        columns = list(columns or self.schema.names)
        parts = [p for p in self.snapshot().parts if before is None or p.first < before]
        return self._rows(parts, before, touched).select(*columns)

    def latest(
        self, columns: Sequence[str] | None = None, before: int | None = None, touched: Collection[int] | None = None
    ) -> DataFrame:
        """The newest row of every key. The choice is made before the shuffle too, within each task."""
        columns = list(columns or self.schema.names)
        others = [c for c in columns if c != self.key]
        rows = self.read([self.key, BATCH, *others], before, touched)
        newest = F.max_by(F.struct(*others), BATCH) if others else F.max(BATCH)
        found = rows.groupBy(self.key).agg(newest.alias("_row"))
        return found.select(*[F.col(c) if c == self.key else F.col("_row")[c].alias(c) for c in columns])

    def changed(self, rows: DataFrame, before: int | None = None, touched: Collection[int] | None = None) -> DataFrame:
        """Those of `rows` whose key is not stored, or whose newest stored row differs."""
        known = self.latest([self.key, PRINT], before, touched)
        marked = rows.withColumn(PRINT, self.fingerprint())
        return marked.join(known, [self.key, PRINT], "left_anti").select(*rows.columns)

    def fingerprint(self) -> Column:
        """128 bits over all columns in order; a null is told from any value."""
        return F.md5(F.to_json(F.struct(*self.schema.names), {"ignoreNullFields": "false"}))

    # Changes

    def append(self, rows: DataFrame, batch: int) -> None:
        """Add `rows` as batch number `batch`.

        A batch that is there already is replaced, as it may have run again after a failure; once it
        has been merged with others it is finished, and nothing happens.
        """
        state = self.snapshot()
        if any(p.first <= batch <= p.last and p.first < p.last for p in state.parts):
            return
        part = self._write(rows.withColumns({BATCH: F.lit(batch).cast("bigint"), PRINT: self.fingerprint()}), batch, batch)
        others = [p for p in state.parts if p.first != batch]
        self._commit(state, [*others, part])

    def merge(self, at_once: int = MERGED_AT_ONCE, only_latest: bool = False, whole: bool = False) -> bool:
        """Merge the newest folders if there are enough small ones; whether it was done.

        `whole` takes all folders, however large the older ones are. `only_latest` keeps the newest row of a key among those merged. Readers see the old folders
        until the new one is complete; these are removed with the snapshots before the last ones.
        """
        state = self.snapshot()
        parts = sorted(state.parts, key=lambda p: p.first)
        size, first = 0, len(parts)
        while first and (whole or first == len(parts) or parts[first - 1].size <= 2 * size):
            first -= 1
            size += parts[first].size
        run = parts[first:]
        if len(run) < max(2, at_once):
            return False
        rows = self._rows(run, None, None)
        if only_latest:
            every = [c for c in rows.columns if c != self.key]
            newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*every), BATCH).alias("_row"))
            rows = newest.select(self.key, "_row.*").select(*rows.columns)
        part = self._write(rows, run[0].first, run[-1].last)
        self._commit(state, [*parts[:first], part])
        self._clear()
        return True

    # Files

    def _rows(self, parts: Sequence[Part], before: int | None, touched: Collection[int] | None) -> DataFrame:
        hidden = [T.StructField(BATCH, T.LongType()), T.StructField(PRINT, T.StringType())]
        schema = T.StructType([*self.schema.fields, *hidden])
        wanted = None if touched is None else set(touched)
        folders = [
            f"{self.path}/data/{p.folder}/{BUCKET}={b}" for p in parts for b in p.buckets if wanted is None or b in wanted
        ]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*folders)
        return rows if before is None else rows.filter(F.col(BATCH) < before)

    def _write(self, rows: DataFrame, first: int, last: int) -> Part:
        folder = f"{first}-{last}-{uuid.uuid4().hex}"
        path = f"{self.path}/data/{folder}"
        bucketed = rows.filter(F.col(self.key).isNotNull()).withColumn(BUCKET, self.bucket_of(F.col(self.key)))
        bucketed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at(path))]
        held = tuple(sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}=")))
        return Part(folder, first, last, held, int(self._fs.getContentSummary(self._at(path)).getLength()))

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/snapshots")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def _load(self, number: int) -> Snapshot:
        stream = self._fs.open(self._at(f"{self.path}/snapshots/{number}.json"))
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        parts = tuple(Part(**p | {"buckets": tuple(p["buckets"])}) for p in said["parts"])
        return Snapshot(number, said["buckets"], parts)

    def _commit(self, before: Snapshot, parts: Sequence[Part]) -> None:
        """Put a snapshot after `before`, complete or not at all; fails if another one came between."""
        number = before.number + 1
        at = self._at(f"{self.path}/snapshots/{number}.json")
        if self._fs.exists(at):
            raise RuntimeError(f"{self.path} was changed by another writer")
        ordered = sorted(parts, key=lambda p: p.first)
        said = json.dumps({"buckets": before.buckets, "parts": [asdict(p) for p in ordered]})
        draft = self._at(f"{self.path}/snapshots/{number}-{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft, False)
        out.write(bytearray(said.encode()))
        out.close()
        if not self._fs.rename(draft, at):
            raise RuntimeError(f"{self.path} was changed by another writer")

    def _clear(self) -> None:
        """Remove the older snapshots, and the folders that only they list."""
        numbers = sorted(self._numbers())
        kept = {p.folder for n in numbers[-KEPT:] for p in self._load(n).parts}
        for n in numbers[:-KEPT]:
            gone = {p.folder for p in self._load(n).parts} - kept
            for folder in gone:
                self._fs.delete(self._at(f"{self.path}/data/{folder}"), True)
            self._fs.delete(self._at(f"{self.path}/snapshots/{n}.json"), False)
