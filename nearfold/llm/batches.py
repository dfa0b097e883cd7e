"""Helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfold.session import freeze

SLICE_BYTES = 1 << 20
#: Files of a table whose numbers are broadcast; of more, the rows are numbered in a copy.
FILES = 1 << 16
_SMALL = {"parquet.block.size": 1 << 20, "parquet.page.size": 64 << 10, "parquet.enable.dictionary": "false"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def free_name(df: DataFrame, stem: str) -> str:
    """A name for a column that `df` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def number_rows(df: DataFrame, column: str = "row") -> DataFrame:
    """`df` with a number for each row in `column`, the same however often and by whatever splits it is read.

    Rows read from files are numbered by their file and their place in it, without a copy. All else
    (rows computed, generated or joined) is numbered once and written; that table stays, as with
    `freeze`. Its texts go out in small row groups and pages, so that a task holds few of them.
    """
    path, number = free_name(df, f"{column}_file"), free_name(df, f"{column}_file_number")
    files = _file_numbers(df, path, number) if is_scan(df) else None
    if files is None:
        return freeze(df.withColumn(column, F.monotonically_increasing_id()), "numbered", **_SMALL)
    numbered = df.withColumns({path: F.col("_metadata.file_path"), column: F.col("_metadata.row_index")})
    numbered = numbered.join(F.broadcast(files), path)
    return numbered.withColumn(column, F.shiftleft(number, 40) + F.col(column)).drop(path, number)


def is_scan(df: DataFrame) -> bool:
    """Whether the rows are those of files, perhaps filtered and with some columns computed from others."""
    if any(c.lower() == "_metadata" for c in df.columns):
        return False
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def _file_numbers(df: DataFrame, path: str, number: str) -> DataFrame | None:
    files = df.select(F.col("_metadata.file_path").alias(path)).distinct().limit(FILES + 1).collect()
    if len(files) > FILES:
        return None
    numbered = list(enumerate(sorted(r[0] for r in files)))
    return df.sparkSession.createDataFrame(numbered, f"{number} bigint, {path} string")


def least_hashed(rows: DataFrame, id_col: str, class_col: str, sample: int) -> DataFrame:
    """Ids and classes of the `sample` rows of each class whose ids have the least hashes; a small table.

    A count of each class gives a bound for the hash that a few times as many rows pass; only these are
    ranked, so no task gathers the rows of a class, nor each task's best of it. There should be few
    classes. Rows without an id or a class are left out.
    """
    kinds = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, {class_col} {rows.schema[class_col].dataType.simpleString()}"
    known = rows.select(id_col, class_col).filter(F.col(id_col).isNotNull() & F.col(class_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(class_col).agg(F.count("*")).collect()}
    found: list[tuple] = []
    factor = 4
    while counts:
        bounds = [(c, min(2**64 * factor * sample // n, 2**64 - 1) - 2**63) for c, n in counts.items()]
        bound = rows.sparkSession.createDataFrame(bounds, f"{kinds.split(', ')[1]}, most bigint")
        hashed = known.withColumn("hashed", F.xxhash64(id_col)).join(F.broadcast(bound), class_col)
        ranked = Window.partitionBy(class_col).orderBy("hashed", id_col)
        best = hashed.filter("hashed <= most").withColumn("nth", F.row_number().over(ranked)).filter(F.col("nth") <= sample)
        held = [tuple(r) for r in best.select(id_col, class_col).collect()]
        got = {c: sum(1 for x in held if x[1] == c) for c in counts}
        enough = {c for c, n in counts.items() if got[c] >= min(sample, n)}
        found += [x for x in held if x[1] in enough]
        counts = {c: n for c, n in counts.items() if c not in enough}
        factor *= 8
    return rows.sparkSession.createDataFrame(found, kinds)


def some_of_each(rows: DataFrame, keys: list[str], value: str, most: int = 8) -> DataFrame:
    """At most `most` rows for each combination of keys, those with the least `value`."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= most).drop("nth")


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string or binary column; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch cut into runs of rows with about `limit` bytes of text, one row at least.

    Temporary arrays are a multiple of the bytes at hand, so this bounds a task's memory by the
    longest text and not by the batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(first, last - first), raw_texts(column.slice(first, last - first))
            first = last


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions `starts[i] .. starts[i] + lengths[i] - 1` for all i, one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, dtype=np.int64) - before, lengths) + np.arange(lengths.sum())


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
