"""Token ids of whole texts in ORC files.

Rows lie in ascending id order over the files, so the stripe and row-group ranges of the id column
let a reader skip all but the stripes in question, and a Bloom filter on it rules out the rest. Ids
are `array<int>`, which ORC stores in its run-length integer encoding; stripes are read in parallel.
Null texts are empty: they hold the end id alone. Null ids come first. Rows that share an id stay
apart, in the order in which the files hold them. Other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfold.llm.batches import list_array, slices
from nearfold.llm.tokens import default_path, encoder

END_ID = 2


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    stripe_bytes: int = 64 << 20,
    index_stride: int = 1000,
) -> None:
    """Write `doc_id, row, ids`; `row` counts the rows of a file. Range-partitioned and sorted by id.

    A number of the row breaks ties, so that an id with very many rows still spreads over tasks.
    """
    file = tokenizer or default_path()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, code = 0, encoder(file)
        for batch, raws in slices(batches, "text"):
            ids, counts = code.encode(raws)
            ends = np.cumsum(counts)
            whole = np.insert(ids, ends, end_id)
            rows = pa.array(np.arange(row, row + len(raws)))
            row += len(raws)
            lists = list_array(whole, counts + 1, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), rows, lists], ["doc_id", "row", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    ordered = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(text_col).alias("text"),
            F.monotonically_increasing_id().alias("n"),
        )
        .repartitionByRange("doc_id", "n")
        .sortWithinPartitions("doc_id", "n")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(coded, f"doc_id {kind}, row bigint, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_stride)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, row, ids, file` of files whose ids are whole numbers. A filter on `doc_id` reaches the stripes' statistics and filters."""
    files = spark.read.schema("doc_id bigint, row bigint, ids array<int>").orc(path)
    return files.withColumn("file", F.col("_metadata.file_name"))


def checksums(files: DataFrame) -> DataFrame:
    """`doc_id, file, row, n_tokens, ids_crc32` of each row; the crc is over little-endian uint32."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            data = memoryview(lists.flatten().to_numpy().astype("<u4", copy=False)).cast("B")
            ends = (4 * np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
            columns = [*batch.columns[:3], lists.value_lengths().cast(pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    schema = "doc_id bigint, file string, row bigint, n_tokens bigint, ids_crc32 bigint"
    return files.select("doc_id", "file", "row", "ids").mapInArrow(summed, schema)


def positions(rows: DataFrame) -> DataFrame:
    """Adds `start`, the ids of all rows before: sums within each file after sums over the files.

    Files follow one another by their part number, which grows beyond the five digits it is padded to.
    """
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    part = F.regexp_extract("file", r"^part-(\d+)", 1).try_cast("bigint")
    earlier = Window.orderBy(part, "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inside.join(bases, "file").withColumn("start", F.col("base") + F.col("inside"))
