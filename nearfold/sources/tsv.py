"""Tab-separated dumps and compressed CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfold.fixed import NULL_TOKENS
from nearfold.functions.nulls import normalize_nulls, null_if_token


def read_tsv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    quote: str = "",
    spread: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Scan of one or many (gzip) tab-separated files with a header line.

    Everything is read as text under the given names, then `null_tokens` become null and number
    columns are cast. Unreadable numbers give null, or an error with `strict`; `rejected_rows` lists
    them. The dumps are unquoted, so `quote` is off and a leading `"` is an ordinary character; with
    `quote='"'` a quoted value may span lines (and the file can no longer be split).

    A gzip file is always read by one task. `spread` deals its lines to that many partitions before
    anything else is done with them; many files need none.
    """
    names = list(columns) if columns else schema.names
    text = _read_text(spark, path, schema, quote).select(*names)
    text = text.repartition(spread) if spread else text
    text = normalize_nulls(text, names, null_tokens)
    return text.select(*[_typed(F.col(n), schema[n].dataType, strict).alias(n) for n in names])


def rejected_rows(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    null_tokens: Sequence[str] = NULL_TOKENS,
    quote: str = "",
) -> DataFrame:
    """Rows with text in a number column that is neither a null marker nor a number."""
    text = _read_text(spark, path, schema, quote)
    bad = F.lit(False)
    for field in schema.fields:
        if not isinstance(field.dataType, T.StringType):
            value = null_if_token(F.col(field.name), null_tokens)
            bad = bad | (value.isNotNull() & value.try_cast(field.dataType).isNull())
    return text.filter(bad)


def normalise_file(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    out: str,
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Scan a dump, turn its null markers into nulls, store it as Parquet, and return the table.

    One task unpacks a gzip file; its lines are then rebalanced over all tasks, which convert and
    write them, into files of Spark's advisory size.
    """
    text = _read_text(spark, path, schema, "").hint("rebalance")
    text = normalize_nulls(text, schema.names, null_tokens)
    rows = text.select(*[_typed(F.col(f.name), f.dataType, False).alias(f.name) for f in schema.fields])
    rows.write.mode("overwrite").parquet(out)
    return spark.read.schema(schema).parquet(out)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Compressed CSV with a header, one file per partition."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("compression", compression)
        .option("escape", '"')
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what `write_csv` wrote."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        # An empty cell is null, a quoted empty cell is empty text.
        .option("nullValue", "\u0000")
        .csv(path)
    )


def _read_text(
    spark: SparkSession, path: str | list[str], schema: T.StructType, quote: str
) -> DataFrame:
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return (
        spark.read.schema(as_text)
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", quote)
        .option("escape", quote)
        .option("multiLine", bool(quote))
        # Only the tokens passed by the caller are nulls.
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )


def _typed(col, kind: T.DataType, strict: bool):
    if isinstance(kind, T.StringType):
        return col
    return col.cast(kind) if strict else col.try_cast(kind)
