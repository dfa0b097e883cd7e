"""Reads over stored tables: one row, a few rows, JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def row_lookup(df: DataFrame, key: str, value: object, collation: str | None = None) -> DataFrame:
    """Rows whose key equals `value`; the comparison is pushed into the Parquet scan.

    The value is a literal, never spliced into SQL text, so quotes in it are harmless. Text is compared
    byte by byte; with a `collation` of Spark such as `UNICODE_CI_AI` as that says, here without case
    and accents, so `Amelie` finds `AMÉLIE`, and several rows may be found where one key was meant to
    be. Such a comparison is not pushed into the scan: row groups cannot be left out by it.
    """
    own = F.col(key)
    if collation is None:
        return df.filter(own == F.lit(value))
    return df.filter(F.collate(own, collation) == F.collate(F.lit(value), collation))


def get_row(df: DataFrame, key: str, value: object, collation: str | None = None) -> Row:
    """The first row with this key; `KeyError` if there is none."""
    found = row_lookup(df, key, value, collation).first()
    if found is None:
        raise KeyError(f"Unknown {key}: {value}")
    return found


def rows_list(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first `n` rows in key order (a table scan without order gives arbitrary ones)."""
    return df.orderBy(key).limit(n)


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, in column `json`; nulls are kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
