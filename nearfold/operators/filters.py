"""Row filters that behave like the data-frame library users come from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without a null in any of `cols`."""
    return df.dropna(how="any", subset=list(cols))


def dropna_any(df: DataFrame) -> DataFrame:
    """Rows without a null (or NaN) in any column."""
    return df.dropna(how="any")


def reject_list(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Rows whose `col` is not one of `values`. Null rows stay, unlike with a plain SQL `NOT IN`."""
    return df.filter(~F.col(col).isin(list(values)) | F.col(col).isNull())
