"""Null markers in text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.fixed import NULL_TOKENS


def null_if_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """`col`, with every value listed in `tokens` turned into null."""
    return F.when(~col.isin(list(tokens)), col) if tokens else col


def normalize_nulls(
    df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Apply `null_if_token` to `cols` (default: all string columns) in one projection."""
    if cols is None:
        cols = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: null_if_token(F.col(c), tokens) for c in cols})
