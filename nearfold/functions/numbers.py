"""Casts, classes and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearfold.fixed import CLASS_LABELS, OUT_OF_RANGE_LABEL


def cast_trunc(col: Column, strict: bool = False) -> Column:
    """Text to whole number by way of a double, cut toward zero (`95.7` is 95, `-3.9` is -3).

    Unreadable text gives null; with `strict` it raises (the default ANSI cast).
    """
    if strict:
        return col.cast("double").cast("bigint")
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("bigint")


def bin_right_closed(
    col: Column,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    other: str = OUT_OF_RANGE_LABEL,
) -> Column:
    """Class label of a number: the first class is `[e0, e1]`, the others `(ei, ei+1]`.

    Values outside all classes, and nulls, get the text `other`. `ml.feature.Bucketizer` closes its
    classes on the left and therefore does not fit.
    """
    labels = list(labels or CLASS_LABELS)[: len(edges) - 1]
    label = F.when(col < F.lit(edges[0]), F.lit(other))
    for upper, name in zip(edges[1:], labels, strict=True):
        label = label.when(col <= F.lit(upper), F.lit(name))
    return label.otherwise(F.lit(other))


def round_half_even(col: Column, places: int = 2) -> Column:
    """Round the binary value half to even, as array libraries do (`round` is half-up)."""
    scale = float(10**places)
    return F.rint(col * F.lit(scale)) / F.lit(scale)
