"""Feature text, tokens and token counts; all per row, so none of these needs a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def combined_text(cols: Sequence[str]) -> Column:
    """The columns joined by one space. Null in any of them gives null (`concat_ws` would skip it)."""
    parts: list[Column] = []
    for name in cols:
        parts += [F.lit(" "), F.col(name).cast("string")]
    return F.concat(*parts[1:])


def tokens(text: Column, min_len: int = 2) -> Column:
    """Lower-case runs of word characters (letters, digits, underscore) of at least `min_len`.

    With the default length, the one-letter class labels A, B, C ... of a feature text do not count,
    while the out-of-range label `nan` does.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(rf"([\p{{L}}\p{{N}}_]{{{min_len},}})"), F.lit(1))


def sorted_tokens(text: Column, min_len: int = 2) -> Column:
    """All tokens of the text in order; equal arrays mean equal count vectors."""
    return F.sort_array(tokens(text, min_len))


def term_counts(text: Column, min_len: int = 2) -> Column:
    """`array<struct<term, tf>>` of a text, ordered by term."""
    return count_sorted(sorted_tokens(text, min_len))


def count_sorted(ordered: Column) -> Column:
    """Run lengths of an ordered token array, as `array<struct<term, tf>>`."""

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)),
        )
        return _let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, n: F.struct(
                    F.get(s, start).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(s)) - start).cast("bigint").alias("tf"),
                ),
            ),
        )

    # An empty array would make `sequence` count downwards.
    counted = _let(ordered, lambda s: F.when(F.size(s) > 0, runs(s)))
    return F.coalesce(counted, F.array().cast("array<struct<term:string,tf:bigint>>"))


def squared_norm(counts: Column) -> Column:
    """Sum of squared counts, as a whole number; 0 for a text without tokens."""
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, t: acc + t["tf"] * t["tf"])


def dot_product(a: Column, b: Column) -> Column:
    """Dot product of two count arrays: merge them by term and multiply where neighbours agree."""
    both = F.sort_array(F.concat(a, b))

    def add(s: Column) -> Column:
        last = F.size(s) - 2
        return F.when(
            last >= 0,
            F.aggregate(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                F.lit(0).cast("bigint"),
                lambda acc, i: acc
                + F.when(
                    F.get(s, i)["term"] == F.get(s, i + 1)["term"],
                    F.get(s, i)["tf"] * F.get(s, i + 1)["tf"],
                ).otherwise(F.lit(0).cast("bigint")),
            ),
        ).otherwise(F.lit(0).cast("bigint"))

    return _let(both, add)


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from whole-number dot product and squared norms; 0 where either vector is empty.

    Whole numbers add up the same in any order, so the score does not depend on the shuffle. The
    squared norms are multiplied as doubles, which rounds like the exact product but cannot overflow.
    """
    scale = F.sqrt(norm_a.cast("double") * norm_b.cast("double"))
    return F.when((norm_a > 0) & (norm_b > 0), dot.cast("double") / scale).otherwise(F.lit(0.0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times inside `body`."""
    return F.transform(F.array(value), body)[0]
