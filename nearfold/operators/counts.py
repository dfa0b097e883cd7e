"""Counts of tokens, terms and rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nearfold.functions.text import cosine, dot_product, squared_norm, term_counts, tokens


def token_counts(df: DataFrame, id_col: str, text_col: str, min_len: int = 2) -> DataFrame:
    """`id, term, tf` for every token of every text. Counted inside the row, so without a shuffle."""
    return df.select(id_col, F.inline(term_counts(F.col(text_col), min_len)))


def vocabulary(df: DataFrame, id_col: str, text_col: str, min_len: int = 2) -> DataFrame:
    """`term, df, total_tf`: in how many texts a term occurs, and how often in all.

    Each text contributes a term once, so the number of texts is a plain count that combines before
    the shuffle; frequent terms do not pile up.
    """
    return (
        token_counts(df, id_col, text_col, min_len)
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))
    )


def matrix_shape(df: DataFrame, id_col: str, text_col: str, min_len: int = 2) -> DataFrame:
    """One row: number of texts (with or without tokens) and number of distinct terms."""
    terms = df.select(F.explode(F.array_distinct(tokens(F.col(text_col), min_len))).alias("term"))
    shape = terms.distinct().agg(F.count("*").alias("n_terms"))
    rows = df.agg(F.count("*").alias("n_rows"))
    return rows.select("n_rows", shape.scalar().alias("n_terms"))


def doc_norms(df: DataFrame, id_col: str, text_col: str, min_len: int = 2) -> DataFrame:
    """`id, n2`: squared length of each count vector; 0 for a text without tokens. No shuffle."""
    return df.select(id_col, squared_norm(term_counts(F.col(text_col), min_len)).alias("n2"))


def pair_scores(df: DataFrame, text_a: str, text_b: str, min_len: int = 2) -> DataFrame:
    """`dot, n2_a, n2_b, score` of two texts that stand in the same row. No shuffle."""
    counted = df.withColumns(
        {"_a": term_counts(F.col(text_a), min_len), "_b": term_counts(F.col(text_b), min_len)}
    )
    sums = counted.withColumns(
        {
            "dot": dot_product(F.col("_a"), F.col("_b")),
            "n2_a": squared_norm(F.col("_a")),
            "n2_b": squared_norm(F.col("_b")),
        }
    ).drop("_a", "_b")
    return sums.withColumn("score", cosine(F.col("dot"), F.col("n2_a"), F.col("n2_b")))


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """`stage, n_rows`: rows left after each condition in turn, counted in one pass over `df`.

    `counted_stages` gives the same numbers in passing, inside a job that does something else.
    """
    names = ["input", *stages]
    totals = df.agg(*_stage_totals(stages))
    rows = F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n_rows")) for n in names])
    return totals.select(F.inline(rows))


def counted_stages(df: DataFrame, stages: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows that meet all conditions, and a function that says how many were left after each.

    The counts are taken while the rows pass, by whatever job reads them first, such as the write of
    a cleaned table; there is no pass of their own. The function waits for that job. Give it a
    job that reads all rows once: with a limit, or with rows read again, the numbers mean just that.
    """
    seen = Observation()
    kept = df.observe(seen, *_stage_totals(stages))
    for condition in stages.values():
        kept = kept.filter(condition)
    return kept, lambda: {stage: int(seen.get[stage]) for stage in ["input", *stages]}


def _stage_totals(stages: Mapping[str, Column]) -> list[Column]:
    passed = [F.lit(True)]
    for condition in stages.values():
        passed.append(passed[-1] & F.coalesce(condition, F.lit(False)))
    return [F.count_if(c).alias(n) for n, c in zip(["input", *stages], passed, strict=True)]


def union_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`stage, n_rows` of several tables."""
    counts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("stage"), "n_rows")
              for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)
