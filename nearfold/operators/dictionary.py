"""Terms with dense numbers, and texts as sparse rows over them.

Numbers run from 0 without gaps, in the order of the terms' bytes. They come from a range partitioning:
a term's number is its place in its range plus the terms of the ranges before, so no task sees all
terms. Terms that turn up later follow those that are there, which keep their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.operators.counts import token_counts
from nearfold.session import Steps, freeze

_PLACE = (1 << 33) - 1
# A broadcast of terms holds fewer than this.
FREQUENT = 1 << 16


def numbered_terms(terms: DataFrame, first: int = 0, ranges: int | None = None) -> DataFrame:
    """`number` for every row of `terms` (column `term`, each once), from `first` on.

    Other columns stay. There are as many `ranges` as shuffle partitions, if no number is given; one row
    for each goes to the driver.
    """
    spark = terms.sparkSession
    with Steps(spark) as steps:
        ranged = terms.repartitionByRange(ranges, "term") if ranges else terms.repartitionByRange("term")
        ordered = ranged.sortWithinPartitions("term")
        ordered = steps.freeze(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
        part = F.shiftright("at", 33).alias("part")
        sizes = ordered.groupBy(part).agg(F.count("*").alias("n")).orderBy("part").collect()
        bases, total = [], first
        for r in sizes:
            bases.append((r.part, total))
            total += r.n
        base = F.broadcast(spark.createDataFrame(bases, "part bigint, base bigint"))
        placed = ordered.withColumn("part", part).join(base, "part")
        number = F.col("base") + F.col("at").bitwiseAND(F.lit(_PLACE))
        return freeze(placed.select(*terms.columns, number.alias("number")), "terms")


def term_dictionary(counts: DataFrame) -> DataFrame:
    """`term, df, number` of postings `id, term, tf`: in how many rows a term occurs, and its number."""
    return numbered_terms(counts.groupBy("term").agg(F.count("*").alias("df")))


def more_terms(dictionary: DataFrame, counts: DataFrame, size: int | None = None) -> DataFrame:
    """`term, df, number` of the terms of new postings that the dictionary lacks; to be added to it.

    `size` is the number of terms in the whole dictionary, if only part of it is given.
    """
    new = counts.groupBy("term").agg(F.count("*").alias("df")).join(dictionary.select("term"), "term", "left_anti")
    if size is None:
        size = dictionary.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    return numbered_terms(new, size)


def sparse_postings(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Postings `id, ..., tf` with the term's `number` and `df` in place of the term.

    Terms in more than 1/`FREQUENT` of the postings, fewer than so many, are broadcast; in texts these are nearly
    all postings. Only the others are joined by shuffle. `counts` is read twice.
    """
    frequent = F.col("df") * FREQUENT > dictionary.agg(F.sum("df")).scalar()
    terms = dictionary.select("term", "df", "number")
    hot = F.broadcast(terms.filter(frequent))
    rest = counts.join(hot.select("term"), "term", "left_anti").join(terms.filter(~frequent), "term")
    return counts.join(hot, "term").unionByName(rest).drop("term")


def sparse_rows(df: DataFrame, id_col: str, text_col: str, min_len: int = 2) -> tuple[DataFrame, DataFrame]:
    """`id, numbers, tfs` of every text, ascending by number, and the dictionary `term, df, number`.

    A text without tokens has empty arrays. Ids must be unique. Both tables are written.
    """
    postings = freeze(token_counts(df, id_col, text_col, min_len), "postings")
    dictionary = term_dictionary(postings)
    rows = sparse_postings(postings, dictionary).groupBy(id_col)
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("number", "tf"))).alias("row"))
    none = F.array().cast("array<bigint>")
    every = df.select(id_col).join(rows, id_col, "left")
    return freeze(
        every.select(
            id_col, F.coalesce("row.number", none).alias("numbers"), F.coalesce("row.tf", none).alias("tfs")
        ),
        "sparse-rows",
    ), dictionary
