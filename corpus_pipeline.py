"""The corpus pipeline: stages over the table `documents`, each written as Parquet and read again.

Every stage takes what the one before kept and returns the columns of `documents`; the last one
returns the packed sequences. Stages read `labels` and `benchmark` from the folder of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nearfold.llm import decontaminate, jaccard, packing, quality, suffix
from nearfold.llm.batches import id_remainder, table
from nearfold.session import freeze

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 4) != 2)
    return quality.accepted_documents(docs, quality.fit(docs, labels))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id."""
    return jaccard.one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without what repeats across them or within."""
    return suffix.without_repeats(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: pieces with their ids, sequence and place."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", keep_clean),
    ("best-fit packing", pack),
]

#: The stages score, link and pack by means that SQL lacks; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
