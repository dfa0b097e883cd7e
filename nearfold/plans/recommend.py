"""From the content table to stored and displayed recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from nearfold.fixed import FEATURE_COLUMNS, LINK_BASE, NEIGHBOURS
from nearfold.functions.text import combined_text
from nearfold.operators.reads import get_row
from nearfold.operators.rescoring import NeighbourState
from nearfold.operators.shapes import as_links, as_wide, wide_to_arrays
from nearfold.operators.topk import neighbour_lists


def features(df: DataFrame, id_col: str, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """`id, combined_features`; rows lacking one of the columns are left out."""
    text = combined_text(cols).alias("combined_features")
    return df.select(id_col, text).dropna(subset=["combined_features"])


def recommendations(
    content: DataFrame,
    id_col: str = "tconst",
    cols: Sequence[str] = FEATURE_COLUMNS,
    k: int = NEIGHBOURS,
    **options,
) -> DataFrame:
    """Neighbour lists of every title over the whole table."""
    return neighbour_lists(features(content, id_col, cols), id_col, "combined_features", k, **options)


def score_table(content: DataFrame, id_col: str = "tconst", **options) -> DataFrame:
    """The stored recommendation table: id, ten neighbours, ten scores."""
    k = options.get("k", NEIGHBOURS)
    return as_wide(recommendations(content, id_col, **options), k, id_col)


def score_state(spark: SparkSession, path: str, content: DataFrame, id_col: str = "tconst", k: int = NEIGHBOURS) -> NeighbourState:
    """The stored state of the recommendations of a growing content table."""
    return NeighbourState(spark, path, content.schema[id_col].dataType, k)


def rescore(state: NeighbourState, content: DataFrame, id_col: str = "tconst", cols: Sequence[str] = FEATURE_COLUMNS) -> None:
    """Take up the titles of `content` that are not scored yet; lists of others change where these fit in."""
    state.add(features(content, id_col, cols), id_col, "combined_features")


def state_table(state: NeighbourState, id_col: str = "tconst") -> DataFrame:
    """The recommendation table of a state: id, neighbours, scores, as `score_table` gives it."""
    return as_wide(state.neighbours(), state.k, id_col)


def title_info(content: DataFrame, key: object, id_col: str = "tconst") -> Row:
    """One title's content row; `KeyError` if unknown."""
    return get_row(content, id_col, key)


def reco_wide(scores: DataFrame, key: object, id_col: str = "tconst") -> Row:
    """One title's recommendations in wide form; `KeyError` if unknown."""
    return get_row(scores, id_col, key)


def reco_arrays(scores: DataFrame, key: object, id_col: str = "tconst") -> Row:
    """One title's recommendations as two arrays; `KeyError` if unknown."""
    return get_row(wide_to_arrays(scores, id_col), id_col, key)


def reco_links(
    scores: DataFrame, content: DataFrame, key: object, id_col: str = "tconst", base: str = LINK_BASE
) -> DataFrame:
    """One title's displayed recommendations, best first: rank, score with two places, link."""
    mine = wide_to_arrays(scores.filter(F.col(id_col) == F.lit(key)), id_col)
    links = as_links(mine, content, id_col, "primaryTitle", "startYear", "genres", base)
    return links.orderBy("rank")
