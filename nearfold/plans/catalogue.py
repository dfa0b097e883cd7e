"""From dumps to the merged content table.

Every step is a function from DataFrames to a DataFrame. Where the usual hand-written job for these
dumps differs from what it is meant to do, the meaning is built and the difference is noted:

* flags are compared as numbers, never as text with a number;
* packed person lists are split before they are matched with person ids;
* batch person keys are those of the crew that are not stored yet;
* keys that were tried once are remembered, so rows that fail cleaning do not come up for ever;
* stored rows are unique per key, so merges cannot multiply rows;
* the year, type and adult limits are parameters, unlimited in batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.fixed import RUNTIME_EDGES, RUNTIME_REJECTS, YEAR_EDGES
from nearfold.functions.numbers import bin_right_closed, cast_trunc
from nearfold.operators.filters import dropna_any, dropna_subset, reject_list
from nearfold.operators.joins import anti_keys, merge_on_key, semi_keys
from nearfold.operators.keys import distinct_keys, one_per_key, packed_keys, unseen_batch
from nearfold.schemas import CONTENT, CREW, NAMES, RATINGS, TITLES

NUMBER_COLUMNS = ["startYear", "runtimeMinutes", "isAdult"]


def clean_rows(
    df: DataFrame,
    required: Sequence[str] = (),
    rejects: dict[str, Sequence[object]] | None = None,
    numbers: Sequence[str] = (),
    conditions: Sequence[Column] = (),
    classes: dict[str, tuple[str, Sequence[float]]] | None = None,
    drop: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Generic cleaning in one narrow pass, without a shuffle.

    Drop rows lacking a `required` value, drop rejected values, cast `numbers` from text to whole
    numbers (unreadable rows go; `strict` raises), keep rows meeting all `conditions`, and add class
    columns `{new: (source, edges)}`.
    """
    if required:
        df = dropna_subset(df, required)
    for col, values in (rejects or {}).items():
        df = reject_list(df, col, values)
    if numbers:
        df = df.withColumns({c: cast_trunc(F.col(c), strict) for c in numbers})
        df = dropna_subset(df, numbers)
    for condition in conditions:
        df = df.filter(condition)
    for new, (source, edges) in (classes or {}).items():
        df = df.withColumn(new, bin_right_closed(F.col(source), edges))
    return df.drop(*drop)


def clean_titles(
    raw: DataFrame,
    keys: DataFrame | None = None,
    year_below: int | None = None,
    title_type: str | None = None,
    adult: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Titles with runtime and year classes.

    First load: `year_below=1950, title_type="movie", adult=0`. Batch: `keys` only.
    """
    if keys is not None:
        raw = semi_keys(raw, keys, "tconst")
    conditions = []
    if year_below is not None:
        conditions.append(F.col("startYear") < year_below)
    if title_type is not None:
        conditions.append(F.col("titleType") == title_type)
    if adult is not None:
        conditions.append(F.col("isAdult") == adult)
    cleaned = clean_rows(
        raw,
        required=["startYear", "runtimeMinutes", "genres", "isAdult"],
        rejects={"runtimeMinutes": RUNTIME_REJECTS},
        numbers=NUMBER_COLUMNS,
        conditions=conditions,
        classes={
            "runtimeCategory": ("runtimeMinutes", RUNTIME_EDGES),
            "yearCategory": ("startYear", YEAR_EDGES),
        },
        drop=["isAdult"],
        strict=strict,
    )
    return cleaned.select(*TITLES.names)


def unreadable_titles(raw: DataFrame) -> DataFrame:
    """Rows that `clean_titles` drops because a number column holds other text."""
    known = reject_list(
        dropna_subset(raw, ["startYear", "runtimeMinutes", "genres", "isAdult"]),
        "runtimeMinutes",
        RUNTIME_REJECTS,
    )
    bad = F.lit(False)
    for c in NUMBER_COLUMNS:
        bad = bad | cast_trunc(F.col(c)).isNull()
    return known.filter(bad)


def wanted_titles(raw: DataFrame, title_type: str = "movie", adult: int = 0) -> DataFrame:
    """The raw rows of this type that are not adult; the flag counts as a number."""
    return raw.filter((F.col("titleType") == title_type) & (F.col("isAdult").try_cast("double") == adult))


def candidate_keys(
    raw: DataFrame,
    attempted: DataFrame,
    title_type: str = "movie",
    adult: int = 0,
    limit: int | None = None,
) -> DataFrame:
    """The keys to work on: of this type, not adult, never tried before; with `limit` so many of them."""
    return unseen_batch(wanted_titles(raw, title_type, adult), attempted, "tconst", limit)


def clean_crew(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Crew of the given titles, with the stored column names."""
    return semi_keys(renamed_crew(raw), keys, "tconst")


def renamed_crew(raw: DataFrame) -> DataFrame:
    """Crew under its stored column names."""
    renamed = raw.withColumnsRenamed({"directors": "directors_id", "writers": "writers_id"})
    return renamed.select(*CREW.names)


def clean_ratings(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Ratings of the given titles."""
    return semi_keys(raw, keys, "tconst").select(*RATINGS.names)


def person_keys(crew: DataFrame, stored_names: DataFrame | None = None) -> DataFrame:
    """Distinct persons of the crew; with `stored_names`, only those not stored yet."""
    keys = packed_keys(crew, ["directors_id", "writers_id"], "nconst")
    return keys if stored_names is None else anti_keys(keys, stored_names, "nconst")


def packed_cells(crew: DataFrame) -> DataFrame:
    """Distinct cells of both crew columns as they are (lists stay packed, null counts once)."""
    return distinct_keys(
        [crew.select(F.col(c).alias("nconst")) for c in ("directors_id", "writers_id")]
    )


def clean_names(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Names of the given persons."""
    return semi_keys(raw, keys, "nconst").select(*NAMES.names)


def merge_content(titles: DataFrame, crew: DataFrame, ratings: DataFrame) -> DataFrame:
    """The content table: titles with crew and ratings, without any null. Twelve columns."""
    return dropna_any(merge_on_key([titles, crew, ratings], "tconst")).select(*CONTENT.names)


def initial_load(
    titles: DataFrame, crew: DataFrame, ratings: DataFrame, names: DataFrame, **limits
) -> dict[str, DataFrame]:
    """All stored tables of a first load, as one lazy plan per table.

    A key delivered more than once in a dump is stored once, see `one_per_key`. The merge takes crew
    and ratings unfiltered: its inner joins select the same titles in one shuffle per table.
    """
    stored = one_per_key(clean_titles(titles, **limits), "tconst")
    crew, ratings, names = one_per_key(crew, "tconst"), one_per_key(ratings, "tconst"), one_per_key(names, "nconst")
    stored_crew = clean_crew(crew, stored)
    persons = person_keys(stored_crew)
    return {
        "titles": stored,
        "crew": stored_crew,
        "ratings": clean_ratings(ratings, stored),
        "person_keys": persons,
        "names": clean_names(names, persons),
        "content": merge_content(stored, renamed_crew(crew), ratings.select(*RATINGS.names)),
    }
