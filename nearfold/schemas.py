"""Schemas of the dumps and of the stored tables. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import types as T

from nearfold.fixed import NEIGHBOURS


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _WHOLE, _REAL = T.StringType(), T.LongType(), T.DoubleType()

# Dumps, read as text unless the file is purely numeric.
RAW_TITLES = _table(
    tconst=_TEXT, titleType=_TEXT, primaryTitle=_TEXT, originalTitle=_TEXT, isAdult=_TEXT,
    startYear=_TEXT, endYear=_TEXT, runtimeMinutes=_TEXT, genres=_TEXT,
)
RAW_CREW = _table(tconst=_TEXT, directors=_TEXT, writers=_TEXT)
RAW_RATINGS = _table(tconst=_TEXT, averageRating=_REAL, numVotes=_WHOLE)
RAW_NAMES = _table(
    nconst=_TEXT, primaryName=_TEXT, birthYear=_TEXT, deathYear=_TEXT,
    primaryProfession=_TEXT, knownForTitles=_TEXT,
)

# Stored tables.
TITLES = _table(
    tconst=_TEXT, titleType=_TEXT, primaryTitle=_TEXT, startYear=_WHOLE, runtimeMinutes=_WHOLE,
    genres=_TEXT, runtimeCategory=_TEXT, yearCategory=_TEXT,
)
CREW = _table(tconst=_TEXT, directors_id=_TEXT, writers_id=_TEXT)
RATINGS = RAW_RATINGS
NAMES = _table(nconst=_TEXT, primaryName=_TEXT)
CONTENT = T.StructType([*TITLES.fields, *CREW.fields[1:], *RATINGS.fields[1:]])
SCORES = T.StructType(
    [
        T.StructField("tconst", _TEXT),
        *[T.StructField(f"top{i}", _TEXT) for i in range(1, NEIGHBOURS + 1)],
        *[T.StructField(f"score{i}", _REAL) for i in range(1, NEIGHBOURS + 1)],
    ]
)
SCORE_ARRAYS = _table(tconst=_TEXT, titles=T.ArrayType(_TEXT), scores=T.ArrayType(_REAL))
