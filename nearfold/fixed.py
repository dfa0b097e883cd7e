"""These must equal the catalogue's conventions for right results."""

import string

# Null markers of the tab-separated dumps.
NULL_TOKENS = ["\\N", ""]

# Null markers that pandas' CSV reader knows by default, plus the ones added for these dumps.
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    "\\N", " nan", "  nan", "   nan",
]

# Genre names found in the runtime column of shifted rows.
RUNTIME_REJECTS = [
    "Reality-TV", "Talk-Show", "Documentary", "Game-Show",
    "Animation,Comedy,Family", "Game-Show,Reality-TV",
]

# Class edges; classes are closed on the right, labelled A, B, C, ...
RUNTIME_EDGES = [0, 10, 20, 30, 45, 60, 120, 150, 180, 9999]
YEAR_EDGES = [1850, 1900, 1930, 1950, 1960, 1970, 1980, 1990, 2000, 2010, 2020, 2030]
CLASS_LABELS = list(string.ascii_uppercase)
OUT_OF_RANGE_LABEL = "nan"

# Columns of the feature text, in this order, joined by one space.
FEATURE_COLUMNS = [
    "primaryTitle", "titleType", "genres", "runtimeCategory", "yearCategory",
    "directors_id", "writers_id",
]

# Sizes.
NEIGHBOURS = 10
CANDIDATE_BATCH = 100

# Address in front of a title id in a displayed link.
LINK_BASE = "https://www.imdb.com/title/"

# Text around a displayed recommendation.
SCORE_CAPTION = "Matching score : "
TITLE_CAPTION = " Movie : "
HEADING_CAPTION = "Recommandations for title : "
