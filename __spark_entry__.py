"""Registered queries over the supplied tables, each with the SQL that must give the same rows.

The catalogue dumps are derived from the tables by Spark: `part` stands for titles, per-part
aggregates of `lineitem` for crew and ratings, `supplier` for persons, `documents` for long texts.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from nearfold import schemas  # noqa: E402
from nearfold.fixed import CANDIDATE_BATCH, RUNTIME_EDGES, YEAR_EDGES  # noqa: E402
from nearfold.functions.nulls import normalize_nulls  # noqa: E402
from nearfold.functions.numbers import bin_right_closed, cast_trunc  # noqa: E402
from nearfold.functions.text import combined_text  # noqa: E402
from nearfold.operators import counts, dictionary, filters, joins, keys, reads, shapes, topk  # noqa: E402
from nearfold.plans import catalogue, recommend  # noqa: E402
from nearfold.session import freeze, new_folder  # noqa: E402
from nearfold.sources import tables, tsv  # noqa: E402
from nearfold.sources.buckets import BucketTable  # noqa: E402
from nearfold.streaming import ingest  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def entry(spark: SparkSession) -> DataFrame:
    return reco_topk(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text"])


# --------------------------------------------------------------------------------------------------
# Dumps derived from the tables


def _raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand, size = F.col("p_brand"), F.col("p_size")
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("tt"), F.col("p_partkey")).alias("tconst"),
        F.when(F.col("p_type") == "PROMO", "short").otherwise("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        F.when(brand == "Brand#1", "1").otherwise("0").alias("isAdult"),
        F.when(size == 13, "\\N").otherwise((size + 1910).cast("string")).alias("startYear"),
        F.lit("\\N").alias("endYear"),
        F.when(brand == "Brand#2", "Talk-Show")
        .when(brand == "Brand#3", "unknown")
        .otherwise((F.col("p_retailprice") / 10).cast("string"))
        .alias("runtimeMinutes"),
        F.concat_ws(",", F.lower("p_type"), brand).alias("genres"),
    )


def _raw_crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = F.min("l_suppkey"), F.max("l_suppkey")
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(first.alias("first"), last.alias("last"))
        .select(
            F.concat(F.lit("tt"), "l_partkey").alias("tconst"),
            F.concat(F.lit("nm"), "first").alias("directors"),
            F.concat(F.lit("nm"), "first", F.lit(",nm"), "last").alias("writers"),
        )
    )


def _raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum("l_quantity").alias("total"), F.count("*").alias("numVotes"))
        .select(
            F.concat(F.lit("tt"), "l_partkey").alias("tconst"),
            (F.col("total") / F.col("numVotes")).alias("averageRating"),
            "numVotes",
        )
    )


def _raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("nm"), "s_suppkey").alias("nconst"),
        F.col("s_name").alias("primaryName"),
        F.lit(None).cast("string").alias("birthYear"),
        F.lit(None).cast("string").alias("deathYear"),
        F.lit("director,writer").alias("primaryProfession"),
        F.lit("").alias("knownForTitles"),
    )


def _initial(spark: SparkSession, sf_dir: str, year_below: int | None = None) -> dict[str, DataFrame]:
    return catalogue.initial_load(
        normalize_nulls(_raw_titles(spark, sf_dir)),
        _raw_crew(spark, sf_dir),
        _raw_ratings(spark, sf_dir),
        _raw_names(spark, sf_dir),
        year_below=year_below,
        title_type="movie",
        adult=0,
    )


def _case(value: str, edges: list[int]) -> str:
    """The class rule as SQL."""
    labels = "ABCDEFGHIJK"
    steps = " ".join(f"WHEN {value} <= {e} THEN '{labels[i]}'" for i, e in enumerate(edges[1:]))
    return f"CASE WHEN {value} < {edges[0]} THEN 'nan' {steps} ELSE 'nan' END"


def _titles_sql(conditions: str) -> str:
    return f"""
titles AS (
  SELECT tconst, titleType, primaryTitle, startYear, runtimeMinutes, genres,
         {_case('runtimeMinutes', RUNTIME_EDGES)} AS runtimeCategory,
         {_case('startYear', YEAR_EDGES)} AS yearCategory
  FROM (SELECT 'tt' || p_partkey AS tconst,
               CASE WHEN p_type = 'PROMO' THEN 'short' ELSE 'movie' END AS titleType,
               p_name AS primaryTitle, CAST(p_size + 1910 AS BIGINT) AS startYear,
               CAST(trunc(p_retailprice / 10) AS BIGINT) AS runtimeMinutes,
               lower(p_type) || ',' || p_brand AS genres, p_brand
        FROM part WHERE p_size <> 13 AND p_brand NOT IN ('Brand#2', 'Brand#3'))
  WHERE {conditions}),
crew AS (
  SELECT 'tt' || l_partkey AS tconst, 'nm' || min(l_suppkey) AS directors_id,
         'nm' || min(l_suppkey) || ',nm' || max(l_suppkey) AS writers_id
  FROM lineitem GROUP BY l_partkey),
ratings AS (
  SELECT 'tt' || l_partkey AS tconst, sum(l_quantity) / count(*) AS averageRating,
         count(*) AS numVotes
  FROM lineitem GROUP BY l_partkey),
content AS (
  SELECT t.*, directors_id, writers_id, averageRating, numVotes
  FROM titles t JOIN crew USING (tconst) JOIN ratings USING (tconst))"""


_FIRST_LOAD = "startYear < 1950 AND titleType = 'movie' AND p_brand <> 'Brand#1'"
_BATCHES = "titleType = 'movie' AND p_brand <> 'Brand#1'"

# --------------------------------------------------------------------------------------------------
# Scans, filters, casts, classes


@query("SELECT p_partkey, p_name, p_type, p_size FROM part")
def scan_project(spark, sf_dir):
    return tables.scan(spark, f"{sf_dir}/part.parquet", ["p_partkey", "p_name", "p_type", "p_size"])


_NULLED = """SELECT event_id, user_id,
  CASE WHEN event_type IN ('error') THEN NULL ELSE event_type END AS event_type, value, props
FROM events"""


def _nulled_events(spark, sf_dir, cols=("event_type",), tokens=("error",)):
    events = _table(spark, sf_dir, "events")
    return normalize_nulls(
        events.select("event_id", "user_id", "event_type", "value", "props"), cols, tokens
    )


@query(_NULLED)
def normalize_null_tokens(spark, sf_dir):
    return _nulled_events(spark, sf_dir)


@query(f"SELECT * FROM ({_NULLED}) WHERE event_type IS NOT NULL")
def dropna_subset(spark, sf_dir):
    return filters.dropna_subset(_nulled_events(spark, sf_dir), ["event_type"])


@query(
    """SELECT event_id, user_id, event_type, value, props FROM events
WHERE event_type NOT IN ('error', '{"k": 69}') AND props NOT IN ('error', '{"k": 69}')"""
)
def dropna_any(spark, sf_dir):
    return filters.dropna_any(
        _nulled_events(spark, sf_dir, ["event_type", "props"], ["error", '{"k": 69}'])
    )


@query("SELECT p_partkey, p_type FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')")
def reject_list(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return filters.reject_list(part, "p_type", ["PROMO", "SMALL"])


@query(
    "SELECT o_orderkey, CAST(trunc(-o_totalprice) AS BIGINT) AS whole FROM orders"
)
def cast_truncated(spark, sf_dir):
    text = (-F.col("o_totalprice")).cast("string")
    return _table(spark, sf_dir, "orders").select("o_orderkey", cast_trunc(text).alias("whole"))


_ORDER_YEARS = [1995, 1996, 1998, 2000]


@query(
    f"SELECT o_orderkey, {_case('year(o_orderdate)', _ORDER_YEARS)} AS year_class FROM orders"
)
def bin_classes(spark, sf_dir):
    label = bin_right_closed(F.year("o_orderdate"), _ORDER_YEARS)
    return _table(spark, sf_dir, "orders").select("o_orderkey", label.alias("year_class"))


def _order_rows(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.year("o_orderdate").cast("string").alias("start_year"),
        (F.col("o_totalprice") / 1000).cast("string").alias("minutes"),
    )


@query(
    f"""SELECT o_orderkey, start_year, minutes, {_case('minutes', RUNTIME_EDGES)} AS runtime_class,
  {_case('start_year', _ORDER_YEARS)} AS year_class
FROM (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS start_year,
             CAST(trunc(o_totalprice / 1000) AS BIGINT) AS minutes FROM orders)
WHERE o_orderstatus = 'O' AND start_year < 2000"""
)
def clean_basics(spark, sf_dir):
    return catalogue.clean_rows(
        _order_rows(spark, sf_dir),
        required=["start_year", "minutes"],
        rejects={"minutes": ["Reality-TV"]},
        numbers=["start_year", "minutes"],
        conditions=[F.col("o_orderstatus") == "O", F.col("start_year") < 2000],
        classes={
            "runtime_class": ("minutes", RUNTIME_EDGES),
            "year_class": ("start_year", _ORDER_YEARS),
        },
        drop=["o_orderstatus"],
    )


@query(
    """SELECT 'input' AS stage, count(*) AS n_rows FROM orders
UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'year', count(*) FROM orders WHERE o_orderstatus = 'O' AND year(o_orderdate) < 2000"""
)
def stage_counts(spark, sf_dir):
    return counts.stage_counts(
        _order_rows(spark, sf_dir),
        {
            "status": F.col("o_orderstatus") == "O",
            "year": cast_trunc(F.col("start_year")) < 2000,
        },
    )


@query(
    """SELECT 'input' AS stage, count(*) AS n_rows FROM orders
UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'year', count(*) FROM orders WHERE o_orderstatus = 'O' AND year(o_orderdate) < 2000"""
)
def observed_counts(spark, sf_dir):
    """The counts of `stage_counts`, taken while the cleaned rows are written."""
    conditions = {"status": F.col("o_orderstatus") == "O", "year": cast_trunc(F.col("start_year")) < 2000}
    kept, left = counts.counted_stages(_order_rows(spark, sf_dir), conditions)
    freeze(kept, "cleaned")
    return spark.createDataFrame(list(left().items()), "stage string, n_rows bigint")


@query(
    """SELECT 'names' AS stage, count(*) AS n_rows FROM supplier
UNION ALL SELECT 'titles', count(*) FROM part
UNION ALL SELECT 'lines', count(*) FROM lineitem"""
)
def table_counts(spark, sf_dir):
    names = {"names": "supplier", "titles": "part", "lines": "lineitem"}
    return counts.union_counts({k: _table(spark, sf_dir, t) for k, t in names.items()})


# --------------------------------------------------------------------------------------------------
# Joins and key sets


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 10)"""
)
def semi_keys(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    small = _table(spark, sf_dir, "part").filter("p_size < 10")
    return joins.semi_keys(lines, small.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


_UNSEEN = "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


@query(_UNSEEN)
def anti_keys(spark, sf_dir):
    return keys.unseen_batch(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), "doc_id"
    )


@query(f"{_UNSEEN} ORDER BY doc_id LIMIT {CANDIDATE_BATCH}")
def candidate_batch(spark, sf_dir):
    """One work batch: its size is the feature."""
    return keys.unseen_batch(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "labels"),
        "doc_id",
        CANDIDATE_BATCH,
    )


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def distinct_keys(spark, sf_dir):
    return keys.distinct_keys(
        [
            _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")),
            _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey")),
        ]
    )


@query(
    f"WITH {_titles_sql(_BATCHES)}, stored AS (SELECT crew.* FROM crew SEMI JOIN titles USING (tconst))"
    " SELECT directors_id AS nconst FROM stored UNION SELECT writers_id FROM stored"
)
def packed_cells(spark, sf_dir):
    return catalogue.packed_cells(_initial(spark, sf_dir)["crew"])


_PERSONS_SQL = f"""WITH {_titles_sql(_BATCHES)},
stored AS (SELECT crew.* FROM crew SEMI JOIN titles USING (tconst)),
persons AS (SELECT DISTINCT unnest(string_split(cell, ',')) AS nconst
            FROM (SELECT directors_id AS cell FROM stored UNION ALL SELECT writers_id FROM stored))"""


@query(f"{_PERSONS_SQL} SELECT nconst FROM persons")
def person_keys(spark, sf_dir):
    return _initial(spark, sf_dir)["person_keys"]


@query(
    f"""{_PERSONS_SQL} SELECT nconst, s_name AS primaryName
FROM persons JOIN supplier ON nconst = 'nm' || s_suppkey"""
)
def person_names(spark, sf_dir):
    return _initial(spark, sf_dir)["names"]


@query(f"WITH {_titles_sql(_FIRST_LOAD)} SELECT * FROM titles")
def clean_titles(spark, sf_dir):
    """The first load of one period: the limit is the feature."""
    return _initial(spark, sf_dir, year_below=1950)["titles"]


@query("SELECT 'tt' || p_partkey AS tconst FROM part WHERE p_brand = 'Brand#3' AND p_size <> 13")
def unreadable_titles(spark, sf_dir):
    raw = normalize_nulls(_raw_titles(spark, sf_dir))
    return catalogue.unreadable_titles(raw).select("tconst")


@query(f"WITH {_titles_sql(_BATCHES)} SELECT crew.* FROM crew SEMI JOIN titles USING (tconst)")
def title_crew(spark, sf_dir):
    return _initial(spark, sf_dir)["crew"]


@query(
    f"WITH {_titles_sql(_BATCHES)} SELECT ratings.* FROM ratings SEMI JOIN titles USING (tconst)"
)
def title_ratings(spark, sf_dir):
    return _initial(spark, sf_dir)["ratings"]


@query(f"WITH {_titles_sql(_BATCHES)} SELECT * FROM content")
def merge_content(spark, sf_dir):
    return _initial(spark, sf_dir)["content"]


def _doc_state(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    stored = joins.semi_keys(docs, _table(spark, sf_dir, "labels"), "doc_id")
    return stored.withColumn("state", F.lit("stored")), docs.withColumn("state", F.lit("new"))


_UPSERT = """SELECT doc_id, lang, n_chars,
  CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'stored' ELSE 'new' END AS state
FROM documents d"""


@query(_UPSERT)
def incremental_upsert(spark, sf_dir):
    stored, batch = _doc_state(spark, sf_dir)
    return keys.upsert(stored, batch, "doc_id")


@query(
    """SELECT doc_id, lang, n_chars, CASE WHEN lang = 'en' THEN 'new' ELSE 'stored' END AS state FROM documents d
WHERE lang = 'en' OR EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
)
def incremental_refresh(spark, sf_dir):
    """The batch holds some stored keys and some new ones; others are stored only."""
    stored, batch = _doc_state(spark, sf_dir)
    return keys.upsert(stored, batch.filter("lang = 'en'"), "doc_id", refresh=True)


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def latest_per_key(spark, sf_dir):
    """One row per user, the newest; equal times go to the greater event."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return keys.one_per_key(events, "user_id", "ts").select("user_id", "ts", "event_id")


# --------------------------------------------------------------------------------------------------
# Text and counts


@query("SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS combined_features FROM part")
def combined_features(spark, sf_dir):
    return recommend.features(
        _table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_type", "p_brand"]
    )


def _post_sql(key: str, text: str, table: str) -> str:
    return rf"""SELECT {key}, term, count(*) AS tf
FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {table})
GROUP BY {key}, term"""


_DOC_POST = _post_sql("doc_id", "text", "documents")


@query(_DOC_POST)
def token_counts(spark, sf_dir):
    return counts.token_counts(_documents(spark, sf_dir), "doc_id", "text")


@query(
    f"""SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf
FROM ({_DOC_POST}) GROUP BY term"""
)
def vocabulary(spark, sf_dir):
    return counts.vocabulary(_documents(spark, sf_dir), "doc_id", "text")


@query(
    f"""SELECT (SELECT count(*) FROM documents) AS n_rows,
  (SELECT count(DISTINCT term) FROM ({_DOC_POST})) AS n_terms"""
)
def matrix_shape(spark, sf_dir):
    return counts.matrix_shape(_documents(spark, sf_dir), "doc_id", "text")


@query(
    f"""WITH post AS ({_DOC_POST}), terms AS (SELECT DISTINCT term FROM post),
numbered AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS number FROM terms)
SELECT d.doc_id, coalesce(string_agg(number || ':' || tf, ' ' ORDER BY number), '') AS entries
FROM documents d LEFT JOIN (SELECT * FROM post JOIN numbered USING (term)) p ON p.doc_id = d.doc_id GROUP BY d.doc_id"""
)
def sparse_rows(spark, sf_dir):
    """Texts as rows of a sparse matrix over numbered terms, entries shown as text."""
    rows, _ = dictionary.sparse_rows(_documents(spark, sf_dir), "doc_id", "text")
    entry = F.transform(F.arrays_zip("numbers", "tfs"), lambda e: F.concat_ws(":", e["numbers"], e["tfs"]))
    return rows.select("doc_id", F.array_join(entry, " ").alias("entries"))


@query(
    f"""SELECT d.doc_id, coalesce(CAST(sum(tf * tf) AS BIGINT), 0) AS n2
FROM documents d LEFT JOIN ({_DOC_POST}) p ON p.doc_id = d.doc_id GROUP BY d.doc_id"""
)
def doc_norms(spark, sf_dir):
    return counts.doc_norms(_documents(spark, sf_dir), "doc_id", "text")


@query(
    f"""WITH post AS ({_post_sql('conv_id, turn', 'text', 'conversations')}),
n AS (SELECT conv_id, turn, CAST(sum(tf * tf) AS BIGINT) AS n2 FROM post GROUP BY ALL),
p AS (SELECT a.conv_id, a.turn, CAST(sum(a.tf * b.tf) AS BIGINT) AS dot
      FROM post a JOIN post b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.term = a.term
      GROUP BY ALL),
v AS (SELECT a.conv_id, a.turn, coalesce(p.dot, 0) AS dot, coalesce(x.n2, 0) AS n2_a,
             coalesce(y.n2, 0) AS n2_b
      FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
      LEFT JOIN p ON p.conv_id = a.conv_id AND p.turn = a.turn
      LEFT JOIN n x ON x.conv_id = a.conv_id AND x.turn = a.turn
      LEFT JOIN n y ON y.conv_id = b.conv_id AND y.turn = b.turn)
SELECT *, CASE WHEN n2_a > 0 AND n2_b > 0
               THEN CAST(dot AS DOUBLE) / sqrt(CAST(n2_a * n2_b AS DOUBLE)) ELSE 0.0 END AS score
FROM v"""
)
def cosine_pairs(spark, sf_dir):
    """Score of each turn with the next one; the join keys are unique on both sides."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    pairs = turns.join(following, ["conv_id", "turn"])
    return counts.pair_scores(pairs, "text", "next").drop("text", "next")


# --------------------------------------------------------------------------------------------------
# Neighbours


def _topk_sql(corpus: str) -> str:
    """All pairs, brute force. `corpus` gives `id, text`."""
    return f"""WITH {corpus},
post AS ({_post_sql('id', 'text', 'corpus')}),
n AS (SELECT id, CAST(sum(tf * tf) AS BIGINT) AS n2 FROM post GROUP BY id),
p AS (SELECT a.id AS t, b.id AS o, CAST(sum(a.tf * b.tf) AS BIGINT) AS dot
      FROM post a JOIN post b ON a.term = b.term WHERE a.id <> b.id GROUP BY a.id, b.id),
s AS (SELECT x.id AS t, y.id AS o,
             coalesce(CAST(p.dot AS DOUBLE) / sqrt(CAST(nx.n2 * ny.n2 AS DOUBLE)), 0.0) AS score
      FROM corpus x JOIN corpus y ON x.id <> y.id
      LEFT JOIN p ON p.t = x.id AND p.o = y.id
      LEFT JOIN n nx ON nx.id = x.id LEFT JOIN n ny ON ny.id = y.id),
reco AS (SELECT t AS target_id, CAST(rk AS INTEGER) AS rank, o AS other_id, score
         FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY score DESC, o) AS rk FROM s)
         WHERE rk <= 10)"""


_PART_CORPUS = (
    "corpus AS (SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand AS text FROM part)"
)


def _wide_sql(key: str) -> str:
    columns = [f"max(CASE WHEN rank = {i} THEN other_id END) AS top{i}" for i in range(1, 11)]
    columns += [f"max(CASE WHEN rank = {i} THEN score END) AS score{i}" for i in range(1, 11)]
    return f"SELECT target_id AS {key}, {', '.join(columns)} FROM reco GROUP BY target_id"


def _part_lists(spark, sf_dir):
    return recommend.recommendations(
        _table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_type", "p_brand"]
    )


@query(f"{_topk_sql(_PART_CORPUS)} SELECT * FROM reco")
def reco_topk(spark, sf_dir):
    return shapes.as_long(_part_lists(spark, sf_dir))


@query(f"{_topk_sql('corpus AS (SELECT doc_id AS id, text FROM documents)')} SELECT * FROM reco")
def reco_topk_text(spark, sf_dir):
    return topk.cosine_topk(_documents(spark, sf_dir), "doc_id", "text")


@query(f"{_topk_sql(_PART_CORPUS)} SELECT * FROM reco WHERE target_id IN (1, 7, 50)")
def reco_chosen(spark, sf_dir):
    """A few titles against the whole corpus, which is not ranked for it."""
    features = recommend.features(_table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_type", "p_brand"])
    return shapes.as_long(topk.neighbours_of(features, "p_partkey", "combined_features", [1, 7, 50]))


@query(f"{_topk_sql(_PART_CORPUS)} {_wide_sql('target_id')}")
def reco_wide(spark, sf_dir):
    return shapes.as_wide(_part_lists(spark, sf_dir))


@query(
    f"""{_topk_sql(_PART_CORPUS)} SELECT target_id, count(*) AS n,
  string_agg(CAST(other_id AS VARCHAR), ',' ORDER BY rank) AS titles,
  string_agg(CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY rank) AS millionths
FROM reco GROUP BY target_id"""
)
def reco_array(spark, sf_dir):
    """The array form; the arrays are shown as text so that any two engines print them alike."""
    arrays = shapes.as_arrays(_part_lists(spark, sf_dir))
    millionths = F.transform("scores", lambda s: F.round(s * 1000000).cast("bigint").cast("string"))
    return arrays.select(
        "target_id",
        F.size("titles").cast("bigint").alias("n"),
        F.array_join(F.col("titles").cast("array<string>"), ",").alias("titles"),
        F.array_join(millionths, ",").alias("millionths"),
    )


@query(
    f"""{_topk_sql(_PART_CORPUS)}, shown AS (
  SELECT target_id AS p_partkey, rank, other_id, round_even(score * 100, 0) / 100 AS score_2dp,
         '[' || p_name || ', ' || p_size || ' (' || p_type || ')](https://www.imdb.com/title/' || other_id || ')' AS link
  FROM reco JOIN part ON part.p_partkey = other_id)
SELECT *, 'Matching score : ' || score_2dp || ' Movie : ' || link AS line FROM shown
UNION ALL
SELECT p_partkey, 0, p_partkey, NULL, link, 'Recommandations for title : ' || link
FROM (SELECT p_partkey, '[' || p_name || ', ' || p_size || ' (' || p_type || ')](https://www.imdb.com/title/'
             || p_partkey || ')' AS link FROM part)"""
)
def reco_links(spark, sf_dir):
    arrays = shapes.as_arrays(_part_lists(spark, sf_dir), "p_partkey")
    part = _table(spark, sf_dir, "part")
    return shapes.as_links(arrays, part, "p_partkey", "p_name", "p_size", "p_type")


_CONTENT_CORPUS = f"""{_titles_sql(_BATCHES)},
corpus AS (
  SELECT tconst AS id, primaryTitle || ' ' || titleType || ' ' || genres || ' ' || runtimeCategory
         || ' ' || yearCategory || ' ' || directors_id || ' ' || writers_id AS text FROM content)"""


@query(f"{_topk_sql(_CONTENT_CORPUS)} {_wide_sql('tconst')}")
def content_scores(spark, sf_dir):
    """Dumps to stored score table: cleaning, crew, ratings, merge, feature text, neighbours."""
    content = freeze(_initial(spark, sf_dir)["content"], "content")
    return recommend.score_table(content)


@query(f"{_topk_sql(_PART_CORPUS)} SELECT * FROM reco")
def rescore_batch(spark, sf_dir):
    """Neighbours of a first load, and of two batches after it that are scored against what is there."""
    part, state, names = _table(spark, sf_dir, "part"), None, ["p_name", "p_type", "p_brand"]
    for digits in ((0, 1, 2, 3, 4, 5, 6), (7, 8), (9,)):
        rows = part.filter((F.col("p_partkey") % 10).isin(*digits))
        state = state or recommend.score_state(spark, new_folder(spark, "scores"), rows, "p_partkey")
        recommend.rescore(state, rows, "p_partkey", names)
    return shapes.as_long(state.neighbours())


@query(f"{_topk_sql(_CONTENT_CORPUS)} {_wide_sql('tconst')}")
def rescored_content(spark, sf_dir):
    """The score table of a content table that grows by a batch."""
    content = freeze(_initial(spark, sf_dir)["content"], "content")
    state = recommend.score_state(spark, new_folder(spark, "scores"), content)
    recommend.rescore(state, content.filter("startYear < 1950"))
    recommend.rescore(state, content)
    return recommend.state_table(state)


# --------------------------------------------------------------------------------------------------
# Reads


@query("SELECT * FROM part WHERE p_partkey = 7")
def row_lookup(spark, sf_dir):
    return reads.row_lookup(_table(spark, sf_dir, "part"), "p_partkey", 7)


@query("SELECT * FROM nation WHERE lower(n_name) = 'nation_7'")
def row_lookup_collated(spark, sf_dir):
    """A lookup by text in which case and accents do not count."""
    return reads.row_lookup(_table(spark, sf_dir, "nation"), "n_name", "NÂTION_7", "UNICODE_CI_AI")


@query("SELECT * FROM part ORDER BY p_partkey LIMIT 20")
def rows_list(spark, sf_dir):
    return reads.rows_list(_table(spark, sf_dir, "part"), "p_partkey", 20)


@query(
    """SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"'
  || o_orderstatus || '","o_totalprice":' || o_totalprice || ',"o_orderdate":"'
  || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '","o_orderpriority":"' || o_orderpriority || '"}' AS json
FROM orders"""
)
def to_json_records(spark, sf_dir):
    return reads.to_json_records(_table(spark, sf_dir, "orders"))


# --------------------------------------------------------------------------------------------------
# Files and streams


def _write_dump(df: DataFrame, path: str) -> None:
    (
        df.write.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("compression", "gzip")
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .csv(path)
    )


@query(
    """SELECT 'tt' || p_partkey AS tconst,
  CASE WHEN p_type = 'PROMO' THEN 'short' ELSE 'movie' END AS titleType, p_name AS primaryTitle,
  CASE WHEN p_size <> 13 THEN CAST(p_size + 1910 AS VARCHAR) END AS startYear
FROM part"""
)
def tsv_scan(spark, sf_dir):
    path = new_folder(spark, "dump")
    _write_dump(_raw_titles(spark, sf_dir), path)
    columns = ["tconst", "titleType", "primaryTitle", "startYear"]
    return tsv.read_tsv(spark, path, schemas.RAW_TITLES, columns)


@query(f"WITH {_titles_sql(_BATCHES)} SELECT * FROM ratings")
def normalise_file(spark, sf_dir):
    path = new_folder(spark, "dump")
    _write_dump(_raw_ratings(spark, sf_dir), path)
    return tsv.normalise_file(spark, path, schemas.RAW_RATINGS, new_folder(spark, "ratings"))


@query(
    """SELECT 'tt' || l_partkey AS tconst, 'nm' || min(l_suppkey) AS directors,
  'nm' || min(l_suppkey) || ',nm' || max(l_suppkey) AS writers FROM lineitem GROUP BY l_partkey"""
)
def crew_file(spark, sf_dir):
    path = new_folder(spark, "dump")
    _write_dump(_raw_crew(spark, sf_dir), path)
    return tsv.normalise_file(spark, path, schemas.RAW_CREW, new_folder(spark, "crew"))


@query("SELECT 'nm' || s_suppkey AS nconst, s_name AS primaryName FROM supplier")
def names_file(spark, sf_dir):
    path = new_folder(spark, "dump")
    _write_dump(_raw_names(spark, sf_dir), path)
    return tsv.read_tsv(spark, path, schemas.RAW_NAMES, ["nconst", "primaryName"])


@query(
    r"""SELECT 'tt' || p_partkey AS tconst, CASE WHEN p_type = 'PROMO' THEN 'short' ELSE 'movie' END AS titleType,
  CASE WHEN p_brand = 'Brand#1' THEN '1' ELSE '0' END AS isAdult,
  CASE WHEN p_size = 13 THEN '\N' ELSE CAST(p_size + 1910 AS VARCHAR) END AS startYear FROM part"""
)
def candidate_scan(spark, sf_dir):
    """The scan for candidates, whose null markers stay text."""
    path = new_folder(spark, "dump")
    _write_dump(_raw_titles(spark, sf_dir), path)
    columns = ["tconst", "titleType", "isAdult", "startYear"]
    return tsv.read_tsv(spark, path, schemas.RAW_TITLES, columns, null_tokens=[])


@query("SELECT * REPLACE (p_size + 1 AS p_size) FROM part WHERE p_size > 10")
def table_replace(spark, sf_dir):
    """A table overwritten by rows computed from itself."""
    path = new_folder(spark, "versions")
    tables.replace(_table(spark, sf_dir, "part"), path)
    older = tables.read_current(spark, path).filter("p_size > 10")
    tables.replace(older.withColumn("p_size", (F.col("p_size") + 1).cast("int")), path)
    return tables.read_current(spark, path)


@query(f"{_topk_sql(_PART_CORPUS)} {_wide_sql('p_partkey').replace(' FROM reco', ' FROM reco WHERE target_id = 7')}")
def score_lookup(spark, sf_dir):
    """The score table stored, put in place of an older one, and read by key."""
    path = new_folder(spark, "scores")
    scores = shapes.as_wide(_part_lists(spark, sf_dir), id_name="p_partkey")
    tables.replace(scores.limit(0), path)
    tables.replace(scores, path)
    return reads.row_lookup(tables.read_current(spark, path), "p_partkey", 7)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_export(spark, sf_dir):
    suppliers = _table(spark, sf_dir, "supplier")
    path = new_folder(spark, "export")
    tsv.write_csv(suppliers, path)
    return tsv.read_csv(spark, path, suppliers.schema)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark, sf_dir):
    """Events arrive as a file stream and are stored once per key; a second run adds nothing."""
    schema = _table(spark, sf_dir, "events").schema
    store, checkpoint = new_folder(spark, "events"), new_folder(spark, "progress")
    for _ in range(2):
        arriving = (
            spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        )
        ingest.upsert_stream(arriving, store, "event_id", checkpoint)
    return ingest.stored_rows(spark, store, schema, "event_id")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_dedup(spark, sf_dir):
    """Events delivered twice, each time to a stream that starts again and knows the keys it has seen."""
    events = _table(spark, sf_dir, "events")
    landing, store, progress = (new_folder(spark, n) for n in ("landing", "events", "progress"))
    for _ in range(2):
        events.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(events.schema).parquet(landing)
        ingest.dedup_stream(arriving, store, "event_id", progress)
    return spark.read.schema(events.schema).parquet(store)


_CORRECTED = "SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN value + 1 ELSE value END AS value) FROM events"


def _corrected_events(spark, sf_dir):
    """Events stored in ten batches, and an eleventh one with corrections."""
    events = _table(spark, sf_dir, "events")
    store = BucketTable(spark, new_folder(spark, "events"), events.schema, "event_id")
    for batch in range(10):
        store.append(events.filter(F.col("event_id") % 10 == batch), batch)
    store.append(events.filter("user_id % 7 = 0").withColumn("value", F.col("value") + 1), 10)
    return store


@query(_CORRECTED)
def compacted_store(spark, sf_dir):
    """Eleven batches merged to one folder, the newest row of each key kept."""
    store = _corrected_events(spark, sf_dir)
    store.merge(only_latest=True)
    return store.read()


@query(f"SELECT event_id, value + 1 AS value FROM ({_CORRECTED}) WHERE user_id % 5 = 0")
def changed_rows(spark, sf_dir):
    """What a delivery changes, found by key and fingerprint: most of its rows are stored as they come."""
    store = _corrected_events(spark, sf_dir)
    delivered = store.latest().withColumn(
        "value", F.when(F.col("user_id") % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))
    )
    return store.changed(delivered).select("event_id", "value")


@query(f"WITH {_titles_sql(_BATCHES)} SELECT * FROM content")
def title_stream(spark, sf_dir):
    """Dated drops of titles, taken up by one stream in two runs, through the catalogue chain."""
    landing, store = new_folder(spark, "landing"), new_folder(spark, "store")
    progress = new_folder(spark, "progress")
    titles = _raw_titles(spark, sf_dir)
    crew, ratings = freeze(_raw_crew(spark, sf_dir), "crew"), freeze(_raw_ratings(spark, sf_dir), "ratings")
    names = _raw_names(spark, sf_dir)
    # The first drop brings some of the titles, the second one all of them.
    days = {"2024-01-01": titles.filter(F.col("genres").startswith("economy")), "2024-01-02": titles}
    for day, delivered in days.items():
        _write_dump(delivered, f"{landing}/{day}")
        arriving = ingest.drops(spark, landing, schemas.RAW_TITLES, files_per_trigger=1000)
        ingest.title_stream(arriving, store, progress, lambda: (crew, ratings, names))
    return ingest.stored(spark, store, "content")


@query(f"WITH {_titles_sql(_BATCHES)} SELECT * FROM content")
def title_batch(spark, sf_dir):
    """All unseen titles as one scheduled batch, then the same dump again, which adds nothing."""
    store = new_folder(spark, "store")
    raw = normalize_nulls(_raw_titles(spark, sf_dir))
    sides = (_raw_crew(spark, sf_dir), _raw_ratings(spark, sf_dir), _raw_names(spark, sf_dir))
    for _ in range(2):
        ingest.run_batch(spark, store, raw, *sides)
    return ingest.stored(spark, store, "content")


def _one_batch(spark, sf_dir, table):
    store = new_folder(spark, "store")
    raw = normalize_nulls(_raw_titles(spark, sf_dir))
    sides = (_raw_crew(spark, sf_dir), _raw_ratings(spark, sf_dir), _raw_names(spark, sf_dir))
    ingest.run_batch(spark, store, raw, *sides)
    return ingest.stored(spark, store, table)


@query(f"{_PERSONS_SQL} SELECT nconst, s_name AS primaryName FROM persons JOIN supplier ON nconst = 'nm' || s_suppkey")
def batch_names(spark, sf_dir):
    """Names that a batch stores."""
    return _one_batch(spark, sf_dir, "names")


@query("SELECT 'tt' || p_partkey AS tconst FROM part WHERE p_type <> 'PROMO' AND p_brand <> 'Brand#1'")
def batch_attempted(spark, sf_dir):
    """Keys that a batch marks as tried, whether they pass cleaning or not."""
    return _one_batch(spark, sf_dir, "attempted")


@query(f"WITH {_titles_sql(_BATCHES)} SELECT * FROM content")
def title_refresh(spark, sf_dir):
    """A first delivery with old ratings and without some of the crew, then the full one."""
    store = new_folder(spark, "store")
    raw = normalize_nulls(_raw_titles(spark, sf_dir))
    # Read several times in each batch, so made from the lines only once.
    crew, ratings = freeze(_raw_crew(spark, sf_dir), "crew"), freeze(_raw_ratings(spark, sf_dir), "ratings")
    names = _raw_names(spark, sf_dir)
    early = ratings.withColumn("numVotes", F.col("numVotes") - 1)
    ingest.run_batch(spark, store, raw, crew.filter(~F.col("tconst").endswith("3")), early, names)
    ingest.run_batch(spark, store, raw, crew, ratings, names, refresh=True)
    return ingest.current(spark, store, "content")


# --------------------------------------------------------------------------------------------------
# Training-data operators, where their package is there

try:
    from corpus_pipeline import ORACLE_SQL, run
    from nearfold.llm.queries import ORACLE as LLM_ORACLE
    from nearfold.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "nearfold.llm", "nearfold.llm.queries"):
        raise
else:
    QUERIES.update(LLM_QUERIES, pipeline=run)
    ORACLE.update(LLM_ORACLE)
    if ORACLE_SQL is not None:
        ORACLE["pipeline"] = ORACLE_SQL
