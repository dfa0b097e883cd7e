"""First load, batches and streams over hand-written dumps."""

import gzip

import pytest

from nearfold import schemas
from nearfold.functions.nulls import normalize_nulls
from nearfold.plans import catalogue, recommend
from nearfold.sources.tsv import read_tsv
from nearfold.streaming import ingest

TITLE = "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres".split()


def titles(spark, rows):
    """(key, type, adult, year, minutes) with the rest filled in."""
    full = [(k, t, f"Title {k}", k, a, y, "\\N", m, "Drama,Comedy") for k, t, a, y, m in rows]
    return normalize_nulls(spark.createDataFrame(full, schemas.RAW_TITLES))


@pytest.fixture
def sides(spark):
    keys = [f"tt{i}" for i in range(300)]
    crew = spark.createDataFrame(
        [(k, "nm1,nm2", "nm3") if i % 2 == 0 else (k, "nm4", None) for i, k in enumerate(keys)],
        schemas.RAW_CREW,
    )
    ratings = spark.createDataFrame([(k, 5.5, i) for i, k in enumerate(keys)], schemas.RAW_RATINGS)
    names = spark.createDataFrame(
        [(f"nm{i}", f"Name {i}", None, None, "", "") for i in range(9)], schemas.RAW_NAMES
    )
    return crew, ratings, names


ROWS = [
    ("tt0", "movie", "0", "1920", "95.7"),
    ("tt1", "movie", "0", "1949", "60"),
    ("tt2", "movie", "0", "1950", "60"),
    ("tt3", "movie", "1", "1920", "60"),
    ("tt4", "short", "0", "1920", "10"),
    ("tt5", "movie", "0", "\\N", "60"),
    ("tt6", "movie", "0", "1920", "Reality-TV"),
    ("tt7", "movie", "0", "1920", "words"),
    ("tt8", "movie", "0", "1840", "10000"),
]


def test_first_load(spark, sides):
    crew, ratings, names = sides
    raw = titles(spark, ROWS)
    limits = {"year_below": 1950, "title_type": "movie", "adult": 0}
    out = catalogue.initial_load(raw, crew, ratings, names, **limits)
    stored = {r.tconst: r for r in out["titles"].collect()}
    assert set(stored) == {"tt0", "tt1", "tt8"}
    assert out["titles"].columns == schemas.TITLES.names
    assert (stored["tt0"].runtimeMinutes, stored["tt0"].runtimeCategory) == (95, "F")
    assert (stored["tt8"].runtimeCategory, stored["tt8"].yearCategory) == ("nan", "nan")
    assert sorted(r.nconst for r in out["person_keys"].collect()) == ["nm1", "nm2", "nm3", "nm4"]
    assert out["names"].count() == 4
    content = out["content"]
    assert content.columns == schemas.CONTENT.names
    # tt1 has no writer, so it is not in the merged table.
    assert {r.tconst for r in content.collect()} == {"tt0", "tt8"}
    assert [r.tconst for r in catalogue.unreadable_titles(raw).collect()] == ["tt7"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        catalogue.clean_titles(raw, strict=True).collect()


def test_score_table_and_reads(spark, sides):
    crew, ratings, names = sides
    raw = titles(spark, [(f"tt{i}", "movie", "0", str(1900 + i), "60") for i in range(0, 28, 2)])
    content = catalogue.initial_load(raw, crew, ratings, names)["content"]
    scores = recommend.score_table(content)
    assert scores.schema == schemas.SCORES
    arrays = recommend.reco_arrays(scores, "tt2")
    wide = recommend.reco_wide(scores, "tt2")
    assert arrays.titles == [wide[f"top{i}"] for i in range(1, 11)] and "tt2" not in arrays.titles
    heading, *lines = recommend.reco_links(scores, content, "tt2").collect()
    assert (heading.rank, heading.other_id, heading.score_2dp) == (0, "tt2", None)
    assert heading.line == (
        "Recommandations for title : [Title tt2, 1902 (Drama,Comedy)](https://www.imdb.com/title/tt2)"
    )
    assert [r.other_id for r in lines] == arrays.titles
    first = arrays.titles[0]
    assert lines[0].link == (
        f"[Title {first}, {1900 + int(first[2:])} (Drama,Comedy)](https://www.imdb.com/title/{first})"
    )
    assert recommend.title_info(content, "tt2").primaryTitle == "Title tt2"
    with pytest.raises(KeyError):
        recommend.reco_wide(scores, "tt3")


def test_failing_titles_do_not_block_the_queue(spark, sides, tmp_path):
    store = str(tmp_path / "store")
    bad = [(f"tt{i:03}", "movie", "0", "1920", "words") for i in range(100)]
    raw = titles(spark, bad + [("tt250", "movie", "0", "1920", "60")])
    for _ in range(3):
        ingest.run_batch(spark, store, raw, *sides)
    assert ingest.stored(spark, store, "attempted").count() == 101
    assert [r.tconst for r in ingest.stored(spark, store, "content").collect()] == ["tt250"]


def test_a_repeated_batch_changes_nothing(spark, sides, tmp_path):
    store = str(tmp_path / "store")
    ingest.run_batch(spark, store, titles(spark, ROWS), *sides)
    before = {t: ingest.stored(spark, store, t).count() for t in ingest.STORED}
    assert before["titles"] == 4 and before["attempted"] == 7
    # The same batch once more, as after a failure half way.
    ingest.run_batch(spark, store, titles(spark, ROWS), *sides, batch=0)
    # And the same dump delivered again as a new batch.
    ingest.run_batch(spark, store, titles(spark, ROWS), *sides)
    assert {t: ingest.stored(spark, store, t).count() for t in ingest.STORED} == before


def drop(folder, name, rows):
    (folder / name).mkdir(parents=True)
    text = "\t".join(TITLE) + "\n"
    for k, t, a, y, m in rows:
        text += "\t".join([k, t, f"Title {k}", k, a, y, "\\N", m, "Drama,Comedy"]) + "\n"
    (folder / name / "titles.tsv.gz").write_bytes(gzip.compress(text.encode()))


def test_stream_of_drops_equals_one_batch(spark, sides, tmp_path):
    landing, store, progress = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "progress")

    def take():
        ingest.title_stream(ingest.drops(spark, str(landing), schemas.RAW_TITLES), store, progress, lambda: sides)

    drop(landing, "2024-01-01", ROWS[:4])
    drop(landing, "2024-01-02", ROWS)
    take()
    drop(landing, "2024-01-03", [*ROWS, ("tt20", "movie", "0", "1999", "60")])
    take()
    take()
    once = str(tmp_path / "once")
    whole = read_tsv(spark, str(landing / "2024-01-03"), schemas.RAW_TITLES)
    ingest.run_batch(spark, once, whole, *sides, limit=None)
    for table in ingest.STORED:
        streamed = sorted(map(str, ingest.stored(spark, store, table).collect()))
        assert streamed == sorted(map(str, ingest.stored(spark, once, table).collect())), table


def test_upsert_stream(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "k bigint, v string"

    def take(refresh, progress):
        rows = spark.readStream.schema(schema).parquet(source)
        ingest.upsert_stream(rows, table + progress, "k", str(tmp_path / progress), refresh)
        return rows.schema

    for progress, refresh, want in [("a", False, "old"), ("b", True, "new")]:
        source = str(tmp_path / f"in{progress}")
        spark.createDataFrame([(1, "old"), (2, "old")], schema).coalesce(1).write.parquet(source)
        take(refresh, progress)
        spark.createDataFrame([(2, "new"), (3, "new")], schema).coalesce(1).write.mode("append").parquet(source)
        kind = take(refresh, progress)
        take(refresh, progress)
        got = ingest.current_rows(spark, table + progress, kind, "k").orderBy("k").collect()
        assert [tuple(r) for r in got] == [(1, "old"), (2, want), (3, "new")]


def test_fixed_values():
    from nearfold import fixed

    assert fixed.RUNTIME_EDGES == [0, 10, 20, 30, 45, 60, 120, 150, 180, 9999]
    assert fixed.YEAR_EDGES == [1850, 1900, 1930, 1950, 1960, 1970, 1980, 1990, 2000, 2010, 2020, 2030]
    assert fixed.LINK_BASE == "https://www.imdb.com/title/" and fixed.CANDIDATE_BATCH == 100


def test_repeated_deliveries_do_not_multiply(spark, sides):
    crew, ratings, names = (side.unionByName(side) for side in sides)
    once = catalogue.initial_load(titles(spark, ROWS), *sides)
    twice = catalogue.initial_load(titles(spark, ROWS + ROWS), crew, ratings, names)
    for table in once:
        assert sorted(map(str, twice[table].collect())) == sorted(map(str, once[table].collect())), table


def test_late_crew_and_new_ratings_arrive(spark, sides, tmp_path):
    store = str(tmp_path / "store")
    crew, ratings, names = sides
    raw = titles(spark, ROWS)
    ingest.run_batch(spark, store, raw, crew.limit(0), ratings, names)
    assert ingest.stored(spark, store, "content").count() == 0
    for _ in range(2):
        ingest.run_batch(spark, store, raw, crew, ratings, names, refresh=True)
    whole = str(tmp_path / "whole")
    ingest.run_batch(spark, whole, raw, crew, ratings, names)
    want = sorted(map(str, ingest.stored(spark, whole, "content").collect()))
    assert want and sorted(map(str, ingest.current(spark, store, "content").collect())) == want
    assert ingest.stored(spark, store, "attempted").count() == ingest.stored(spark, whole, "attempted").count()


def test_a_limited_batch_leaves_the_rest(spark, sides, tmp_path):
    store = str(tmp_path / "store")
    for taken in (3, 6, 7):
        ingest.run_batch(spark, store, titles(spark, ROWS), *sides, limit=3)
        assert ingest.stored(spark, store, "attempted").count() == taken


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, sides, tmp_path, monkeypatch):
    from nearfold.sources.buckets import BucketTable

    store = str(tmp_path / "store")
    ingest.run_batch(spark, store, titles(spark, ROWS), *sides, buckets=64)
    asked = []
    rows = BucketTable._rows

    def watched(self, parts, before, touched):
        asked.append((self.path.rsplit("/", 1)[1], touched))
        return rows(self, parts, before, touched)

    monkeypatch.setattr(BucketTable, "_rows", watched)
    ingest.run_batch(spark, store, titles(spark, [("tt77", "movie", "0", "1999", "60")]), *sides)
    assert {t for t, _ in asked} == {"attempted", "names"}
    assert len(dict(asked)["attempted"]) == 1


def test_small_batches_are_merged(spark, sides, tmp_path):
    store = str(tmp_path / "store")
    for k in range(3):
        ingest.run_batch(spark, store, titles(spark, ROWS), *sides, limit=1)
    before = {t: sorted(map(str, ingest.stored(spark, store, t).collect())) for t in ingest.STORED}
    assert "attempted" in ingest.compact(spark, store)
    assert {t: sorted(map(str, ingest.stored(spark, store, t).collect())) for t in ingest.STORED} == before
    assert ingest.next_batch(spark, store) == 3


def test_dedup_stream_forgets_late_keys(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "k bigint, ts timestamp"

    def take(*values):
        spark.createDataFrame(values, "k bigint, at string").selectExpr("k", "cast(at as timestamp) ts").write.mode(
            "append"
        ).parquet(source)
        rows = spark.readStream.schema(schema).parquet(source)
        ingest.dedup_stream(rows, out, "k", progress, "ts", "1 day")
        return sorted(r.k for r in spark.read.schema(schema).parquet(out).collect())

    assert take((1, "2024-01-01"), (1, "2024-01-01"), (None, "2024-01-01")) == [1]
    assert take((1, "2024-01-01"), (2, "2024-01-09")) == [1, 2]
    # Key 1 is forgotten; a row of its old day is late, one of a new day counts as the first.
    assert take((1, "2024-01-01"), (2, "2024-01-09"), (1, "2024-01-10")) == [1, 1, 2]
