"""Rows keep their numbers when reads of one input split its files differently."""

import random

import pytest
from test_chunks import brute as chunk_brute
from test_suffix import brute as suffix_brute
from test_suffix import words

from nearfold import session
from nearfold.llm import chunks, jaccard, suffix

PARTS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def unsteady(spark, monkeypatch):
    """Each table that is written changes into how many parts the next read splits files."""
    before, written = spark.conf.get(PARTS), session._written

    def write(df, path, **options):
        out = written(df, path, **options)
        spark.conf.set(PARTS, "1" if spark.conf.get(PARTS) != "1" else "8")
        return out

    monkeypatch.setattr(session, "_written", write)
    yield
    spark.conf.set(PARTS, before)


def collected(spark, df):
    """The rows of a lazy result, read with either number of parts."""
    out = []
    for parts in ("1", "8"):
        spark.conf.set(PARTS, parts)
        out.append(df.collect())
    return out


def written(spark, tmp_path, rows):
    """Files of different sizes, as a read sorts files by size."""
    path = str(tmp_path / "rows")
    for a, z in ((0, 2), (2, 9), (9, 12), (12, len(rows))):
        spark.createDataFrame(rows[a:z], "doc_id bigint, text string, n_chars bigint").coalesce(1).write.mode(
            "append"
        ).parquet(path)
    return spark.read.parquet(path)


def texts(seed):
    rng = random.Random(seed)
    passages = [words(rng, 90) for _ in range(4)]
    rows = []
    for k in range(24):
        text = words(rng, rng.randrange(10, 90)) + " " + passages[k % 4] + " " + words(rng, rng.randrange(10, 90))
        rows.append((k, text if k % 5 else words(rng, 40), 0))
    return rows


def test_repeats(spark, tmp_path, unsteady):
    rows = texts(1)
    docs = written(spark, tmp_path, rows)
    want = {d: kept for (d, *_), (kept, _) in zip(rows, suffix_brute([t.encode() for _, t, _ in rows]))}
    assert any(want[d] != t.encode() for d, t, _ in rows)
    for got in collected(spark, suffix.remove_repeats(docs)):
        assert {r.doc_id: bytes(r.kept) for r in got} == want
    for got in collected(spark, suffix.without_repeats(docs)):
        assert {r.doc_id: r.text for r in got} == {d: kept.decode("utf-8", "ignore") for d, kept in want.items()}


def test_chunks(spark, tmp_path, unsteady):
    rows = texts(2)
    docs = written(spark, tmp_path, rows)
    want = {int(d): kept for d, kept, *_ in chunk_brute([r[:2] for r in rows])}
    assert any(want[d] != t.encode() for d, t, _ in rows)
    for got in collected(spark, chunks.drop_repeated_chunks(docs)):
        assert {r.doc_id: bytes(r.kept) for r in got} == want


def test_one_of_each_group(spark, tmp_path, unsteady):
    rng = random.Random(3)
    own = [words(rng, 20) for _ in range(6)]
    rows = [(k, own[k % 6], 0) for k in range(24)]
    docs = written(spark, tmp_path, rows)
    for got in collected(spark, jaccard.one_of_each_group(docs)):
        assert sorted(tuple(r) for r in got) == rows[:6]
