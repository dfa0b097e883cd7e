"""Repeated strings against a count of all windows."""

import hashlib
import random
import tempfile
from collections import Counter

import numpy as np
import pytest
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import chunks, jaccard, queries, suffix

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, kept string, row int, spans string"


def brute(raws, width=200):
    count = Counter(r[i : i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r) + 1, dtype=int)
        for i in range(len(r) - width + 1):
            if count[r[i : i + width]] > 1:
                covered[i] += 1
                covered[i + width if i + width <= len(r) else len(r)] -= 1
        mask = np.cumsum(covered)[: len(r)] > 0
        edge = np.diff(mask.astype(int), prepend=0, append=0)
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((bytes(np.frombuffer(r, dtype=np.uint8)[~mask]), spans))
    return out


def check(spark, rows, width=200, parts=5):
    path = f"{tempfile.mkdtemp()}/rows"
    spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(parts).write.parquet(path)
    got = suffix.remove_repeats(spark.read.parquet(path), width=width).collect()
    want = brute([(t or "").encode() for _, t in rows], width)
    found = sorted((str(r.doc_id), bytes(r.kept), [(s.start, s.stop) for s in r.removed], r.n_bytes) for r in got)
    assert found == sorted(
        (str(d), kept, spans, len((t or "").encode())) for (d, t), (kept, spans) in zip(rows, want)
    )


def test_query(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op8_suffix_array_dedup"](spark, SF_DIR).collect()}
    ids = sorted(documents)
    want = brute([(documents[i] or "").encode() for i in ids])
    assert len(got) == len(ids)
    for i, (kept, spans) in zip(ids, want):
        r = got[i]
        assert (r.n_removed, r.n_spans) == (sum(z - a for a, z in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert sum(r.n_removed for r in got.values()) > 0


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgé", k=rng.randrange(1, 9))) for _ in range(n))


def test_passages_of_all_lengths(spark):
    rng = random.Random(1)
    passages = [words(rng, n) for n in (30, 40, 45, 60, 200)]
    rows = []
    for k in range(80):
        parts = [words(rng, rng.randrange(0, 60)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        cut = rng.choice(passages)
        a = rng.randrange(len(cut))
        parts.insert(rng.randrange(4), cut[a : a + rng.randrange(len(cut))])
        rows.append((k, "".join(parts)))
    check(spark, rows)
    check(spark, rows, width=64)


@pytest.mark.parametrize("hot", [3, 10_000])
def test_hot_passage(spark, monkeypatch, hot):
    """With a low bound every repeated anchor is hot and goes the way of single windows."""
    monkeypatch.setattr(suffix, "HOT", hot)
    rng = random.Random(2)
    passage = words(rng, 90)
    rows = [(k, words(rng, 20) + passage + words(rng, 30)) for k in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(10)] + [(200, passage[40:300]), (201, words(rng, 300))]
    rows += [(202, rows[5][1][:700] + "x"), (203, "y" + rows[5][1][100:])]
    check(spark, rows, parts=7)


def test_odd_rows(spark):
    rng = random.Random(3)
    long = words(rng, 9000)
    rows = [
        (1, None), (2, ""), (3, "short"), (3, "short"), (None, words(rng, 100)), (4, "ab" * 400), (5, "z" * 199),
        (6, "z" * 200), (7, "q" * 201), (8, long), (9, long[5000:20000]), (10, "é" * 150), (11, "é" * 100 + "x" + "é" * 100),
        (None, words(rng, 100)),
    ]
    check(spark, rows)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix.remove_repeats(empty).count() == 0
    assert suffix.remove_repeats(spark.createDataFrame([(1, None, "x", 1, "y")], SCHEMA)).first().kept == b""


def test_chunks_of_a_long_text(monkeypatch):
    raw = words(random.Random(4), 4000).encode()
    whole = suffix.runs([b"ab", raw])
    monkeypatch.setattr(suffix, "_CHUNK", 1000)
    cut = suffix.runs([b"ab", raw])
    spread = lambda r: np.repeat(r[3], r[2]).tolist()
    assert spread(whole) == spread(cut) and cut[0].tolist() == [1] * len(cut[0])


def test_suffix_order_is_that_of_the_bytes():
    rng = np.random.default_rng(5)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    text = suffix._Text(buf)
    places = rng.integers(60, 2900, 500)
    room = rng.integers(0, 60, 500)
    group = rng.integers(0, 4, 500)
    for step in (1, -1):
        order, common = suffix.suffix_order(text, group, places, room, step)
        keys = [
            (int(g), (buf[p : p + r] if step > 0 else buf[p - r : p][::-1]).tobytes())
            for g, p, r in zip(group[order], places[order], room[order])
        ]
        assert keys == sorted(keys)
        for (g, a), (h, b), c in zip(keys, keys[1:], common[1:]):
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert c == (same if g == h else -1)


def test_colliding_hashes_are_found(monkeypatch):
    """With a useless hash the verification falls back on the bytes."""
    monkeypatch.setattr(suffix, "RAW_BYTE_HASH", np.zeros(256, dtype=np.uint64))
    test_suffix_order_is_that_of_the_bytes()


def test_columns_of_any_names(spark, tmp_path):
    """Columns named like those that the operators use inside, in rows from files and in made-up ones."""
    rng = random.Random(6)
    passage = words(rng, 80)
    texts = [words(rng, 30) + passage + words(rng, 30) for _ in range(4)] + [None, "", "short", "short"]
    names = "doc_id bigint, text string, Row bigint, spans string, nths int, hash string, row_file string, `a.b` int"
    rows = [(k, t, 7, "s", 1, "h", "f", 3) for k, t in enumerate(texts)]
    made = spark.createDataFrame(rows, names)
    made.write.parquet(str(tmp_path / "rows"))
    for docs in (made, spark.read.parquet(str(tmp_path / "rows"))):
        got = sorted(suffix.without_repeats(docs).collect(), key=lambda r: r.doc_id)
        assert [tuple(r)[2:] for r in got] == [(7, "s", 1, "h", "f", 3)] * 8
        assert [r.text for r in got[4:]] == texts[4:] and all(len(r.text) < len(t) for r, t in zip(got[:4], texts))
        assert jaccard.one_of_each_group(docs).columns == docs.columns
        assert chunks.drop_repeated_chunks(docs).count() == 8


def test_ids_as_text(spark):
    docs = spark.createDataFrame([("x1", "some words here"), ("7", "some words here"), (None, "other")], "doc_id string, text string")
    assert sorted(r.doc_id or "" for r in chunks.drop_repeated_chunks(docs).collect()) == ["", "7", "x1"]
    assert {r.component_id for r in jaccard.similar_groups(docs).collect()} == {7, None}
