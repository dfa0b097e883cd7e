"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import jaccard, queries
from nearfold.llm.graph import components
from nearfold.llm.words import shingle_hashes, word_hashes

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n_shingles string, key int, node string"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute(rows, percent=75):
    """`row number -> (doc_id, n, component)`; rows of one id are one document."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [
        (doc_id, len(s), least.get(find(i)) if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))
    ]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def run(spark, rows, percent=75, parts=4):
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(parts)
    found = jaccard.similar_groups(df, percent=percent).collect()
    kept = {(r.component_id, r.row) for r in found if r.kept and r.n_shingles}
    assert {c for c, _ in kept} == {r.component_id for r in found if r.n_shingles}
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=key)


def test_words_and_shingles(documents):
    texts = [*documents.values(), "", "one two", "A b\x0bc\x1cd\td  E f", "x " * 300]
    raws = [t.encode() for t in texts]
    got = shingle_hashes(*word_hashes(raws))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    again = shingle_hashes(*word_hashes([b"zz", *[r.upper() if r.isascii() else r for r in raws]]))[1:]
    assert all(np.array_equal(a, b) for a, b in zip(got, again))


def test_same_as_sql(spark, duck):
    want = duck.sql(queries.ORACLE["op2_ngram_jaccard_join"]).df().sort_values("doc_id", ignore_index=True)
    got = queries.QUERIES["op2_ngram_jaccard_join"](spark, SF_DIR).toPandas()
    got = got.sort_values("doc_id", ignore_index=True)
    for c in ("doc_id", "n_shingles", "component_id"):
        assert got[c].tolist() == want[c].tolist()


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_random_edits(spark, percent):
    """Copies with more and more edits, about sizes where bands meet, and a passage in most texts."""
    rng = random.Random(percent)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for size in (5, 6, 9, 18, 19, 20, 60, 67, 68, 80, 200, 259, 260, 330):
        for _ in range(3):
            text = rng.choices(vocabulary, k=size)
            if rng.random() < 0.7:
                text[size // 2 : size // 2] = passage
            for _ in range(rng.randrange(2, 9)):
                copy = list(text)
                for _ in range(rng.randrange(0, max(2, size // 12))):
                    at = rng.randrange(len(copy))
                    copy[at : at + rng.randrange(0, 2)] = rng.choices(vocabulary, k=rng.randrange(0, 3))
                rows.append((len(rows), " ".join(copy)))
    assert run(spark, rows, percent) == sorted(brute(rows, percent), key=key)


def test_odd_rows(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [
        (9, None), (8, ""), (7, " \n"), (6, "One two"), (5, "one TWO"), (None, "one two"), (4, "É two"),
        (3, long), (2, long + " tail"), (2, "another text with the same id here"), (1, "another text"),
        (None, "nothing like any other text in here"), (12, "Another text with the same id here"),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=key)


def test_one_of_each_group(spark, tmp_path):
    rows = [(3, "a b c d e f"), (2, "A b c d e f"), (2, "a b c d e f"), (None, "x y z"), (None, "X y z"), (1, None), (1, "")]
    rows += [(9, "p q r s t u")]
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "rows"))
    docs = spark.read.parquet(str(tmp_path / "rows"))
    kept = jaccard.one_of_each_group(docs)
    assert kept.schema == docs.schema
    found = sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()), key=str)
    assert found == sorted([(2, "a b c d e f"), (None, "x y z"), (1, ""), (1, ""), (9, "p q r s t u")], key=str)


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("unlike, tile", [(0, 2048), (1, 3)])
def test_entries_of_unlike_sets(spark, monkeypatch, unlike, tile):
    monkeypatch.setattr(jaccard, "UNLIKE", unlike)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "ROUNDS", (1, 0))
    test_random_edits(spark, 75)


def test_large_group_of_near_copies(spark):
    """Each text differs from each other; two halves link through one text only."""
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(300):
        text = list(base)
        text[(7 * k) % 120] = f"x{k}"
        rows.append((k, " ".join(text)))
    half = base[:60] + [f"c{k}" for k in range(60)]
    rows += [(300 + k, " ".join([*half, f"y{k}"])) for k in range(50)]
    assert run(spark, rows, parts=7) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("tile", [2048, 20])
def test_sets_of_many_groups_join_once(spark, monkeypatch, tile):
    """Texts around one passage are in many groups and tiles; sketches and components join once per text."""
    written, freeze = {}, jaccard.Steps.freeze

    def freeze_and_note(self, df, name):
        written[name] = freeze(self, df, name)
        return written[name]

    monkeypatch.setattr(jaccard.Steps, "freeze", freeze_and_note)
    monkeypatch.setattr(jaccard.Steps, "__exit__", lambda *_: None)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "ROWS_PER_TASK", 100)
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(120):
        own = [f"v{k}-{i}" for i in range(rng.randrange(6, 12))]
        at = rng.randrange(len(own))
        text = own[:at] + passage + own[at:]
        rows.append((len(rows), " ".join(text)))
        if k % 10 == 0:
            rows.append((len(rows), " ".join([*text[:-1], "end"])))
    assert run(spark, rows, parts=5) == sorted(brute(rows), key=key)
    tiles = written["tiles"]
    n = tiles.count()
    assert n == tiles.select("node").distinct().count()
    assert tiles.selectExpr("inline(tiles)").selectExpr("inline(groups)").count() > n


@pytest.mark.parametrize("part", [500_000, 20])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr("nearfold.llm.graph.PART_LINKS", part)
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    pairs += [(1000 + k, 1001 + k) for k in range(70)] + [(5, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
