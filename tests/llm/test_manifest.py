"""The manifest against SQL, and against hashing by hand where the SQL does not reach."""

import hashlib
import itertools
import random

import pytest
from llm_tables import documents, duck  # noqa: F401
from pyspark.sql import functions as F

from nearfold.llm import manifest, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, node string, slot int"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes, fanout):
    """Root of the nodes, and for each of them `left, right` per level."""
    paths, spans = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for at in range(0, len(nodes), fanout):
            run, held = nodes[at : at + fanout], spans[at : at + fanout]
            for k, span in enumerate(held):
                for leaf in span:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            over.append([x for s in held for x in s])
        nodes, spans = up, over
    return nodes[0], paths


def brute(rows, fanout):
    def first(x):
        return (x is not None, x if x is not None else 0)

    leaves = [
        (r[2], r[0], sha(*[field(x) for x in (r[0], r[3], r[2], r[4], r[1])])) for r in rows
    ]
    leaves.sort(key=lambda x: (x[0] is not None, (x[0] or "").encode(), first(x[1]), x[2]))
    groups = [(k, list(v)) for k, v in itertools.groupby(leaves, key=lambda x: x[0])]
    trees = [climb([x[2] for x in v], fanout) for _, v in groups]
    root, tops = climb([t[0] for t in trees], fanout)
    out = []
    for (_, v), (subroot, paths), top in zip(groups, trees, tops, strict=True):
        out += [(x[1], x[2], tuple(p + top), subroot, root) for x, p in zip(v, paths, strict=True)]
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA).repartition(3)
    found = manifest.manifest(df, **options).collect()
    return sorted([(r.doc_id, r.leaf, tuple(map(tuple, r.path)), r.subroot, r.root) for r in found], key=str)


def made(n, seed=1):
    rng = random.Random(seed)
    langs = ["en"] * 8 + ["de", "fr", None, "", "é"]
    return [(k, f"text {rng.random()}", rng.choice(langs), rng.choice(["a", None]), rng.randrange(99)) for k in range(n)]


ODD = [
    (1, None, None, None, None), (1, None, None, None, None), (2, "", "", "", 0), (None, "x", "en", "s", 1),
    (None, "x", "en", "s", 1), (3, "y", "en", "s", 1), (3, "z", "en", "s", 1), (3, "z", "en", "s", 1),
    (-4, "long " * 50_000, "en", "s", 2**63 - 1), (5, "ß € 𝄞", "zh", "-", 5),
]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_by_hand(spark, monkeypatch, fanout):
    monkeypatch.setattr(manifest, "BLOCK", 9)
    rows = made(301) + ODD
    assert run(spark, rows, fanout=fanout) == brute(rows, fanout)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17])
def test_small_groups(spark, monkeypatch, n):
    monkeypatch.setattr(manifest, "BLOCK", 4)
    rows = [(k, "t", "en", None, None) for k in range(n)]
    assert run(spark, rows) == brute(rows, 2)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK", 4)
    rows = [(k, "t", f"g{k % 37}", None, None) for k in range(80)]
    assert run(spark, rows) == brute(rows, 2)


def test_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(7, "same", "en", "s", 4)] * 200
    assert run(spark, rows) == brute(rows, 2)


def test_nothing(spark):
    assert run(spark, []) == []


def test_tampered_leaf_is_found(spark):
    rows = made(40)
    df = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    other = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    claims = {"claimed": manifest.leaf_digest(COLUMNS, {"text": other})}
    found = manifest.verify(manifest.manifest(df, claims=claims), "claimed").collect()
    assert {r.doc_id for r in found if not r.verified} == set(range(0, 40, 5))
    assert all(r.verified for r in manifest.verify(manifest.manifest(df)).collect())


def test_query_as_sql(spark, duck):
    got = queries.QUERIES["op13_merkle_manifest"](spark, SF_DIR)
    want = duck.sql(queries.ORACLE["op13_merkle_manifest"])
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[k] for k in at) for r in want.fetchall())
