"""Token files and packing against the tokenizers library itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import packing, queries, token_files
from nearfold.llm.tokens import RunEncoder, default_path

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, ids string, row int, length string"
ODD = [
    (5, None, "x", 1, "y"),
    (None, "no id", "x", 1, "y"),
    (3, "", "x", 1, "y"),
    (3, "", "x", 1, "y"),
    (2, "word " * 9000, "x", 1, "y"),
    (1, " \n\t ", None, None, None),
    (4, "it's l'été 'quoted' dash—, é.  x <|endoftext|>a1.5٣!! \x1cb", "x", 1, "y"),
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(default_path())


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_encoder_equals_the_library(plain, documents):
    texts = [t for t in documents.values()] + [r[1] or "" for r in ODD]
    texts += ["<|ENDOFTEXT|> <|endoftext|>", "ſS K İi", "a b　c", "½''s 's'", "don't 'tis we'll"]
    small = RunEncoder(default_path(), capacity=50)
    for _ in range(2):
        for k in range(0, len(texts), 7):
            part = texts[k : k + 7]
            ids, counts = small.encode([t.encode() for t in part])
            want = [plain.encode(t, add_special_tokens=False).ids for t in part]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == sum(want, [])


def test_token_files(spark, plain, documents):
    got = queries.QUERIES["op5_token_files"](spark, SF_DIR).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == sorted(documents)
    start = 0
    for r in got:
        ids = [*plain.encode(documents[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_of_odd_rows(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame(ODD, SCHEMA), path)
    files = token_files.read_token_files(spark, path)
    rows = token_files.positions(token_files.checksums(files)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 4, 5]
    assert [r.n_tokens for r in rows if r.doc_id in (1, 3, 5)] == [1, 1, 1, 1]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    assert files.filter(F.col("doc_id") == 2).count() == 1


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), path)
    files = token_files.read_token_files(spark, path)
    assert token_files.positions(token_files.checksums(files)).count() == 0


def check_packing(rows, capacity=4096):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(spark, plain, documents):
    rows = queries.QUERIES["op1_best_fit_packing"](spark, SF_DIR).collect()
    total = 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in documents.items():
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        want = [(k, k * 4096, ids[k * 4096 : (k + 1) * 4096]) for k in range(-(-len(ids) // 4096))]
        got = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [
            (k, s, len(w), crc(w)) for k, s, w in want
        ]
    assert check_packing(rows) <= -(-total // 4096) + 1


def test_packing_odd_rows_and_nothing(spark):
    odd = packing.pack_documents(spark.createDataFrame(ODD, SCHEMA))
    rows = odd.collect()
    assert check_packing(rows) == 3  # 9001 ids: two full pieces, and a rest with all others
    assert sorted(r.length for r in rows if r.doc_id == 3) == [1, 1]
    assert sum(r.length for r in rows if r.doc_id == 2) == 9001
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_local_search_empties_bins():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 51, 800)
    worst = np.arange(800) // 2
    found = packing.local_search(lengths, worst, 100)
    fill = np.bincount(found, weights=lengths)
    assert fill.max() <= 100 and fill.sum() == lengths.sum()
    assert (fill > 0).sum() <= np.ceil(lengths.sum() / 100) + 2
    assert (fill**2).sum() >= (np.bincount(worst, weights=lengths) ** 2).sum()


def test_groups_hand_on_their_loose_bins(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1, 3000, 3000))]
    df = spark.createDataFrame(rows, "row bigint, length bigint")
    placed = packing._offsets(packing.pack_pieces(df, 4096, group_pieces=200, keep_open=4))
    out = placed.join(df, "row").collect()
    assert len(out) == 3000
    assert check_packing(out) <= -(-sum(n for _, n in rows) // 4096) * 1.01 + 1


def test_loose_bins_of_all_groups_meet(spark):
    """Pieces of which two or three fill a bin badly: many groups do about as well as a single one."""
    rng = np.random.default_rng(3)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1000, 2000, 4000))]
    df = spark.createDataFrame(rows, "row bigint, length bigint")

    def bins(**options):
        out = packing._offsets(packing.pack_pieces(df, 4096, **options)).join(df, "row").collect()
        assert len(out) == 4000
        return check_packing(out)

    alone = bins(group_pieces=4000)
    assert bins(group_pieces=250) <= alone * 1.02 < bins(group_pieces=250, keep_open=2) * 1.02


def test_positions_past_five_digits(spark):
    """Part numbers are padded to five digits, and go on without that."""
    names = ["part-00000-x.orc", "part-99999-x.orc", "part-100000-x.orc", "part-100001-x.orc"]
    rows = [(2 * k + j, name, j, 10) for k, name in enumerate(names) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id bigint, file string, row bigint, n_tokens bigint")
    assert [r.start for r in token_files.positions(df).orderBy("doc_id").collect()] == list(range(0, 80, 10))
