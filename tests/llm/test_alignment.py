"""Token alignment against overlaps found one by one."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import alignment, queries
from nearfold.llm.alignment import Fragment, Open, compose

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, row string, place int, sha string, groups string, key int"


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def a_bytes(token):
    """Byte-level vocabularies spell a byte that cannot be printed as the next free character from 256 on."""
    odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    return bytes(odd[ord(c) - 256] if ord(c) >= 256 else ord(c) for c in token)


def brute(rows, libraries):
    a_lib, b_lib = libraries
    docs = []
    for doc_id, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        spell_a = [a_bytes(a_lib.id_to_token(k)) for k in a]
        pieces = [b_lib.id_to_piece(k) for k in b]
        spell_b = [
            bytes([int(p[3:5], 16)]) if b_lib.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in zip(b, pieces, strict=True)
        ]
        want = (" " + (text or "")).encode()
        if not text or b"".join(spell_a) != want or b"".join(spell_b) != want:
            docs.append((doc_id, [], [], [], []))
            continue
        spans = []
        for spell in (spell_a, spell_b):
            at, own = 0, []
            for s in spell:
                own.append((at, at + len(s)))
                at += len(s)
            spans.append(own)
        links, first = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, x, y = [], [], []
        ends = sorted([(e, 0, k) for (_, e), k in zip(spans[0], a, strict=True)] + [(e, 1, k) for (_, e), k in zip(spans[1], b, strict=True)])
        for e, side, k in ends:
            (y if side else x).append(k)
            if e in cuts and side:
                groups.append((x, y))
                x, y = [], []
        docs.append((doc_id, a, b, groups, links))
    counts = Counter(p for d in docs for p in d[4])
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for doc_id, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else "")
        )
    return sorted(out, key=str), {(*p, n, n == most[p[1]]) for p, n in counts.items()}


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA).repartition(3)
    found = alignment.align(df, **options)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    rows = [tuple(r) for r in found.rows.select(*columns).collect()]
    return sorted(rows, key=str), {tuple(r) for r in found.pairs.select("a_id", "b_id", "count", "best").collect()}


def made(n):
    rng = random.Random(3)
    stock = ["the ", "token", "ization", "ß", "é", "中文", " \U0001f600", "\n\n", "  ", "1234", "<s>", "<|endoftext|>", "á", "'ll", "()", "\t", "x" * 9]
    return [(k, "".join(rng.choices(stock, k=rng.randint(1, 60)))) for k in range(n)]


ODD = [
    (None, "no id"), (1, None), (2, ""), (3, " "), (4, "   two  spaces  "), (5, "same"), (5, "same"), (6, "same"),
    (7, "holds ▁ a piece mark"), (8, "nul \x00 and \x1b"), (9, "long words " * 9_000), (10, "漢" * 3_000), (11, "z" * 5_000),
]


@pytest.mark.parametrize(("chunk", "fan", "hot"), [(1 << 16, 16, 1 << 18), (16, 3, 7), (1, 2, 0)])
def test_by_hand(spark, monkeypatch, libraries, chunk, fan, hot):
    monkeypatch.setattr(alignment, "FAN", fan)
    rows = made(60) + ([r for r in ODD if len(r[1] or "") < 2_000] if chunk == 1 else ODD)
    assert run(spark, rows, chunk=chunk, hot=hot) == brute(rows, libraries)


def test_groups_as_text(spark):
    df = spark.createDataFrame([(1, "tokenization of words")], "doc_id bigint, text string")
    (row,) = alignment.align(df, keep_groups=True, chunk=4).rows.collect()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") == row.n_groups - 1


def random_fragment(rng, at):
    def open_(n, m):
        a, b = sorted(rng.sample(range(at, at + 50), n)), sorted(rng.sample(range(at, at + 50), m))
        if n and m:
            a[-1] = b[-1] = at + 50
        return Open(*[np.array(x, dtype=np.int64) for x in (rng.choices(range(9), k=n), a, rng.choices(range(9), k=m), b)])

    if rng.random() < 0.4:
        return Fragment(n_a=2, left=Open(*[np.array(x, dtype=np.int64) for x in ([1, 2], [at, at + 1], [3], [at + 2])]))
    return Fragment(n_groups=1, groups=b"7|7", closed=True, left=open_(2, 3), right=open_(1, 2))


def same(x, y):
    return alignment._as_row(x) == alignment._as_row(y)


def test_monoid():
    rng = random.Random(1)
    for _ in range(200):
        x, y, z = (random_fragment(rng, 100 * k) for k in range(3))
        assert same(compose(compose(x, y, 10), z, 10), compose(x, compose(y, z, 10), 10))
        assert same(compose(Fragment(), x, 10), x) and same(compose(x, Fragment(), 10), x)


def test_nothing(spark):
    assert run(spark, []) == ([], set())


def test_query(spark, documents, libraries):
    got = [tuple(r) for r in queries.QUERIES["op12_token_alignment"](spark, SF_DIR).collect()]
    assert sorted(got, key=str) == brute(sorted(documents.items()), libraries)[0]
