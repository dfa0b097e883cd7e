"""Chunk dedup against a chunker that looks at one byte at a time."""

import hashlib
import random
import tempfile

import numpy as np
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import chunks, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, kept string, row int, removed string"


def plain_cut(raw):
    """Ends of the chunks of one text."""
    rolled = []
    for i in range(len(raw)):
        rolled.append(sum(int(chunks._GEAR[raw[i - j]]) << j for j in range(min(32, i + 1))) & 0xFFFFFFFF)
    r, n = chunks.REACH, len(raw)
    ends = {n} if n else set()
    for i in range(n):
        at = i + 1
        if at >= 32 + r and n - at >= r:
            if all(rolled[i] < x for x in rolled[at : at + r]) and all(rolled[i] <= x for x in rolled[i - r : i]):
                ends.add(at)
    out, start = [], 0
    for end in sorted(ends):
        while end - start > chunks.LONGEST:
            start += chunks.LONGEST
            out.append(start)
        start = end
        out.append(end)
    return out


def brute(rows):
    seen, flags = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    cuts = [plain_cut((t or "").encode()) for _, t in rows]
    repeats = [[] for _ in rows]
    for k in order:
        raw, start = (rows[k][1] or "").encode(), 0
        for end in cuts[k]:
            d = hashlib.blake2b(raw[start:end], digest_size=16).digest()
            if d in seen:
                repeats[k].append((start, end))
            seen.setdefault(d, k)
            start = end
    for k, (doc_id, text) in enumerate(rows):
        spans = []
        for a, z in repeats[k]:
            if spans and spans[-1][1] == a:
                spans[-1] = (spans[-1][0], z)
            else:
                spans.append((a, z))
        raw, kept, at = (text or "").encode(), b"", 0
        # A run goes from 64 bytes on, and a shorter one if it is the whole text.
        spans = [s for s in spans if s[1] - s[0] >= 64 or s == (0, len(raw))]
        for a, z in spans:
            kept, at = kept + raw[at:a], z
        flags.append((str(doc_id), kept + raw[at:], spans, len(raw), len(cuts[k]), len(repeats[k])))
    return sorted(flags)


def found(df):
    return sorted(
        (str(r.doc_id), bytes(r.kept), [(s.start, s.stop) for s in r.removed], r.n_bytes, r.n_chunks, r.n_repeats)
        for r in chunks.drop_repeated_chunks(df).collect()
    )


def run(spark, rows, parts=4):
    path = f"{tempfile.mkdtemp()}/rows"
    spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(parts).write.parquet(path)
    return found(spark.read.parquet(path))


def test_query(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op4_chunk_dedup"](spark, SF_DIR).collect()}
    rows = sorted(documents.items())
    for doc_id, kept, spans, n, n_chunks, n_repeats in brute(rows):
        r = got[int(doc_id)]
        assert (r.n_bytes, r.n_chunks, r.n_repeats, r.n_spans) == (n, n_chunks, n_repeats, len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert r.n_removed == n - len(kept)
    assert len(got) == len(rows)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghé", k=rng.randrange(1, 9))) for _ in range(n))


def test_passages(spark):
    """A passage of 51 words is found wherever it stands; its first holder and other text keep theirs."""
    rng = random.Random(1)
    rows, passages = [], [words(rng, 51) for _ in range(60)]
    for k in range(180):
        rows.append((k, words(rng, rng.randrange(0, 80)) + " " + passages[k % 60] + " " + words(rng, rng.randrange(0, 80))))
    rows += [(500 + k, words(rng, 100)) for k in range(40)]
    got = run(spark, rows)
    assert got == brute(rows)
    removed = {int(d): (kept, spans) for d, kept, spans, *_ in got}
    for k in range(60):
        assert removed[k][1] == []
    for k in range(60, 180):
        gone = sum(z - a for a, z in removed[k][1])
        assert gone >= 64 and gone <= len(passages[k % 60].encode()) + 2
    assert all(removed[500 + k][1] == [] for k in range(40))


def test_insertions_move_few_cuts():
    rng = random.Random(2)
    raw = words(rng, 2000).encode()
    text, starts, ends = chunks.cut([raw, raw[:3000] + b"inserted" + raw[3000:]])
    one = {raw[a:z] for a, z in zip(starts[text == 0], ends[text == 0])}
    other = raw[:3000] + b"inserted" + raw[3000:]
    two = {other[a:z] for a, z in zip(starts[text == 1], ends[text == 1])}
    assert len(one - two) <= 4 and len(one) > 100


def test_cut_alike_in_any_company():
    rng = random.Random(3)
    raws = [words(rng, rng.randrange(0, 300)).encode() for _ in range(40)] + [b"", b"z" * 5000, b"ab" * 900]
    text, _, ends = chunks.cut(raws)
    for k, raw in enumerate(raws):
        assert ends[text == k].tolist() == plain_cut(raw)
    assert np.all(np.diff(text) >= 0)


def test_odd_rows(spark):
    rng = random.Random(4)
    copy = words(rng, 200)
    rows = [
        (1, None), (2, ""), (3, "short"), (3, "short"), (4, copy), (4, copy), (None, copy), (0, copy),
        (5, "z" * 4000), (6, "z" * 4000), (7, words(rng, 20_000)), (None, None),
    ]
    assert [r[1:] for r in run(spark, rows)] == [r[1:] for r in brute(rows)]
    assert run(spark, []) == []
