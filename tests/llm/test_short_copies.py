"""Chunk dedup of texts that are shorter than the least run inside a text."""

import random
from collections import Counter

from llm_tables import documents, duck  # noqa: F401
from test_chunks import run, words

from nearfold.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_short_text_with_many_copies(spark):
    """Of 40 copies the first stays, whatever the length; a short run inside a text stays too."""
    rng = random.Random(11)
    short = ["x", "Die tz.", "é" * 20, "y" * 63, "z" * 64]
    rows = [(100 * k + n, text) for k, text in enumerate(short) for n in range(40)]
    rng.shuffle(rows)
    rest = words(rng, 12)
    rows += [(1000, "Die tz."), (1001, "Die tz. " + rest), (1002, None), (1003, ""), (1004, "")]
    got = {int(r[0]): r[1:] for r in run(spark, rows)}
    for doc_id, text in rows:
        raw = (text or "").encode()
        copy = doc_id == 1000 or doc_id < 1000 and doc_id % 100 > 0
        kept, spans, n_bytes, _, n_repeats = got[doc_id]
        assert (kept, spans) == ((b"", [(0, len(raw))]) if copy else (raw, [])), doc_id
        assert n_bytes == len(raw) and (n_repeats > 0) == copy


def test_no_copy_is_left(spark, documents):
    """Each text of the given table stays at most once as a whole."""
    got = {r.doc_id: r for r in queries.QUERIES["op4_chunk_dedup"](spark, SF_DIR).collect()}
    whole = Counter(t for d, t in documents.items() if t and got[d].n_removed < got[d].n_bytes)
    assert any(n > 1 for n in Counter(t for t in documents.values() if t and len(t.encode()) < 64).values())
    assert max(whole.values()) == 1
