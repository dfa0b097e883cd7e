"""Leaks against an alignment of every item with every text."""

import random
import re

import numpy as np
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import decontaminate, queries
from nearfold.llm.decontaminate import MIN_WORDS, Items, matches

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, item_id string, distance int"
ITEMS = "item_id bigint, text string, doc_id string"


def split(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def align(item, text):
    row = [0] * (len(text) + 1)
    for k, word in enumerate(item):
        new = [k + 1]
        for j, other in enumerate(text):
            new.append(min(row[j + 1] + 1, row[j] + (word != other), new[j] + 1))
        row = new
    return min(row), row.index(min(row)) - 1


def brute(docs, items, max_error=0.25):
    out = []
    for d, text in docs:
        words = split(text)
        for i, item in items:
            want = split(item)
            if len(want) >= MIN_WORDS and len(words) and len(set(want) & set(words)) >= (1 - max_error) * len(set(want)) / 2:
                n, end = align(want, words)
                if n <= int(len(want) * max_error):
                    out.append((d, i, n, len(want), end))
            elif want and len(want) < 8:
                at = [k for k in range(len(words)) if words[k : k + len(want)] == want]
                if at and (len(want) >= 5 or want == words):
                    out.append((d, i, 0, len(want), at[0] + len(want) - 1))
    return sorted(out, key=str)


def find(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS).repartition(3)
    i = spark.createDataFrame([(*r, "y") for r in items], ITEMS)
    clean = decontaminate.clean_documents(d, i)
    assert clean.schema == d.schema
    found = sorted((tuple(r) for r in decontaminate.find_leaks(d, i).collect()), key=str)
    return found, clean.collect()


def test_query(spark, duck):
    got = sorted((tuple(r) for r in queries.QUERIES["op3_benchmark_decontamination"](spark, SF_DIR).collect()), key=str)
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert got == brute(docs, items) and len(got) > 0


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
    return words


def test_recall_by_edits():
    """Of edited items in random text nearly all are found, and nothing else is."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)] + ["the", "of", "and"] * 300
    items = [rng.choices(vocabulary, k=rng.randrange(14, 60)) for _ in range(120)]
    block = Items([type("R", (), {"item_id": k, "text": " ".join(w)})() for k, w in enumerate(items)], 0.25)
    for share, least in ((0.0, 1.0), (0.1, 0.99), (0.2, 0.95), (0.25, 0.9)):
        texts, truth = [], set()
        for k, item in enumerate(items):
            cut = edited(rng, item, int(len(item) * share), vocabulary)
            text = rng.choices(vocabulary, k=80) + cut + rng.choices(vocabulary, k=50)
            texts.append(" ".join(text).encode())
            if align(item, text)[0] <= int(len(item) * 0.25):
                truth.add((k, k))
        found = {(t, k) for t, k, _, _ in matches(block, *decontaminate.sequences(texts))}
        assert found <= truth or all(align(items[k], texts[t].decode().split())[0] <= len(items[k]) // 4 for t, k in found)
        assert len(found & truth) >= least * len(truth), share


def test_odd_rows(spark):
    rng = random.Random(8)
    vocabulary = [f"é{k}" for k in range(500)]
    long = rng.choices(vocabulary, k=15)
    items = [
        (1, " ".join(long)), (1, " ".join(long)), (None, "One, two three four five six seven eight NINE"),
        (3, None), (4, ""), (5, "tiny item"), (6, "?!"),
    ]
    filler = " ".join(rng.choices(vocabulary, k=30_000))
    docs = [
        (1, None), (2, ""), (3, "Tiny: ITEM!"), (4, "a tiny item"), (None, " ".join(long).upper()),
        (5, filler + " " + " ".join(long) + ". " + filler), (5, "one two three four five six seven eight nine"),
        (6, "one two three four five x seven eight nine"), (7, " ".join(long[:7])), (8, " ".join(long[3:])),
        (9, "one two three four five x seven y z nine"),
    ]
    found, clean = find(spark, docs, items)
    assert found == brute(docs, items)
    assert sorted((r.doc_id, r.text) for r in clean if r.doc_id) == [
        (1, None), (2, ""), (4, "a tiny item"), (7, docs[8][1]), (9, docs[10][1]),
    ]


def test_nothing(spark):
    assert find(spark, [], [(1, "a b c d e f g h i")]) == ([], [])
    found, clean = find(spark, [(1, "a b c d e f g h i")], [])
    assert found == [] and len(clean) == 1


def test_blocks_of_items(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(900)]
    items = [(k, " ".join(rng.choices(vocabulary, k=20))) for k in range(40)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=10)) + " " + t) for k, t in items]
    monkeypatch.setattr(decontaminate, "KEYS_PER_BLOCK", 9_000)
    found, clean = find(spark, docs, items)
    assert found == brute(docs, items) and clean == [] and len(found) == 40


def test_distance():
    a = np.array([1, 2, 3, 4], dtype=np.uint64)
    assert decontaminate.distance(a, np.array([9, 1, 2, 4, 9], dtype=np.uint64)) == (1, 4)
    assert decontaminate.distance(a, np.array([], dtype=np.uint64)) == (4, 0)


def test_short_items_inside_texts(spark):
    """From five words on an item is found wherever it stands; shorter ones must be the whole text."""
    items = [(5, "One two three four five"), (6, "a b c d e f"), (4, "tiny little short item"), (7, "a b c d e f g")]
    docs = [
        (1, "x one two, three four FIVE. one two three four five y"), (2, "one two three four x five"), (3, "A b c d e f"),
        (4, "so a b c d e f g h"), (5, "the tiny little short item"), (6, "Tiny little; short item!"), (7, "one two three"),
        (8, "four five"), (9, "a b c d e"),
    ]
    found, clean = find(spark, docs, items)
    assert found == brute(docs, items)
    assert [f[:2] for f in found] == [(1, 5), (3, 6), (4, 6), (4, 7), (6, 4)]
    assert sorted(r.doc_id for r in clean) == [2, 5, 7, 8, 9]


def test_index_size_is_bounded():
    """A block's index is arrays of about twelve bytes a key, and blocks are cut by their keys."""
    rng = random.Random(5)
    rows = [type("R", (), {"item_id": k, "text": " ".join(f"w{rng.randrange(9999)}" for _ in range(30))})() for k in range(300)]
    block = Items(rows, 0.25)
    size = sum(a.nbytes for band in block.keys for walk in band for sample in walk for a in sample[1:])
    keys = 300 * decontaminate.WALKS * decontaminate.SAMPLES * 15
    assert size <= 12 * keys
