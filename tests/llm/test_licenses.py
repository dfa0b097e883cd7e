"""License scans against Python's regular expressions, pairwise suppression, and SQL."""

import random
import re
import string
from re import _constants as C
from re import _parser

import pytest
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import licenses, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, row string, said int, labels string, f string, m int, start int"
RULES = licenses.all_rules()
CONFIDENCE = {0: 0.5, 1: 1.0, 2: 0.9, 3: 0.7, 4: 0.3}


def sample(parsed, rng):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, arg in parsed:
        if op is C.LITERAL:
            out += chr(arg)
        elif op is C.IN:
            if arg[0][0] is C.NEGATE:
                out += rng.choice("abxyz")
            else:
                kind, x = rng.choice(arg)
                out += chr(x) if kind is C.LITERAL else chr(rng.randint(*x))
        elif op is C.NOT_LITERAL:
            out += rng.choice("abxyz")
        elif op is C.MAX_REPEAT:
            low, high, inner = arg
            for _ in range(rng.randint(low, min(high, low + 3))):
                out += sample(inner, rng)
        elif op is C.SUBPATTERN:
            out += sample(arg[-1], rng)
        elif op is C.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        else:
            raise AssertionError(op)
    return out


def words(text):
    small = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def brute(text):
    own = words(text)
    padded = "".join(f" {w} " for w in own)
    found = []
    for no, (tier, label, _, pattern) in enumerate(RULES):
        for m in re.finditer(licenses.over_words(pattern), padded):
            found.append((padded[: m.start()].count(" ") // 2, padded[: m.end()].count(" ") // 2, tier, no, label))
    kept = []
    for start, stop, tier, no, label in found:
        inside = [
            e for e in found
            if tier and e[2] and e[2] <= tier and e[0] <= start and e[1] >= stop
            and (e[2] < tier or e[1] - e[0] > stop - start or (e[1] - e[0] == stop - start and e[3] < no))
        ]
        if not inside:
            kept.append((start, stop, label, tier))
    base = [f for f in found if f[2] == 0]
    return (
        len(own), len(base), min((f[0] for f in base), default=None), max((f[0] for f in base), default=None),
        sorted({f[4] for f in base}), sorted({k[2] for k in kept}),
        max((CONFIDENCE[k[3]] for k in kept), default=0.0), sorted(kept),
    )


def run(spark, rows):
    df = spark.createDataFrame([(*r, "a", 1, "b", "c", 2, 3) for r in rows], SCHEMA).repartition(3)
    found = licenses.scan_licenses(df).collect()
    return sorted([(r.doc_id, (*r[1:8], [tuple(x) for x in r.detections])) for r in found], key=str)


def expected(rows):
    return sorted([(doc, brute(text)) for doc, text in rows], key=str)


def test_hundreds_of_rules_each_with_its_keyword():
    assert len(RULES) > 300
    rng = random.Random(1)
    for _, _, keyword, pattern in RULES:
        for _ in range(20):
            text = sample(_parser.parse(pattern), rng)
            assert keyword in text.split(" "), (keyword, pattern, text)
            assert re.fullmatch(licenses.over_words(pattern), licenses.over_words(text))


def test_made_texts(spark):
    rng = random.Random(2)
    parsed = [_parser.parse(r[3]) for r in RULES]
    rows = []
    for k in range(len(RULES)):
        picks = [parsed[k], *rng.choices(parsed, k=3)]
        noise = rng.choices(["the", "word", "of", "version", "3", "0", "by", "cc", "license", "é"], k=12)
        parts = [*(sample(p, rng) for p in picks), *noise]
        rng.shuffle(parts)
        text = rng.choice([" ", ", ", "\n", " - "]).join(parts)
        rows.append((k, text.upper() if k % 7 == 0 else text))
    assert run(spark, rows) == expected(rows)


def test_odd_rows(spark):
    notice = "Released under CC-BY 4.0. All rights reserved"
    rows = [
        (1, None), (2, ""), (3, " .,\n"), (None, notice), (4, notice), (4, notice), (5, "cc by cc by, CC-by"),
        (6, "word " * 30_000 + notice + " word" * 30_000), (7, "all rights reserved " * 3_000),
        (8, "ALL RíGHTS RESERVED Kelvin cc\x00by"), (9, "GNU General Public License version 3"),
    ]
    assert run(spark, rows) == expected(rows)


def test_longer_detections_win(spark):
    (row,) = run(spark, [(1, "GNU General Public License version 3, or see the LGPL.")])
    assert row[1][4:6] == (["gpl"], ["gpl", "gpl-3.0", "lgpl"])
    assert [d[:3] for d in row[1][7]] == [(0, 4, "gpl"), (1, 4, "gpl"), (1, 6, "gpl-3.0"), (9, 10, "lgpl")]


def test_phrases_that_overlap_themselves():
    with pytest.raises(ValueError):
        licenses.all_rules([("a b a", "x")])


def test_nothing(spark):
    assert run(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = queries.QUERIES["op11_license_scans"](spark, SF_DIR)
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow"))


def test_query_as_sql(spark, duck):
    got = queries.QUERIES["op11_license_scans"](spark, SF_DIR)
    want = duck.sql(queries.ORACLE["op11_license_scans"])
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=str)
