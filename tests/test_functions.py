import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearfold.fixed import (
    CLASS_LABELS,
    PANDAS_NULL_TOKENS,
    RUNTIME_EDGES,
    YEAR_EDGES,
)
from nearfold.functions.nulls import normalize_nulls
from nearfold.functions.numbers import bin_right_closed, cast_trunc, round_half_even
from nearfold.functions.text import (
    combined_text,
    cosine,
    dot_product,
    squared_norm,
    term_counts,
    tokens,
)
from nearfold.operators.filters import dropna_any, reject_list

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_null_tokens(spark):
    df = spark.createDataFrame([("\\N",), ("",), ("None",), ("NULL",), ("N/A",), ("null",), ("Null",)], "t string")
    assert [r.t for r in normalize_nulls(df).collect()] == [None, None, "None", "NULL", "N/A", "null", "Null"]
    wide = normalize_nulls(df, tokens=PANDAS_NULL_TOKENS)
    assert [r.t for r in wide.collect()] == [None] * 6 + ["Null"]
    assert normalize_nulls(df, tokens=[]).first().t == "\\N"


def test_cast_trunc(spark):
    got = column(spark, ["95.7", "-3.9", "12", "Drama", None, "nan", "1e30"], "string", cast_trunc)
    assert got == [95, -3, 12, None, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["Drama"], "string", lambda c: cast_trunc(c, strict=True))


def test_bin_edges(spark):
    got = column(spark, [-1, 0, 10, 11, 120, 121, 9999, 10000, None], "int",
                 lambda c: bin_right_closed(c, RUNTIME_EDGES))
    assert got == ["nan", "A", "A", "B", "F", "G", "I", "nan", "nan"]
    got = column(spark, [1849, 1850, 1900, 1901, 1950, 1951, 2030, 2031], "int",
                 lambda c: bin_right_closed(c, YEAR_EDGES))
    assert got == ["nan", "A", "A", "B", "C", "D", "K", "nan"]


@few
@given(st.lists(st.floats(-100, 100) | st.integers(-5, 40), min_size=1, max_size=40))
def test_bins_equal_pandas_cut(spark, values):
    edges = [0, 5, 7.5, 30]
    want = pd.cut(pd.Series(values, dtype=float), edges, labels=CLASS_LABELS[:3], include_lowest=True)
    got = column(spark, [float(v) for v in values], "double", lambda c: bin_right_closed(c, edges))
    assert got == want.astype(str).tolist()


@few
@given(st.lists(st.integers(-10_000, 10_000).map(lambda i: i / 1000), min_size=1, max_size=50))
def test_round_half_even_equals_numpy(spark, values):
    assert column(spark, values, "double", round_half_even) == np.round(values, 2).tolist()


def test_token_examples(spark):
    texts = ["movie A Sci-Fi x nm01,nm02 L'été foo_bar", "cafés", "nan A K", "? ! a", ""]
    assert column(spark, texts, "string", tokens) == [
        ["movie", "sci", "fi", "nm01", "nm02", "été", "foo_bar"], ["cafe"], ["nan"], [], [],
    ]
    assert column(spark, ["A b"], "string", lambda c: tokens(c, min_len=1)) == [["a", "b"]]


words = st.text(st.sampled_from("abé_1 2-,.ß字"), max_size=40)


@few
@given(st.lists(words, min_size=1, max_size=20))
def test_term_counts_equal_python(spark, texts):
    want = [sorted(Counter(re.findall(r"(?u)\b\w\w+\b", t.lower())).items()) for t in texts]
    got = column(spark, texts, "string", term_counts)
    assert [[(r.term, r.tf) for r in row] for row in got] == [
        sorted(w, key=lambda p: p[0].encode()) for w in want
    ]
    norms = column(spark, texts, "string", lambda c: squared_norm(term_counts(c)))
    assert norms == [sum(n * n for _, n in w) for w in want]


@few
@given(st.lists(st.tuples(words, words), min_size=1, max_size=20))
def test_dot_product_and_score(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    a, b = term_counts(F.col("a")), term_counts(F.col("b"))
    dot = dot_product(a, b)
    score = cosine(dot, squared_norm(a), squared_norm(b))
    rows = df.orderBy("i").select(dot, score).collect()
    for (x, y), (d, s) in zip(pairs, rows, strict=True):
        cx, cy = (Counter(re.findall(r"\w\w+", t.lower())) for t in (x, y))
        assert d == sum(cx[t] * cy[t] for t in cx)
        assert 0.0 <= s <= 1.0
        if cx and cx == cy:
            assert s == 1.0
        if not cx or not cy:
            assert s == 0.0


def test_combined_text_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(combined_text(["x", "y"])).collect()] == ["a b", None]


def test_filters_treat_nulls_like_data_frames(spark):
    df = spark.createDataFrame([("x", 1.0), (None, 2.0), ("y", float("nan")), ("z", 3.0)], "t string, v double")
    assert [r.t for r in reject_list(df, "t", ["x"]).collect()] == [None, "y", "z"]
    assert [r.t for r in dropna_any(df).collect()] == ["x", "z"]


def test_counts_in_passing(spark):
    from nearfold.operators.counts import counted_stages, stage_counts

    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("x"))
    stages = {"even": F.col("id") % 2 == 0, "large": F.col("x") > 50}
    kept, left = counted_stages(df, stages)
    assert kept.count() == 20
    assert left() == {r.stage: r.n_rows for r in stage_counts(df, stages).collect()} == {"input": 100, "even": 50, "large": 20}


def test_collated_lookup(spark):
    from nearfold.operators.reads import get_row, row_lookup

    df = spark.createDataFrame([("AMÉLIE", 1), ("amelie", 2), ("Amélia", 3), (None, 4)], "k string, v int")
    assert [r.v for r in row_lookup(df, "k", "Amelie", "UNICODE_CI_AI").collect()] == [1, 2]
    assert row_lookup(df, "k", "Amelie").count() == 0
    with pytest.raises(KeyError):
        get_row(df, "k", "Emilie", "UNICODE_CI_AI")


def test_dictionary(spark):
    from nearfold.operators import dictionary

    texts = [(1, "bb aa aa"), (2, "cc bb"), (3, None), (4, "é aa zz")]
    rows, terms = dictionary.sparse_rows(spark.createDataFrame(texts, "id bigint, text string"), "id", "text")
    numbers = {r.term: r.number for r in terms.collect()}
    assert numbers == {"aa": 0, "bb": 1, "cc": 2, "zz": 3}
    got = {r.id: list(zip(r.numbers, r.tfs)) for r in rows.collect()}
    assert got == {1: [(0, 2), (1, 1)], 2: [(1, 1), (2, 1)], 3: [], 4: [(0, 1), (3, 1)]}
    later = spark.createDataFrame([(9, "aa", 1), (9, "ab", 1), (9, "zzz", 2)], "id bigint, term string, tf bigint")
    assert {r.term: r.number for r in dictionary.more_terms(terms, later).collect()} == {"ab": 4, "zzz": 5}


def test_numbers_without_gaps(spark):
    from nearfold.operators import dictionary

    terms = spark.range(5000).select(F.hex(F.xxhash64("id")).alias("term"))
    got = dictionary.numbered_terms(terms, first=7, ranges=13).collect()
    assert [r.term for r in sorted(got, key=lambda r: r.number)] == sorted(r.term for r in got)
    assert sorted(r.number for r in got) == list(range(7, 5007))
