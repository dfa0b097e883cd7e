"""Neighbour lists against brute force, with blocks small enough that all steps take part."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import plan_of
from nearfold.operators import heads, products, topk
from nearfold.operators.shapes import as_arrays, as_long, as_wide, wide_to_arrays
from nearfold.operators.topk import cosine_topk, neighbour_lists
from nearfold.session import shared_dir


def brute(texts: dict, k: int, pad: bool = True) -> dict:
    counts = {i: Counter(re.findall(r"\w\w+", t.lower())) for i, t in texts.items()}
    norm = {i: sum(v * v for v in c.values()) for i, c in counts.items()}
    lists = {}
    for i, c in counts.items():
        scored = []
        for j, d in counts.items():
            if i == j:
                continue
            dot = sum(n * d[t] for t, n in c.items())
            score = dot / np.sqrt(float(norm[i]) * float(norm[j])) if dot else 0.0
            if score > 0 or pad:
                scored.append((-score, j))
        lists[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return lists


def run(spark, texts: dict, k: int, kind: str = "bigint", **options) -> dict:
    df = spark.createDataFrame(list(texts.items()), f"id {kind}, text string").repartition(3)
    rows = neighbour_lists(df, "id", "text", k, **options).collect()
    assert len(rows) == len(texts)
    return {r.target_id: [(n.id, n.score) for n in r.neighbours] for r in rows}


corpora = st.integers(0, 10_000)


def corpus(seed: int, n: int = 60) -> dict:
    """Few words with very uneven use, so ties, copies, multiples and empty texts all occur."""
    rng = np.random.default_rng(seed)
    vocab = np.array(["the", "of", "aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "ii", "jj"])
    weight = 1.0 / np.arange(1, 13)
    return {
        int(i): " ".join(rng.choice(vocab, rng.integers(0, 7), p=weight / weight.sum()))
        for i in rng.permutation(n)
    }


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(corpora)
def test_equals_brute_force_in_small_blocks(spark, seed):
    texts = corpus(seed)
    assert run(spark, texts, 4, block_rows=5) == brute(texts, 4)


def test_without_fill_and_in_one_block(spark):
    texts = corpus(7, 40)
    assert run(spark, texts, 3, pad_zero=False) == brute(texts, 3, pad=False)


@pytest.mark.parametrize("side", [1, 2, 5])
def test_tiles_of_several_blocks(spark, monkeypatch, side):
    monkeypatch.setattr(topk, "TILE_SIDE", side)
    monkeypatch.setattr(products, "SLICE_ROWS", 3)
    monkeypatch.setattr(topk, "MAX_SLOTS", 3)
    texts = corpus(11)
    assert run(spark, texts, 4, block_rows=6) == brute(texts, 4)


def test_hot_keys_are_spread(spark, monkeypatch):
    """With a low limit for `hot`, every spreading path is taken; results must not change."""
    monkeypatch.setattr("nearfold.operators.joins.HOT_KEYS", 20)
    monkeypatch.setattr(topk, "HOT_KEYS", 20)
    texts = corpus(13, 90)
    texts.update({1000 + i: "the same text" for i in range(45)})
    assert run(spark, texts, 5, block_rows=8) == brute(texts, 5)


def test_text_ids(spark):
    texts = {f"tt{i}": t for i, t in corpus(3, 40).items()}
    texts["é"] = texts["tt1"]
    assert run(spark, texts, 4, kind="string", block_rows=6) == brute(texts, 4)


def test_more_copies_than_neighbours(spark):
    texts = {i: "Same words here" for i in range(14)} | {50: "same words", 51: "other thing"}
    lists = run(spark, texts, 10)
    for i in range(14):
        assert lists[i] == [(j, 1.0) for j in range(14) if j != i][:10]
    assert lists == brute(texts, 10)


def test_multiples_score_exactly_one(spark):
    texts = {i: " ".join(["ab cd cd"] * (i + 1)) for i in range(13)}
    lists = run(spark, texts, 10, block_rows=3)
    assert all(score == 1.0 for row in lists.values() for _, score in row)
    assert lists == brute(texts, 10)


def test_no_tokens_and_null_text(spark):
    texts = {1: "? ! a", 2: "ab cd", 3: "ab", 4: None}
    lists = run(spark, texts, 2)
    assert lists[1] == [(2, 0.0), (3, 0.0)]
    assert lists[4] == [(1, 0.0), (2, 0.0)]
    assert lists[2][0][0] == 3 and lists[2][1] == (1, 0.0)


def test_nothing_shared_at_all(spark):
    texts = {1: "ab", 2: "cd", 3: ""}
    assert run(spark, texts, 2) == brute(texts, 2)
    assert run(spark, texts, 2, pad_zero=False) == {1: [], 2: [], 3: []}


def test_empty_corpus(spark):
    assert run(spark, {}, 3) == {}


def test_small_corpus_gives_short_lists(spark):
    texts = {i: f"word w{i}" for i in range(5)}
    df = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    lists = neighbour_lists(df, "id", "text")
    wide = as_wide(lists).orderBy("target_id").first()
    assert [wide[f"top{i}"] for i in range(1, 11)] == [1, 2, 3, 4] + [None] * 6
    assert [wide[f"score{i}"] for i in range(5, 11)] == [None] * 6
    assert as_arrays(lists).filter("size(titles) <> 4 OR size(scores) <> 4").isEmpty()
    again = wide_to_arrays(as_wide(lists), "target_id").orderBy("target_id").collect()
    assert again == as_arrays(lists).orderBy("target_id").collect()


def test_ids_must_be_unique(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "cd")], "id bigint, text string")
    with pytest.raises(ValueError, match="unique"):
        cosine_topk(df, "id", "text")


def test_chosen_targets_get_the_same_lists(spark):
    texts = {**corpus(11, 40), 900: "", 901: "? !", 902: "zzz alone"}
    df = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    every = {r.target_id: r.neighbours for r in neighbour_lists(df, "id", "text", 4).collect()}
    some = [min(texts), 900, 901, 902, max(corpus(11, 40))]
    got = {r.target_id: r.neighbours for r in topk.neighbours_of(df, "id", "text", some, 4).collect()}
    assert got == {t: every[t] for t in some}
    short = topk.neighbours_of(df, "id", "text", [902], 4, pad_zero=False).first()
    assert short.neighbours == []
    with pytest.raises(ValueError, match="unknown"):
        topk.neighbours_of(df, "id", "text", [5555])
    with pytest.raises(ValueError, match="at most"):
        topk.neighbours_of(df, "id", "text", list(range(2000)))


def test_plans(spark, monkeypatch):
    """No pair product, no row-wise Python, and the rank limit runs before the shuffle."""
    plans = {}

    def watched(step):
        def freeze(*args):
            plans[args[-1]] = plan_of(args[-2])
            return step(*args)

        return freeze

    monkeypatch.setattr(topk, "freeze", watched(topk.freeze))
    monkeypatch.setattr(topk.Steps, "freeze", watched(topk.Steps.freeze))
    run(spark, corpus(5), 4, block_rows=6)
    assert {"rows", "groups", "vocabulary", "ordered", "vectors", "own", "peaks", "heads", "met", "ranked", "lists"} == set(plans)
    for plan in plans.values():
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "BatchEvalPython" not in plan
    limit = plans["groups"].index("row_number(), 5, Partial")
    assert limit > plans["groups"].index("Exchange hashpartitioning(digest")
    assert "row_number(), 5, Partial" in plans["ranked"]


def test_blocks_end_at_rows_or_postings(spark, monkeypatch):
    """A few very long texts between short ones: no block passes either bound by more than one row."""
    monkeypatch.setattr(topk, "MAX_BLOCK_POSTINGS", 120)
    texts = {i: " ".join(f"w{(i * j) % 90}" for j in range(80 if i % 9 == 0 else 6)) for i in range(1, 120)}
    seen = {}
    step = topk.Steps.freeze

    def freeze(self, df, name):
        seen[name] = step(self, df, name)
        if name == "vectors":
            seen["rows"] = seen[name].selectExpr("block", "size(terms) AS n").collect()
        return seen[name]

    monkeypatch.setattr(topk.Steps, "freeze", freeze)
    df = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    lists = topk.neighbour_lists(df, "id", "text", 3, block_rows=10).count()
    blocks = {}
    for r in seen["rows"]:
        blocks.setdefault(r.block, []).append(r.n)
    assert lists == len(texts) and len(blocks) > 5
    assert all(len(b) <= 10 and sum(b) - max(b) <= 120 for b in blocks.values())


def test_steps_are_removed(spark):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "nearfold"
    before = set(folder.glob("steps-*")) if folder.exists() else set()
    run(spark, corpus(9, 30), 3, block_rows=6)
    assert set(folder.glob("steps-*")) == before


def test_wide_tiles_hold_many_blocks(spark, monkeypatch):
    # Blocks travel once for each tile; with many blocks of bounded size on a side they meet in few tiles.
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(i, " ".join(words[(i * j) % 6] for j in range(1, 4)) + f" w{i % 45}") for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    plain = sorted(topk.cosine_topk(df, "id", "text", 5, block_rows=200).collect())
    monkeypatch.setattr(topk, "MAX_BLOCK_POSTINGS", 30)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 1))
    with_tiles = topk.cosine_topk(df, "id", "text", 5, block_rows=4)
    assert sorted(with_tiles.collect()) == plain


def test_frequent_terms_are_numbered_without_a_shuffle(spark, monkeypatch):
    from nearfold.operators import dictionary

    rows = [(i, t, 1 + i % 2) for i in range(20) for t in ("the", f"w{i % 10}")]
    counts = spark.createDataFrame(rows, "id bigint, term string, tf bigint")
    terms = dictionary.term_dictionary(counts)
    number = {r.term: (r.number, r.df) for r in terms.collect()}
    # With a bound of 3, one term is frequent; the shuffled side leaves it out.
    for bound in (1, 3, 1 << 16):
        monkeypatch.setattr(dictionary, "FREQUENT", bound)
        found = dictionary.sparse_postings(counts, terms)
        assert sorted((r.id, r.number, r.df, r.tf) for r in found.collect()) == sorted(
            (i, *number[t], tf) for i, t, tf in rows
        )
        assert "_hot" not in plan_of(found) and "Union" in plan_of(found)


def test_offers_are_ranked_by_as_many_tasks_as_they_need(spark, monkeypatch):
    written, freeze = {}, topk.Steps.freeze

    def freeze_and_note(self, df, name):
        written[name] = freeze(self, df, name)
        return written[name]

    monkeypatch.setattr(topk.Steps, "freeze", freeze_and_note)
    monkeypatch.setattr(topk.Steps, "__exit__", lambda *_: None)
    monkeypatch.setattr(topk, "MAX_OFFERS", 20, raising=False)
    texts = corpus(5, 200)
    got, want = run(spark, texts, 4, block_rows=5), brute(texts, 4)
    assert {i: [j for j, _ in x] for i, x in got.items()} == {i: [j for j, _ in x] for i, x in want.items()}
    assert len(written["ranked"].inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("dear, next_rows, seed", [(1, 4, 21), (2, 9, 22), (1000, 4, 23)])
def test_targets_meet_the_rows_of_their_rarest_terms(spark, monkeypatch, dear, next_rows, seed):
    """Rare and frequent terms, slices and targets that meet all rows, all in small parts; no tile is made."""
    monkeypatch.setattr(topk, "HEAD_BLOCKS", 2)
    monkeypatch.setattr(topk, "_score_tiles", None)
    sizes = {"RARE": 10, "RARE_ROWS": 4, "FEW_ROWS": 1, "COMMON": 5, "BUCKET_ROWS": 20, "TARGET_ROWS": 9, "MAX_COPIES": 1 << 40, "UNBOUND": 1}
    for name, value in (sizes | {"DEAR": dear, "NEXT_ROWS": next_rows}).items():
        monkeypatch.setattr(heads, name, value)
    monkeypatch.setattr(products, "PACK_ROWS", 6)
    monkeypatch.setattr(products, "OTHER_ROWS", 7)
    rng = np.random.default_rng(seed)
    texts = {i: f"{t} all d{rng.integers(30)} d{rng.integers(30)} e{rng.integers(8)}" for i, t in corpus(seed, 130).items()}
    assert run(spark, texts, 4, block_rows=9) == brute(texts, 4)


def test_rows_whose_rare_terms_nobody_shares_need_no_tiles(spark, monkeypatch):
    """One weak target in a block made all its targets meet all blocks."""
    monkeypatch.setattr(heads, "RARE", 60)
    monkeypatch.setattr(heads, "FEW_ROWS", 1)
    monkeypatch.setattr(heads, "NEXT_ROWS", 40)
    monkeypatch.setattr(topk, "HEAD_BLOCKS", 8)
    tiles = []
    monkeypatch.setattr(topk, "_score_tiles", lambda *a: tiles.append(a))
    texts = {
        i: f"movie brand a{i % 6} b{i % 5} c{i % 7} " + (f"own{i} own{i}" if i % 20 == 0 else f"nm{i // 15} nm{i // 15} nm{i // 15}")
        for i in range(900)
    }
    assert run(spark, texts, 4, block_rows=45) == brute(texts, 4) and not tiles


def test_long_texts_meet_in_tiles(spark, monkeypatch):
    """Rows with many rare terms are not sent once for each of them, nor looked at a second time."""
    monkeypatch.setattr(topk, "HEAD_BLOCKS", 2)
    monkeypatch.setattr(topk, "raised", None)
    monkeypatch.setattr(heads, "RARE", 4)
    rng = np.random.default_rng(3)
    texts = {i: " ".join(f"w{n}" for n in rng.integers(0, 300, 40)) for i in range(80)}
    assert run(spark, texts, 4, block_rows=9) == brute(texts, 4)
