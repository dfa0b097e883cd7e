"""Lists kept under insertions against brute force over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_topk import brute, corpus

from nearfold.operators import heads, rescoring
from nearfold.operators.rescoring import NeighbourState
from nearfold.plans import recommend


def frame(spark, texts, kind="bigint"):
    return spark.createDataFrame(list(texts.items()), f"id {kind}, text string").repartition(3)


def lists(state):
    return {r.target_id: [(n.id, n.score) for n in r.neighbours] for r in state.neighbours().collect()}


def added(spark, path, batches, k, kind=T.LongType()):
    state = NeighbourState(spark, str(path), kind, k)
    for texts in batches:
        state.add(frame(spark, texts, kind.simpleString()), "id", "text")
    return state


@pytest.mark.parametrize("rows_per_scan", [7, 4096])
def test_three_batches_equal_one(spark, tmp_path, monkeypatch, rows_per_scan):
    monkeypatch.setattr(rescoring, "ROWS_PER_SCAN", rows_per_scan)
    texts = corpus(5, 90)
    order = sorted(texts, key=lambda i: (i * 37) % 91)  # later batches bring smaller ids too
    batches = [{i: texts[i] for i in order[a:z]} for a, z in ((0, 40), (40, 60), (60, 90))]
    state = added(spark, tmp_path, batches, 4)
    assert lists(state) == brute(texts, 4)
    without = {r.target_id: [(n.id, n.score) for n in r.neighbours] for r in state.neighbours(pad_zero=False).collect()}
    assert without == brute(texts, 4, pad=False)


def test_copies_arrive_later(spark, tmp_path):
    first = {i: "same words here" for i in range(20, 30)} | {50: "same words", 51: "other", 52: ""}
    later = {i: "same words here" for i in range(6)} | {53: "same words", 54: None, 55: "brand new words"}
    state = added(spark, tmp_path, [first, later], 4)
    texts = {i: t or "" for i, t in (first | later).items()}
    assert lists(state) == brute(texts, 4)


def test_text_ids(spark, tmp_path):
    texts = {f"tt{i}": t for i, t in corpus(3, 40).items()}
    batches = [dict(list(texts.items())[a::2]) for a in range(2)]
    assert lists(added(spark, tmp_path, batches, 3, T.StringType())) == brute(texts, 3)


def test_known_rows_and_empty_batches(spark, tmp_path):
    texts = corpus(8, 30)
    state = added(spark, tmp_path, [{}, texts, texts, {}, {1: "another text for a known id"}], 3)
    assert lists(state) == brute(texts, 3)


def test_stored_rows_are_not_scored_again(spark, tmp_path):
    """Lists with invented scores stay as they are, but for what new rows add."""
    texts = {i: f"word w{i} x{i % 3}" for i in range(12)}
    state = added(spark, tmp_path, [texts], 2)
    invented = F.transform("members", lambda m: F.struct(m["id"].alias("id"), F.lit(0.875).alias("score")))
    stored = state.lists.latest().withColumn("members", invented).cache()
    before = {bytes(r.digest): r.members for r in stored.collect()}
    state.lists.append(stored, 0)
    state.vectors.append(state.vectors.read().withColumn("floor", F.lit(0.875)), 0)
    state.add(frame(spark, {100: "word w3 x0", 101: "nothing"}), "id", "text")
    after = {bytes(r.digest): r.members for r in state.lists.latest().collect()}
    changed = {d for d in before if after[d] != before[d]}
    assert len(changed) == 1 and len(after) == len(before) + 1
    (digest,) = changed
    assert [(m.id, m.score) for m in after[digest]][0] == (100, 1.0) and {m.score for m in after[digest][1:]} == {0.875}


def test_a_batch_that_fails_is_taken_up_again(spark, tmp_path, monkeypatch):
    texts = corpus(4, 50)
    first, second = ({i: t for i, t in texts.items() if i % 2 == r} for r in range(2))
    state = added(spark, tmp_path, [first], 3)
    append, rows = state.lists.append, state.rows.append

    def fails(*_):
        raise OSError("no")

    monkeypatch.setattr(state.rows, "append", fails)
    with pytest.raises(OSError):
        state.add(frame(spark, second), "id", "text")
    assert append and state.rows.read().count() == len(first)
    monkeypatch.setattr(state.rows, "append", rows)
    state.add(frame(spark, second), "id", "text")
    assert lists(state) == brute(texts, 3)


def test_repeated_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, "ab"), (1, "cd")], "id bigint, text string")
    with pytest.raises(ValueError, match="unique"):
        NeighbourState(spark, str(tmp_path), T.LongType()).add(df, "id", "text")


def test_content_table(spark, tmp_path):
    rows = [(f"tt{k}", f"Title {k % 4}", "movie", "drama,comedy", "A", "B", f"nm{k % 3}", "nm9") for k in range(9)]
    names = ["tconst", "primaryTitle", "titleType", "genres", "runtimeCategory", "yearCategory", "directors_id", "writers_id"]
    content = spark.createDataFrame(rows, names)
    state = recommend.score_state(spark, str(tmp_path), content)
    recommend.rescore(state, content.limit(4))
    recommend.rescore(state, content)
    want = recommend.score_table(content).orderBy("tconst").collect()
    assert recommend.state_table(state).orderBy("tconst").collect() == want


@pytest.mark.parametrize("dear", [1, 2, 1000])
def test_large_batches_meet_by_the_rarest_terms(spark, tmp_path, monkeypatch, dear):
    """Stored and added targets, copies that arrive later, short lists; no scan is made."""
    monkeypatch.setattr(rescoring, "MANY_SCANS", 0)
    monkeypatch.setattr(rescoring, "scan_scorer", None)
    sizes = {"RARE": 10, "RARE_ROWS": 4, "FEW_ROWS": 1, "COMMON": 5, "BUCKET_ROWS": 20, "TARGET_ROWS": 9, "NEXT_ROWS": 6}
    for name, value in (sizes | {"MAX_COPIES": 1 << 40, "UNBOUND": 1, "DEAR": dear}).items():
        monkeypatch.setattr(heads, name, value)
    rng = np.random.default_rng(dear)
    texts = {i: f"{t} all d{rng.integers(30)} d{rng.integers(30)} e{rng.integers(8)}" for i, t in corpus(dear, 130).items()}
    texts |= {200 + i: texts[i] for i in range(0, 130, 9)} | {300: "", 301: None, 302: "alone"}
    order = sorted(texts, key=lambda i: (i * 37) % 91)
    batches = [{i: texts[i] for i in order[a:z]} for a, z in ((0, 70), (70, 110), (110, 200))]
    texts = {i: t or "" for i, t in texts.items()}
    assert lists(added(spark, tmp_path, batches, 4)) == brute(texts, 4)
