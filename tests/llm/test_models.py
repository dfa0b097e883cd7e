"""Quality and language models: held-out accuracy, and defined results for odd rows."""

import zlib

import numpy as np
import pytest

from nearfold.llm import language, quality, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, score string, label int"
ODD = [(1, None, "en"), (2, "", None), (3, "12 -- ?", "en"), (3, "word " * 20000, "en"),
       (None, "été où la forêt", "fr"), (7, "été où la forêt " * 40, "fr")]


def crc(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


def test_quality_query(spark):
    got = queries.QUERIES["op6_quality_classifier"](spark, SF_DIR).toPandas().set_index("doc_id")
    assert got.index.is_unique and len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert (got.held_out == [crc(i, 4) == 2 for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().set_index("doc_id")
    known = labels.join(got[got.held_out], how="inner")
    good, bad = (known[known.quality == k].score.to_numpy() for k in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (known.predicted == known.quality).mean() > 0.95


def odd(spark):
    return spark.createDataFrame([(d, t, lang, "x", 1) for d, t, lang in ODD], SCHEMA)


def test_quality_of_odd_rows(spark):
    docs = odd(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    empty = quality.fit(docs, none)
    assert [r.score for r in quality.score_quality(docs, empty).collect()] == [0.5] * len(ODD)
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None), (None, 1), (8, 1), (2, 7)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    assert sorted(model.labels.tolist()) == [0, 1, 1]
    scored = quality.score_quality(docs, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    kept = quality.accepted_documents(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.score >= quality.ACCEPT for r in scored)
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_labelled_rows_reach_the_driver_packed(spark, monkeypatch):
    # As they are, with their matrix and in the JVM, they took hundreds of MB of the driver's memory.
    texts = [(k, f"plain words of text {k} and " * (k % 7 + 1) if k % 2 else f"| {k} | {k * 7} |\n" * (k % 5 + 1)) for k in range(1500)]
    texts.append((3, "another text of three"))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1500)], "doc_id bigint, quality int")
    rows = sorted((k, k % 2, row.tobytes()) for (k, _), row in zip(texts, quality.features([t.encode() for _, t in texts])))
    matrix = np.frombuffer(b"".join(r for *_, r in rows), dtype=np.float32).reshape(len(rows), -1)
    sizes, to_arrow = [], type(docs).toArrow

    def sized(df):
        found = to_arrow(df)
        sizes.append(found.nbytes)
        return found

    monkeypatch.setattr(type(docs), "toArrow", sized)
    model = quality.fit(docs, labels)
    assert len(sizes) == 1 and 0 < sizes[0] < matrix.nbytes / 5
    expected = quality.fit_rows(matrix, np.array([label for _, label, _ in rows]))
    assert model.labels.tolist() == expected.labels.tolist() and np.array_equal(model.rarity, expected.rarity)
    assert model.vectors.shape == (1501, quality.DIMENSIONS)
    assert np.allclose(model.score(matrix), expected.score(matrix), atol=1e-4)


def test_votes_are_those_of_all_cosines():
    rng = np.random.default_rng(1)
    rows = rng.random((300, quality._KINDS**3 + quality._SHAPES)).astype(np.float32) * (rng.random(300) < 0.9)[:, None]
    labels = (rng.random(300) < 0.4).astype(np.int64)
    model = quality.fit_rows(rows[:200], labels[:200])
    got = model.score(rows[200:])
    latent = model.embed(rows[200:])
    for score, v in zip(got, latent):
        near = [(float(v @ w), k) for k, w in enumerate(model.vectors)]
        best = sorted(near, reverse=True)[: quality.NEIGHBOURS]
        votes = [(max(c, 0.0) ** quality.SHARPNESS * model.weights[k], labels[k]) for c, k in best]
        total = sum(v for v, _ in votes)
        want = sum(v for v, y in votes if y) / total if total else 0.5
        assert score == pytest.approx(want, abs=1e-4)


def test_language_query(spark):
    got = queries.QUERIES["op7_language_id"](spark, SF_DIR).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().set_index("doc_id")
    assert got.index.is_unique and len(got) == len(docs)
    assert (got.held_out == [crc(i, 3) == 1 for i in got.index]).all() and got.score.between(0, 1).all()
    both = got[got.held_out].join(docs)
    assert (both.lang_pred == both.lang).mean() > 0.97


def test_language_of_odd_rows(spark):
    docs = odd(spark)
    nothing = language.fit(docs.limit(0))
    assert [(r.lang_pred, r.score) for r in language.predict(docs, nothing).collect()] == [("und", 0.0)] * len(ODD)
    rows = language.predict(docs, language.fit(docs)).collect()
    assert [r.lang_pred for r in rows] == ["und", "und", "und", "en", "fr", "fr"]
    assert [r.score for r in rows[:3]] == [0.0] * 3 and all(0 <= r.score <= 1 for r in rows)


def test_code_switched_text():
    rng = np.random.default_rng(3)
    words = {"a": [f"{x}ing" for x in "bcdfgh"], "b": [f"{x}ung" for x in "bcdfgh"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang], n))
    labels = ["a", "b"] * 40
    model = language.train([text(x, 40).encode() for x in labels], labels)
    chance, counts = model.texts([(text("a", 150) + " " + text("b", 50)).encode(), text("b", 3).encode()])
    assert counts.tolist() == [200, 3]
    assert chance[0] == pytest.approx([0.75, 0.25], abs=0.03) and chance[1][1] > 0.9


def test_forward_backward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(4)
    model = language.Field(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)))
    scores, sizes = rng.normal(size=(2, 4, 3)), np.array([4, 2])
    found, expected = model.marginals(scores, sizes)
    total = np.zeros((3, 3))
    for c, n in enumerate(sizes):
        weight = np.zeros((n, 3))
        moves, z = np.zeros((3, 3)), 0.0
        for path in np.ndindex(*(3,) * n):
            p = np.exp(sum(scores[c, t, y] for t, y in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
            z += p
            for t, y in enumerate(path):
                weight[t, y] += p
            for a, b in zip(path, path[1:]):
                moves[a, b] += p
        assert found[c, :n] == pytest.approx(weight / z)
        total += moves / z
    assert expected == pytest.approx(total)
