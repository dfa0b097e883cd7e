"""The pipeline against brute force, stage by stage, and on odd rows."""

import random

import pytest
from test_decontaminate import brute as leaks
from test_jaccard import brute as groups
from test_suffix import brute as cuts
from test_token_ops import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from nearfold.llm import quality
from nearfold.llm.tokens import default_path

SF_DIR = "/root/testdata/sf0.001"


def stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def check(spark, sf_dir, tmp_path):
    docs, good, single, cut, clean, packed = stages(spark, sf_dir, tmp_path)
    for df in (good, single, cut, clean):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    rows = [[(r.doc_id, r.text) for r in df.collect()] for df in (docs, good, single, cut, clean)]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("crc32(cast(doc_id as string)) % 4 <> 2")
    scores = quality.fit(docs, labels).score(quality.features([(t or "").encode() for _, t in rows[0]]))
    assert sorted(map(str, rows[1])) == sorted(str(r) for r, s in zip(rows[0], scores) if s >= quality.ACCEPT)

    want, seen = [], set()
    for (doc_id, n, component), row in sorted(zip(groups(rows[1]), rows[1]), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if n == 0 or component not in seen and doc_id == component:
            want.append(row)
            seen.add(component)
    assert sorted((str(d), len(t or "")) for d, t in rows[2]) == sorted((str(d), len(t or "")) for d, t in want)

    kept = cuts([(t or "").encode() for _, t in rows[2]])
    want = [(d, None if t is None else k.decode("utf-8", "ignore")) for (d, t), (k, _) in zip(rows[2], kept)]
    assert sorted(map(str, rows[3])) == sorted(map(str, want))
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaky = {k for k, row in enumerate(rows[3]) if leaks([row], items)}
    assert sorted(map(str, rows[4])) == sorted(str(r) for k, r in enumerate(rows[3]) if k not in leaky)

    plain = Tokenizer.from_file(default_path())
    whole = sorted([*plain.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows[4])
    pieces = packed.collect()
    check_packing(pieces)
    by = {}
    for r in pieces:
        by.setdefault(r.doc_id, []).append(r)
    if len(by) == len(rows[4]):
        assert sorted(sum((p.ids for p in sorted(ps, key=lambda p: p.piece)), []) for ps in by.values()) == whole
    assert sum(r.length for r in pieces) == sum(map(len, whole))
    return rows


def test_stages(spark, tmp_path):
    rows = check(spark, SF_DIR, tmp_path)
    assert len(rows[0]) > len(rows[1]) > len(rows[2]) >= len(rows[4]) > 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert check_packing(out.collect()) > 0


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, tmp_path, empty):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    text = " ".join(rng.choices(words, k=100))
    rows = [
        (1, None), (2, ""), (3, text), (3, text), (4, text + " more"), (None, text), (None, "short"), (5, "é" * 300),
        (6, " ".join(rng.choices(words, k=30_000))), (7, "x " * 500), (8, " ".join(words[:60]) + " " + text[:250]),
        (9, " ".join(words[20:60])),
    ]
    docs = spark.createDataFrame(
        [(d, t, None, "s", len(t or "")) for d, t in rows if not empty],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    items = [] if empty else [(1, " ".join(words[:60])), (None, None), (2, "short")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [] if empty else [(2, 0, 0), (3, 1, 0), (6, 1, 1), (None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    monkey = pytest.MonkeyPatch()
    monkey.setattr(quality, "ACCEPT", 0.0)  # few labels tell little; let all rows reach the later stages
    monkey.setattr(quality.accepted_documents, "__defaults__", ("text", 0.0))
    try:
        if empty:
            assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
        else:
            check(spark, str(tmp_path), tmp_path)
    finally:
        monkey.undo()
