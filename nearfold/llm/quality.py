"""Quality scores by votes of the nearest labelled texts.

A text becomes counts of three byte classes in a row (letters by kind, marks by kind, digits, white
space), damped and weighted by rarity, next to the shape of its repetition and its length. A truncated
singular value decomposition, fitted on a bounded sample of labelled texts, turns this into a latent
vector. The sample's vectors are broadcast; each text is multiplied with all of them in blocks, and
its `NEIGHBOURS` nearest by cosine vote with a weight that grows with their similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.batches import least_hashed, slices, some_of_each
from nearfold.llm.words import located_words

#: Most labelled texts of each class in the sample; the bound of what is collected and broadcast.
SAMPLE = 3000
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 8
ACCEPT = 0.7
_KINDS = 12
_SHAPES = 20
_WIDTH = _KINDS**3 + _SHAPES
_BLOCK = 1024
#: Texts that a task measures and scores at once: their features and their cosines with the whole sample stand in memory.
_TEXTS = 256


def _kinds() -> np.ndarray:
    kind = np.full(256, 9, dtype=np.int64)  # other ASCII marks
    for chars, k in ((" \t\r\x0b\x0c", 0), ("\n", 1), ("aeiou", 2), (".", 5), (",;:", 6), ("!?", 7), ("|", 8), ("'\"()-", 10)):
        kind[list(chars.encode())] = k
    kind[[b for b in range(97, 123) if chr(b) not in "aeiou"]] = 3
    kind[65:91] = 4
    kind[48:58] = 11
    kind[128:] = 3
    return kind


_KIND = _kinds()


def features(raws: list[bytes]) -> np.ndarray:
    """One row per text: damped counts of kind triples, then one-hot shapes of repetition and length."""
    triples = _KINDS**3
    out = np.zeros((len(raws), triples + _SHAPES), dtype=np.float32)
    for k, raw in enumerate(raws):
        kind = _KIND[np.frombuffer(raw, dtype=np.uint8)]
        if len(kind) > 2:
            codes = (kind[:-2] * _KINDS + kind[1:-1]) * _KINDS + kind[2:]
            counts = np.bincount(codes, minlength=triples)
            out[k, :triples] = np.sqrt(counts / len(codes))
    words, _, _, counts = located_words(raws)
    ends = np.cumsum(counts)
    for k, (a, z) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
        n = z - a
        fresh = len(np.unique(words[a:z])) / n if n else 0.0
        out[k, triples + (min(int(fresh * 10), 9) if n else 10)] = 0.6
        out[k, triples + 11 + min(n.bit_length() // 2, _SHAPES - 12)] = 0.1
    return out


@dataclass
class Model:
    """A latent space and the labelled vectors in it."""

    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def embed(self, rows: np.ndarray) -> np.ndarray:
        latent = (rows * self.rarity) @ self.basis
        norms = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, norms, out=np.zeros_like(latent), where=norms > 0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 in the votes of the nearest labelled vectors; 0.5 without any vote."""
        out = np.full(len(rows), 0.5)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(rows), _BLOCK):
            near = self.embed(rows[a : a + _BLOCK]) @ self.vectors.T
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            votes = np.maximum(np.take_along_axis(near, best, axis=1).astype(np.float64), 0.0) ** SHARPNESS
            votes *= self.weights[best]
            total = votes.sum(axis=1)
            good = (votes * self.labels[best]).sum(axis=1)
            out[a : a + _BLOCK] = np.divide(good, total, out=np.full(len(total), 0.5), where=total > 0)
        return np.clip(out, 0.0, 1.0)


def scores_of(model: Model, raws: list[bytes]) -> np.ndarray:
    return np.concatenate([model.score(features(raws[a : a + _TEXTS])) for a in range(0, len(raws), _TEXTS)])


def fit_rows(rows: np.ndarray, labels: np.ndarray) -> Model:
    return _fit_blocks(lambda: (rows[a : a + _BLOCK] for a in range(0, len(rows), _BLOCK)), labels)


def _fit_blocks(blocks: Callable[[], Iterator[np.ndarray]], labels: np.ndarray) -> Model:
    """A model of the rows that each call of `blocks` gives, a block at a time; there is no matrix of all."""
    if not len(labels):
        none = np.zeros((0, 1), dtype=np.float32)
        return Model(np.ones(_WIDTH, np.float32), np.zeros((_WIDTH, 1), np.float32), none, labels, np.zeros(0))
    held = sum((block > 0).sum(axis=0) for block in blocks())
    rarity = (1.0 + np.log((1 + len(labels)) / (1 + held))).astype(np.float32)
    # The Gram matrix is as wide as the features, however many texts there are.
    gram = np.zeros((len(held), len(held)))
    for block in blocks():
        weighted = block * rarity
        gram += weighted.T @ weighted
        del weighted
    _, vectors = np.linalg.eigh(gram)
    basis = vectors[:, ::-1][:, : min(DIMENSIONS, len(labels))].astype(np.float32)
    del gram, vectors
    model = Model(rarity, basis, np.zeros((0, 1)), labels, np.zeros(0))
    model.vectors = np.concatenate([model.embed(block) for block in blocks()])
    # Classes vote as if they were equally frequent in the sample.
    share = np.array([max((labels == c).mean(), 1e-9) for c in (0, 1)])
    model.weights = 0.5 / share[labels]
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model of at most `sample` texts of each label 0 and 1, those with the least hash of their id.

    Labels without an id, a text row or a value of 0 or 1 are left out. Of rows of `docs` that share
    an id at most eight are learned from.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)")
    chosen = F.broadcast(least_hashed(known.distinct(), "id", "label", sample))  # twice `sample` pairs at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in slices(batches, "text"):
            found = [x.tobytes() for x in features(raws)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["id", "label", "row"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = rows.select("id", "text", "label").mapInArrow(measure, f"id {kind}, label int, row binary")
    # Ids may repeat in `docs`: of the rows with one id eight are learned from.
    found = some_of_each(rows, ["id", "label"], "row")
    # What rows are ordered by, the driver samples: a hash and not the row, which is some thousand bytes.
    found = found.orderBy("id", "label", F.xxhash64("row")).select("label", "row")
    # Most counts of a row are 0: it goes to the driver packed, stays so, and is unpacked a block at a time.
    found = found.mapInArrow(_pack, "label int, row binary").toArrow()

    def blocks() -> Iterator[np.ndarray]:
        for a in range(0, len(found), _BLOCK):
            raws = [zlib.decompress(x) for x in found.column("row").slice(a, _BLOCK).to_pylist()]
            yield np.frombuffer(b"".join(raws), dtype=np.float32).reshape(-1, _WIDTH)

    return _fit_blocks(blocks, found.column("label").to_numpy().astype(np.int64))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = pa.array([zlib.compress(x.as_py(), 1) for x in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["label", "row"])


def _score(model: Model, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in slices(batches, text):
            scores = pa.array(scores_of(model, raws))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return score


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, score` for every row: 0 to 1, higher where label 1 is likelier.

    Null texts are empty; an empty text is scored by its shape like any other. Without labelled texts
    every score is 0.5. Repeated rows and ids are scored each for itself. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_score(model, "text"), f"doc_id {kind}, text string, score double")
    return scored.select("doc_id", "score")


def accepted_documents(
    docs: DataFrame, model: Model, text_col: str = "text", accept: float = ACCEPT
) -> DataFrame:
    """The rows of `docs` whose score is at least `accept`, with all their columns."""
    column = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices([batch], batch.schema.names[column]):
                yield part.filter(pa.array(scores_of(model, raws) >= accept))

    return docs.mapInArrow(keep, docs.schema)
