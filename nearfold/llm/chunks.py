"""Substring dedup by content-defined chunks.

A gear hash rolls over each text: every byte adds a random number, and older ones shift out after 32
bytes. A text is cut where the hash is least among its `REACH` neighbours on both sides. Cuts hence
depend on about `32 + 2 * REACH` bytes around them and on nothing else, so an insertion moves no cut
but those next to it, and copies of a passage are cut alike from its first cut on. A chunk is never
shorter than `REACH` bytes, but for the last of a text, and never longer than `LONGEST`.

Chunks with one digest are one chunk: the first, by document id and place, stays. Runs of repeated
chunks go if they are `SHORTEST_RUN` bytes long, which chance does not reach, or are the whole text,
however short; a shorter run inside a text stays.
Digests travel as packed arrays, one a task and digest, so a chunk that a third of the texts hold
gathers no more entries than there are tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.batches import number_rows, ragged, slices
from nearfold.llm.words import mix
from nearfold.session import Steps, freeze

REACH = 24
LONGEST = 1024
SHORTEST_RUN = 64
CHUNKS_PER_BUCKET = 1_000_000
FLUSH = 500_000
_U = np.uint64
_LAST = np.iinfo(np.int64).max
_GEAR = (mix(np.arange(256, dtype=_U) + _U(991)) >> _U(32)).astype(np.uint32)


def gear(buf: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: the sum of the gears of 32 bytes, each shifted by its age."""
    rolled, age = _GEAR[buf], 1
    while age < 32:
        older = np.zeros_like(rolled)
        older[age:] = rolled[:-age] << np.uint32(age)
        rolled, age = rolled + older, 2 * age
    return rolled


def _least_ahead(values: np.ndarray, n: int) -> np.ndarray:
    """Least of the `n` values after each one; beyond the end all are greatest."""
    padded = np.concatenate([values[1:], np.full(n, np.iinfo(values.dtype).max, values.dtype)])
    size = 1
    while 2 * size <= n:
        padded = np.minimum(padded[:-size], padded[size:])
        size *= 2
    rest = n - size
    return (np.minimum(padded[:-rest], padded[rest:]) if rest else padded)[: len(values)]


def cut(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of all texts: text number, start and end."""
    sizes = np.array([len(x) for x in raws], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(raws), dtype=np.uint8)
    if not len(buf):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    rolled = gear(buf)
    low = (rolled < _least_ahead(rolled, REACH)) & (rolled <= _least_ahead(rolled[::-1], REACH)[::-1])
    # A cut stands behind its byte. All it depends on lies within the text, or there is no cut.
    at = np.flatnonzero(low) + 1
    text = np.searchsorted(begins + sizes, at, "left")
    text = np.minimum(text, len(raws) - 1)
    inside = (at - begins[text] >= 32 + REACH) & (begins[text] + sizes[text] - at >= REACH)
    edges = np.unique(np.concatenate([at[inside], begins, begins + sizes]))
    starts, ends = edges[:-1], edges[1:]
    parts = -(-(ends - starts) // LONGEST)
    if (parts > 1).any():
        nth = ragged(np.zeros(len(parts), dtype=np.int64), parts)
        starts = np.repeat(starts, parts) + nth * LONGEST
        ends = np.minimum(np.repeat(ends, parts), starts + LONGEST)
    text = np.searchsorted(begins + sizes, starts, "right")
    return text, starts - begins[text], ends - begins[text]


def _digests(raws: list[bytes], text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    blake = hashlib.blake2b
    spans = zip(text.tolist(), starts.tolist(), ends.tolist(), strict=True)
    data = b"".join([blake(raws[t][a:z], digest_size=16).digest() for t, a, z in spans])
    return np.frombuffer(data, dtype=_U).reshape(-1, 2)


_ENTRIES = "bucket int, digests binary, ids binary, rows binary, nths binary"
_NAMES = ["bucket", "digests", "ids", "rows", "nths"]


def _first_of_each(digests: np.ndarray, ids: np.ndarray, rows: np.ndarray, nths: np.ndarray):
    """Order by digest, id, row and place, and whether each is the first with its digest."""
    order = np.lexsort((nths, rows, ids, digests[:, 1], digests[:, 0]))
    d = digests[order]
    first = np.ones(len(d), dtype=bool)
    first[1:] = (d[1:] != d[:-1]).any(axis=1)
    return order, first


def _entries(buckets: int):
    """First chunks of each digest by bucket; under negative buckets those that are repeats already."""

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        digests, ids, rows, nths = (np.concatenate(x) for x in zip(*held, strict=True))
        order, first = _first_of_each(digests, ids, rows, nths)
        sent, known = order[first], order[~first]
        bucket = (((digests[sent, 0] >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
        parts = [(bucket, sent, 1, 0), ((rows[known] % buckets).astype(np.int64), known, -1, -1)]
        out = []
        for numbers, places, sign, shift in parts:
            by = np.argsort(numbers, kind="stable")
            ends = np.searchsorted(numbers[by], np.arange(buckets + 1))
            for k in range(buckets):
                at = places[by[int(ends[k]) : int(ends[k + 1])]]
                if len(at):
                    out.append(
                        (sign * k + shift, *(x[at].tobytes() for x in (digests, ids, rows, nths)))
                    )
        for a in range(0, len(out), 64):
            kinds = (pa.int32(), *[pa.binary()] * 4)
            columns = [pa.array(x, t) for x, t in zip(zip(*out[a : a + 64], strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch, raws in slices(batches, "text"):
            text, starts, ends = cut(raws)
            ids = batch.column(1).cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
            rows = batch.column(0).to_numpy()
            nths = np.arange(len(text)) - np.searchsorted(text, text)
            held.append((_digests(raws, text, starts, ends), ids[text], rows[text], nths.astype(np.int32)))
            size += len(text)
            if size > FLUSH:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    return entries


def _repeats(key: tuple, group: pa.Table) -> pa.Table:
    """`row, nth` of the chunks that are not the first with their digest."""
    kinds = (("digests", _U), ("ids", np.int64), ("rows", np.int64), ("nths", np.int32))
    digests, ids, rows, nths = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()]) for c, t in kinds
    )
    if key[0].as_py() >= 0:
        order, first = _first_of_each(digests.reshape(-1, 2), ids, rows, nths)
        again = order[~first]
        rows, nths = rows[again], nths[again]
    return pa.table({"row": rows, "nth": nths})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `doc_id, text, nths` to what is left of the texts."""
    names = ["doc_id", "kept", "removed", "n_bytes", "n_chunks", "n_repeats"]
    for batch, raws in slices(batches, "text"):
        text, starts, ends = cut(raws)
        first = np.searchsorted(text, np.arange(len(raws) + 1))
        kept, removed, repeats = [], [], []
        for k, (raw, nths) in enumerate(zip(raws, batch.column(2).to_pylist(), strict=True)):
            spans: list[list[int]] = []
            for nth in sorted(nths or []):
                a, z = int(starts[first[k] + nth]), int(ends[first[k] + nth])
                if spans and spans[-1][1] == a:
                    spans[-1][1] = z
                else:
                    spans.append([a, z])
            spans = [s for s in spans if s[1] - s[0] >= min(SHORTEST_RUN, len(raw))]
            at, left = 0, []
            for a, z in spans:
                left.append(raw[at:a])
                at = z
            kept.append(b"".join([*left, raw[at:]]))
            removed.append([{"start": a, "stop": z} for a, z in spans])
            repeats.append(len(nths or []))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(kept, pa.binary()),
                pa.array(removed, _SPANS),
                pa.array([len(r) for r in raws], pa.int64()),
                pa.array(np.diff(first)),
                pa.array(repeats, pa.int64()),
            ],
            names,
        )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, kept, removed, n_bytes, n_chunks, n_repeats` for every row of `docs`.

    `kept` (binary) is the text's UTF-8 without its removed runs `start, stop`; of a text that repeats
    as a whole nothing is kept, whatever its length. Of chunks with one
    digest the one with the least id (nulls last), and then the first row and place, is no repeat.
    Null texts are empty and have no chunks. Rows that share an id, or are equal in all columns, are
    rows of their own. Other columns are not read. Ids are whole numbers, or text that holds such;
    other text counts as null in the order.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = number_rows(
        docs.select(
            F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            F.col(id_col).try_cast("bigint").alias("rank"),
        )
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, int(size / (2 * REACH) / CHUNKS_PER_BUCKET))
    with Steps(docs.sparkSession) as steps:
        sent = rows.select("row", "rank", "text").mapInArrow(_entries(buckets), _ENTRIES)
        again = sent.groupBy("bucket").applyInArrow(_repeats, "row bigint, nth int")
        again = steps.freeze(again, "repeats")
        nths = freeze(again.groupBy("row").agg(F.collect_list("nth").alias("nths")), "repeated-chunks")
    joined = rows.join(nths, "row", "left").select("doc_id", "text", "nths")
    schema = (
        f"doc_id {kind}, kept binary, removed array<struct<start:bigint,stop:bigint>>, "
        "n_bytes bigint, n_chunks bigint, n_repeats bigint"
    )
    return joined.mapInArrow(_kept, schema)
