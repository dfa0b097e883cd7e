"""Documents that hold a passage within a small word edit distance of a benchmark item.

Edit distance is mapped to Hamming distance by random walks over words (the CGK embedding): at step
j the walk writes the word under it and moves on if a hash of j and the word says so. Two texts with
few edits mostly walk in step, so most of what they write agrees. Windows start at every word, as
long as the items: the walk over a window is compared with an item only where the item's own walk has
not ended. Per walk several samples of a few steps are drawn; where an item's and a window's words
agree on a sample, the pair is a candidate, and an exact alignment decides.

Before that a lossless count rules out most windows: n words with at most k edits share at least
`n - 1 - 2k` word pairs, so the pairs of a window that any item holds must be as many. Walks start
only at such pairs: the first one shared stands at most 2k words into the item, and the walks of an
item are indexed from each of these words. Candidates must share as many pairs with their own item.

The recall of the samples is set by `WALKS`, `SAMPLES` and `DEPTH`. With a share `q` of steps in
agreement it is `1 - (1 - q ** DEPTH) ** (WALKS * SAMPLES)`: 0.98 for q = 0.4, which texts with a
quarter of their words edited reach on average, and practically 1 for lighter edits. Neighbouring
windows add to it. Choices of walks and samples are fixed, so a result does not depend on partitions.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nearfold.llm.batches import ragged, slices
from nearfold.llm.words import MARKS, located_words, mix

_U = np.uint64
WALKS = 8
SAMPLES = 8
DEPTH = 3
#: Items of fewer words are searched without edits; of fewer than `LEAST_WORDS`, which stand in many
#: texts by chance, only a text that has no other words counts.
MIN_WORDS = 8
LEAST_WORDS = 5
#: Keys that the items of a block put into the index, twelve bytes each.
KEYS_PER_BLOCK = 4_000_000
_BITS = 22
_WINDOWS = 20_000
_WORDS = 2_000_000
_TAGS = 16


def folded(raws: list[bytes]) -> list[bytes]:
    """Capitals of Latin-1 become small; ASCII ones do in the word hash already."""
    buf = np.frombuffer(b"\n".join(raws), dtype=np.uint8).copy()
    at = np.flatnonzero(buf[:-1] == 0xC3) + 1
    at = at[(buf[at] >= 0x80) & (buf[at] <= 0x9E) & (buf[at] != 0x97)]
    buf[at] += 0x20
    data, out, begin = buf.tobytes(), [], 0
    for raw in raws:
        out.append(data[begin : begin + len(raw)])
        begin += len(raw) + 1
    return out


def sequences(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of letters, digits and non-ASCII bytes), and words of each text."""
    words, _, _, counts = located_words(folded(raws), MARKS)
    return words, counts


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * _U(0x9E3779B97F4A7C15) + words[1:]) >> _U(64 - _BITS)


def _seed(walk: int, step: int) -> np.uint64:
    return mix(np.array([walk * 100_003 + step + 1], dtype=_U))[0]


def walks(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """What the walk writes from each start, step by step; 0 after the stop."""
    at = starts.copy()
    out = np.zeros((steps, len(starts)), dtype=_U)
    for j in range(steps):
        live = at < stops
        word = np.where(live, words[np.minimum(at, len(words) - 1)], _U(0))
        out[j] = word
        at += (live & ((mix(word ^ _seed(walk, j)) >> _U(63)) > 0)).astype(np.int64)
    return out


class Items:
    """A bounded block of benchmark items, ready to be sent to tasks."""

    def __init__(self, rows: list[Row], max_error: float) -> None:
        raws = [(r.text or "").encode() for r in rows]
        words, counts = sequences(raws)
        ends = np.cumsum(counts)
        split = [words[z - n : z] for z, n in zip(ends.tolist(), counts.tolist(), strict=True)]
        self.max_error = max_error
        self.exact: dict[int, dict[bytes, list[int]]] = {}  # short items by their number of words
        rows = [(r.item_id, w) for r, w in zip(rows, split, strict=True) if len(w)]
        rows.sort(key=lambda r: len(r[1]) < MIN_WORDS)  # short ones last
        self.ids, self.lengths = [r[0] for r in rows], [len(r[1]) for r in rows]
        self.words = [w for _, w in rows if len(w) >= MIN_WORDS]
        for k, (_, w) in enumerate(rows):
            if len(w) < MIN_WORDS:
                self.exact.setdefault(len(w), {}).setdefault(w.tobytes(), []).append(k)
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.edits = np.floor(self.sizes * max_error).astype(np.int64)
        self.known = np.zeros(1 << _BITS, dtype=bool)
        for w in self.words:
            self.known[_pairs(w).astype(np.int64)] = True
        # Bands of similar length: windows of the longest must hold the pairs that the shortest asks for.
        self.bands: list[np.ndarray] = []
        order = np.argsort(self.sizes, kind="stable")
        while len(order):
            near = self.sizes[order] <= max(self.sizes[order[0]] * 1.25, self.sizes[order[0]] + 2)
            self.bands.append(order[near])
            order = order[~near]
        self.pairs = [frozenset(_pairs(w).tolist()) for w in self.words]
        self.keys = [self._keys(band) for band in self.bands]

    def steps(self, band: np.ndarray) -> int:
        return int(1.6 * self.sizes[band].min())

    def samples(self, band: np.ndarray, walk: int) -> np.ndarray:
        """Sampled steps, one row per sample."""
        rng = np.random.default_rng([walk, int(self.sizes[band].min())])
        return np.sort(rng.integers(0, self.steps(band), (SAMPLES, DEPTH)), axis=1)

    def _keys(self, band: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Samples of the items' walks, also of those that skip words in front: tags, sorted keys, their items."""
        flat = np.concatenate([self.words[k] for k in band])
        skips = 2 * self.edits[band] + 1
        stops = np.repeat(np.cumsum(self.sizes[band]), skips)
        skipped = ragged(np.zeros(len(band), dtype=np.int64), skips)
        starts = stops - np.repeat(self.sizes[band], skips) + skipped
        owners = np.repeat(band, skips)
        found = []
        for walk in range(WALKS):
            written = walks(flat, starts, stops, walk, self.steps(band))
            per_sample = []
            for steps in self.samples(band, walk):
                keys = _sampled(written, steps)
                order = np.lexsort((owners, keys))
                keys, items = keys[order], owners[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (items[1:] != items[:-1])])
                tags = np.zeros(1 << _TAGS, dtype=bool)
                tags[keys >> _U(64 - _TAGS)] = True
                per_sample.append((tags, keys[new], items[new].astype(np.int32)))
            found.append(per_sample)
        return found


def _sampled(written: np.ndarray, steps: np.ndarray) -> np.ndarray:
    key = np.zeros(written.shape[1], dtype=_U)
    for step in steps:
        key = mix(key ^ written[step])
    return key


def _windows(items: Items, band: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Starts that the pair count leaves, as places in `words`; texts follow one another."""
    if len(words) < 2:
        return np.zeros(0, dtype=np.int64)
    sizes, edits = items.sizes[band], items.edits[band]
    need = max(int((sizes - 1 - 2 * edits).min()), 1)
    width = int((sizes + edits).max()) - 1
    hits = items.known[_pairs(words).astype(np.int64)]
    ends = np.cumsum(counts)
    hits[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(words))] - 1] = False  # pairs over two texts
    total = np.concatenate([[0], np.cumsum(hits)])
    inside = total[np.minimum(np.arange(len(hits)) + width, len(hits))] - total[:-1]
    return np.flatnonzero(hits & (inside >= need))


def candidates(items: Items, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of a place in `words` and an item that agree on a sample, in order."""
    ends, n_items = np.cumsum(counts), max(len(items.words), 1)
    found = [np.zeros(0, dtype=np.int64)]
    for band, keys in zip(items.bands, items.keys, strict=True):
        starts = _windows(items, band, words, counts)
        for a in range(0, len(starts), _WINDOWS):
            some = starts[a : a + _WINDOWS]
            stops = ends[np.searchsorted(ends, some, "right")]
            for walk in range(WALKS):
                written = walks(words, some, stops, walk, items.steps(band))
                for steps, (tags, known, owners) in zip(items.samples(band, walk), keys[walk], strict=True):
                    key = _sampled(written, steps)
                    near = np.flatnonzero(tags[key >> _U(64 - _TAGS)])
                    first = np.searchsorted(known, key[near])
                    hits = np.searchsorted(known, key[near], "right") - first
                    found.append(np.unique(np.repeat(some[near], hits) * n_items + owners[ragged(first, hits)]))
    codes = np.unique(np.concatenate(found))
    return np.stack([codes // n_items, codes % n_items], axis=1)


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edit distance of the item to a run of the text, and where the first such run ends."""
    n = len(text)
    steps = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    for k, word in enumerate(item):
        best = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(np.concatenate([[k + 1], best]) - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


def matches(items: Items, words: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Text number, item, distance and number of the last word, the best for each text and item."""
    begins = np.cumsum(counts) - counts
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    found = candidates(items, words, counts)
    texts = np.searchsorted(np.cumsum(counts), found[:, 0], "right")
    for text, (at, k) in zip(texts.tolist(), found.tolist(), strict=True):
        places[text, k].append(at)
    pairs = _pairs(words)
    out = []
    for (text, k), starts in places.items():
        n, most = int(items.sizes[k]), int(items.edits[k])
        low, high = int(begins[text]), int(begins[text] + counts[text])
        best = (most + 1, 0)
        first = 0
        while first < len(starts):  # candidates that overlap are aligned in one go
            last = first
            while last + 1 < len(starts) and starts[last + 1] - starts[last] <= n:
                last += 1
            a, z = max(low, starts[first] - n - most), min(high, starts[last] + 2 * (n + most))
            if sum(map(items.pairs[k].__contains__, pairs[a : z - 1].tolist())) >= n - 1 - 2 * most:
                d, end = distance(items.words[k], words[a:z])
                best = min(best, (d, a - low + end - 1))
            first = last + 1
        if best[0] <= most:
            out.append((text, k, *best))
    return out + _equal(items, words, counts)


def _equal(items: Items, words: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Short items: the first place in each text that has exactly their words."""
    ends = np.cumsum(counts)
    found: dict[tuple[int, int], int] = {}
    for n, known in items.exact.items():
        if n > len(words):
            continue
        starts = np.arange(len(words) - n + 1)
        text = np.searchsorted(ends, starts, "right")
        inside = starts + n <= ends[text]
        if n < LEAST_WORDS:
            inside &= counts[text] == n
        starts = starts[inside]
        first = np.array([np.frombuffer(w, dtype=_U)[0] for w in known], dtype=_U)
        starts = starts[np.isin(words[starts], first)]
        for at in starts.tolist():
            for k in known.get(words[at : at + n].tobytes(), ()):
                t = int(np.searchsorted(ends, at, "right"))
                found.setdefault((t, k), at + n - 1 - int(ends[t] - counts[t]))
    return [(t, k, 0, last) for (t, k), last in found.items()]


def _gathered(
    batches: Iterator[pa.RecordBatch], text: str
) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Runs of rows with many words, so that the walks step over long arrays."""
    parts, words, counts, held = [], [], [], 0
    for part, raws in slices(batches, text):
        w, c = sequences(raws)
        parts.append(part)
        words.append(w)
        counts.append(c)
        held += len(w)
        if held > _WORDS:
            yield pa.Table.from_batches(parts), np.concatenate(words), np.concatenate(counts)
            parts, words, counts, held = [], [], [], 0
    if parts:
        yield pa.Table.from_batches(parts), np.concatenate(words), np.concatenate(counts)


def _blocks(items: DataFrame, max_error: float, id_col: str, text_col: str) -> Iterator[Broadcast]:
    """The items in blocks whose index has a bounded size; each is sent to all tasks in its turn."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    words = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    keys = WALKS * SAMPLES * (2 * F.floor(words * max_error) + 1)
    blocks = max(1, -(-(rows.agg(F.sum(keys)).first()[0] or 0) // KEYS_PER_BLOCK))
    for block in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield items.sparkSession.sparkContext.broadcast(Items(part.collect(), max_error))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    max_error: float = 0.25,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """`doc_id, item_id, distance, item_words, last_word`, one row per document row and item found.

    `distance` counts inserted, deleted and replaced words of the item's best alignment within the
    document, at most `max_error` of the item's words; `last_word` is the number of the word where it
    ends, from 0. Words are runs of ASCII letters and digits and of all other characters beyond ASCII;
    ASCII marks do not count, nor the case of ASCII and Latin-1 letters. Items of fewer than `MIN_WORDS`
    words are found only without edits, and those of fewer than `LEAST_WORDS` only where a document has
    the same words and no others. Items and documents without words match nothing. Equal items, equal documents and null ids each
    count for themselves. Other columns are not read.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance int, item_words int, last_word bigint"
    item_type = to_arrow_type(items.schema[item_id_col].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(items, max_error, item_id_col, item_text_col):
        found = rows.mapInArrow(_find(block, item_type), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _find(block: Broadcast, item_type: pa.DataType):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for rows, words, counts in _gathered(batches, "text"):
            found = sorted(matches(items, words, counts))
            text, item, errors, last = zip(*found, strict=True) if found else ((),) * 4
            out = pa.table(
                [
                    rows.column("doc_id").take(pa.array(text, pa.int64())),
                    pa.array([items.ids[k] for k in item], item_type),
                    pa.array(errors, pa.int32()),
                    pa.array([items.lengths[k] for k in item], pa.int32()),
                    pa.array(last, pa.int64()),
                ],
                ["doc_id", "item_id", "distance", "item_words", "last_word"],
            )
            yield from out.to_batches()

    return find


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    max_error: float = 0.25,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` in which `find_leaks` finds nothing, with all their columns.

    A null or empty text holds nothing and stays; equal rows go or stay together; without items all
    rows stay.
    """
    for block in _blocks(items, max_error, item_id_col, item_text_col):
        docs = docs.mapInArrow(_clean(block, docs.columns.index(text_col)), docs.schema)
    return docs


def _clean(block: Broadcast, column: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        first = next(batches, None)
        if first is not None:
            name = first.schema.names[column]
            for rows, words, counts in _gathered(chain([first], batches), name):
                leaky = {m[0] for m in matches(items, words, counts)}
                keep = pa.array([k not in leaky for k in range(rows.num_rows)])
                yield from rows.filter(keep).to_batches()

    return clean
