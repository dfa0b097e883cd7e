"""Removal of every byte that a repeated string of `width` bytes covers, by suffix sorting.

All suffixes of a corpus cannot be sorted in one place, and most stand in no repeated string. So:

1. Each window of `width` bytes picks an anchor, the place of the least hash of `GRAM` bytes in it.
   Equal windows pick equal anchors. Consecutive windows with one anchor are a run. Anchors whose
   hash occurs once in the corpus are done; hashes travel as packed arrays, one a task and hash.
2. Runs whose anchor occurs again travel with their text to the anchor's bucket. There the contexts
   right of the anchors are suffix-sorted, and those left of them from right to left: prefix
   polynomial hashes and a binary search give the common extension of two suffixes, so a mergesort
   compares them in logarithmic time. Extensions of neighbours are verified byte by byte. A window
   that reaches `o` bytes left of the anchor is repeated if another run shares its block of the
   right order at `width - o` bytes and its block of the left order at `o` bytes.
3. Windows become spans, spans meet their document, and the bytes between them are kept.

Skew: equal runs of a task travel once, and mark each other there. Anchors with more than `HOT` runs
(the rims of a passage that very many documents hold) are sorted within each task; of their windows
one of each kind travels on, by digest. So no anchor, and no window, gathers more rows in a bucket
than `HOT` or the number of tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.batches import free_name, number_rows, ragged, slices
from nearfold.llm.words import RAW_BYTE_HASH, mix, powers
from nearfold.session import Steps, freeze

_U = np.uint64
WIDTH = 200
GRAM = 64
HOT = 10_000
RUNS_PER_BUCKET = 20_000
RUNS_AT_ONCE = 4_000
HOT_RUNS_AT_ONCE = 1_000
ANCHORS_PER_BUCKET = 400_000
ANCHORS_HELD = 400_000
FLUSH_BYTES = 12 << 20
_PLACE = (1 << 24) - 1
_CHUNK = 1 << 22


def _prefix_sums(buf: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum(RAW_BYTE_HASH[buf] * powers(len(buf)), out=sums[1:])
    return sums


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each `n` consecutive values, by doubling."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = n - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(raws: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Runs of windows: text number, first window, windows, anchor and hash of the anchor.

    Places count from the start of the text. A very long text is read in overlapping chunks; a
    window's anchor depends on the window alone.
    """
    parts: list[tuple[int, int, bytes]] = []  # text, place of the chunk in it, bytes
    for k, raw in enumerate(raws):
        for at in range(0, max(len(raw) - width + 1, 0), _CHUNK):
            parts.append((k, at, raw[at : at + _CHUNK + width - 1]))
    found: list[tuple[np.ndarray, ...]] = []
    first = 0
    while first < len(parts):
        last, size = first, 0
        while last < len(parts) and (last == first or size + len(parts[last][2]) <= _CHUNK):
            size += len(parts[last][2])
            last += 1
        found.append(_runs(parts[first:last], width))
        first = last
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=_U),)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(parts: list[tuple[int, int, bytes]], width: int) -> tuple[np.ndarray, ...]:
    buf = np.frombuffer(b"".join(x[2] for x in parts), dtype=np.uint8)
    sizes = np.array([len(x[2]) for x in parts])
    begins = np.cumsum(sizes) - sizes
    gram = min(GRAM, width)
    sums = _prefix_sums(buf)
    n = len(buf) - gram + 1
    hashes = mix((sums[gram:] - sums[:n]) * powers(n, inverse=True))
    keyed = (hashes & ~_U(_PLACE)) | np.arange(n, dtype=_U)
    least = _least(keyed, width - gram + 1)
    windows = ragged(begins, sizes - width + 1)
    anchors = (least[windows] & _U(_PLACE)).astype(np.int64)
    change = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)])
    at = np.flatnonzero(change)
    anchor, start = anchors[at], windows[at]
    part = np.searchsorted(begins, start, "right") - 1
    shift = np.array([x[1] for x in parts])[part] - begins[part]
    text = np.array([x[0] for x in parts])[part]
    # Anchors have small hashes, by their choice; buckets are dealt by a hash that is even again.
    return text, start + shift, np.diff(np.append(at, len(windows))), anchor + shift, mix(hashes[anchor])


class _Text:
    """Prefix hashes of a buffer, and common extensions of suffixes and of prefixes in it."""

    def __init__(self, buf: np.ndarray) -> None:
        self.buf, self.sums = buf, _prefix_sums(buf)
        self.power = powers(len(buf) + 1)

    def extension(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """Common bytes from `x` and `y` on (step 1) or before them (step -1), `most` at most."""
        low, high = np.zeros(len(x), dtype=np.int64), most.astype(np.int64)
        px, py = self.power[x], self.power[y]
        sx, sy = self.sums[x], self.sums[y]
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            ex, ey = self.sums[x + step * mid], self.sums[y + step * mid]
            same = (ex - sx) * py == (ey - sy) * px
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        return low

    def verified(self, x: np.ndarray, y: np.ndarray, common: np.ndarray, step: int) -> np.ndarray:
        """Whether the common extensions hold byte by byte."""
        a = ragged(x if step > 0 else x - common, common)
        b = ragged(y if step > 0 else y - common, common)
        wrong = np.concatenate([[0], np.cumsum(self.buf[a] != self.buf[b])])
        ends = np.cumsum(common)
        return wrong[ends] == wrong[ends - common]


def suffix_order(
    text: _Text, group: np.ndarray, places: np.ndarray, room: np.ndarray, step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `places` within each group, and common bytes with the one before.

    A suffix is `room` bytes long and runs right (step 1) or left (step -1). Mergesort from below:
    runs of doubling width merge in all groups at once, and each suffix finds its rank in the
    neighbouring run by binary search. The first suffix of a group has -1.
    """
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]]))
    sizes = np.diff(np.append(first, len(order)))
    base = np.repeat(first, sizes)
    inside = np.arange(len(order)) - base
    total = np.repeat(sizes, sizes)

    def after(x: np.ndarray, y: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Whether suffix x comes after suffix y, or `equal` if they are the same."""
        most = np.minimum(room[x], room[y])
        common = text.extension(places[x], places[y], most, step)
        ends = common == most
        back = 0 if step > 0 else -1
        ix = np.where(ends, 0, places[x] + step * common + back)
        iy = np.where(ends, 0, places[y] + step * common + back)
        later = np.where(ends, room[x] > room[y], text.buf[ix] > text.buf[iy])
        return np.where(ends & (room[x] == room[y]), equal, later)

    width = 1
    while width < sizes.max(initial=0):
        active = np.flatnonzero(total > width)
        spot, size = inside[active], total[active]
        pair = spot // (2 * width) * (2 * width)
        left = spot - pair < width
        other = np.where(left, np.minimum(pair + width, size), pair)
        low = np.zeros(len(active), dtype=np.int64)
        high = np.where(left, np.minimum(pair + 2 * width, size), np.minimum(pair + width, size)) - other
        other = other + base[active]
        item = order[active]
        while (busy := np.flatnonzero(low < high)).size:
            mid = (low[busy] + high[busy]) >> 1
            # Equal suffixes keep their order: one of the right run comes after those of the left.
            beyond = after(item[busy], order[other[busy] + mid], ~left[busy])
            low[busy] = np.where(beyond, mid + 1, low[busy])
            high[busy] = np.where(beyond, high[busy], mid)
        own = np.where(left, spot - pair, spot - pair - width)
        order[base[active] + pair + own + low] = item
        width *= 2

    common = np.full(len(order), -1, dtype=np.int64)
    nth = np.flatnonzero(inside > 0)
    x, y = order[nth], order[nth - 1]
    common[nth] = text.extension(places[x], places[y], np.minimum(room[x], room[y]), step)
    bad = nth[~text.verified(places[x], places[y], common[nth], step)]
    for start in np.unique(base[bad]).tolist():  # two strings with one hash: sort these by their bytes
        stop = start + int(total[start])
        cut = {}
        for k in order[start:stop].tolist():
            p, r = int(places[k]), int(room[k])
            cut[k] = (text.buf[p : p + r] if step > 0 else text.buf[p - r : p][::-1]).tobytes()
        order[start:stop] = sorted(cut, key=cut.__getitem__)
        for at in range(start + 1, stop):
            a, b = cut[int(order[at - 1])], cut[int(order[at])]
            same = next((i for i, (u, v) in enumerate(zip(a, b, strict=False)) if u != v), min(len(a), len(b)))
            common[at] = same
    return order, common


def repeated_windows(
    strings: list[bytes], group: np.ndarray, anchor: np.ndarray, width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the strings: string, place, whether it is repeated, whether it is first of its kind.

    The string of a run holds its windows and no more; `anchor` is the place of the anchor in it.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    text = _Text(np.frombuffer(b"".join(strings), dtype=np.uint8))
    places = begins + anchor
    n = len(strings)
    blocks = []
    for step, room in ((1, sizes - anchor), (-1, anchor)):
        order, common = suffix_order(text, group, places, room, step)
        blocks.append((order, common))
    count = sizes - width + 1
    flat = np.cumsum(count) - count
    repeated = np.zeros(int(count.sum()), dtype=bool)
    head = np.ones(int(count.sum()), dtype=bool)
    (right, common_right), (left, common_left) = blocks
    block_right, block_left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(int(anchor.max(initial=-1)) + 1):
        valid = np.flatnonzero((anchor >= o) & (anchor - o < count))
        if len(valid) < 2:
            continue
        block_right[right] = np.cumsum(common_right < width - o)
        block_left[left] = np.cumsum(common_left < o)
        key = block_right[valid] * (n + 1) + block_left[valid]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        at = flat[valid[by]] + anchor[valid[by]] - o
        repeated[at[1:][same]] = True
        repeated[at[:-1][same]] = True
        head[at[1:][same]] = False
    string = np.repeat(np.arange(n), count)
    return string, np.arange(len(string)) - flat[string], repeated, head


def _portions(group: np.ndarray) -> Iterator[np.ndarray]:
    """Places of whole groups, about `RUNS_AT_ONCE` at a time."""
    order = np.argsort(group, kind="stable")
    ends = np.append(np.flatnonzero(group[order][1:] != group[order][:-1]) + 1, len(order))
    at = 0
    while at < len(order):
        k = max(int(np.searchsorted(ends, at + RUNS_AT_ONCE, "right")) - 1, int(np.searchsorted(ends, at, "right")))
        yield order[at : int(ends[k])]
        at = int(ends[k])


def _spans(owner: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of the runs of consecutive windows; windows are in order."""
    if not len(owner):
        return (np.zeros(0, dtype=np.int64),) * 3
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)])
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(owner)) - 1
    return owner[at], place[at], place[last] + width


# --------------------------------------------------------------------------------------------------
# Step 1: anchors that occur again

_ANCHORS = "bucket int, hashes binary, docs binary, nths binary, hits binary"


def _anchors(buckets: int, width: int):
    names = ["bucket", "hashes", "docs", "nths", "hits"]

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        v, doc, nth = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(v, kind="stable")
        v, doc, nth = v[order], doc[order], nth[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        hits = np.diff(np.append(first, len(v)))
        bucket = (((v[first] >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
        # The first of each hash travels; the others of a task know already that they are repeated,
        # but not yet whether the anchor is hot.
        rest = np.ones(len(v), dtype=bool)
        rest[first] = False
        rows = []
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        for k in range(buckets):
            at = slice(int(ends[k]), int(ends[k + 1]))
            if at.start < at.stop:
                f = first[at]
                rows.append((k, v[f].tobytes(), doc[f].tobytes(), nth[f].tobytes(), hits[at].astype(np.int32).tobytes()))
        local = np.repeat(hits, hits)[rest]
        doc, nth, v = doc[rest], nth[rest], v[rest]
        spread = doc % buckets
        order = np.argsort(spread, kind="stable")
        ends = np.searchsorted(spread[order], np.arange(buckets + 1))
        for k in range(buckets):
            at = order[int(ends[k]) : int(ends[k + 1])]
            if len(at):
                rows.append(
                    (-1 - k, v[at].tobytes(), doc[at].tobytes(), nth[at].tobytes(), local[at].astype(np.int32).tobytes())
                )
        kinds = (pa.int32(), *[pa.binary()] * 4)
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch, raws in slices(batches, "text"):
            text, _, _, _, v = runs(raws, width)
            row = batch.column(0).to_numpy()
            begins = np.searchsorted(text, np.arange(len(raws)))
            nth = (np.arange(len(text)) - begins[text]).astype(np.int32)
            held.append((v, row[text], nth))
            size += len(v)
            if size > ANCHORS_HELD:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return anchors


def _repeated_anchors(key: tuple, group: pa.Table) -> pa.Table:
    """Runs `row, nth` whose anchor occurs again, and with no row the hashes of hot anchors.

    Of a run that its own task knew to be repeated, `hot` is still open and `hash` is given.
    """
    v, doc, nth, hits = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()])
        for c, t in (("hashes", np.int64), ("docs", np.int64), ("nths", np.int32), ("hits", np.int32))
    )
    if key[0].as_py() < 0:
        return pa.table({"row": doc, "nth": nth, "hot": pa.nulls(len(v), pa.bool_()), "hash": v})
    order = np.argsort(v, kind="stable")
    v, doc, nth, hits = v[order], doc[order], nth[order], hits[order]
    first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    sums = np.add.reduceat(hits, first)
    hits = np.repeat(sums, np.diff(np.append(first, len(v))))
    keep, hot = hits > 1, v[first][sums > HOT]
    known = pa.table({"row": doc[keep], "nth": nth[keep], "hot": hits[keep] > HOT})
    known = known.append_column("hash", pa.nulls(known.num_rows, pa.int64()))
    named = pa.table({"row": pa.nulls(len(hot), pa.int64()), "nth": pa.nulls(len(hot), pa.int32())})
    named = named.append_column("hot", pa.array([True] * len(hot), pa.bool_())).append_column("hash", pa.array(hot))
    return pa.concat_tables([known, named])


# --------------------------------------------------------------------------------------------------
# Step 2: windows that are repeated

_RUNS = "bucket int, hashes binary, docs binary, starts binary, anchors binary, sizes binary, text binary"
_RUN_NAMES = ["bucket", "hashes", "docs", "starts", "anchors", "sizes", "text"]


class _Sender:
    """Collects what a task sends to the buckets.

    Buckets from 0 on get runs, then come as many for windows of hot anchors; negative ones pass on
    spans that are already known. A run or window whose document is -1 only stands for its kind.
    """

    def __init__(self, buckets: int, width: int) -> None:
        self.buckets, self.width = buckets, width
        self.clear()

    def clear(self) -> None:
        self.seen: dict[tuple[int, bytes], list] = {}
        self.held = 0

    def add(self, v: int, doc: int, start: int, anchor: int, text: bytes, hot: bool) -> None:
        found = self.seen.get((v, text))
        if found is None:
            self.seen[v, text] = [doc, start, anchor, hot, None]
            self.held += len(text) + 200
        else:
            if found[4] is None:
                found[4] = []
            found[4].append((doc, start))
            self.held += 64

    def send(self) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[tuple[int, int, int, int, int, bytes]]] = {}
        hot = []
        for (v, text), (doc, start, anchor, is_hot, more) in self.seen.items():
            if more:
                for d, s in [(doc, start), *more]:
                    rows.setdefault(-1 - d % self.buckets, []).append((0, d, s, 0, len(text), b""))
            doc = -1 if more else doc
            if is_hot:
                hot.append((v, doc, start, anchor, text))
            else:
                bucket = ((v >> 32) * self.buckets) >> 32
                rows.setdefault(bucket, []).append((v, doc, start, anchor, len(text), text))
        self.clear()
        hot.sort(key=lambda x: x[0])
        while hot:
            yield from self._hot_batches(hot[-HOT_RUNS_AT_ONCE:])
            del hot[-HOT_RUNS_AT_ONCE:]
        batch: list[tuple] = []
        for bucket, items in rows.items():
            v, doc, start, anchor, size, text = zip(*items, strict=True)
            batch.append(
                (
                    bucket,
                    np.array(v, dtype=_U).tobytes(),
                    np.array(doc, dtype=np.int64).tobytes(),
                    np.array(start, dtype=np.int64).tobytes(),
                    np.array(anchor, dtype=np.int32).tobytes(),
                    np.array(size, dtype=np.int64).tobytes(),
                    b"".join(text),
                )
            )
            if len(batch) == 64:
                yield _run_batch(batch)
                batch = []
        if batch:
            yield _run_batch(batch)

    def _hot_batches(self, hot: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Windows of runs with hot anchors: known spans, and by digest one window of each kind.

        Runs of one anchor may come in more than one call; then a kind of window travels once for each.
        """
        v, doc, start, anchor, text = zip(*hot, strict=True)
        string, place, repeated, head = repeated_windows(
            list(text), np.array(v, dtype=_U), np.array(anchor, dtype=np.int64), self.width
        )
        doc, start = np.array(doc, dtype=np.int64), np.array(start, dtype=np.int64)
        known = repeated & (doc[string] >= 0)
        s, a, z = _spans(string[known], place[known], self.width)
        yield from self._packed(-1 - doc[s] % self.buckets, doc[s], start[s] + a, z - a, np.zeros((len(s), 0), dtype=np.uint8))
        string, place, repeated = string[head], place[head], repeated[head]
        digests = b"".join(
            hashlib.blake2b(text[k][p : p + self.width], digest_size=16).digest()
            for k, p in zip(string.tolist(), place.tolist(), strict=True)
        )
        kinds = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 16)
        bucket = self.buckets + kinds[:, :4].copy().view("<u4").reshape(-1).astype(np.int64) % self.buckets
        yield from self._packed(
            bucket, np.where(repeated, -1, doc[string]), start[string] + place, np.full(len(string), self.width), kinds
        )

    def _packed(
        self, bucket: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, text: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        """A row for each bucket; `text` has as many bytes for each entry."""
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order])) + 1
        rows = []
        for at in np.split(order, edges) if len(order) else ():
            zeros = np.zeros(len(at), dtype=np.int64)
            rows.append(
                (
                    int(bucket[at[0]]), zeros.tobytes(), doc[at].astype(np.int64).tobytes(), start[at].astype(np.int64).tobytes(),
                    zeros.astype(np.int32).tobytes(), size[at].astype(np.int64).tobytes(), text[at].tobytes(),
                )
            )
        for at in range(0, len(rows), 64):
            yield _run_batch(rows[at : at + 64])


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), *[pa.binary()] * 6)
    columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, _RUN_NAMES)


def _send_runs(buckets: int, width: int):
    """From rows `row, text, nths, hots` the flagged runs."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets, width)
        for batch, raws in slices(batches, "text"):
            text, start, count, anchor, v = runs(raws, width)
            begins = np.searchsorted(text, np.arange(len(raws)))
            rows = batch.column(0).to_pylist()
            flags = batch.column(2).to_pylist()
            for k, raw in enumerate(raws):
                for flag in flags[k]:
                    at = int(begins[k]) + (flag >> 1)
                    s = int(start[at])
                    cut = raw[s : s + int(count[at]) + width - 1]
                    sender.add(int(v[at]), rows[k], s, int(anchor[at]) - s, cut, bool(flag & 1))
                if sender.held > FLUSH_BYTES:
                    yield from sender.send()
        yield from sender.send()

    return send


def _meet(width: int):
    def meet(key: tuple, group: pa.Table) -> pa.Table:
        """`row, start, stop` of the repeated windows of one bucket."""
        bucket, buckets = key[0].as_py(), group.column("buckets")[0].as_py()
        v, doc, start, anchor, size = (
            np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()])
            for c, t in (
                ("hashes", _U), ("docs", np.int64), ("starts", np.int64), ("anchors", np.int32), ("sizes", np.int64),
            )
        )
        if bucket < 0:
            return pa.table({"row": doc, "start": start, "stop": start + size})
        texts = b"".join(group.column("text").to_pylist())
        if bucket >= buckets:
            kinds = np.frombuffer(texts, dtype=_U).reshape(-1, 2)
            _, kind, hits = np.unique(kinds, axis=0, return_inverse=True, return_counts=True)
            keep = (hits[kind.reshape(-1)] > 1) & (doc >= 0)
            return pa.table({"row": doc[keep], "start": start[keep], "stop": start[keep] + width})
        ends = np.cumsum(size)
        found = []
        for some in _portions(v):
            strings = [texts[a:z] for a, z in zip((ends - size)[some].tolist(), ends[some].tolist(), strict=True)]
            string, place, repeated, _ = repeated_windows(strings, v[some], anchor[some].astype(np.int64), width)
            string = some[string]
            keep = repeated & (doc[string] >= 0)
            s, a, z = _spans(string[keep], place[keep], width)
            found.append((doc[s], start[s] + a, start[s] + z))
        return pa.table(dict(zip(("row", "start", "stop"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return meet


# --------------------------------------------------------------------------------------------------
# Step 3


def _cut(raw: bytes, spans: list[dict]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and its maximal removed runs."""
    merged: list[tuple[int, int]] = []
    for a, z in sorted((s["start"], s["stop"]) for s in spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(z, merged[-1][1]))
        else:
            merged.append((a, z))
    kept, at = [], 0
    for a, z in merged:
        kept.append(raw[at:a])
        at = z
    return b"".join([*kept, raw[at:]]), merged


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `row, text, spans` to `row, kept, removed, n_bytes`."""
    for batch, raws in slices(batches, "text"):
        spans = batch.column(2).to_pylist()
        cuts = [_cut(raw, s) if s else (raw, []) for raw, s in zip(raws, spans, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([c[0] for c in cuts], pa.binary()),
                pa.array([[{"start": a, "stop": z} for a, z in c[1]] for c in cuts], _SPANS),
                pa.array([len(r) for r in raws], pa.int64()),
            ],
            ["doc_id", "kept", "removed", "n_bytes"],
        )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def repeated_spans(texts: DataFrame, steps: Steps, width: int = WIDTH) -> DataFrame:
    """`row, spans` for the rows of `row, text` that hold repeated strings."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, int(size / 85 / ANCHORS_PER_BUCKET))
    anchors = texts.mapInArrow(_anchors(buckets, width), _ANCHORS)
    schema = "row bigint, nth int, hot boolean, hash bigint"
    again = steps.freeze(anchors.groupBy("bucket").applyInArrow(_repeated_anchors, schema), "again")
    hot = again.filter("row is null").select("hash", F.lit(True).alias("is_hot")).distinct()
    open_ = again.filter("row is not null and hot is null").select("row", "nth", "hash").join(hot, "hash", "left")
    known = again.filter("row is not null and hot is not null").select("row", "nth", "hot")
    known = known.unionByName(open_.select("row", "nth", F.coalesce("is_hot", F.lit(False)).alias("hot")))
    flag = F.shiftleft("nth", 1) + F.col("hot").cast("int")
    flagged = steps.freeze(known.groupBy("row").agg(F.sort_array(F.collect_list(flag)).alias("flags")), "flagged")
    number = flagged.agg(F.sum(F.size("flags"))).first()[0] or 0
    buckets = max(16, -(-number // RUNS_PER_BUCKET))
    sent = texts.join(flagged, "row").select("row", "text", "flags").mapInArrow(_send_runs(buckets, width), _RUNS)
    met = sent.withColumn("buckets", F.lit(buckets)).groupBy("bucket")
    spans = met.applyInArrow(_meet(width), "row bigint, start bigint, stop bigint")
    found = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return freeze(found, "spans")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """`doc_id, kept, removed, n_bytes` for every row of `docs`.

    `kept` (binary) is the text's UTF-8 without the bytes that lie in a string of `width` bytes that
    also starts anywhere else, in another row or the same one; `removed` lists the maximal removed
    runs as `start, stop`. Strings are judged on the input, so all copies lose them. Null texts are
    empty; texts shorter than `width` stay whole. Rows that share an id or are equal in all columns
    are rows of their own, and null ids stay null. Other columns are not read.
    """
    rows = number_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    with Steps(docs.sparkSession) as steps:
        spans = repeated_spans(rows.select("row", "text"), steps, width)
    joined = rows.join(spans, "row", "left").select("doc_id", "text", "spans")
    schema = f"doc_id {kind}, kept binary, removed array<struct<start:bigint,stop:bigint>>, n_bytes bigint"
    return joined.mapInArrow(_keep, schema)


def without_repeats(docs: DataFrame, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All rows of `docs` with their columns, the text cut as `remove_repeats` cuts it.

    A character that a cut divides goes as a whole. A null text stays null, and `n_chars`, if there
    is such a column, is counted anew. An empty or short text stays as it is, rows that are equal in
    all columns are rows of their own, and other columns may have any names and values.
    """
    names = {c: free_name(docs, f"{c}_of_text") for c in ("row", "of", "spans")}
    numbered = number_rows(docs, names["row"])
    rows = numbered.select(F.col(names["row"]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with Steps(docs.sparkSession) as steps:
        spans = repeated_spans(rows, steps, width).withColumnsRenamed({"row": names["of"], "spans": names["spans"]})
    joined = numbered.join(spans, F.col(names["row"]) == F.col(names["of"]), "left").drop(names["row"], names["of"])
    place, last, names_out = docs.columns.index(text_col), len(docs.columns), docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices([batch], batch.schema.names[place]):
                spans = part.column(last).to_pylist()
                valid = part.column(place).is_valid().to_pylist()
                texts = [
                    (_cut(raw, s)[0] if s else raw).decode("utf-8", "ignore") if ok else None
                    for raw, s, ok in zip(raws, spans, valid, strict=True)
                ]
                columns = list(part.columns[:last])
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names_out)

    # Spark's Arrow functions take no columns with a dot in their name, but they can return such.
    out = joined.toDF(*[f"c{k}" for k in range(last + 1)]).mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length(text_col).cast(kind))
    return out
