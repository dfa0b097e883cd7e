"""Exact Jaccard join of word-shingle sets by partitioning the universe into segments.

Sets of n and p shingles whose Jaccard similarity is at least t differ in at most
`(1 - t) / (1 + t) * (n + p)` shingles. Sizes fall into bands, each twice as wide as the one before; a
pair belongs to the band of its larger set. A band hashes the universe into segments, four shingles
of its largest sets each. Segments are visited in an order common to the band, and a set indexes the
hashes of its segments' subsets until these are worth H + 1 credits, H the most differences to a
partner. A credit is a difference that the partner must have if it shares no entry:

* a subset of `LEAST` shingles or more is indexed itself and worth one credit;
* where the band allots it, a larger subset is indexed with its one-deletion neighbourhood and worth
  two, because a partner's subset that is neither equal nor one shingle off holds two differences;
* smaller subsets are worth nothing. They would match wherever two texts share a few words.

By the pigeonhole principle a similar pair shares the entry of a segment that both have indexed: if
the first segment on which they agree came after one of them had stopped, H + 1 differences would
lie before it. Cost decides the order and the allotment. Shingle counts of all documents per band
and hash range order segments from cheap to dear, so what many documents share (a passage, a
licence) comes last and is rarely indexed; neighbourhoods go to the cheapest segments, as many as the
credits ask for. A set whose segments cannot pay (mostly a small one) also indexes its first H + 1
shingles, as in prefix filtering; where only one of a pair cannot pay, its partner's credits suffice.

Candidates are thinned by a parity sketch: every shingle flips one bit, so two sketches differ in no
more bits than their sets differ in shingles, and a pair whose sketches differ in more than H bits is
out. This loses nothing and costs a bit or so per shingle.

Equal sets collapse first. Index entries travel as packed arrays; within a task the sets with the
same entry send one of them, the pivot, for all that its sketch allows (and for all, if very many
others remain), so no entry gathers more rows than a bound times the number of tasks. Entries give
stars, not pairs: pivot with each other set. Stars are verified on the words themselves and linked
into components. Only where sets that share an entry still lie in different components are
their sketches compared pair by pair, within a task and in tiles of bounded size; pairs inside a
component can change nothing. Of the pairs that the sketches allow, each set's nearest are verified
first and components joined, then more of what still lies apart, and last all of it. So no link
between components is lost, and a group of copies costs its size and not its square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfold.llm.batches import free_name, number_rows, ragged, slices
from nearfold.llm.graph import components
from nearfold.llm.words import SHINGLE, mix, shingle_hashes, word_hashes
from nearfold.session import Steps, freeze

_U = np.uint64
RANGES = 1 << 12
LEAST = 2
ENTRIES_PER_BUCKET = 1_000_000
FLUSH = 700_000
PAIRS_PER_GROUP = 64
#: Sets of one task and entry that travel besides the pivot; if more are left, the pivot stands for all.
UNLIKE = 32
#: Sets of a tile on either side, or half of those of a group that stands in one tile.
TILE = 2048
ROWS_PER_TASK = 20_000
OTHERS_AT_ONCE = 100_000
#: Partners of a set that are verified in one round; 0 is all, and comes last.
ROUNDS = (8, 0)


def band(n: int) -> int:
    return n.bit_length() - 1


def segments(b: int) -> int:
    return max(1, 2 ** (b + 1) // 4)


def schemes(n: int, percent: int) -> list[tuple[int, int]]:
    """Bands in which a set of `n` shingles takes part, with the most differences to a partner."""
    b, most = band(n), 100 * n // percent
    top = 2 ** (b + 1) - 1
    found = [(b, (100 - percent) * (n + min(most, top)) // (100 + percent))]
    if most > top:
        found.append((b + 1, (100 - percent) * (n + most) // (100 + percent)))
    return found


def sketches(shingles: np.ndarray, percent: int) -> list[bytes]:
    """Parity sketches of a set for each of its bands, with a bit per shingle of the largest set."""
    out = []
    for b, _ in schemes(len(shingles), percent):
        bits = 2 ** (b + 1)
        odd = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(bool)).tobytes())
    return out


def alike(n: int, own: list[int], p: int, other: list[int], percent: int) -> bool:
    """Whether two sets of these sizes and sketches (as numbers) may be similar."""
    if 100 * min(n, p) < percent * max(n, p):
        return False
    b = band(max(n, p))
    k, j = b - band(n), b - band(p)
    if k >= len(own) or j >= len(other):
        return False
    return (own[k] ^ other[j]).bit_count() <= (100 - percent) * (n + p) // (100 + percent)


def _number(sketch: bytes) -> int:
    return int.from_bytes(sketch, "little")


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def short_digest(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _sets(raws: list[bytes]) -> list[np.ndarray]:
    return shingle_hashes(*word_hashes(raws))


def _describe(percent: int):
    """One row per document, and rows with the counts of this task: `band, range, hits`."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_shingles", "key", "low", "high", "band", "range", "hits"]
        hits: dict[int, np.ndarray] = {}
        seen: set[bytes] = set()
        kind = pa.int64()
        for batch, raws in slices(batches, "text"):
            sets = _sets(raws)
            keys = [digest(s) if len(s) else None for s in sets]
            for s, key in zip(sets, keys, strict=True):
                if key is None or key in seen:
                    continue
                seen.add(key)
                spots = np.bincount((s >> _U(52)).astype(np.int64), minlength=RANGES)
                for b, _ in schemes(len(s), percent):
                    hits[b] = hits[b] + spots if b in hits else spots
            drawn = [sketches(s, percent) if len(s) else [] for s in sets]
            none = pa.nulls(len(raws), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], kind),
                    pa.array(keys, pa.binary()),
                    pa.array([x[0] if x else None for x in drawn], pa.binary()),
                    pa.array([x[1] if len(x) > 1 else None for x in drawn], pa.binary()),
                    none,
                    none,
                    pa.nulls(len(raws), kind),
                ],
                names,
            )
        for b, spots in hits.items():
            at = np.flatnonzero(spots)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(len(at), kind)] * 3,
                    *[pa.nulls(len(at), pa.binary())] * 3,
                    pa.array(np.full(len(at), b), pa.int32()),
                    pa.array(at, pa.int32()),
                    pa.array(spots[at], kind),
                ],
                names,
            )

    return describe


def allot(hits: np.ndarray, b: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank and credit of a band's segments from the counts per hash range.

    Where a band has more segments than ranges, the segments of a range share its entry.
    """
    m = segments(b)
    parts = min(m, RANGES)
    cost = hits.reshape(parts, RANGES // parts).max(axis=1)
    order = np.argsort(cost, kind="stable")
    rank = np.empty(parts, dtype=np.int64)
    rank[order] = np.arange(parts)
    # The least and the greatest sets of the band; a segment's subset is Poisson-distributed.
    needs = []
    for n in (2**b, 2 ** (b + 1) - 1):
        most = next(h for scheme, h in schemes(n, percent) if scheme == b)
        mean = n / m
        none, one, two = (np.exp(-mean) * mean**k / (1, 1, 2)[k] for k in range(3))
        single, double = m * (1 - none - one), m * (1 - none - one - two)
        needs.append((most + 1 - single) / max(double, 1e-9))
    share = min(max(max(needs) * 1.1 + 1.0 / np.sqrt(m), 0.0), 1.0)
    credit = np.ones(parts, dtype=np.int64)
    credit[order[: int(np.ceil(share * parts))]] = 2
    return rank, credit


def entries(shingles: np.ndarray, plan: dict[int, tuple[np.ndarray, np.ndarray]], percent: int) -> np.ndarray:
    """Index entries of one set, even for subsets themselves and odd for one-deletion neighbours."""
    found = []
    even = ~_U(1)
    values = mix(shingles ^ _U(0xD6E8FEB86659FD93))
    for b, most in schemes(len(shingles), percent):
        m = segments(b)
        rank, credit = plan[b]
        at = ((shingles >> _U(32)) * _U(m)) >> _U(32)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sizes = np.diff(np.append(first, len(at)))
        seg = at[first]
        part = (seg.astype(np.int64) * len(rank)) // m
        worth = np.where(sizes > LEAST, credit[part], (sizes == LEAST).astype(np.int64))
        order = np.lexsort((seg, rank[part]))
        paid = np.cumsum(worth[order])
        taken = order[: int(np.searchsorted(paid, most + 1)) + 1]
        taken = taken[worth[taken] > 0]
        sums = np.add.reduceat(values, first)
        tag = mix(seg * _U(64) + _U(b))
        found.append(mix(sums[taken] ^ tag[taken]) & even)
        double = taken[worth[taken] == 2]
        each = np.repeat(double, sizes[double])
        rest = sums[each] - values[ragged(first[double], sizes[double])]
        found.append(mix(rest ^ tag[each]) | _U(1))
        if paid[-1] <= most:
            found.append(mix(shingles[: most + 1] ^ _U(0xA0761D6478BD642F + b)) & even)
    return np.concatenate(found)


def _groups(sigs: np.ndarray, dids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows sorted by entry, subsets themselves first, and the runs of equal entries.

    An entry is even where it is a subset and odd where it is a neighbour of one.
    """
    order = np.lexsort((dids, sigs))
    sigs, dids = sigs[order], dids[order]
    fresh = np.ones(len(sigs), dtype=bool)
    fresh[1:] = (sigs[1:] != sigs[:-1]) | (dids[1:] != dids[:-1])
    sigs, dids = sigs[fresh], dids[fresh]
    name = sigs >> sigs.dtype.type(1)
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]])) if len(sigs) else np.zeros(0, int)
    return sigs, dids, first, np.diff(np.append(first, len(sigs)))


def _edges(pivots: np.ndarray, members: np.ndarray) -> np.ndarray:
    out = pivots != members
    return np.unique(np.stack([pivots[out], members[out]], axis=1), axis=0)


def _index(plan: dict[int, tuple[np.ndarray, np.ndarray]], buckets: int, percent: int):
    """Packed entries per bucket, and under negative buckets the stars found within the task."""

    def flush(sigs: list[np.ndarray], sets: dict[int, tuple[int, list[int]]]) -> Iterator[pa.RecordBatch]:
        s = np.concatenate(sigs)
        d = np.repeat(np.fromiter(sets, dtype=np.int64, count=len(sets)), [len(x) for x in sigs])
        s, d, first, sizes = _groups(s, d)
        travels = np.ones(len(s), dtype=bool)
        stands: dict[tuple[int, int], bool] = {}
        several = (sizes > 1) & ((s[first] & _U(1)) == 0)  # two neighbours of a subset tell nothing
        for a, size in zip(first[several].tolist(), sizes[several].tolist(), strict=True):
            pivot, *others = d[a : a + size].tolist()
            for x in others:
                if (pivot, x) not in stands:
                    stands[pivot, x] = x == pivot or alike(*sets[pivot], *sets[x], percent)
            unlike = [not stands[pivot, x] for x in others]
            if sum(unlike) > UNLIKE:
                stands.update(((pivot, x), True) for x in others)
                unlike = [False] * len(others)
            travels[a + 1 : a + size] = unlike
        star = np.array([p for p, is_like in stands.items() if is_like and p[0] != p[1]], dtype=np.int64)
        star = star.reshape(-1, 2)
        s, d = s[travels], d[travels]
        where = (((s >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
        order = np.lexsort((d, where))
        s, d, where = s[order].astype(np.uint32), d[order], where[order]
        ends = np.searchsorted(where, np.arange(buckets + 1))
        rows = []
        for k, (a, z) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            if a < z:  # a set once, with the number of its entries
                at = np.flatnonzero(np.concatenate([[True], d[a + 1 : z] != d[a : z - 1]]))
                counts = np.diff(np.append(at, z - a)).astype(np.uint32)
                rows.append((k, s[a:z].tobytes(), d[a:z][at].tobytes(), counts.tobytes()))
        spread = star[:, 0] % buckets if len(star) else star
        for k in np.unique(spread).tolist():
            mine = star[spread == k]
            rows.append((-1 - k, mine[:, 0].tobytes(), mine[:, 1].tobytes(), b""))
        kinds = (pa.int32(), *[pa.binary()] * 3)
        for at in range(0, len(rows), 64):
            part = list(zip(*rows[at : at + 64], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(part, kinds, strict=True)], ["bucket", "sigs", "dids", "counts"]
            )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, sets, held = [], {}, 0
        seen: set[bytes] = set()
        for _, raws in slices(batches, "text"):
            for s in _sets(raws):
                if not len(s):
                    continue
                key = digest(s)
                if key in seen:
                    continue
                seen.add(key)
                if short_digest(key) in sets:  # two sets with one short digest stay apart
                    yield from flush(sigs, sets)
                    sigs, sets, held = [], {}, 0
                sigs.append(entries(s, plan, percent))
                sets[short_digest(key)] = (len(s), [_number(x) for x in sketches(s, percent)])
                held += len(sigs[-1])
            if held > FLUSH:
                yield from flush(sigs, sets)
                sigs, sets, held = [], {}, 0
        if held:
            yield from flush(sigs, sets)

    return index


def _meet(key: tuple, group: pa.Table) -> pa.Table:
    """Stars of one bucket.

    Rows `a, b` are pivot and member: with kind 0 and 2 over tasks, by the member's subset itself or
    by a neighbour of it, with kind 1 within a task.
    """
    if key[0].as_py() < 0:
        both = [
            np.concatenate([np.frombuffer(x, dtype=np.int64) for x in group.column(c).to_pylist()])
            for c in ("sigs", "dids")
        ]
        pairs = np.unique(np.stack(both, axis=1), axis=0)
        return _rows([(1, pairs)])
    sigs, dids, counts = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()])
        for c, t in (("sigs", np.uint32), ("dids", np.int64), ("counts", np.uint32))
    )
    sigs, dids, first, sizes = _groups(sigs, np.repeat(dids, counts))
    several = (sizes > 1) & ((sigs[first] & 1) == 0)
    if not several.any():
        return _rows([])
    rows = np.repeat(several, sizes)
    odd, dids, sizes = (sigs[rows] & 1).astype(np.int64), dids[rows], sizes[several]
    first = np.cumsum(sizes) - sizes
    pivots = np.repeat(dids[first], sizes)
    even = odd == 0
    return _rows([(0, _edges(pivots[even], dids[even])), (2, _edges(pivots[~even], dids[~even]))])


def _rows(parts: list[tuple[int, np.ndarray]]) -> pa.Table:
    kinds = np.concatenate([np.full(len(x), k) for k, x in parts] or [np.zeros(0)]).astype(np.int32)
    rows = np.concatenate([x for _, x in parts] or [np.zeros((0, 2), dtype=np.int64)])
    return pa.table({"kind": kinds, "a": rows[:, 0], "b": rows[:, 1]})


def _shingle_set(raw: bytes) -> set:
    words = raw.lower().split()
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def _verify(percent: int):
    def verify(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows:
            one = _shingle_set(left.column("text")[0].as_py())
            for b, raw in zip(right.column("b").to_pylist(), right.column("other"), strict=True):
                other = _shingle_set(raw.as_py())
                shared = len(one & other)
                if 100 * shared >= percent * (len(one) + len(other) - shared):
                    found.append(b)
        return pa.table({"a": pa.array([key[0].as_py()] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return verify


def _thin(percent: int):
    """Of rows `a, b, n_a, n_b` and sketches the pairs that may be similar."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, *bits = (batch.column(k).to_pylist() for k in range(2, 8))
            low_a, high_a, low_b, high_b = ([_number(x) if x else None for x in c] for c in bits)
            keep = [
                alike(n, [x for x in (la, ha) if x is not None], p, [x for x in (lb, hb) if x is not None], percent)
                for n, p, la, ha, lb, hb in zip(n_a, n_b, low_a, high_a, low_b, high_b, strict=True)
            ]
            rows = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], ["a", "b"])

    return thin


def _words(sketches: list[bytes]) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words."""
    width = max(8, len(sketches[0]))
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in sketches), dtype="<u8").reshape(len(sketches), -1)


class _Members:
    """The sets of one tile: sizes, components, bands and sketches, by their place."""

    def __init__(
        self, n: list[int], comp: list[int], low: list[bytes], high: list[bytes | None], percent: int, limit: int
    ) -> None:
        self.n, self.comp, self.low, self.high, self.percent = np.array(n), np.array(comp), low, high, percent
        self.limit = limit
        self.wanted = np.zeros(len(n), dtype=bool)
        self.bands = np.array([band(x) for x in n])

    def pairs(self, left: np.ndarray, right: np.ndarray, odd: np.ndarray, other: np.ndarray) -> Iterator[np.ndarray]:
        """Pairs of places that lie in different components and may be similar, or each set's nearest.

        All places of such pairs are marked in `wanted`. `odd` and `other` say which sides hold their entry as a neighbour; two of them tell nothing.
        """
        for b in np.unique(self.bands[left]).tolist():
            one = np.flatnonzero(self.bands[left] == b)
            for step, mine, theirs in ((0, self.low, self.low), (1, self.high, self.low), (-1, self.low, self.high)):
                x = one[[mine[k] is not None for k in left[one].tolist()]] if step == 1 else one
                two = np.flatnonzero(self.bands[right] == b + step)
                if step == -1 and len(two):
                    two = two[[theirs[k] is not None for k in right[two].tolist()]]
                if len(x) and len(two):
                    yield from self._near(left[x], right[two], odd[x], other[two], mine, theirs)

    def _near(self, left, right, odd, other, mine, theirs) -> Iterator[np.ndarray]:
        table = _words([theirs[k] for k in right.tolist()])
        rows = _words([mine[k] for k in left.tolist()])
        n, comp = self.n[right], self.comp[right]
        for row, k, is_odd in zip(rows, left.tolist(), odd.tolist(), strict=True):
            m = int(self.n[k])
            fits = (comp != self.comp[k]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))
            if is_odd:
                fits &= ~other
            some = np.flatnonzero(fits)
            if len(some):
                gap = np.bitwise_count(table[some] ^ row).sum(axis=1)
                fits = gap <= (100 - self.percent) * (n[some] + m) // (100 + self.percent)
                near, gap = some[fits], gap[fits]
                if len(near):
                    self.wanted[k] = True
                    self.wanted[right[near]] = True
                    if self.limit:
                        near = near[np.argsort(gap, kind="stable")[: self.limit]]
                    yield np.stack([np.full(len(near), k), right[near]], axis=1)


def _mixed_pairs(percent: int, limit: int):
    def mixed_pairs(key: tuple, group: pa.Table) -> pa.Table:
        """Pairs of one tile to verify, and each set that any allowed pair holds as a pair with itself."""
        i, j = key[1].as_py(), key[2].as_py()
        group = group.sort_by("node").combine_chunks()
        node = group.column("node").to_numpy()
        members = _Members(*(group.column(c).to_pylist() for c in ("n", "comp", "low", "high")), percent, limit)
        held = group.column("groups").combine_chunks()
        place = np.repeat(np.arange(len(node)), held.value_lengths().to_numpy())
        names, block, odd = (held.flatten().field(c).to_numpy(zero_copy_only=False) for c in range(3))
        order = np.argsort(names, kind="stable")
        ends = np.flatnonzero(np.append(names[order][1:] != names[order][:-1], True)) + 1
        found = [np.zeros((0, 2), dtype=np.int64)]
        for a, z in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            rows = order[a:z]
            left, right = rows[block[rows] == i], rows[block[rows] == j]
            # Of two sets in different components one is outside the most frequent component.
            comps, counts = np.unique(members.comp[place[rows]], return_counts=True)
            most = comps[np.argmax(counts)]
            away, there = (members.comp[place[x]] != most for x in (left, right))
            near = []
            for x, y in ((left[away], right), (right[there], left[~away])):
                near += members.pairs(place[x], place[y], odd[x], odd[y])
            if near:
                found.append(np.unique(np.sort(node[np.concatenate(near)], axis=1), axis=0))
        wanted = node[members.wanted]
        pairs = np.concatenate([np.unique(np.concatenate(found), axis=0), np.stack([wanted, wanted], axis=1)])
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return mixed_pairs


def _keep_own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `node, key, text` whose text has the key; an id may stand for several texts."""
    for batch, raws in slices(batches, "text"):
        keys = batch.column(1).to_pylist()
        keep = [len(s) > 0 and digest(s) == k for s, k in zip(_sets(raws), keys, strict=True)]
        rows = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2).cast(pa.binary())], ["node", "text"])


class JaccardJoin:
    """State of one join: the input, its distinct sets and the intermediate tables."""

    def __init__(self, docs: DataFrame, percent: int, steps: Steps) -> None:
        self.docs, self.percent, self.steps = docs, percent, steps

    def describe(self) -> None:
        schema = "row bigint, doc_id bigint, n_shingles bigint, key binary, low binary, high binary, band int, range int, hits bigint"
        texts = self.docs.select("row", "doc_id", "text")
        seen = self.steps.freeze(texts.mapInArrow(_describe(self.percent), schema), "described")
        described = seen.filter("band is null")
        self.rows = described.select("row", "doc_id", "n_shingles", "key")
        counted = seen.filter("band is not null").groupBy("band", "range").agg(F.sum("hits").alias("hits"))
        hits: dict[int, np.ndarray] = {}
        for r in counted.collect():  # at most RANGES rows for each of about 20 bands
            hits.setdefault(r.band, np.zeros(RANGES, dtype=np.int64))[r.range] = r.hits
        self.plan = {b: allot(h, b, self.percent) for b, h in hits.items()}
        self.total = int(sum(h.sum() for h in hits.values()))
        # A key has one size; the least id is the one whose text is fetched.
        distinct = described.filter("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("doc_id"),
            F.min("n_shingles").alias("n"),
            F.min("low").alias("low"),
            F.min("high").alias("high"),
        )
        self.nodes = self.steps.freeze(
            distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("did", _short("key")),
            "nodes",
        )

    def index(self) -> None:
        buckets = max(16, -(-self.total * 2 // (3 * ENTRIES_PER_BUCKET)))
        packed = self.docs.select("text").mapInArrow(
            _index(self.plan, buckets, self.percent), "bucket int, sigs binary, dids binary, counts binary"
        )
        met = packed.groupBy("bucket").applyInArrow(_meet, "kind int, a bigint, b bigint")
        met = self.steps.freeze(met, "met")
        self.stars = met.groupBy("a", "b").agg((F.min("kind") == 2).alias("odd"))
        self.within = met.filter("kind = 1").select("a", "b").distinct()

    def to_nodes(self, pairs: DataFrame) -> DataFrame:
        """Pairs of short digests as pairs of nodes whose sizes and sketches allow the similarity."""
        pairs = pairs.select("a", "b")
        for side in ("a", "b"):
            columns = [F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "low", "high")]
            pairs = pairs.join(self.nodes.select(F.col("did").alias(side), *columns), side)
        fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        columns = ["node_a", "node_b", "n_a", "n_b", "low_a", "high_a", "low_b", "high_b"]
        near = pairs.filter(fits & F.expr("node_a <> node_b")).select(*columns)
        return near.mapInArrow(_thin(self.percent), "a bigint, b bigint")

    def fetch(self, wanted: DataFrame, name: str) -> DataFrame:
        """`node, text` for the nodes in `wanted`; one pass over the documents."""
        chosen = self.nodes.join(wanted.distinct(), "node", "left_semi").select(
            "node", "key", F.col("doc_id").alias("id")
        )
        texts = (
            self.docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")))
            .select("node", "key", "text")
            .mapInArrow(_keep_own_text, "node bigint, text binary")
            .dropDuplicates(["node"])
        )
        return self.steps.freeze(texts, name)

    def verify(self, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        """The pairs of nodes whose sets are similar, found on the words themselves."""
        sized = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_GROUP).cast("int").alias("parts"))
        left = (
            texts.withColumnRenamed("node", "a")
            .join(sized, "a")
            .select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
        )
        right = (
            pairs.join(sized, "a")
            .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
            .select(*(F.col(c).alias(c) for c in ("a", "part", "b", "other")))
        )
        met = left.groupBy("a", "part").cogroup(right.groupBy("a", "part"))
        return self.steps.freeze(met.applyInArrow(_verify(self.percent), "a bigint, b bigint"), f"{name}-links")

    def tile_mixed_groups(self, found: DataFrame) -> None:
        """Sets that share an entry with sets of other components so far, dealt to tiles."""
        placed = self.nodes.join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        placed = self.steps.freeze(placed.select("did", "node", "n", "low", "high", "comp"), "placed-nodes")
        # A group is a pivot with its star. A member of it that is a pivot within a task stands for
        # others; these join after groups with one least node, which mostly share their sets, are one.
        pivots = self.stars.select("a").distinct()
        star = self.stars.select(F.col("a").alias("grp"), F.col("b").alias("did"), "odd")
        star = star.unionByName(pivots.select(F.col("a").alias("grp"), F.col("a").alias("did"), F.lit(False).alias("odd")))
        behind = self.within.select(F.col("a").alias("did"), F.col("b").alias("other"))
        comps = placed.select("did", "node", "comp")
        spans = behind.join(comps.select(F.col("did").alias("other"), "comp"), "other")
        spans = spans.groupBy("did").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        rows = self.steps.freeze(star.join(comps, "did").join(spans, "did", "left"), "grouped")
        mixed = rows.groupBy("grp").agg(
            F.min(F.least("comp", "lo")).alias("x"), F.max(F.greatest("comp", "hi")).alias("y"), F.min("node").alias("lead")
        )
        rows = rows.join(mixed.filter("x <> y").select("grp", "lead"), "grp")
        rows = rows.groupBy(F.col("lead").alias("grp"), "did").agg(F.min("odd").alias("odd"))
        # What many sets share has many entries, whose groups differ in a few members: those with one
        # member of least hash become one, too.
        leads = rows.groupBy("grp").agg(F.min_by("did", F.xxhash64("did")).alias("lead"))
        rows = rows.join(leads, "grp").groupBy(F.col("lead").alias("grp"), "did").agg(F.min("odd").alias("odd"))
        rows = self.steps.freeze(rows, "members")
        rows = rows.unionByName(self.stood_for(rows, behind))
        rows = rows.groupBy("grp", "did").agg(F.min("odd").alias("odd")).join(comps, "did")
        rows = rows.groupBy("grp", "node").agg(F.min("odd").alias("odd"), F.min("comp").alias("comp"))
        rows = self.steps.freeze(rows, "merged")
        # Sets inside the component that most of a group is in need not meet each other. They stand in
        # slices of their own and meet only those outside, who meet everyone.
        sizes = rows.groupBy("grp", "comp").agg(F.count("*").alias("n"))
        sized = sizes.groupBy("grp").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"))
        small = F.col("all") <= 2 * TILE  # one tile holds them all
        sized = sized.filter("all > main.n").select(
            "grp", F.col("main.comp").alias("main"),
            F.when(small, 1).otherwise(F.ceil((F.col("all") - F.col("main.n")) / TILE)).cast("int").alias("outside"),
            F.when(small, 0).otherwise(F.ceil(F.col("main.n") / TILE)).cast("int").alias("inside"),
        )
        rows = rows.join(sized, "grp")
        # Small groups share a task.
        parts = max(1, -(-rows.count() // ROWS_PER_TASK))
        rows = rows.withColumn("part", F.pmod(F.xxhash64("grp"), F.lit(parts)))
        away, slot = (F.col("comp") != F.col("main")) | (F.col("inside") == 0), F.xxhash64("node")
        inner = F.col("outside") + F.pmod(slot, F.greatest("inside", F.lit(1)))
        rows = rows.withColumn("block", F.when(away, F.pmod(slot, "outside")).otherwise(inner).cast("int"))
        meets = F.when(away, F.col("outside") + F.col("inside")).otherwise(F.col("outside"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
        rows = rows.select(
            "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "grp", "block", "odd", "node",
        )
        # A set can be in very many groups and tiles. Its sketches and component join once for all.
        rows = rows.groupBy("node", "part", "i", "j").agg(F.collect_list(F.struct("grp", "block", "odd")).alias("groups"))
        rows = rows.groupBy("node").agg(F.collect_list(F.struct("part", "i", "j", "groups")).alias("tiles"))
        self.tiles = self.steps.freeze(rows.join(placed.drop("did", "comp"), "node"), "tiles")

    def stood_for(self, rows: DataFrame, behind: DataFrame) -> DataFrame:
        """The sets behind the members of each group, once for a group however many members they are behind.

        They travel packed, in slices so small that a group's slice is about `OTHERS_AT_ONCE` numbers.
        """
        sizes = behind.groupBy("did").agg(F.count("*").alias("n"))
        total = rows.join(sizes, "did").agg(F.sum("n")).first()[0] or 0
        slices = max(1, -(-total // OTHERS_AT_ONCE))
        packed = behind.withColumn("slice", F.pmod(F.xxhash64("other"), F.lit(slices))).groupBy("did", "slice")
        packed = packed.agg(F.collect_list("other").alias("others"))
        met = rows.select("grp", "did").join(packed, "did").groupBy("grp", "slice")
        once = met.agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        return once.select("grp", F.explode("others").alias("did"), F.lit(False).alias("odd"))

    def cross_pairs(self, found: DataFrame, limit: int) -> DataFrame:
        """Pairs of nodes in one tile that may be similar and lie in different components by now.

        With a `limit`, so many of the nearest for each node. Pairs `a = b` name the nodes of all.
        """
        rows = self.tiles.join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        rows = rows.select("node", "n", "low", "high", "comp", F.inline("tiles"))
        met = rows.groupBy("part", "i", "j")
        return met.applyInArrow(_mixed_pairs(self.percent, limit), "a bigint, b bigint").distinct()

    def solve(self) -> DataFrame:
        """`node, component` of the nodes with links."""
        self.describe()
        self.index()
        ends = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        tried = self.steps.freeze(self.to_nodes(self.stars).select(*ends).distinct(), "star-pairs")
        nodes = tried.select(F.col("a").alias("node")).unionByName(tried.select(F.col("b").alias("node")))
        texts = self.fetch(nodes, "star-texts")
        links = self.verify(tried, texts, "star")
        found = components(links)
        self.tile_mixed_groups(found)
        for turn, limit in enumerate(ROUNDS):
            met = self.steps.freeze(self.cross_pairs(found, limit), f"met-{turn}")
            if turn == 0:  # later rounds hold no other nodes
                missing = met.filter("a = b").select(F.col("a").alias("node")).join(texts, "node", "left_anti")
                missing = self.steps.freeze(missing, "missing")
                if not missing.isEmpty():
                    texts = texts.unionByName(self.fetch(missing, "more-texts"))
            pairs = met.filter("a <> b").join(tried, ["a", "b"], "left_anti")
            pairs = self.steps.freeze(pairs, f"pairs-{turn}")
            if pairs.isEmpty():
                if limit:
                    continue
                break
            more = self.verify(pairs, texts, f"round-{turn}")
            tried = tried.unionByName(pairs)
            if not more.isEmpty():
                links = links.unionByName(more)
                found = components(links)
        return found


def _short(column: str) -> Column:
    """The first eight bytes of a key as a little-endian bigint, as `short_digest` reads them."""
    pairs = F.concat(*[F.substring(F.hex(column), 15 - 2 * k, 2) for k in range(8)])
    return F.conv(pairs, 16, -10).cast("bigint")


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """`doc_id, n_shingles, component_id, row, kept` for every row of `docs`.

    Words are runs of bytes other than space and 0x09 to 0x0D after A-Z became a-z; a set holds the
    distinct runs of five words, or all words of a shorter text as one. Two rows link when
    `100 * shared >= percent * union`. Null texts and texts without words have no shingles and link
    with nothing. Rows with equal sets always link. The component's id is its smallest id; an id that
    stands on several rows is one document for this and several rows of the result. A null id stays
    null as a row's id and counts as an id of a component only if no other is there. Ids are whole
    numbers, or text that holds such; other text counts as a null id. `row` is the number that
    `number_rows` gives the row, the same for each read of files; `kept` is true for one row of each
    component, of those with its id the first, and for every row without shingles. Other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).try_cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return _grouped_rows(number_rows(rows), percent)


def _grouped_rows(rows: DataFrame, percent: int) -> DataFrame:
    """`similar_groups` of rows `row, doc_id, text`, with the column `row`."""
    if not 50 <= percent <= 100:
        raise ValueError("bands fit similarities from 50 to 100 per cent")
    with Steps(rows.sparkSession) as steps:
        join = JaccardJoin(rows, percent, steps)
        found = join.solve()
        comps = join.nodes.join(found, "node", "left").select("key", F.coalesce("component", "node").alias("comp"))
        placed = steps.freeze(join.rows.join(comps, "key", "left").drop("key"), "placed")
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        leads = placed.filter("comp is not null").groupBy("comp").agg(F.min(order).alias("lead"))
        out = placed.join(leads, "comp", "left")
        alone = F.col("comp").isNull()
        return freeze(
            out.select(
                "doc_id",
                "n_shingles",
                F.when(alone, F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("component_id"),
                "row",
                (alone | (F.col("row") == F.col("lead.row"))).alias("kept"),
            ),
            "similar-groups",
        )


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """The rows of `docs` that `similar_groups` keeps, with all their columns, whatever their names.

    Nulls, empty texts, equal rows and ids are taken as there; a table without rows stays one.
    """
    number = free_name(docs, "row_of_text")
    numbered = number_rows(docs, number)
    rows = numbered.select(
        F.col(number).alias("row"), F.col(id_col).try_cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    gone = _grouped_rows(rows, percent).filter(~F.col("kept")).select(F.col("row").alias(number))
    return numbered.join(gone, number, "left_anti").drop(number)
