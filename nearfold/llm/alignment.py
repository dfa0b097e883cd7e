"""Tokens of two tokenizers aligned by the bytes they cover.

Both tokenizers spell the same bytes, a space and the text. Where a token of each ends at one place is
a cut; cuts part the tokens into groups, the smallest runs that correspond. Two tokens are linked where
their bytes overlap; every stretch between two neighbouring ends, of either side, is one link.

A document is cut into chunks of `CHUNK` bytes, each with the tokens that end in it. A chunk knows its
cuts and hence a fragment: an open prefix up to its first cut, closed groups, an open suffix behind its
last cut. Fragments are a monoid: two in a row compose to one, where the suffix of the first and the
prefix of the second close one more group, and the order of compositions does not matter. So the chunks
of long documents spread over the tasks and are composed in a tree, `FAN` fragments at a time. Most
documents are one chunk and closed at once.

How often a pair of ids is linked in the corpus is a sum over the pairs of all chunks. The `HOT` most
frequent pairs are broadcast (a bound that does not grow), which settles nearly all links within the
row; what is left is rare, hence spread evenly, and joins the counts by a shuffle.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nearfold.llm.batches import ragged, slices
from nearfold.session import Steps, freeze

CHUNK = 1 << 16
FAN = 16
HOT = 1 << 18
#: Distinct pairs that a task holds before it passes them on.
PAIRS_AT_ONCE = 1 << 20
#: Words that a library encodes in one call, and about how many a worker remembers.
_AT_ONCE = 1 << 12
WORDS_KEPT = 1 << 18
_tokenizers: dict[tuple[str, str], Tokenizers] = {}


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, dtype: type) -> None:
        self.n, self.room = 0, np.zeros(1 << 12, dtype=dtype)

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.zeros(max(2 * len(self.room), self.n + len(values)), dtype=self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)

    def of(self, places: np.ndarray) -> np.ndarray:
        return self.room[places]


class _Words:
    """Words with a number each, the ids, starts and sizes of both sides, and whether they spell the word."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.chars = 0
        self.a, self.b = ([_Grown(np.int32), _Grown(np.int64), _Grown(np.int32)] for _ in range(2))
        self.spelled = _Grown(bool)


class Tokenizers:
    """Both tokenizers of a Python worker, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        byte_of = _byte_level()
        self.a_bytes = [
            bytes(map(byte_of.__getitem__, t)) if set(t) <= set(byte_of) else b"" for t in map(self.a.id_to_token, range(self.n_a))
        ]
        self.b_bytes = [_piece_bytes(self.b, k) for k in range(self.n_b)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # Every id followed by a comma or by the mark that ends its side of a group.
        ends = [f"{k}{mark}".encode() for n, last in ((self.n_a, "|"), (self.n_b, ";")) for k in range(n) for mark in (",", last)]
        self.spelled_sizes = np.array([len(x) for x in ends])
        width = int(self.spelled_sizes.max())
        self.spelled = np.frombuffer(b"".join(x.ljust(width) for x in ends), dtype=np.uint8).reshape(-1, width)
        self.spelled_mask = np.arange(width) < self.spelled_sizes[:, None]
        self.key_type = np.uint32 if self.n_a * self.n_b < 1 << 32 else np.uint64
        self.words = _Words()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of side A of all texts in a row, how many each text has, the same of side B, and whether they spell it.

        No token of either side goes on over a single space between other characters, so the tokens of a
        text are those of its words, each with the space before it, and a word that was seen before is not
        encoded again. A text in which spaces stand otherwise is taken as one word.
        """
        parts = [[t] if "  " in t or "▁" in t or t[:1] == " " or t[-1:] == " " else t.split(" ") for t in texts]
        words = list(chain.from_iterable(parts))
        if len(self.words.codes) > WORDS_KEPT or self.words.chars > 16 * WORDS_KEPT:
            self.words = _Words()
        self._learn([w for w in dict.fromkeys(words) if w not in self.words.codes])
        codes = np.fromiter(map(self.words.codes.__getitem__, words), dtype=np.int64, count=len(words))
        last = np.cumsum([len(p) for p in parts])
        sides = []
        for ids, starts, sizes in (self.words.a, self.words.b):
            own = sizes.of(codes)
            upto = np.concatenate([[0], np.cumsum(own)])[last]
            sides += [ids.of(ragged(starts.of(codes), own)), np.diff(upto, prepend=0)]
        wrong = np.concatenate([[0], np.cumsum(~self.words.spelled.of(codes))])[last]
        return *sides, np.diff(wrong, prepend=0) == 0

    def _learn(self, words: list[str]) -> None:
        known = self.words
        for at in range(0, len(words), _AT_ONCE):
            some = words[at : at + _AT_ONCE]
            a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in some], add_special_tokens=False)]
            b = self.b.encode(some, num_threads=1)
            for side, found in ((known.a, a), (known.b, b)):
                sizes = np.array([len(x) for x in found], dtype=np.int64)
                side[1].add(side[0].n + np.cumsum(sizes) - sizes)
                side[2].add(sizes)
                side[0].add(np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum())))
            known.spelled.add(self._spelled(some, a, b))
            for w in some:
                known.codes[w] = len(known.codes)
                known.chars += len(w)

    def _spelled(self, words: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """For each word whether both sides spell a space and the word."""
        spoken = [b" " + w.encode() for w in words]
        right = np.ones(len(words), dtype=bool)
        for ids, table, sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            flat = list(chain.from_iterable(ids))
            upto = np.concatenate([[0], np.cumsum(sizes[flat])])[np.cumsum([len(x) for x in ids])] if flat else 0
            as_long = np.array_equal(np.diff(upto, prepend=0), [len(x) for x in spoken])
            if not as_long or b"".join(map(table.__getitem__, flat)) != b"".join(spoken):
                right &= [b"".join(map(table.__getitem__, x)) == s for x, s in zip(ids, spoken, strict=True)]
        return right

    def group_texts(self, codes: np.ndarray) -> np.ndarray:
        return self.spelled[codes][self.spelled_mask[codes]]


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _piece_bytes(model, k: int) -> bytes:
    piece = model.id_to_piece(k)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _tokenizers:
        _tokenizers[a_path, b_path] = Tokenizers(a_path, b_path)
    return _tokenizers[a_path, b_path]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --------------------------------------------------------------------------------------------------
# Fragments


def _none() -> np.ndarray:
    return np.zeros(0, dtype=np.int64)


@dataclass(frozen=True)
class Open:
    """Tokens of a group that is not closed: ids and ends of both sides."""

    a: np.ndarray = field(default_factory=_none)
    a_ends: np.ndarray = field(default_factory=_none)
    b: np.ndarray = field(default_factory=_none)
    b_ends: np.ndarray = field(default_factory=_none)

    def __add__(self, other: Open) -> Open:
        return Open(*[np.concatenate([getattr(self, n), getattr(other, n)]) for n in _OPEN])


_OPEN = ("a", "a_ends", "b", "b_ends")


@dataclass(frozen=True)
class Fragment:
    """A range of a document's bytes; `closed` if it holds a cut, else all its tokens are in `left`."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: bytes = b""
    closed: bool = False
    left: Open = field(default_factory=Open)
    right: Open = field(default_factory=Open)
    #: Pairs of the groups that closed in compositions.
    keys: np.ndarray = field(default_factory=_none)
    counts: np.ndarray = field(default_factory=_none)


def compose(x: Fragment, y: Fragment, n_b: int) -> Fragment:
    """The fragment of two ranges in a row. `Fragment()` is the neutral one."""
    both = replace(
        x,
        n_a=x.n_a + y.n_a, n_b=x.n_b + y.n_b, n_groups=x.n_groups + y.n_groups, n_links=x.n_links + y.n_links,
        keys=np.concatenate([x.keys, y.keys]), counts=np.concatenate([x.counts, y.counts]),
    )
    if not x.closed:
        return replace(both, left=x.left + y.left, closed=y.closed, right=y.right, groups=y.groups)
    if not y.closed:
        return replace(both, right=x.right + y.left)
    seam, parts = x.right + y.left, [x.groups]
    both = replace(both, right=y.right)
    if len(seam.a):
        ends = np.union1d(seam.a_ends, seam.b_ends)
        keys = seam.a[np.searchsorted(seam.a_ends, ends)] * n_b + seam.b[np.searchsorted(seam.b_ends, ends)]
        keys, counts = np.unique(np.concatenate([both.keys, keys]), return_inverse=True)
        counts = np.bincount(counts, np.concatenate([both.counts, np.ones(len(ends))])).astype(np.int64)
        both = replace(both, n_groups=both.n_groups + 1, n_links=both.n_links + len(ends), keys=keys, counts=counts)
        parts.append(b"|".join(b",".join(b"%d" % k for k in side.tolist()) for side in (seam.a, seam.b)))
    return replace(both, groups=b";".join(p for p in [*parts, y.groups] if p))


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_ARRAYS = [f"{side}_{n}" for side in ("left", "right") for n in _OPEN]
_FRAGMENT = ", ".join(
    ["place bigint", *[f"{n} bigint" for n in _NUMBERS], "groups binary", "closed boolean",
     *[f"{n} binary" for n in [*_ARRAYS, "keys", "counts"]]]
)


def _composed(n_b: int):
    def composed(key: tuple, rows: pa.Table) -> pa.Table:
        """The fragments of one node of the tree, composed in their order."""
        found = sorted(rows.to_pylist(), key=lambda r: r["place"])

        def numbers(x: bytes) -> np.ndarray:
            return np.frombuffer(x, dtype=np.int64)

        fragments = [
            Fragment(
                **{n: r[n] for n in _NUMBERS}, groups=r["groups"], closed=r["closed"],
                left=Open(*[numbers(r[f"left_{n}"]) for n in _OPEN]), right=Open(*[numbers(r[f"right_{n}"]) for n in _OPEN]),
                keys=numbers(r["keys"]), counts=numbers(r["counts"]),
            )
            for r in found
        ]
        whole = reduce(lambda x, y: compose(x, y, n_b), fragments)
        row = _as_row(whole) | {"row": key[0].as_py(), "doc_id": found[0]["doc_id"], "place": key[1].as_py()}
        row["node"] = row["place"]
        return pa.Table.from_pylist([row], schema=rows.schema)

    return composed


def _as_row(x: Fragment) -> dict:
    sides = {f"{side}_{n}": getattr(getattr(x, side), n) for side in ("left", "right") for n in _OPEN}
    arrays = {n: v.astype(np.int64).tobytes() for n, v in (sides | {"keys": x.keys, "counts": x.counts}).items()}
    return {n: getattr(x, n) for n in _NUMBERS} | {"groups": x.groups, "closed": x.closed} | arrays


# --------------------------------------------------------------------------------------------------
# Chunks

_CHUNKS = f"n_chunks bigint, sha string, pair_keys binary, pair_counts binary, {_FRAGMENT}"


def _empty_row(row: object, doc_id: object) -> dict:
    return _as_row(Fragment()) | {
        "row": row, "doc_id": doc_id, "place": 0, "n_chunks": 1, "sha": "", "pair_keys": b"", "pair_counts": b"",
    }


def chunk_rows(
    tools: Tokenizers, raws: list[bytes], ids: list[tuple], chunk: int, keep_groups: bool
) -> Iterator[dict]:
    """A row for every chunk of the texts: its fragment, and the pairs of its closed groups.

    All texts lie on one axis of bytes, where ends, cuts and chunks of both sides are places.
    """
    a, n_a, b, n_b, spelled_right = tools.encode([r.decode("utf-8", "replace") for r in raws])
    fine = spelled_right & (np.array([len(r) for r in raws]) > 0)
    good = np.flatnonzero(fine).tolist()
    for k in np.flatnonzero(~fine).tolist():
        yield _empty_row(*ids[k])
    if not good:
        return
    a, b = a[np.repeat(fine, n_a)].astype(np.int64), b[np.repeat(fine, n_b)].astype(np.int64)
    sizes = np.array([len(raws[k]) + 1 for k in good])
    base = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    a_ends, b_ends = np.cumsum(tools.a_sizes[a]), np.cumsum(tools.b_sizes[b])
    in_a, in_b = np.zeros(total + 1, dtype=bool), np.zeros(total + 1, dtype=bool)
    in_a[a_ends], in_b[b_ends] = True, True
    is_cut = in_a & in_b
    is_cut[0] = True
    cuts = np.flatnonzero(is_cut)
    # Chunks: the bytes after `low` up to `high`, of the document `doc`.
    n_chunks = -(-sizes // chunk)
    doc = np.repeat(np.arange(len(good)), n_chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    low = base[doc] + nth * chunk
    high = np.minimum(low + chunk, base[doc] + sizes[doc])
    # `first` and `last` cut of a chunk, its lower edge counting as one; both `high` without any.
    since, until = np.searchsorted(cuts, low), np.searchsorted(cuts, high, "right")
    closed = since < until
    first = np.where(closed, cuts[np.minimum(since, len(cuts) - 1)], high)
    last = np.where(closed, cuts[until - 1], high)
    n_groups = np.where(closed, until - since - 1, 0)

    ends = np.flatnonzero(in_a | in_b)
    owner = np.searchsorted(high, ends)
    inner = (ends > first[owner]) & (ends <= last[owner])
    ends, owner = ends[inner], owner[inner]
    n_links = np.bincount(owner, minlength=len(doc))
    before_a, before_b = np.cumsum(in_a), np.cumsum(in_b)
    keys = a[before_a[ends] - in_a[ends]] * tools.n_b + b[before_b[ends] - in_b[ends]]
    pairs, counts = np.unique(owner * (tools.n_a * tools.n_b) + keys, return_counts=True)
    pair_at = np.searchsorted(pairs, np.arange(len(doc) + 1) * (tools.n_a * tools.n_b))
    pairs = (pairs % (tools.n_a * tools.n_b)).astype(tools.key_type)
    counts = counts.astype(np.uint32)

    # Tokens of closed groups, a group's A side before its B side, spelled in that order.
    def spelled(tokens: np.ndarray, places: np.ndarray, other: np.ndarray, side: int) -> tuple[np.ndarray, ...]:
        at = np.searchsorted(high, places)
        here = (places > first[at]) & (places <= last[at])
        group = np.searchsorted(cuts, places[here])
        code = 2 * (tokens[here] + side * tools.n_a) + other[places[here]]
        return 2 * group + side, code, at[here]

    order, code, at = (np.concatenate(x) for x in zip(spelled(a, a_ends, in_b, 0), spelled(b, b_ends, in_a, 1), strict=True))
    by = np.argsort(order, kind="stable")
    code, at = code[by], at[by]
    spoken = tools.group_texts(code).tobytes()
    text_at = np.concatenate([[0], np.cumsum(np.bincount(at, tools.spelled_sizes[code], len(doc)).astype(np.int64))])
    a_at = np.searchsorted(a_ends, np.stack([low, first, last, high]), "right")
    b_at = np.searchsorted(b_ends, np.stack([low, first, last, high]), "right")

    def open_(r: int, start: int, stop: int) -> Open:
        sa, sb = slice(a_at[start, r], a_at[stop, r]), slice(b_at[start, r], b_at[stop, r])
        zero = base[doc[r]]
        return Open(a[sa], a_ends[sa] - zero, b[sb], b_ends[sb] - zero)

    for r in range(len(doc)):
        groups = spoken[text_at[r] : max(text_at[r], text_at[r + 1] - 1)]
        row, doc_id = ids[good[doc[r]]]
        single = n_chunks[doc[r]] == 1
        fragment = Fragment(
            int(a_at[3, r] - a_at[0, r]), int(b_at[3, r] - b_at[0, r]), int(n_groups[r]), int(n_links[r]),
            groups if keep_groups or not single else b"", bool(closed[r]),
            Open() if single else open_(r, 0, 1), Open() if single else open_(r, 2, 3),
        )
        yield _as_row(fragment) | {
            "row": row, "doc_id": doc_id, "place": int(nth[r]), "n_chunks": int(n_chunks[doc[r]]),
            "sha": hashlib.sha256(groups).hexdigest() if single else None,
            "pair_keys": pairs[pair_at[r] : pair_at[r + 1]].tobytes(), "pair_counts": counts[pair_at[r] : pair_at[r + 1]].tobytes(),
        }


def _chunks(a_path: str, b_path: str, chunk: int, keep_groups: bool, kind: pa.DataType):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(a_path, b_path)
        schema = _arrow_schema(kind)
        for batch, raws in slices(batches, "text"):
            ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            yield pa.RecordBatch.from_pylist(list(chunk_rows(tools, raws, ids, chunk, keep_groups)), schema)

    return chunks


def _arrow_schema(kind: pa.DataType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.strip().split(" ") for x in _CHUNKS.split(",")]
    return pa.schema([("row", pa.int64()), ("doc_id", kind), *[(n, kinds[k]) for n, k in fields]])


# --------------------------------------------------------------------------------------------------
# Counts of pairs


def _numbers(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), dtype=kind)


def _sums(key_type: type):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a task with their counts, `key, n`."""
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            more = _numbers(batch.column(0), key_type).astype(np.int64)
            keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
            weights = np.concatenate([counts, _numbers(batch.column(1), np.uint32)])
            counts = np.bincount(at, weights, len(keys)).astype(np.int64)  # exact up to 2**53
            if len(keys) >= PAIRS_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
                keys, counts = keys[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return sums


def _looked_up(hot, key_type: type):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row what its hot pairs add, and the other pairs."""
        keys, counts, best = hot.value
        for batch in batches:
            own = _numbers(batch.column(1), key_type).astype(np.int64)
            n = _numbers(batch.column(2), np.uint32).astype(np.int64)
            ends = np.cumsum([len(x or b"") for x in batch.column(1).to_pylist()]) // key_type().itemsize
            at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            is_hot = keys[at] == own if len(keys) else np.zeros(len(own), dtype=bool)
            at = at[is_hot]
            for_best, for_sum = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
            for_best[is_hot], for_sum[is_hot] = n[is_hot] * best[at], n[is_hot] * counts[at]
            per_row = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends], prepend=0) for x in (for_best, for_sum, ~is_hot)]
            cold = pa.StructArray.from_arrays([pa.array(own[~is_hot]), pa.array(n[~is_hot])], ["key", "n"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(per_row[2])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(per_row[0]), pa.array(per_row[1]), pa.ListArray.from_arrays(offsets, cold)],
                ["row", "n_best", "count_sum", "cold"],
            )

    return look_up


# --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Alignment:
    """`rows`, one for each document, and `pairs`: `a_id, b_id, count, best`."""

    rows: DataFrame
    pairs: DataFrame


def _tree(chunks: DataFrame, steps: Steps, n_b: int) -> DataFrame:
    """Fragments of the documents of more than one chunk, composed to one each."""
    fields = [x.strip().split(" ")[0] for x in _FRAGMENT.split(",")]
    open_ = chunks.filter("n_chunks > 1").select("row", "doc_id", *fields)
    left = chunks.agg(F.max("n_chunks")).first()[0] or 1
    while left > 1:
        node = open_.withColumn("node", F.floor(F.col("place") / FAN)).groupBy("row", "node")
        schema = open_.withColumn("node", F.lit(0).cast("bigint")).schema
        open_ = steps.freeze(node.applyInArrow(_composed(n_b), schema).drop("node"), f"fragments-{left}")
        left = -(-left // FAN)
    return open_


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    paths: tuple[str, str] | None = None,
    chunk: int = CHUNK,
    hot: int = HOT,
    keep_groups: bool = False,
) -> Alignment:
    """Align the byte-level tokenizer at the first path with the sentencepiece model at the second.

    `rows` has for every row of `docs`: `doc_id, n_a, n_b, n_groups, n_links`; `n_best`, the links whose
    pair is the most frequent one of its B id, ties included; `count_sum`, the counts of all links' pairs;
    `groups_sha256`, the digest of the groups as `a1,a2|b1;a3|b2`, and with `keep_groups` that text in
    `groups`. A count says in how many links of the whole corpus a pair of ids stands.

    A null or empty text, and one whose tokens spell something else than a space and the text, has no
    tokens: zeros and an empty digest. A null id stays null; rows that share an id or are equal in all
    columns count as rows of their own. Special tokens within texts are plain text. Texts are encoded as
    a whole, whatever their length; other columns are not read. `docs` is read once and tokenized once.
    """
    spark = docs.sparkSession
    paths = paths or default_paths()
    tools = tokenizers(*paths)
    n_b, key_type = tools.n_b, tools.key_type
    kind = docs.schema[id_col].dataType
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    arrow = to_arrow_type(kind)
    schema = f"row bigint, doc_id {kind.simpleString()}, {_CHUNKS}"
    with Steps(spark) as steps:
        chunks = steps.freeze(read.mapInArrow(_chunks(*paths, chunk, keep_groups, arrow), schema), "chunks")
        long = _tree(chunks, steps, n_b)
        pairs = chunks.select("row", "pair_keys", "pair_counts")
        seams = long.select("row", "keys", "counts").mapInArrow(_narrowed(key_type), "row bigint, pair_keys binary, pair_counts binary")
        pairs = pairs.unionByName(seams)
        sums = pairs.select("pair_keys", "pair_counts").mapInArrow(_sums(key_type), "key bigint, n bigint")
        of_b = Window.partitionBy("b_id")
        totals = sums.groupBy("key").agg(F.sum("n").alias("count")).withColumn("b_id", F.col("key") % n_b)
        totals = freeze(
            totals.withColumn("best", F.col("count") == F.max("count").over(of_b)).select(
                "key", F.floor(F.col("key") / n_b).alias("a_id"), "b_id", "count", "best"
            ),
            "pairs",
        )
        top = totals.orderBy(F.desc("count"), "key").limit(hot).select("key", "count", "best").toArrow().sort_by("key")
        shared = spark.sparkContext.broadcast(tuple(c.combine_chunks().to_numpy(zero_copy_only=False) for c in top.columns))
        looked_up = steps.freeze(
            pairs.mapInArrow(_looked_up(shared, key_type), "row bigint, n_best bigint, count_sum bigint, cold array<struct<key:bigint,n:bigint>>"),
            "links",
        )
        cold = looked_up.select("row", F.inline("cold")).join(totals, "key")
        cold = cold.select(
            "row", F.when(F.col("best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("count")).alias("count_sum")
        )
        added = looked_up.select("row", "n_best", "count_sum").unionByName(cold)
        whole = chunks.filter("n_chunks = 1").select("row", "doc_id", *_NUMBERS, "sha", "groups")
        whole = whole.unionByName(long.select("row", "doc_id", *_NUMBERS, F.sha2("groups", 256).alias("sha"), "groups"))
        parts = whole.withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})
        parts = parts.unionByName(added, allowMissingColumns=True)
        rows = parts.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"),
            *[F.max(n).alias(n) for n in _NUMBERS],
            F.sum("n_best").alias("n_best"),
            F.sum("count_sum").alias("count_sum"),
            F.max("sha").alias("groups_sha256"),
            *([F.max("groups").cast("string").alias("groups")] if keep_groups else []),
        )
        rows = freeze(rows.drop("row"), "aligned")
    return Alignment(rows, totals.drop("key"))


def _narrowed(key_type: type):
    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of seams in the same width as those of chunks."""
        for batch in batches:
            columns = [
                pa.array([np.frombuffer(x, dtype=np.int64).astype(k).tobytes() for x in batch.column(c).to_pylist()], pa.binary())
                for c, k in ((1, key_type), (2, np.uint32))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "pair_keys", "pair_counts"])

    return narrowed
