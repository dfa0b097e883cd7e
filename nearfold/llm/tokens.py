"""Token ids of whole texts, by a tokenizers file.

The vocabulary named below drops white space, and its pre-tokenizer parts letters from other marks.
The ids of a text are hence those of its runs of letters and runs of other marks in a row, and a run
that was seen before needs no second encoding. A text where this could fail (special tokens, marks
outside ASCII, quotes at the end of a word) is encoded as a whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from nearfold.llm.batches import ragged
from nearfold.llm.words import BYTE_HASH, mix, powers

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 white space, 1 letters, bytes outside ASCII and apostrophes, 2 all else.
_KIND = np.full(256, 2, dtype=np.int8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = _KIND[128:] = _KIND[39] = 1
_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U)
_SLOTS = 1 << 20
#: The library keeps about a kilobyte for each text of a batch until its ids are taken.
_AT_ONCE = 512
_encoders: dict[str, RunEncoder] = {}


class RunEncoder:
    """Encodes texts run by run and remembers up to `capacity` runs in an open hash table."""

    def __init__(self, path: str, capacity: int = _SLOTS // 3) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.capacity = capacity
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(_SLOTS, dtype=_U)
        self.heads = np.zeros(_SLOTS, dtype=_U)
        self.codes = np.full(_SLOTS, -1, dtype=np.int32)
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.lengths = np.zeros(1 << 16, dtype=np.int64)
        self.unsafe = np.zeros(1 << 16, dtype=bool)
        self.known = self.used = 0

    def _look_up(self, keys: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Code of each run, -1 if it is new."""
        slots = (keys & _U(_SLOTS - 1)).astype(np.int64)
        codes = self.codes[slots]
        open_ = np.flatnonzero((codes >= 0) & ((self.keys[slots] != keys) | (self.heads[slots] != heads)))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (_SLOTS - 1)
            at = slots[open_]
            codes[open_] = self.codes[at]
            other = (self.keys[at] != keys[open_]) | (self.heads[at] != heads[open_])
            open_ = open_[(codes[open_] >= 0) & other]
        return codes

    def _insert(self, keys: np.ndarray, heads: np.ndarray, codes: np.ndarray) -> None:
        slots = (keys & _U(_SLOTS - 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.codes[slots[left]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.heads[slots[put]] = keys[put], heads[put]
            self.codes[slots[put]] = codes[put]
            waits = np.ones(len(keys), dtype=bool)
            waits[put] = False
            left = left[waits[left]]
            slots[left] = (slots[left] + 1) & (_SLOTS - 1)

    def _code(self, runs: list[bytes]) -> None:
        model, ids, rest = self.tokenizer.model, [()] * len(runs), []
        for k, run in enumerate(runs):
            if run.isalpha():  # small ASCII letters: nothing to normalise, one pre-token
                ids[k] = [t.id for t in model.tokenize(run.decode())]
            else:
                rest.append(k)
        first, last = self.known, self.known + len(runs)
        self.unsafe = _room(self.unsafe, last)
        for at in range(0, len(rest), _AT_ONCE):
            some = rest[at : at + _AT_ONCE]
            texts = [runs[k].decode("utf-8", "replace") for k in some]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for k, text, e in zip(some, texts, found, strict=True):
                ids[k] = e.ids
                odd = not text.isascii() and not text.replace("'", "").isalpha()
                self.unsafe[first + k] = odd or text[0] == "'" or text[-1] == "'"
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
        self.ids = _room(self.ids, self.used + len(flat))
        self.starts, self.lengths = _room(self.starts, last), _room(self.lengths, last)
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[first:last] = self.used + np.cumsum(sizes) - sizes
        self.lengths[first:last] = sizes
        self.known, self.used = last, self.used + len(flat)

    def encode(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        if self.known > self.capacity:
            self._forget()
        joined = b"\n".join(raws) + b"\n"
        low = np.zeros(len(joined) + 8, dtype=np.uint8)
        low[:-8] = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
        kind = _KIND[low[:-8]]
        change = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
        begins = kind[change] > 0
        starts = change[begins]
        # The text ends with white space, so every run is followed by a change.
        ends = change[1:][begins[:-1]]
        sizes = ends - starts
        total = np.zeros(len(kind) + 1, dtype=_U)
        np.cumsum(BYTE_HASH[low[:-8]] * powers(len(kind)), out=total[1:])
        keys = mix((total[ends] - total[starts]) * powers(len(kind), inverse=True)[starts] + sizes.astype(_U))
        eight = np.ndarray((len(kind),), dtype="<u8", buffer=low, strides=(1,))
        heads = eight[starts] & _HEAD[np.minimum(sizes, 8)]
        codes = self._look_up(keys, heads)
        new = np.flatnonzero(codes < 0)
        if len(new):
            _, first = np.unique(keys[new], return_index=True)
            new, small, known = new[first], low.tobytes(), self.known
            self._code([small[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            self._insert(keys[new], heads[new], np.arange(known, self.known, dtype=np.int32))
            missing = codes < 0
            codes[missing] = self._look_up(keys[missing], heads[missing])
        lengths = self.lengths[codes]
        ids = self.ids[ragged(self.starts[codes], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        last_run = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in raws]))
        ends_at = upto[last_run]
        counts = np.diff(ends_at, prepend=0)
        risky = np.diff(np.concatenate([[0], np.cumsum(self.unsafe[codes])])[last_run], prepend=0) > 0
        whole = [k for k, raw in enumerate(raws) if risky[k] or b"<|" in raw]
        if not whole:
            return ids, counts
        parts = np.split(ids, ends_at[:-1])
        for k in whole:
            text = raws[k].decode("utf-8", "replace")
            parts[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)
            counts[k] = len(parts[k])
        return np.concatenate(parts), counts


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    wider = np.zeros(max(n, 2 * len(array)), dtype=array.dtype)
    wider[: len(array)] = array
    return wider


def encoder(path: str) -> RunEncoder:
    """The encoder of this Python worker for the file at `path`."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        _encoders[path] = RunEncoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
