"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space and 0x09 to 0x0D, after A-Z became a-z.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit numbers whose outputs look random."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


RAW_BYTE_HASH = mix(np.arange(256, dtype=_U) + _U(77))
BYTE_HASH = RAW_BYTE_HASH.copy()
BYTE_HASH[65:91] = BYTE_HASH[97:123]
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
#: Also a gap for `located_words`: every ASCII byte but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first `n` powers of the base of the rolling hash, or of its inverse."""
    base = _INVERSE if inverse else _BASE
    if base not in _tables or len(_tables[base]) < n:
        _tables[base] = _powers(base, max(n, 5 << 18))
    return _tables[base][:n]


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the number of words of each text."""
    hashes, _, _, counts = located_words(raws)
    return hashes, counts


def located_words(
    raws: list[bytes], gap: np.ndarray = _GAP
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of all texts joined by line feeds, and words of each text."""
    buf = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    edge = np.diff((~gap[buf]).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, dtype=_U), starts, ends, np.zeros(len(raws), dtype=np.int64)
    total = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum(BYTE_HASH[buf] * powers(len(buf)), out=total[1:])
    hashes = (total[ends] - total[starts]) * powers(len(buf), inverse=True)[starts]
    bounds = np.cumsum([len(x) + 1 for x in raws])
    upto = np.searchsorted(starts, bounds)
    # The length goes in too, so that a word and its repetition differ in more than a sum.
    return mix(hashes + (ends - starts).astype(_U)), starts, ends, np.diff(upto, prepend=0)


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than five words make one shingle."""
    n = len(words)
    keys = [mix(np.array([k + 1], dtype=_U))[0] | _U(1) for k in range(SHINGLE)]
    rolled = np.zeros(max(n - SHINGLE + 1, 0), dtype=_U)
    for k in range(SHINGLE):
        rolled += words[k : k + len(rolled)] * keys[k]
    rolled = mix(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if count >= SHINGLE:
            out.append(np.unique(rolled[at : at + count - SHINGLE + 1]))
        elif count:
            short = np.add.reduce(words[at : at + count] * np.array(keys[:count], dtype=_U), dtype=_U)
            out.append(mix(np.array([short ^ _U(count)], dtype=_U)))
        else:
            out.append(np.zeros(0, dtype=_U))
        at += count
    return out
