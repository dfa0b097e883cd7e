"""Language of texts by a linear-chain conditional random field over their words.

Every word is labelled, so a text may switch language within a line; the text's language is the one
with most probability over its words. A word's features are its affixes, its letter n-grams, itself,
and the learned lexicons it stands in; transitions between labels are learned too, from training
chains that are pieced together from texts of several languages. Marginals come from
forward-backward. Chains are cut every `CHAIN` words, so memory does not grow with a text, and all
words of a text count.

Training reads a bounded sample of rows, `SAMPLE` texts of each language, and the whole of each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.llm.batches import least_hashed, ragged, slices, some_of_each
from nearfold.llm.words import MARKS, located_words, mix

_U = np.uint64
SAMPLE = 200
CHAIN = 64
UNKNOWN = "und"
_BITS = 17
_AFFIX = 4
_GRAMS = (2, 3)
_EPOCHS = 4
_PIECE = 16
_NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


@dataclass
class Words:
    """Words of some texts: distinct ones with their bytes, and which each place holds."""

    buf: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    which: np.ndarray
    counts: np.ndarray


def words_of(raws: list[bytes]) -> Words:
    """All words with a letter. Bytes outside ASCII count as letters here."""
    hashes, starts, ends, counts = located_words(raws, MARKS)
    buf = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8).copy()
    capital = (buf >= 65) & (buf <= 90)
    buf[capital] += 32
    letters = np.concatenate([[0], np.cumsum(~_NO_LETTER[buf])])
    has = letters[ends] > letters[starts] if len(starts) else np.zeros(0, dtype=bool)
    text = np.repeat(np.arange(len(raws)), counts)[has]
    distinct, first, which = np.unique(hashes[has], return_index=True, return_inverse=True)
    counts = np.bincount(text, minlength=len(raws))
    return Words(buf, distinct, starts[has][first], ends[has][first], which, counts)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word number and hashed feature, one row for each feature of each distinct word."""
    buf, starts, ends = words.buf.astype(_U), words.starts, words.ends
    sizes, number = ends - starts, np.arange(len(starts))
    owners, codes = [number], [words.hashes * _U(31)]
    for tag, step in ((1, 1), (2, -1)):
        code = np.zeros(len(starts), dtype=_U)
        for k in range(_AFFIX):
            has = sizes > k
            at = np.where(has, starts + k if step > 0 else ends - 1 - k, 0)
            code = code * _U(257) + buf[at] + _U(1)
            owners.append(number[has])
            codes.append(code[has] * _U(16) + _U(tag))
    for n in _GRAMS:
        spread = np.maximum(sizes - n + 1, 0)
        at = ragged(starts, spread)
        code = np.zeros(len(at), dtype=_U)
        for k in range(n):
            code = code * _U(257) + buf[at + k] + _U(1)
        owners.append(np.repeat(number, spread))
        codes.append(code * _U(16) + _U(3))
    return np.concatenate(owners), (mix(np.concatenate(codes)) >> _U(64 - _BITS)).astype(np.int64)


@dataclass
class Field:
    """The learned chain: labels, feature weights, transitions and lexicons."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=_U))
    lexicon_label: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each label for each distinct word."""
        owners, codes = self.all_features(words)
        order = np.argsort(owners, kind="stable")
        first = np.searchsorted(owners[order], np.arange(len(words.hashes)))
        if not len(first):
            return np.zeros((0, len(self.labels)))
        return np.add.reduceat(self.weights[codes[order]], first, axis=0).astype(np.float64)

    def all_features(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        owners, codes = features(words)
        if not len(self.lexicon):
            return owners, codes
        at = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
        known = np.flatnonzero(self.lexicon[at] == words.hashes)
        listed = (1 << _BITS) + self.lexicon_label[at[known]]
        return np.concatenate([owners, known]), np.concatenate([codes, listed])

    def marginals(self, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities by forward-backward.

        `scores` is chain x place x label; places beyond a chain's size pass everything through.
        Also the expected transitions, summed over all chains.
        """
        chains, length, _ = scores.shape
        live = np.arange(length)[None, :] < sizes[:, None]
        emit = np.exp(scores - scores.max(axis=2, keepdims=True))
        emit[~live] = 1.0
        step = np.exp(self.transitions - self.transitions.max())
        forward, backward = np.empty_like(emit), np.empty_like(emit)
        now = emit[:, 0]
        forward[:, 0] = now / now.sum(axis=1, keepdims=True)
        for t in range(1, length):
            now = np.where(live[:, t, None], (forward[:, t - 1] @ step) * emit[:, t], forward[:, t - 1])
            forward[:, t] = now / now.sum(axis=1, keepdims=True)
        backward[:, -1] = 1.0
        expected = np.zeros_like(step)
        for t in range(length - 1, 0, -1):
            ahead = emit[:, t] * backward[:, t]
            after = np.where(live[:, t, None], ahead @ step.T, backward[:, t])
            both = live[:, t]
            pair = forward[both, t - 1][:, :, None] * step * ahead[both][:, None, :]
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            backward[:, t - 1] = after / after.sum(axis=1, keepdims=True)
        found = forward * backward
        return found / found.sum(axis=2, keepdims=True), expected

    def texts(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean label probabilities over the words of each text, and its number of words."""
        words = words_of(raws)
        chance = np.zeros((len(raws), len(self.labels)))
        if len(words.which):
            scores = self.emissions(words)
            begins = np.cumsum(words.counts) - words.counts
            pieces = -(-words.counts // CHAIN)
            text = np.repeat(np.arange(len(raws)), pieces)
            nth = ragged(np.zeros(len(raws), dtype=np.int64), pieces)
            start = begins[text] + nth * CHAIN
            size = np.minimum(words.counts[text] - nth * CHAIN, CHAIN)
            at = np.minimum(start[:, None] + np.arange(CHAIN), len(words.which) - 1)
            found, _ = self.marginals(scores[words.which[at]], size)
            found[np.arange(CHAIN)[None, :] >= size[:, None]] = 0.0
            np.add.at(chance, text, found.sum(axis=1))
        return chance / np.maximum(words.counts, 1)[:, None], words.counts


def train(raws: list[bytes], labels: list[str], seed: int = 7) -> Field:
    """Fit by stochastic gradient steps on the log likelihood of the chains."""
    names = sorted(set(labels))
    words = words_of(raws)
    label = np.repeat([names.index(x) for x in labels], words.counts).astype(np.int64)
    model = Field(names, np.zeros(((1 << _BITS) + len(names), len(names)), np.float32), np.zeros((len(names),) * 2))
    if not len(words.which) or len(names) < 2:
        return model
    # A lexicon holds what a language uses and others hardly do.
    use = np.zeros((len(words.hashes), len(names)))
    np.add.at(use, (words.which, label), 1.0)
    total = use.sum(axis=1)
    listed = np.flatnonzero((total >= 3) & (use.max(axis=1) >= 0.9 * total))
    model.lexicon, model.lexicon_label = words.hashes[listed], use[listed].argmax(axis=1)
    owners, codes = model.all_features(words)
    order = np.argsort(owners, kind="stable")
    codes, per_word = codes[order], np.bincount(owners, minlength=len(words.hashes))
    base = np.cumsum(per_word) - per_word
    rng = np.random.default_rng(seed)
    grown, grown_steps = np.full_like(model.weights, 1e-6), np.full(model.transitions.shape, 1e-6)
    last = max(len(words.which) - _PIECE, 0)
    pieces = np.append(np.arange(0, last, _PIECE // 2), last)
    for _ in range(_EPOCHS):
        rng.shuffle(pieces)
        whole = pieces[: len(pieces) // 3 * 3].reshape(-1, 3) if len(pieces) >= 3 else pieces[:1].reshape(-1, 1)
        # Half of the chains stay within one text's surroundings, half join three places.
        within = rng.random(len(whole)) < 0.5
        starts = np.where(within[:, None], np.minimum(whole[:, :1] + _PIECE * np.arange(whole.shape[1]), len(words.which) - _PIECE), whole)
        starts = np.maximum(starts, 0)
        for a in range(0, len(starts), 64):
            span = min(_PIECE, len(words.which))
            at = (starts[a : a + 64, :, None] + np.arange(span)).reshape(len(starts[a : a + 64]), -1)
            held, inverse = np.unique(words.which[at], return_inverse=True)
            inverse = inverse.reshape(at.shape)
            rows = codes[ragged(base[held], per_word[held])]
            first = np.cumsum(per_word[held]) - per_word[held]
            scores = np.add.reduceat(model.weights[rows], first, axis=0).astype(np.float64)
            truth = label[at]
            chance, expected = model.marginals(scores[inverse], np.full(len(at), at.shape[1]))
            gap = -chance
            np.put_along_axis(gap, truth[:, :, None], np.take_along_axis(gap, truth[:, :, None], 2) + 1.0, 2)
            per_held = np.zeros((len(held), len(names)))
            np.add.at(per_held, inverse.reshape(-1), gap.reshape(-1, len(names)))
            slope = np.repeat(per_held, per_word[held], axis=0)
            used, back = np.unique(rows, return_inverse=True)
            summed = np.zeros((len(used), len(names)))
            np.add.at(summed, back, slope)
            summed -= 1e-3 * model.weights[used]
            grown[used] += summed**2
            model.weights[used] += (0.2 * summed / np.sqrt(grown[used])).astype(np.float32)
            seen = np.zeros_like(expected)
            np.add.at(seen, (truth[:, :-1].reshape(-1), truth[:, 1:].reshape(-1)), 1.0)
            slope = seen - expected - 1e-2 * model.transitions
            grown_steps += slope**2
            model.transitions += 0.2 * slope / np.sqrt(grown_steps)
    return model


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Field:
    """A chain of the languages in `docs`, from at most `sample` texts of each.

    The texts are those with the least hash of their id; null languages and null ids are left out. Of
    rows with one id and language at most eight are learned from.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = F.broadcast(least_hashed(rows, "id", "lang", sample).distinct())  # `sample` pairs of each language at most
    found = some_of_each(rows.join(chosen, ["id", "lang"]), ["id", "lang"], "text").orderBy("lang", "id", "text").collect()
    return train([(r.text or "").encode() for r in found], [r.lang for r in found])


def predict(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score` for every row.

    `score` is the mean probability of the predicted language over all words. Null texts, texts
    without a letter, and all texts if nothing was learned are `und` with score 0. Ties go to the
    language that sorts first. Repeated rows and null ids are predicted each for itself. Other columns
    are not read.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in slices(batches, "text"):
            names, scores = [], []
            if model.labels:
                chance, counts = model.texts(raws)
                for raw, row, n in zip(raws, chance, counts.tolist(), strict=True):
                    found = n > 0 and (raw.isascii() or _has_letter(raw))
                    names.append(model.labels[int(row.argmax())] if found else UNKNOWN)
                    scores.append(min(float(row.max()), 1.0) if found else 0.0)
            else:
                names, scores = [UNKNOWN] * len(raws), [0.0] * len(raws)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(label, f"doc_id {kind}, lang_pred string, score double")


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))
