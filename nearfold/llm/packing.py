"""Packing of token sequences into as few sequences of bounded length as can be found.

Documents longer than the bound are cut into full pieces and a rest; nothing else is cut. Full pieces
are sequences by themselves. The other pieces meet in groups of bounded size: best fit by falling
length fills bins, then a local search moves pieces between bins that are not full, always raising
the sum of squared fills, until bins run empty. The pieces of all bins that are not nearly full meet
again, dealt anew to groups of the same size, as long as that closes bins, or until one group is left.

Null texts are empty and hold the end id alone; an empty table gives no rows; repeated rows are
packed each for itself. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearfold.llm.batches import list_array, slices
from nearfold.llm.tokens import default_path, encoder
from nearfold.session import freeze

SEQUENCE = 4096
END_ID = 1
GROUP_PIECES = 16_384
#: A bin filled to this share is left as it is; a round that saves less than this share of its bins is the last.
NEARLY_FULL = 63 / 64
LEAST_GAIN = 0.005


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = SEQUENCE,
) -> DataFrame:
    """Pieces of at most `capacity` ids: `doc_id, piece, start, length, ids, ids_crc32`."""
    file = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(file)
        for batch, raws in slices(batches, "text"):
            ids, counts = code.encode(raws)
            whole = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(counts[doc] - start, capacity)
            data, ends = memoryview(whole).cast("B"), (4 * np.cumsum(length)).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    list_array(whole.astype(np.int32), length, pa.int32()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids array<int>, ids_crc32 bigint"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int = SEQUENCE) -> np.ndarray:
    """Bin of each piece: longest first, each into the fullest bin that holds it."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free room
    rooms, made = 0, 0  # bit r of rooms: some bin has free room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, b, made = capacity, made, made + 1
        bins[k] = b
        left = room - need
        if left:
            free[left].append(b)
            rooms |= 1 << left
    return bins


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int = SEQUENCE) -> np.ndarray:
    """Try to empty the bins that are not full, the least filled first.

    A step gives another underfull bin more from the bin at hand: a piece moves over, two pieces
    replace a shorter one, or a longer piece replaces a shorter one. The other bin is always at
    least as full, so every step raises the sum of squared fills, and the search ends.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths, minlength=bins.max() + 1).astype(np.int64)
    open_bins = np.flatnonzero(fill < capacity)
    members = np.flatnonzero(np.isin(bins, open_bins))
    for victim in open_bins[np.argsort(fill[open_bins], kind="stable")].tolist():
        if fill[open_bins].size and fill[victim] > (capacity - fill[open_bins]).sum() - capacity + fill[victim]:
            break  # the other bins' room does not hold this bin, nor any fuller one
        saved, saved_fill = bins[members].copy(), fill.copy()
        while fill[victim]:
            own = members[bins[members] == victim]
            rest = members[(bins[members] != victim) & (fill[bins[members]] >= fill[victim])]
            step = _step(lengths, bins, fill, own, rest, open_bins, victim, capacity)
            if step is None:
                break
            for piece, target in step:
                fill[bins[piece]] -= lengths[piece]
                fill[target] += lengths[piece]
                bins[piece] = target
        if fill[victim] and (saved_fill[open_bins] ** 2).sum() > (fill[open_bins] ** 2).sum():
            bins[members], fill = saved, saved_fill
    return bins


def _step(
    lengths: np.ndarray, bins: np.ndarray, fill: np.ndarray, own: np.ndarray, rest: np.ndarray,
    open_bins: np.ndarray, victim: int, capacity: int,
) -> list[tuple[int, int]] | None:
    """The step that takes most from the victim, as moves of pieces to bins."""
    others = open_bins[(open_bins != victim) & (fill[open_bins] >= fill[victim])]
    room = capacity - fill[others]
    best, gain = None, 0
    order = np.argsort(room, kind="stable")
    at = np.searchsorted(room[order], lengths[own])
    for piece, k in zip(own.tolist(), at.tolist(), strict=True):
        if k < len(order) and lengths[piece] > gain:
            best, gain = [(piece, int(others[order[k]]))], int(lengths[piece])
    if best or not len(rest):
        return best
    limit = lengths[rest] + capacity - fill[bins[rest]]  # what may stand in this piece's place
    for width in (1, 2):
        if width == 1:
            groups = [(int(p),) for p in own]
        else:
            few = own[np.argsort(-lengths[own], kind="stable")]
            groups = [(int(p), int(q)) for i, p in enumerate(few) for q in few[i + 1 :]]
        for group in groups:
            size = int(lengths[list(group)].sum())
            change = np.where(limit >= size, size - lengths[rest], 0)
            k = int(np.argmax(change))
            if change[k] > gain:
                piece = int(rest[k])
                target = int(bins[piece])
                best, gain = [(piece, victim), *((g, target) for g in group)], int(change[k])
    return best


def _packed(
    pieces: DataFrame, groups: int, level: int, capacity: int, keep_open: int | None
) -> DataFrame:
    """One round: `row, length, level, grp, bin, up`; the pieces with `up` meet again."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bins = local_search(lengths, best_fit(lengths, capacity), capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        loose = np.argsort(fill, kind="stable")
        loose = loose[(fill[loose] > 0) & (fill[loose] < NEARLY_FULL * capacity)][:keep_open]
        return pd.DataFrame(
            {
                "row": group["row"],
                "length": lengths,
                "level": np.int32(level),
                "grp": np.int64(key[0]),
                "bin": bins,
                "up": np.isin(bins, loose),
            }
        )

    grouped = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)).alias("g"))
    schema = "row bigint, length bigint, level int, grp bigint, bin bigint, up boolean"
    return grouped.groupBy("g").applyInPandas(pack, schema)


def pack_pieces(
    pieces: DataFrame, capacity: int = SEQUENCE, group_pieces: int = GROUP_PIECES, keep_open: int | None = None
) -> DataFrame:
    """`row, level, grp, bin` for pieces `row, length` shorter than `capacity`.

    Every group that is not the last hands on the pieces of its bins that are not `NEARLY_FULL`; with
    `keep_open` of so many of them, the least filled. No group is larger than about `group_pieces`.
    """
    done, level, before = None, 0, None
    count = pieces.count()
    while True:
        groups = max(1, -(-count // group_pieces))
        step = freeze(_packed(pieces, groups, level, capacity, 0 if groups == 1 else keep_open), "packing")
        bins = step.select("grp", "bin", "up").distinct().groupBy("up").count().collect()
        loose = sum(r["count"] for r in bins if r.up)
        # What came in filled `before` bins; if these are hardly fewer now, the rest stays as it is.
        over = not loose or before is not None and sum(r["count"] for r in bins) > (1 - LEAST_GAIN) * before
        kept = (step if over else step.filter(~F.col("up"))).select("row", "length", "level", "grp", "bin")
        done = kept if done is None else done.unionByName(kept)
        if over:
            return done
        pieces = step.filter("up").select("row", "length")
        count, level, before = pieces.count(), level + 1, loose


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """`doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset`.

    The ids are written once; the packing moves only row numbers and lengths. A sequence id is made
    of the round, the group and the bin, so no task needs to number all sequences.
    """
    coded = token_pieces(docs, id_col, text_col, tokenizer, end_id, capacity)
    pieces = freeze(coded.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("sequence_id"))
    short = pack_pieces(pieces.filter(F.col("length") < capacity).select("row", "length"), capacity)
    placed = _offsets(short).unionByName(full.withColumn("offset", F.lit(0).cast("bigint")))
    return pieces.join(placed, "row").drop("row")


def _offsets(short: DataFrame) -> DataFrame:
    """Places within each sequence, gapless; a sequence holds `capacity` pieces at most."""
    # Bins of a round number fewer than its pieces; 2^22 bins and 2^35 groups a round fit a long.
    number = (F.col("level").cast("bigint") * (1 << 57)) + F.col("grp") * (1 << 22) + F.col("bin")
    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return short.withColumn("sequence_id", number).select(
        "row", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    )
