"""Packing documents into windows by non-negative least squares over a length histogram.

A document is cut at whole windows; what is left of it is one shorter piece. Lengths are
rounded up to a grid, and every combination of at most ``DEPTH`` grid lengths that fills the
window exactly is a strategy. How often each is used is the non-negative least-squares
solution against the histogram of the pieces, rounded down to what the histogram holds. The
pieces left over are packed greedily, largest first, at the level of the histogram too, so
the plan costs the same for any number of documents.

The plan gives each grid length's pieces, by their rank, a sequence and a slot. Ranks come
from counts per (length, bucket) and a row number inside each, so no length is gathered in
one task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerscope.llm.common import kept, map_rows, slices, stored, text_or_empty, tidied
from tellerscope.llm.library_tokens import IDS, LibraryEncoder

WINDOW = 2048
GRID = 8
DEPTH = 3
END_ID = 1
STEPS = 600
ROWS_PER_BUCKET = 10_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document with the checksum of their ids."""
    end, cache = np.array([end_id], IDS).tobytes(), ("words", vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(cache, lambda: LibraryEncoder(vocabulary, blanks=False))
        for batch in batches:
            for part in slices(batch, batch["bytes"].to_pylist(), 1 << 20):
                rows = []
                for doc, raw in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                    ids = np.frombuffer(raw + end, IDS).astype("<u4")
                    for a in range(0, len(ids), window):
                        own = ids[a : a + window]
                        rows.append((doc, a, len(own), zlib.crc32(own), len(ids)))
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).alias("bytes"))
    return rows.mapInArrow(tidied(cut, cache), PIECES)


# --- the plan -----------------------------------------------------------------------------


def combinations(bins: int, depth: int = DEPTH) -> np.ndarray:
    """All descending tuples of at most ``depth`` numbers that sum to ``bins``; 0 is no part."""
    now = np.array([[i] for i in range(1, bins + 1)])
    for _ in range(depth - 1):
        room = bins - now.sum(axis=1)
        most = np.minimum(room, now[:, -1])
        again = np.repeat(np.arange(len(now)), most + 1)
        last = np.arange(len(again)) - np.repeat(np.cumsum(most + 1) - (most + 1), most + 1)
        now = np.column_stack([now[again], last])
    return now[now.sum(axis=1) == bins]


def least_squares(parts: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, A's columns being the counts of ``parts``.

    Accelerated projected gradient; A is never built, its products are gathers and counts.
    """
    bins = len(histogram)
    scale = max(1.0, float(histogram.max(initial=0)))
    target = histogram / scale

    def times(x):
        return np.bincount(parts.ravel(), weights=np.repeat(x, parts.shape[1]), minlength=bins) * used

    def back(r):
        return (r * used)[parts].sum(axis=1)

    used = np.ones(bins)
    used[0] = 0
    v = np.ones(len(parts))
    for _ in range(20):
        v = back(times(v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    x = y = np.zeros(len(parts))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(times(y) - target) / (1.05 * norm))
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x * scale


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(grid lengths of a sequence, how many such sequences), using up the whole histogram.

    ``histogram[b]`` is the number of pieces of grid length b; the last b fills the window.
    """
    left, bins, out = histogram.astype(np.int64).copy(), len(histogram) - 1, []

    def take(parts: tuple[int, ...], most: int) -> None:
        lengths, each = np.unique(parts, return_counts=True)
        times = int(min(most, (left[lengths] // each).min()))
        if times > 0:
            left[lengths] -= times * each
            out.append((tuple(parts), times))

    parts = combinations(bins, depth)
    there = np.append(True, histogram[1:] > 0)
    parts = parts[there[parts].all(axis=1)]
    if len(parts):
        repeats = least_squares(parts, histogram)
        for i in np.argsort(-repeats, kind="stable"):
            if repeats[i] < 1:
                break
            take(tuple(int(p) for p in parts[i] if p), int(repeats[i] + 1e-6))
    while left.any():
        open_, room, chosen = left.copy(), bins, []
        while room:
            fits = np.flatnonzero(open_[: room + 1])
            if not len(fits):
                break
            chosen.append(int(fits[-1]))
            open_[fits[-1]] -= 1
            room -= int(fits[-1])
        take(tuple(chosen), int(left.max()))
    return out


class Places:
    """Where the r-th piece of a grid length goes."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], bins: int):
        rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(bins + 1)]
        taken, sequence = [0] * (bins + 1), 0
        for parts, times in patterns:
            for slot, length in enumerate(parts):
                if slot and parts[slot - 1] == length:
                    continue
                each = parts.count(length)
                rows[length].append((taken[length], each, sequence, slot))
                taken[length] += each * times
            sequence += times
        self.tables = [np.array(r, np.int64).reshape(-1, 4) for r in rows]

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, slot) of each rank."""
        table = self.tables[length]
        first, each, sequence, slot = table[np.searchsorted(table[:, 0], ranks, "right") - 1].T
        return sequence + (ranks - first) // each, slot + (ranks - first) % each


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end id; each id lies in one piece. Pieces of a sequence
    follow each other from offset 0 and never exceed ``window``.

    Null and empty texts are the end id alone. Null ids are packed like others; rows that
    repeat an id are documents of their own. An empty table gives no rows. Other columns are
    ignored.
    """
    rows = stored(pieces(docs, vocabulary, window, end_id), "pieces")
    bins = -(-window // grid)
    rows = rows.withColumn("bin", F.ceil(F.col("length") / grid).cast("int"))
    histogram = np.zeros(bins + 1, np.int64)
    for length, n in rows.groupBy("bin").count().collect():
        histogram[length] = n
    places = Places(plan(histogram, depth), bins)

    buckets = int(histogram.sum()) // ROWS_PER_BUCKET + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("bin", "bucket").count().select("bin", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bin", "bucket").orderBy("doc_id", "start", "ids_crc32", "length")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(counts, ["bin", "bucket"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, ranks = batch["bin"].to_numpy(), batch["rank"].to_numpy()
        sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths):
            own = lengths == length
            sequence[own], slot[own] = places.find(int(length), ranks[own])
        columns = [batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(slot)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"])

    placed = map_rows(ranked, place, f"{PIECES}, sequence_id long, slot long")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
