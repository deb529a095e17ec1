"""Periodic runs of words, by common extensions in suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word extends. Every
run of exponent two or more has a Lyndon word of length q as its root, for the order of the
words or for the opposite order, and that root is the longest Lyndon word at its place. So the
candidates are the n longest Lyndon words of either order; each is extended to both sides by
its longest common extension with the place one period on.

Extensions come from Ukkonen's suffix tree of the words (to the right) and of the reversed
words (to the left): the lowest common ancestor of two leaves is the least depth between them
in an Euler tour. Range minima take two look-ups in the doubled table of their length; as all
questions are known beforehand, one table is held at a time.

In a run of exponent e every word occurs e times and every pair of neighbours e - 1 times, so
words between rarer pairs can't be in one. Trees are built for the stretches that are left,
which are the whole document where it is periodic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import slices, text_or_empty

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Bytes of text that a task holds as words at a time, and of words kept between documents.
SLICE_BYTES = 8 << 20
MOST_WORD_BYTES = 16 << 20
RUN = np.dtype([("start", "<i8"), ("length", "<i8"), ("period", "<i8")])


# --- suffix trees -----------------------------------------------------------------------


class SuffixTree:
    """Ukkonen's tree of ``word``, whose last symbol, 0, occurs nowhere else.

    ``base`` is more than the largest symbol. Node 0 is the root; the edge into a node is
    labelled ``word[start:stop]``; ``suffix`` is the suffix of a leaf, -1 for inner nodes.
    """

    def __init__(self, word: list[int], base: int):
        n = len(word)
        start, stop, link, suffix, edges = [0], [0], [0], [-1], {}
        node = edge = length = rest = 0
        for i, symbol in enumerate(word):
            rest += 1
            waiting = 0
            while rest:
                if not length:
                    edge = i
                key = node * base + word[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    inner = node
                else:
                    span = stop[child] - start[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if word[start[child] + length] == symbol:
                        if waiting:
                            link[waiting] = node
                        length += 1
                        break
                    inner = len(start)
                    edges[key] = inner
                    start.append(start[child])
                    stop.append(start[child] + length)
                    link.append(0)
                    suffix.append(-1)
                    start[child] += length
                    edges[inner * base + word[start[child]]] = child
                    edges[inner * base + symbol] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                suffix.append(i - rest + 1)
                if waiting:
                    link[waiting] = inner
                waiting = inner if child is not None else 0
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.size, self.spans, self.suffix = n, [b - a for a, b in zip(start, stop)], suffix
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.children = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        self.symbols = (keys[order] % base).tolist()
        self.offsets = np.searchsorted(keys[order] // base, np.arange(len(start) + 1)).tolist()

    def tour(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(depths along the Euler tour, place of each suffix's leaf there, rank of each suffix)."""
        spans, suffix, children, offsets = self.spans, self.suffix, self.children, self.offsets
        depths, place, ranked = [], [0] * self.size, []
        path, levels, cursor = [0], [0], offsets[:-1]
        while path:
            node, depth = path[-1], levels[-1]
            depths.append(depth)
            at = cursor[node]
            if at == offsets[node + 1]:
                path.pop()
                levels.pop()
                continue
            cursor[node] = at + 1
            child = children[at]
            own = suffix[child]
            if own >= 0:
                place[own] = len(depths)
                ranked.append(own)
                depths.append(depth + spans[child])
            else:
                path.append(child)
                levels.append(depth + spans[child])
        ranks = np.empty(self.size, np.int64)
        ranks[ranked] = np.arange(self.size)
        return np.array(depths), np.array(place), ranks

    def opposite_ranks(self) -> np.ndarray:
        """Rank of each suffix if the order of the symbols is turned round; the end stays first."""
        ranked, stack = [], [0]
        while stack:
            node = stack.pop()
            if self.suffix[node] >= 0:
                ranked.append(self.suffix[node])
                continue
            low, high = self.offsets[node], self.offsets[node + 1]
            own = self.children[low:high]  # ascending, so the largest symbol is popped first
            if self.symbols[low] == 0:
                own = own[1:] + own[:1]
            stack += own
        ranks = np.empty(self.size, np.int64)
        ranks[ranked] = np.arange(self.size)
        return ranks


def least_between(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least of ``values`` between the places ``left`` and ``right``, both included."""
    low, high = np.minimum(left, right), np.maximum(left, right)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.int64)
    table = values  # of the least of each 2**k values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = level == k
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k) + 1])
    return out


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """Place of the next smaller rank behind each one: where its longest Lyndon word ends."""
    out, stack = [len(ranks)] * len(ranks), []
    for i, rank in enumerate(ranks.tolist()):
        while stack and stack[-1][0] > rank:
            out[stack.pop()[1]] = i
        stack.append((rank, i))
    return np.array(out)


# --- runs of one sequence -----------------------------------------------------------------


def runs_of_stretch(codes: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """The runs of a sequence of small positive numbers."""
    n, base, word = len(codes), int(codes.max()) + 1, codes.tolist()
    tree = SuffixTree([*word, 0], base)
    depths, place, ranks = tree.tour()
    back_depths, back_place, _ = SuffixTree([*word[::-1], 0], base).tour()
    found = []
    for order in (ranks, tree.opposite_ranks()):
        at = np.arange(n)
        period = next_smaller(order)[:n] - at
        fits = np.maximum(min_exponent * period, min_length) <= n
        at, period = at[fits], period[fits]
        ahead = least_between(depths, place[at], place[at + period])
        # Leaf n of either tree is the end alone, which shares nothing with another leaf.
        back = least_between(back_depths, back_place[n - at], back_place[n - at - period])
        length = period + ahead + back
        long = length >= np.maximum(min_exponent * period, min_length)
        found.append(np.stack([at - back, length, period])[:, long])
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    order = np.lexsort((period, start))
    out = np.empty(len(start), RUN)
    out["start"], out["length"], out["period"] = start[order], length[order], period[order]
    return out


def stretches(codes: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, codes from 1) of the parts of a sequence that can hold runs."""
    at = np.arange(len(codes))
    part = np.zeros(len(codes), np.int64)
    while len(at) >= min_length:
        kinds, of, often = np.unique(part * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        near = (np.diff(at) == 1) & (part[1:] == part[:-1]) & (often[of[1:]] >= min_exponent) & (often[of[:-1]] >= min_exponent)
        _, pair, times = np.unique(of[:-1][near] * len(kinds) + of[1:][near], return_inverse=True, return_counts=True)
        near[near] = times[pair] >= min_exponent - 1
        edge = np.diff(np.concatenate([[0], near.astype(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = last - first + 1
        first, size = first[size >= min_length], size[size >= min_length]
        keep = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        part, before = np.repeat(np.arange(len(first)), size), len(at)
        at = at[keep]
        if len(at) == before:  # each part is one stretch, as before
            break
    if len(at) < min_length:
        return
    for own in np.split(at, np.flatnonzero(np.diff(part)) + 1):
        _, small = np.unique(codes[own], return_inverse=True)
        yield int(own[0]), small + 1


def runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """All runs (start, length, period) of at least both bounds, by start, then period.

    ``codes``: one non-negative number for each word. The exponent must be 2 or more.
    """
    if min_exponent < 2:
        raise ValueError("runs have an exponent of at least 2")
    found = []
    for place, own in stretches(codes, min_length, min_exponent):
        some = runs_of_stretch(own, min_length, min_exponent)
        some["start"] += place
        found.append(some)
    return np.concatenate(found) if found else np.empty(0, RUN)


def without_repeats(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not len(found):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found["start"] + found["period"], 1)
    np.add.at(change, found["start"] + found["length"], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


class Numbers(dict):
    """Words numbered as they come."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.size += len(word) + 100
        return number


# --- the operator ---------------------------------------------------------------------------


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, collapsed.

    Words are what stands between blanks and the characters 9 to 13, compared as they are.
    ``runs``: array of (start, length, period) in words, of at least ``min_length`` words and
    ``min_exponent`` periods, by start, then period. ``collapsed``: the words joined by one
    blank, without those that a run holds behind its first period.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``. A null id is
    kept. Repeated rows each give their row; an empty table gives none. Other columns are
    ignored. A long text is searched in one task, in memory that grows with its words.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            for part in slices(batch, batch["bytes"].to_pylist(), SLICE_BYTES):
                sizes, ends, flat, texts = [], [0], [], []
                for text in part["text"]:
                    words = text.as_py().encode("utf-8", "surrogatepass").split()
                    if numbers.size > MOST_WORD_BYTES:
                        numbers = Numbers()
                    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                    found = runs(codes, min_length, min_exponent)
                    sizes.append(len(words))
                    flat.append(found)
                    ends.append(ends[-1] + len(found))
                    texts.append(b" ".join(without_repeats(words, found)))
                held = np.concatenate([np.empty(0, RUN), *flat])
                structs = pa.StructArray.from_arrays([pa.array(held[c].copy()) for c in RUN.names], RUN.names)
                columns = [part["doc_id"], pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("bytes", F.octet_length("text"))
    return rows.mapInArrow(find, "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def longest(found: Column) -> Column:
    """Of an array of runs the one of the greatest exponent; ties to the smallest start, then period."""

    def better(best: Column, run: Column) -> Column:
        # length / period compared as whole numbers; the array is in order of start and period.
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(found, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where a tenth of the texts repeat a part of themselves to the end.

    With h the crc32 of the id in decimal, g = h div 10 and n words, texts with h mod 10 = 0
    have word i from a = g mod n on replaced by word a + (i - a) mod p, where
    p = 1 + (n - a) div (3 + g mod 8). Other texts, and those without words or id, stay.
    """
    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1), i -> element_at(words, CAST(IF(i < a, i, a + (i - a) % p) + 1 AS INT))), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
