"""Byte-level BPE over rank files, with pre-tokenisation by array scans instead of a regex.

Each character gets a class from its code point and the next two characters. A class is a
transition function over eight states. Functions compose, and all that can arise are
numbered beforehand, so a table gives the number of "first this, then that". The scan runs in
all blocks of a batch at once, one column after the other; a second scan over the block
totals gives the state in which each block begins. State and class say where a piece starts.

Pieces are looked up in a cache. New ones are merged together, row by row of a matrix: in
each step every row merges its leftmost pair of the lowest rank. Token offsets are kept, and
decoding writes each token's bytes at its offset.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import kept, slices, text_or_empty

IDS = np.dtype("<u2")
MOST_PIECES = 400_000
WIDEST = 32
COLUMNS = 256
BATCH_BYTES = 1 << 20
_NONE = np.int32(2**31 - 1)

# Classes of characters. Blanks and other white space come in two kinds each: followed by
# something visible, or by white space or the end. Apostrophes that could begin a contraction
# of two or of three characters have classes of their own.
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, SPACE, SPACES, END = range(9)
# States: at a piece's end; in letters, numbers, other; after a blank that begins a piece;
# in white space; one or two characters before the end of a contraction.
DONE, LETTERS, NUMBERS, OTHERS, JOIN, GAP, ONE, TWO = range(8)
_BEGUN = 0x110000


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a piece starts at this character)."""
    if kind == END:
        return DONE, True
    if state in (ONE, TWO):
        return (DONE, False) if state == ONE else (ONE, False)
    inside = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, SHORT: OTHERS, LONG: OTHERS}
    if state == JOIN:
        return inside.get(kind, DONE), False
    if kind in (SHORT, LONG) and state != OTHERS:
        return (ONE if kind == SHORT else TWO), True
    if kind in inside:
        return inside[kind], state != inside[kind]
    if kind == SPACES:
        return GAP, state != GAP
    return (JOIN if kind == BLANK else DONE), True


class Scanner:
    """Piece starts of many texts at once."""

    def __init__(self):
        # White space is the Unicode property; the four separators 1C-1F do not have it.
        table = np.full(_BEGUN + 1, OTHER, np.uint8)
        for code in range(_BEGUN):
            category = unicodedata.category(chr(code))[0]
            if category in "LN":
                table[code] = LETTER if category == "L" else NUMBER
            elif chr(code).isspace() and not 0x1C <= code <= 0x1F:
                table[code] = SPACE
        table[0x20], table[_BEGUN] = BLANK, END
        self.table = table
        steps = [[_step(s, k) for s in range(8)] for k in range(9)]
        self.starts = np.array([[steps[k][s][1] for k in range(9)] for s in range(8)])
        # All compositions of the nine functions, numbered; the first nine are the classes.
        functions = [tuple(x[0] for x in row) for row in steps]
        number: dict[tuple, int] = {}
        basic = [number.setdefault(f, len(number)) for f in functions]
        for f in (todo := list(number)):
            for g in functions:
                fg = tuple(g[x] for x in f)
                if fg not in number:
                    number[fg] = len(number)
                    todo.append(fg)
        known = np.array(list(number), np.uint8)
        index = {f: i for f, i in number.items()}
        kind = np.uint8 if len(known) <= 256 else np.uint16
        # then[a, k]: function a, then class k.
        self.then = np.array([[index[tuple(functions[k][x] for x in f)] for k in range(9)] for f in number], kind)
        self.apply, self.basic = known, np.array(basic, kind)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        base = self.table[codes]
        after = np.append(base[1:], END)
        seen = (after <= LONG)
        out = base.copy()
        white = (base == BLANK) | (base == SPACE)
        out[white & ~seen] = SPACES
        for i in np.flatnonzero(codes == 39):
            pair = codes[i + 1 : i + 3].tolist()
            if pair[:1] and chr(min(pair[0], 0x10FFFF)) in "stmd":
                out[i] = SHORT
            elif len(pair) == 2 and pair in ([114, 101], [118, 101], [108, 108]):
                out[i] = LONG
        return out

    def piece_starts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each code point; texts are separated by ``_BEGUN``."""
        kinds = self.classes(codes)
        rows = -(-len(kinds) // COLUMNS)
        grid = np.full(rows * COLUMNS, END, np.uint8)
        grid[: len(kinds)] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, COLUMNS).T)
        upto = np.empty((COLUMNS, rows), self.then.dtype)
        upto[0] = now = self.basic[grid[0]]
        for j in range(1, COLUMNS):
            upto[j] = now = self.then[now, grid[j]]
        state, first = DONE, np.empty(rows, np.uint8)
        for i, total in enumerate(now.tolist()):
            first[i] = state
            state = self.apply[total, state]
        before = np.empty((COLUMNS, rows), np.uint8)
        before[0] = first
        before[1:] = self.apply[upto[:-1], first]
        return self.starts[before, grid].T.reshape(-1)[: len(kinds)]


class BytePairs:
    """The vocabulary of a rank file, merging and decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        if size > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]] << 16 | self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        keys, values = np.array(pairs, np.int64).T
        # Open addressing; probes go on until the key or a gap.
        self.bits = 20
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot] == keys
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)
        self.cache: dict[bytes, bytes] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or a value above all ranks."""
        keys = left.astype(np.int64) << 16 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of at most ``WIDEST`` bytes."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        tokens = np.zeros((len(pieces), width + 1), np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        tokens[inside] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), _NONE, np.int32)
        pairs = np.arange(width) < lengths[:, None] - 1
        ranks[pairs] = self.pair_ranks(tokens[:, :-1][pairs], tokens[:, 1:][pairs])
        out: list[bytes] = [b""] * len(pieces)
        rows, columns = np.arange(len(pieces)), np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            done = best == _NONE
            for i in np.flatnonzero(done):
                out[rows[i]] = tokens[i, : lengths[i]].astype(IDS).tobytes()
            if done.all():
                return out
            tokens, ranks, rows, lengths, at, best = (x[~done] for x in (tokens, ranks, rows, lengths, at, best))
            own = np.arange(len(at))
            tokens[own, at] = best
            shift = columns + (columns > at[:, None])
            tokens[:, :-1] = np.take_along_axis(tokens, shift, axis=1)
            shift = np.minimum(columns + (columns >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, shift, axis=1)
            ranks[:, -1] = _NONE
            lengths = lengths - 1
            for left, there in ((at - 1, at > 0), (at, at < lengths - 1)):
                i = own[there]
                ranks[i, left[there]] = self.pair_ranks(tokens[i, left[there]], tokens[i, left[there] + 1])
            # What was moved behind the end is no pair.
            ranks[own, np.maximum(lengths - 1, 0)] = _NONE

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece: a heap of pairs over a linked list."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if 0 <= i and j < len(piece):
                rank = self.ranks.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(parts[i]) + len(parts[j])))

        for i in range(len(piece) - 1):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(piece) or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < len(piece):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([self.ranks[p] for p in parts if p is not None], IDS).tobytes()

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, through the cache."""
        cache = self.cache
        if len(cache) > MOST_PIECES:
            cache.clear()
        new = [p for p in set(pieces) if p not in cache]
        short = sorted((p for p in new if len(p) <= WIDEST), key=len)
        for a in range(0, len(short), 4096):
            part = short[a : a + 4096]
            cache.update(zip(part, self.merge_many(part)))
        for p in new:
            if len(p) > WIDEST:
                cache[p] = self.merge_long(p)
        return [cache[p] for p in pieces]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """First byte of each token in the text."""
        lengths = self.lengths[ids]
        return np.cumsum(lengths) - lengths

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of all tokens, each at its offset."""
        lengths = self.lengths[ids]
        size = int(lengths.sum())
        return self.blob[np.repeat(self.at[ids] - offsets, lengths) + np.arange(size)].tobytes()


class Encoder:
    def __init__(self, path: str):
        self.scanner, self.pairs = Scanner(), BytePairs(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        marks = np.cumsum([len(t) + 1 for t in texts])[:-1] - 1
        codes[marks] = _BEGUN
        raw = joined.encode()
        sizes = 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)
        sizes[marks] = 1
        at = np.cumsum(sizes) - sizes
        starts = np.flatnonzero(self.scanner.piece_starts(codes))
        where = at[starts].tolist()
        ends = where[1:] + [len(raw)]
        real = codes[starts] != _BEGUN
        pieces = [raw[a:b] for a, b, r in zip(where, ends, real.tolist()) if r]
        ids = self.pairs.ids(pieces)
        counts = np.bincount(np.searchsorted(marks, starts[real]), minlength=len(texts)).tolist()
        each = iter(ids)
        return [np.frombuffer(b"".join(itertools.islice(each, n)), IDS) for n in counts]


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """Per document: doc_id, ids, offsets (byte of the text where each token begins), decoded.

    ``decoded`` is what the ids give back, the UTF-8 bytes of the text. Special tokens do not
    exist here; their names are ordinary text. Null and empty texts have no ids. Texts of any
    length are encoded whole. Rows that repeat an id, or have none, are encoded like others;
    an empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("byte pairs", ranks), lambda: Encoder(ranks))
        for batch in batches:
            for part in slices(batch, batch["bytes"].to_pylist(), BATCH_BYTES):
                ids = encoder.encode(part["text"].to_pylist())
                offsets = [encoder.pairs.offsets(x) for x in ids]
                ends = np.cumsum([0, *map(len, ids)])
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x).astype(np.int32))) for x in (ids, offsets)]
                decoded = pa.array([encoder.pairs.decode(x, o) for x, o in zip(ids, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([part["doc_id"], *lists, decoded], ["doc_id", "ids", "offsets", "decoded"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).alias("bytes"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, offsets array<int>, decoded binary")
