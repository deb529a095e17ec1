"""Exact dedup by a minimal perfect hash over the distinct digests seen so far.

Every distinct SHA-256 digest of the history is put into one of many shards, and each shard
gets a minimal perfect hash: levels of bit arrays, in which a key owns the bit that no other
key of its level hits; keys that collide go on to the next level. The rank of the owned bit
is the key's slot, and the slots hold the whole digest, the winner's id and the group's
size. A lookup compares all 32 bytes, so a text that is not in the history can't be taken
for one that is. Such rows are grouped by their digest among themselves.

Rows meet their shard in a shuffle by shard, as many shards to a task as the cluster's number
of shuffle partitions makes it; the index row is sorted before the rows that ask, so a task
holds one shard at a time and streams the rest. Digests that own over a thousandth of
all rows are dealt over ``WAYS`` tasks, with a copy of their shard in each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import stored, text_or_empty, tidied

KEYS_PER_SHARD = 16_384
HOT_SHARE = 1000
WAYS = 32
GAMMA = 2.0
_ROW = np.dtype([("digest", "V32"), ("winner", "<i8"), ("size", "<i8")])
_NO_ID = np.iinfo(np.int64).min


# --- minimal perfect hash of one shard -------------------------------------------------


def _words(digests: np.ndarray) -> np.ndarray:
    return np.frombuffer(digests.tobytes(), "<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bit of each key in a level; a digest is random already, the level only remixes it."""
    with np.errstate(over="ignore"):
        x = words[:, 1] ^ (words[:, 2] * np.uint64(2 * level + 1))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(width)).astype(np.int64)


class PerfectHash:
    """Slots 0..n-1 for n distinct 32-byte keys, without storing the keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [np.cumsum(bits) - bits for bits in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rest, levels = _words(keys), []
        while len(rest):
            width = max(64, int(GAMMA * len(rest)))
            at = _place(rest, len(levels), width)
            owned = np.bincount(at, minlength=width) == 1
            levels.append(owned)
            rest = rest[~owned[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot or -1 for a key that was not built in."""
        words = _words(keys)
        out = np.full(len(words), -1, np.int64)
        open_ = np.arange(len(words))
        for level, bits in enumerate(self.levels):
            at = _place(words[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.before[level] + self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def load(cls, blob: bytes) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        widths = np.frombuffer(blob, "<u4", n, 4)
        at, levels = 4 * (n + 1), []
        for width in map(int, widths):
            size = (width + 7) // 8
            packed = np.frombuffer(blob, np.uint8, size, at)
            levels.append(np.unpackbits(packed, count=width).astype(bool))
            at += size
        return cls(levels), at


def shard_blob(rows: np.ndarray) -> bytes:
    """File form of a shard: the perfect hash, then its slots."""
    mph = PerfectHash.build(rows["digest"])
    slots = np.empty(len(rows), _ROW)
    slots[mph.slots(rows["digest"])] = rows
    return mph.dump() + slots.tobytes()


class Shard:
    def __init__(self, blob: bytes):
        self.mph, at = PerfectHash.load(blob)
        self.slots = np.frombuffer(blob, _ROW, offset=at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, whether the slot holds exactly the key) of each key."""
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = self.mph.slots(keys)
        held = _words(self.slots["digest"][at]) == _words(keys)
        return at, (at >= 0) & held.all(axis=1)


# --- index as a Spark table ---------------------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, digest) of every row; a null text counts as empty."""
    sha = F.unhex(F.sha2(text_or_empty(), 256))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"), sha.alias("digest"))


def catalogue(rows: DataFrame) -> DataFrame:
    """Distinct digests with winner (largest id; null only if no row has an id) and group size."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("size"))


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "V32")


def build_index(catalog: DataFrame, purpose: str = "digest-index") -> tuple[DataFrame, int]:
    """(table of (shard, blob), number of shards) over a catalogue of distinct digests.

    Digests are uniform, so a shard has about ``KEYS_PER_SHARD`` keys whatever the data.
    """
    shards = max(1, math.ceil(catalog.count() / KEYS_PER_SHARD))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blob(shard, parts):
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "blob": pa.array([shard_blob(np.concatenate(parts))], pa.binary())}
            )

        now, parts = None, []
        for batch in batches:
            shard = batch["shard"].to_numpy()
            rows = np.empty(len(shard), _ROW)
            rows["digest"] = _keys(batch["digest"])
            rows["winner"] = batch["winner"].fill_null(_NO_ID).to_numpy()
            rows["size"] = batch["size"].to_numpy()
            for own in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
                if len(own) and shard[own[0]] != now:
                    if parts:
                        yield blob(now, parts)
                    now, parts = int(shard[own[0]]), []
                parts.append(rows[own])
        if parts and now is not None:
            yield blob(now, parts)

    keyed = catalog.select(_shard(shards).alias("shard"), "digest", "winner", "size")
    dealt = keyed.repartition("shard").sortWithinPartitions("shard")
    return stored(dealt.mapInArrow(tidied(build), "shard int, blob binary"), purpose), shards


def heavy(catalog: DataFrame) -> list[bytes]:
    """Digests of over a ``HOT_SHARE``-th of all rows: fewer than ``HOT_SHARE`` of them."""
    total = catalog.agg(F.sum("size")).first()[0] or 0
    hot = catalog.filter(F.col("size") > max(WAYS, total // HOT_SHARE))
    return [bytes(r[0]) for r in hot.select("digest").collect()]


def lookup(rows: DataFrame, index: DataFrame, shards: int, hot: list[bytes]) -> DataFrame:
    """``rows`` (doc_id, text_hash, digest) with winner, size, member and first_copy.

    ``first_copy`` is false on all but one of the rows that repeat both digest and id.
    """
    is_hot = F.col("digest").isin([F.lit(h) for h in hot]) if hot else F.lit(False)
    none = lambda kind: F.lit(None).cast(kind)
    way = F.when(is_hot, F.pmod(F.xxhash64("doc_id"), F.lit(WAYS)).cast("int")).otherwise(F.lit(0))
    asks = rows.select(_shard(shards).alias("shard"), way.alias("way"), F.lit(1).alias("kind"), "digest", "doc_id", "text_hash", none("binary").alias("blob"))
    copies = F.array(F.lit(0))
    if hot:
        spark = rows.sparkSession
        named = spark.createDataFrame(pa.table({"digest": pa.array(hot, pa.binary())}))
        hot_shards = [r[0] for r in named.select(_shard(shards)).distinct().collect()]
        copies = F.when(F.col("shard").isin(hot_shards), F.sequence(F.lit(0), F.lit(WAYS - 1))).otherwise(copies)
    tables = index.select("shard", F.explode(copies).alias("way"), F.lit(0).alias("kind"), none("binary").alias("digest"), none("long").alias("doc_id"), none("long").alias("text_hash"), "blob")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table, last = None, Shard(shard_blob(np.empty(0, _ROW))), None
        empty = table
        for batch in batches:
            shard, way, kind = (batch[c].to_numpy() for c in ("shard", "way", "kind"))
            cell = shard.astype(np.int64) * WAYS + way
            for own in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(cell) | np.diff(kind)) + 1):
                if not len(own):
                    continue
                if cell[own[0]] != now:
                    now, table = cell[own[0]], empty
                part = batch.slice(int(own[0]), len(own))
                if kind[own[0]] == 0:
                    table = Shard(part["blob"][0].as_py())
                    continue
                keys = _keys(part["digest"])
                at, member = table.find(keys)
                winner, size = (np.where(member, table.slots[c][at], 0) if len(table.slots) else np.zeros(len(keys), np.int64) for c in ("winner", "size"))
                pairs = list(zip(part["digest"].to_pylist(), part["doc_id"].to_pylist()))
                first = [a != b for a, b in zip(pairs, [last, *pairs])]
                last = pairs[-1]
                no_id = ~member | (winner == _NO_ID)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"],
                        "text_hash": part["text_hash"],
                        "digest": part["digest"],
                        "winner": pa.array(winner, mask=no_id),
                        "size": pa.array(size, mask=~member),
                        "member": pa.array(member),
                        "first_copy": pa.array(first, pa.bool_()),
                    }
                )

    met = tables.unionByName(asks).repartition("shard", "way").sortWithinPartitions("shard", "way", "kind", "digest", "doc_id")
    return met.mapInArrow(tidied(find), "doc_id long, text_hash long, digest binary, winner long, size long, member boolean, first_copy boolean")


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    Without ``history`` the documents are their own history: all are looked up in the index
    over their distinct digests, and the largest id of equal texts stays. With ``history``
    (doc_id, text) a text that it holds is a repeat of the history's row and goes, and the
    other documents are grouped among themselves.

    Null and empty texts are equal. A null id ranks below every id. Of rows that repeat both
    text and id, one is kept. An empty table gives no rows. Other columns are ignored.
    """
    rows = stored(digests(docs), "digests")
    own = catalogue(rows)
    if history is None:
        catalog = stored(own, "digest-catalogue")
        index, shards = build_index(catalog)
        found = lookup(rows, index, shards, heavy(catalog))
        kept = F.col("doc_id").eqNullSafe(F.col("winner")) & F.col("first_copy")
        return found.select("doc_id", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_hash")

    index, shards = build_index(stored(catalogue(digests(history)), "digest-history"))
    seen = stored(lookup(rows, index, shards, heavy(own)), "digest-lookups")
    members = seen.filter("member").select("doc_id", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), F.lit(False).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_hash")
    fresh = seen.filter("not member").select("doc_id", "text_hash", "digest")
    new = stored(catalogue(fresh), "digest-new")
    index, shards = build_index(new)
    kept = F.col("doc_id").eqNullSafe(F.col("winner")) & F.col("first_copy")
    others = lookup(fresh, index, shards, heavy(new)).select("doc_id", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_hash")
    return members.unionByName(others)
