"""Token-id files: one wavelet matrix per shard of documents in ascending id order.

The matrix keeps one bit plane per bit of the ids, highest first; each plane is the sequence
stably sorted by the bits before it. A rank directory with one count per 512 bits makes
access, counting and occurrence lookup a walk over the planes, without restoring the ids.
A file holds a head, the documents' ids and lengths, and the planes, each compressed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerscope.llm.common import kept, make_folder, slices, stored, text_or_empty, write_stream
from tellerscope.llm.library_tokens import IDS, LibraryEncoder
from tellerscope.session import work_dir

MAGIC = b"WMTX1\n"
SHARD_TOKENS = 1 << 21
SHARD_BYTES = 12 << 20
END_ID = 2
SUFFIX = ".wmx"
_BLOCK = 512


class Plane:
    """Bits with rank and select."""

    def __init__(self, words: np.ndarray, directory: np.ndarray, n: int):
        self.words, self.directory, self.n = words, directory, n
        self.zeros = n - int(directory[-1])

    @classmethod
    def pack(cls, bits: np.ndarray) -> Plane:
        blocks = len(bits) // _BLOCK + 1
        packed = np.zeros(blocks * _BLOCK // 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[: len(own)] = own
        words = packed.view("<u8").reshape(blocks, -1)
        counts = np.bitwise_count(words).sum(axis=1, dtype=np.uint32)
        return cls(words, np.concatenate([[0], np.cumsum(counts)]).astype("<u4"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8).reshape(-1), count=self.n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        word = self.words.reshape(-1)[at >> 6]
        return ((word >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, inside = at // _BLOCK, at % _BLOCK
        words, k = self.words[block], inside >> 6
        full = (np.bitwise_count(words) * (np.arange(words.shape[1]) < k[:, None])).sum(axis=1, dtype=np.int64)
        last = words[np.arange(len(at)), k] & ((np.uint64(1) << (inside & 63).astype(np.uint64)) - np.uint64(1))
        return self.directory[block].astype(np.int64) + full + np.bitwise_count(last)

    def select(self, k: int, bit: bool) -> int:
        """Position of the k-th (from 0) one or zero: a binary search over ranks."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = int(self.rank1(np.array([mid + 1]))[0])
            if (ones if bit else mid + 1 - ones) <= k:
                low = mid + 1
            else:
                high = mid
        return low


class WaveletMatrix:
    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = 16) -> WaveletMatrix:
        planes, now = [], ids
        for b in range(bits - 1, -1, -1):
            own = ((now >> b) & 1).astype(bool)
            planes.append(Plane.pack(own))
            now = np.concatenate([np.compress(~own, now), np.compress(own, now)])
        return cls(planes, len(ids))

    def access(self, at) -> np.ndarray:
        """Ids at the given positions."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for p in self.planes:
            bit, ones = p.get(at), p.rank1(at)
            out = (out << 1) | bit
            at = np.where(bit, p.zeros + ones, at - ones)
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for i, p in enumerate(self.planes):
            one = (token >> (len(self.planes) - 1 - i)) & 1
            ranks = p.rank1(np.array([low, high]))
            low, high = (p.zeros + int(r) for r in ranks) if one else (int(x - r) for x, r in zip((low, high), ranks))
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` in [low, high)."""
        high = self.n if high is None else min(high, self.n)
        if token >> len(self.planes) or low >= high:
            return 0
        a, b = self._range(token, max(0, low), high)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        if k >= self.count(token):
            return -1
        at = self._range(token, 0, self.n)[0] + k
        for i in range(len(self.planes) - 1, -1, -1):
            p, one = self.planes[i], (token >> (len(self.planes) - 1 - i)) & 1
            at = p.select(at - p.zeros, True) if one else p.select(at, False)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: the stable sorts are undone from the last plane up."""
        now = np.zeros(self.n, np.uint16)
        for i, p in enumerate(reversed(self.planes)):
            own, back = p.bits(), np.empty_like(now)
            back[np.flatnonzero(~own)], back[np.flatnonzero(own)] = now[: p.zeros], now[p.zeros :]
            back |= own.astype(np.uint16) << i
            now = back
        return now


def dump_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The file of one shard."""
    matrix, pack = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1).compress
    known = np.array([x is not None for x in doc_ids], bool)
    parts = [np.packbits(known).tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes()]
    parts += [x.tobytes() for p in matrix.planes for x in (p.words, p.directory)]
    packed = [pack(p) for p in parts]
    head = json.dumps({"tokens": len(ids), "documents": len(doc_ids), "sections": [len(p) for p in packed]}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + b"".join(packed)


def load_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(document ids, lengths, matrix) of a file."""
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    at = len(MAGIC) + 4
    size = int.from_bytes(raw[at - 4 : at], "little")
    head = json.loads(raw[at : at + size])
    at, unpack, parts = at + size, zstandard.ZstdDecompressor().decompress, []
    for size in head["sections"]:
        parts.append(unpack(raw[at : at + size]))
        at += size
    n, docs = head["tokens"], head["documents"]
    known = np.unpackbits(np.frombuffer(parts[0], np.uint8), count=docs)
    doc_ids = [int(x) if k else None for x, k in zip(np.frombuffer(parts[1], "<i8"), known)]
    planes = [Plane(np.frombuffer(w, "<u8").reshape(-1, _BLOCK // 64), np.frombuffer(d, "<u4"), n) for w, d in zip(parts[3::2], parts[4::2])]
    return doc_ids, np.frombuffer(parts[2], "<i8"), WaveletMatrix(planes, n)


def write_shards(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` and write the shards; the manifest (file, part, number, documents, tokens).

    Documents are dealt by ranges of their id, about ``SHARD_BYTES`` of text each; a task
    starts a new file when ``SHARD_TOKENS`` are full, so its memory stays bounded. Files are
    named by task and number, so that a repeated task writes the same files again.
    """
    make_folder(folder)
    text = text_or_empty()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encoder = kept(("bytes", vocabulary), lambda: LibraryEncoder(vocabulary, blanks=True))
        end = np.array([end_id], IDS).tobytes()
        held_ids, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{part:07d}-{number:05d}{SUFFIX}"
            lengths = [len(x) // 2 for x in held]
            write_stream(f"{folder}/{name}", [dump_shard(held_ids, lengths, np.frombuffer(b"".join(held), IDS))])
            return pa.RecordBatch.from_pydict({"file": [name], "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "documents": [len(held_ids)], "tokens": [size]})

        for batch in batches:
            for piece in slices(batch, batch["bytes"].to_pylist(), 1 << 20):
                ids = encoder.encode(piece["text"].to_pylist())
                for doc, raw in zip(piece["doc_id"].to_pylist(), ids):
                    if held and size + len(raw) // 2 >= SHARD_TOKENS:
                        yield flush()
                        held_ids, held, size, number = [], [], 0, number + 1
                    held_ids.append(doc)
                    held.append(raw + end)
                    size += len(raw) // 2 + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    ranged = rows.repartitionByRange(max(1, total // SHARD_BYTES + 1), "doc_id").sortWithinPartitions("doc_id", "text")
    sized = ranged.withColumn("bytes", F.octet_length("text"))
    schema = "file string, part long, number long, documents long, tokens long"
    return stored(sized.mapInArrow(write, schema), "token-manifest")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(file, place, doc_id, local_start, n_tokens, ids_crc32) of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch["path"].to_pylist(), batch["content"]):
                doc_ids, lengths, matrix = load_shard(raw.as_py())
                ids = matrix.decode().astype("<u4")
                starts = np.cumsum(lengths) - lengths
                crcs = [zlib.crc32(ids[s : s + n]) for s, n in zip(starts.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [path.rpartition("/")[2]] * len(doc_ids),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "local_start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return files.select("path", "content").mapInArrow(read, "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def first_tokens(manifest: DataFrame) -> DataFrame:
    """(file, base): tokens of all files before each, summed in two levels."""
    thousand = F.floor(F.col("part") / 1000)
    rows = manifest.withColumn("thousand", thousand)
    before = Window.orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("thousand").agg(F.sum("tokens").alias("sum")).select("thousand", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("head"))
    inside = Window.partitionBy("thousand").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(heads, "thousand").select("file", (F.col("head") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("base"))


def token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` and read them back.

    Per document: doc_id, start (tokens of all documents before it), n_tokens (with the end
    id), ids_crc32 (of the ids as little-endian unsigned 32-bit integers), file.

    Null and empty texts are the end id alone. Null ids come first; rows that repeat an id
    follow each other in the order of their texts, each with its own tokens. An empty table
    writes no file and gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "token-files")
    manifest = write_shards(docs, vocabulary, folder, end_id)
    return read_shards(spark, folder).join(first_tokens(manifest), "file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "file")
