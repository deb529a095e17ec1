"""WARC archives of pages, read back through a merged external index.

Each page becomes a record of a ``.warc.gz`` archive, one gzip member per record. Of equal
payloads of at least ``LEAST_BYTES`` the one of the smallest page id is written as response,
the others as revisits that refer to it.

Reading an archive gives its capture run, sorted by URL key, time and page id. The key space
is split at sampled keys; every run is cut into slices at the splits, and a range's slices
meet in one task, where a tree of losers merges them. So the index is ordered over all
archives, and a URL with very many captures is spread over several ranges.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import MOST_BROADCAST, make_folder, spread_join, stored, write_stream
from tellerscope.session import work_dir

LEAST_BYTES = 100
ARCHIVE_BYTES = 16 << 20
ARCHIVE_RECORDS = 20_000
RANGE_ROWS = 200_000
SAMPLES_PER_RANGE = 20
HOT_SHARE = 1000
WAYS = 32
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=timezone.utc)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long, record_bytes long"
KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
FIELDS = [tuple(f.split(" ")) for f in CAPTURE.split(", ")]


# --- records -----------------------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    value = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "none") else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which holds no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    time = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % 10**9)
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Target-URI": None if url is None else quote(url, safe="".join(map(chr, range(0x21, 0x7F)))),
        "WARC-Date": time.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Refers-To": None if refers_to is None else _name(refers_to),
        "WARC-Profile": None if refers_to is None else REVISIT,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of a record; names are in lower case."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}, payload


def url_key(url: str | None) -> str:
    """Sort key: host labels in reverse, then path and query; no scheme, user or fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return (url or "").lower()
    if host.startswith("www."):
        host = host[4:]
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _member(raw: bytes) -> bytes:
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a stream, one in memory at a time."""
    at, rest = 0, stream.read(1 << 20)
    while rest:
        unpack, parts, size = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            parts.append(unpack.decompress(rest))
            size += len(rest)
            rest = b"" if unpack.eof else stream.read(1 << 20)
            if not rest and not unpack.eof:
                raise ValueError("the archive ends inside a record")
        rest = unpack.unused_data
        size -= len(rest)
        yield at, size, b"".join(parts)
        at += size
        rest = rest or stream.read(1 << 20)


# --- archives ------------------------------------------------------------------------------


def with_decisions(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): ``refers_to`` is null for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("html", 256)))
    groups = rows.filter(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("size"))
    repeated = stored(groups.filter(F.col("size") > 1), "repeated-payloads")
    n, total = repeated.agg(F.count("*"), F.sum("size")).first()
    if n <= MOST_BROADCAST:
        joined = rows.join(F.broadcast(repeated.drop("size")), "digest", "left")
    else:
        hot = [bytes(r[0]) for r in repeated.filter(F.col("size") > max(WAYS, total // HOT_SHARE)).select("digest").collect()]
        joined = spread_join(rows, repeated.drop("size"), "digest", hot, WAYS, ["page_id"], "left")
    return joined.withColumn("refers_to", F.expr("CASE WHEN first IS NOT NULL AND NOT page_id <=> first THEN first END")).drop("first")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives of ``pages``; the manifest (archive, records, bytes).

    Each task writes its rows as they stream by and starts a new archive at
    ``ARCHIVE_BYTES`` or ``ARCHIVE_RECORDS``. Names come from task and number, so a task
    that runs again writes the same archives.
    """
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, packed, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            name = f"{part:07d}-{number:05d}.warc.gz"
            write_stream(f"{folder}/{name}", packed)
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(packed)], "bytes": [size]})

        for batch in batches:
            for page, url, html, digest, refers in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "refers_to"))):
                raw = record(page.as_py(), url.as_py(), html.as_py().encode(), digest.as_py().hex(), refers.as_py())
                packed.append(_member(raw))
                size += len(packed[-1])
                if size >= ARCHIVE_BYTES or len(packed) >= ARCHIVE_RECORDS:
                    yield close()
                    number, packed, size = number + 1, [], 0
        if packed:
            yield close()

    rows = with_decisions(pages, least_bytes).select("page_id", "url", "html", "digest", "refers_to")
    return stored(rows.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


# --- index ---------------------------------------------------------------------------------


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, KINDS[k]) for c, (_, k) in zip(zip(*rows) if rows else [[]] * len(FIELDS), FIELDS)]


def capture_runs(manifest: DataFrame, folder: str) -> DataFrame:
    """The captures of every archive, sorted within it; payload digests are of what was read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name in batch["archive"].to_pylist():
                store, at = fs.FileSystem.from_uri(f"{folder}/{name}")
                rows = []
                with store.open_input_stream(at, compression=None) as stream:
                    for offset, length, raw in members(stream):
                        fields, http, payload = parse(raw)
                        kind = fields["warc-type"]
                        if kind == "response":
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        else:
                            size, digest = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
                        key = url_key(fields.get("warc-target-uri"))
                        rows.append((key, fields["warc-date"], _page(fields["warc-record-id"]), size, digest, kind, _page(fields.get("warc-refers-to")), name, offset, length))
                rows.sort(key=_order)
                yield pa.RecordBatch.from_arrays(_columns(rows), [n for n, _ in FIELDS])

    n = manifest.count()
    return manifest.select("archive").repartition(max(1, n), "archive").mapInArrow(read, CAPTURE)


class LoserTree:
    """K-way merge of sorted iterators; inner nodes keep the loser of their match."""

    def __init__(self, runs: list[Iterable[tuple]], order):
        self.order = order
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else order(h) for h in self.heads]
        k = len(runs)
        self.losers = [-1] * max(1, k)
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._first(a, b) else (b, a)
        self.winner = (winners[1] if k > 1 else 0) if k else -1

    def _first(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; runs at their end come last."""
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = head = next(self.runs[w], None)
            self.keys[w] = None if head is None else self.order(head)
            node = (w + len(self.runs)) // 2
            while node:
                if self._first(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merged_index(runs: DataFrame) -> DataFrame:
    """The captures of all runs with range_id and position, their place in the global order.

    Splits are taken from a sample of the keys, about ``SAMPLES_PER_RANGE`` a range, as range
    partitioning does; every capture is indexed. A range holds about ``RANGE_ROWS``.
    """
    spark, n = runs.sparkSession, runs.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-n // RANGE_ROWS), min(tasks, n // 500))
    share = min(1.0, ranges * SAMPLES_PER_RANGE / max(1, n))
    keys = ["url_key", "captured_at", "page_id"]
    sampled = runs.select(*keys).sample(share, seed=7).collect()
    places = sorted((r[0], r[1], r[2] is not None, r[2] or 0) for r in sampled)
    splits = [places[i * len(places) // ranges] for i in range(1, ranges)] if places else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = [(k, t, p is not None, p or 0) for k, t, p in zip(*(batch[c].to_pylist() for c in keys))]
            of = np.array([bisect_right(splits, p) for p in places], np.int64)
            # A slice ends where the range changes or a new run begins.
            new = [i for i in range(1, len(of)) if of[i] != of[i - 1] or places[i] < places[i - 1]]
            ends = [0, *new, len(of)] if len(of) else [0]
            rows = pa.StructArray.from_arrays(batch.columns, [n for n, _ in FIELDS])
            slices = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[ends[:-1]], pa.int64()), pa.array([part] * len(slices), pa.int64()), pa.array(range(number, number + len(slices)), pa.int64()), slices],
                ["range_id", "part", "number", "run"],
            )
            number += len(slices)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(range_id: int, held: list) -> Iterator[pa.RecordBatch]:
            rows, position = [], 0
            for row in LoserTree([[tuple(r.values()) for r in run] for run in held], _order):
                rows.append(row)
                if len(rows) == 10_000:
                    yield made(range_id, position, rows)
                    position, rows = position + len(rows), []
            if rows:
                yield made(range_id, position, rows)

        def made(range_id: int, position: int, rows: list[tuple]) -> pa.RecordBatch:
            place = [pa.array([range_id] * len(rows), pa.int64()), pa.array(range(position, position + len(rows)), pa.int64())]
            return pa.RecordBatch.from_arrays([*_columns(rows), *place], [*[n for n, _ in FIELDS], "range_id", "position"])

        now, held = None, []
        for batch in batches:
            for range_id, run in zip(batch["range_id"].to_pylist(), batch["run"]):
                if range_id != now:
                    if held:
                        yield from out(now, held)
                    now, held = range_id, []
                held.append(run.as_py())
        if held:
            yield from out(now, held)

    sliced = runs.mapInArrow(cut, f"range_id long, part long, number long, run array<struct<{CAPTURE.replace(' ', ':').replace(',:', ',')}>>")
    met = sliced.repartition(ranges, "range_id").sortWithinPartitions("range_id", "part", "number")
    return met.mapInArrow(merge, f"{CAPTURE}, range_id long, position long")


def warc_index(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives of ``pages``, read them back, and return the merged index.

    One row per page: the columns of ``CAPTURE``, range_id and position. ``payload_bytes`` and
    ``payload_digest`` are of the full payload, for revisits too.

    A null html is an empty payload, a null url the key of the empty address. A null page id
    sorts before all ids and never is the one that others refer to, unless no row with the
    payload has an id: then all are responses. Rows that repeat the smallest id and its
    payload are all responses. An empty table gives no archive and no rows. Other columns are
    ignored.
    """
    folder = folder or work_dir(pages.sparkSession, "archives")
    manifest = write_archives(pages, folder, least_bytes)
    return merged_index(stored(capture_runs(manifest, folder), "capture-runs"))
