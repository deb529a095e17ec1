"""Near-duplicate groups by one-permutation MinHash.

Every document is the set of its distinct shingles. One hash deals the shingles over bins and
keeps the least of each bin; an empty bin takes the value of the first filled bin in an order
of its own, which is the same for all documents (optimal densification). Bins are read in
bands, and equal bands make a bucket. A pair at the least similarity of 0.8 shares no bucket
with a probability of (1 - 0.8^5)^48 = 5e-9, a more similar pair with less.

Equal sets are one class. In each bucket every class is a candidate with the bucket's hub
only, so candidates grow with the rows and not with the pairs. They are compared on their full
sets, and links join components. A bucket whose classes are still of several components may
hide a link between two of them. There

* classes outside the bucket's largest component become hubs of their own, if that gives at
  most ``PAIRS_PER_CLASS`` pairs for each class of the bucket;
* else blocks of the bucket's sets are compared in arrays, which give only links;
* a bucket of over ``MOST_DEALT`` components is dealt anew first, by the bands of another hash,
  as classes that have only a part in common seldom meet twice.

So each pair of different components that shares a bucket of the last deal is compared.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import slices, spread_join, stored, text_or_empty
from tellerscope.llm.components import components
from tellerscope.llm.ngram_join import class_sets, family_links, shingles, similar_pairs

WORDS = 4
SIMILARITY = (80, 100)
BANDS, ROWS = 48, 5
PAIRS_PER_CLASS = 4
MOST_DEALT = 8192
MOST_DEALS = 4
HOT_SHARE = 1000
WAYS = 32
SLICE_BYTES = 8 << 20
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


# --- signatures ---------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


@functools.cache
def _probes() -> np.ndarray:
    """For each bin, when it asks each other bin for its value: an order of its own."""
    return np.argsort(np.random.default_rng(13).random((BANDS * ROWS, BANDS * ROWS)), axis=1)


def signature(found: np.ndarray, deal: int = 0) -> np.ndarray:
    """Least hash of each bin of a set of distinct hashes; ``deal`` names the hash function."""
    bins = BANDS * ROWS
    values = np.sort(_mix(found + np.uint64((deal + 1) * int(_B) % (1 << 64))))
    of = ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))  # values are sorted, so bins are
    out = np.zeros(bins, np.uint64)
    filled = of[first]
    out[filled] = values[first]
    if len(filled) < bins:
        empty = np.setdiff1d(np.arange(bins), filled, assume_unique=True)
        asked = _probes()[np.ix_(empty, filled)]
        out[empty] = out[filled[asked.argmin(axis=1)]]
    return out


def bands(found: np.ndarray, deal: int = 0) -> np.ndarray:
    """One 64-bit key per band of the signature."""
    rows = signature(found, deal).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _A
    for r in range(ROWS):
        key = _mix(key + rows[:, r])
    return key.view(np.int64)


def document_bands(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n, signature, bands) of every document; ``signature`` names the set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch["bytes"].to_pylist(), SLICE_BYTES):
                sizes, names, keys = [], [], []
                for text in part["text"]:
                    found = shingles(text.as_py(), k)
                    sizes.append(len(found))
                    names.append(xxhash.xxh3_128_digest(found.tobytes()))
                    keys.append(bands(found) if len(found) else np.empty(0, np.int64))
                columns = [part["doc_id"], part["text_hash"], pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "signature", "bands"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("bytes"))
    return rows.mapInArrow(sets, "doc_id long, text_hash long, n long, signature binary, bands array<long>")


def dealt_anew(crowded: DataFrame, sets: DataFrame, deal: int) -> DataFrame:
    """(key, class_id, n) of ``crowded`` (key, class_id, n) in finer buckets, by another hash."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bands(np.array(s.as_py(), np.int64).view(np.uint64), deal) for s in batch["shingles"]]
            yield pa.RecordBatch.from_arrays([batch["class_id"], pa.array(found, pa.list_(pa.int64()))], ["class_id", "bands"])

    finer = sets.join(crowded.select("class_id").distinct(), "class_id", "left_semi").mapInArrow(keys, "class_id long, bands array<long>")
    rows = crowded.join(finer, "class_id").select("key", F.explode("bands").alias("band"), "class_id", "n")
    return stored(rows.select(F.xxhash64("key", "band").alias("key"), "class_id", "n"), "finer-bands")


# --- buckets --------------------------------------------------------------------------------


def buckets(rows: DataFrame) -> DataFrame:
    """(key, class_id, n, hub) of the ``rows`` (key, class_id, n) whose key two classes or more have.

    The hub (class_id, n) is the smallest class of the bucket.
    """
    groups = rows.groupBy("key").agg(F.min(F.struct("class_id", "n")).alias("hub"), F.count("*").alias("members")).filter("members > 1")
    groups = stored(groups, "buckets")
    total = groups.agg(F.sum("members")).first()[0] or 0
    hot = [r[0] for r in groups.filter(F.col("members") > max(WAYS, total // HOT_SHARE)).select("key").collect()]
    return stored(spread_join(rows, groups.select("key", "hub"), "key", hot, WAYS, ["class_id"]), "bucket-members")


def unresolved(shared: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, keys) of the buckets whose classes are of several components.

    Members: key, class_id, n, root. Keys: key, main (the largest component), roots, members, pairs
    (of classes in different components). Of buckets with the same classes one is given.
    """
    placed = shared.join(near.withColumnRenamed("node", "class_id"), "class_id", "left").select("key", "class_id", "n", F.coalesce("root", "class_id").alias("root"))
    placed = stored(placed, "bucket-components")
    held = placed.groupBy("key", "root").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("class_id")).alias("mark"))
    squares = F.sum(F.col("size").cast("double") * F.col("size"))
    keys = held.groupBy("key").agg(F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("roots"), F.sum("size").alias("members"), squares.alias("squares"), F.bit_xor("mark").alias("mark"))
    keys = keys.filter("roots > 1").groupBy("members", "roots", "mark", "squares").agg(F.min(F.struct("key", "main")).alias("one"))
    pairs = (F.col("members").cast("double") * F.col("members") - F.col("squares")) / 2
    return placed, stored(keys.select("one.*", "members", "roots", pairs.alias("pairs")), "unresolved-buckets")


def _fits(a: str, b: str, similarity: tuple[int, int]):
    """Whether sets of these sizes can be similar at all."""
    return similarity[1] * F.least(F.col(a), F.col(b)) >= similarity[0] * F.greatest(F.col(a), F.col(b))


def near_dedup(docs: DataFrame, k: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_hash.

    Documents are linked where similarity[1] * intersection >= similarity[0] * union;
    ``component_id`` is the smallest id that links reach, the own one included, and is ``kept``.
    Bands are laid out for a similarity of 0.8 or more.

    A null or wordless text has no shingles, is linked with nothing and kept. Rows that repeat
    an id take part each with its own text. A null id is a ``component_id`` only of a component
    without other ids. An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sets = stored(document_bands(docs, k), "minhash-sets")
    grouped = sets.filter("n > 0").groupBy("signature").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    # The ids are fixed by being written.
    classes = stored(grouped.withColumn("class_id", F.monotonically_increasing_id()), "minhash-classes")
    info = classes.drop("bands")
    rows = classes.select(F.explode("bands").alias("key"), "class_id", "n")
    links, near = None, None

    def joined(new: DataFrame) -> DataFrame:
        return new if links is None else links.unionByName(new)

    for deal in range(1, MOST_DEALS + 1):
        shared = buckets(rows)
        # Stars: of a class's hubs first the one it meets most often.
        spokes = shared.filter(F.col("class_id") != F.col("hub.class_id")).select(F.col("class_id").alias("a"), "n", F.col("hub.class_id").alias("b"), F.col("hub.n").alias("nb"))
        spokes = spokes.filter(_fits("n", "nb", similarity)).groupBy("a", "b").agg(F.count("*").alias("common"))
        best = stored(spokes.groupBy("a").agg(F.max_by("b", F.struct("common", "b")).alias("b")), "star-pairs")
        found = class_sets(docs, info, best.select(F.explode(F.array("a", "b")).alias("class_id")), k)
        links = stored(joined(similar_pairs(found, best, similarity)), "star-links")
        near = components(links)

        placed, keys = unresolved(shared, near)
        few = F.col("pairs") <= PAIRS_PER_CLASS * F.col("members")
        outside = placed.join(keys.filter(few).select("key", "main"), "key").filter("root <> main").select("key", F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
        met = outside.join(placed, "key").filter((F.col("ra") != F.col("root")) & _fits("na", "n", similarity))
        met = met.select(F.least("a", "class_id").alias("a"), F.greatest("a", "class_id").alias("b")).distinct()
        met = stored(met.join(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "outsider-pairs")
        many = keys.filter(~few)
        large = F.col("roots") > (MOST_DEALT if deal < MOST_DEALS else 1 << 62)
        blocks = stored(placed.join(many.filter(~large).select("key"), "key").select(F.col("key").alias("family"), "class_id", "root"), "block-members")
        again = stored(placed.join(many.filter(large).select("key"), "key").select("key", "class_id", "n"), "crowded-buckets")

        named = met.select(F.explode(F.array("a", "b")).alias("class_id")).unionByName(blocks.select("class_id")).unionByName(again.select("class_id"))
        found = class_sets(docs, info, named, k)
        between = similar_pairs(found, met, similarity).unionByName(family_links(blocks.join(found, "class_id"), similarity))
        links = stored(joined(between), "all-links")
        if not again.limit(1).count():
            break
        rows = dealt_anew(again, found, deal)

    roots = components(links).withColumnRenamed("node", "class_id")
    named = info.join(roots, "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_set = stored(named.join(least, "root").select("signature", "component_id", "size"), "components")
    total = by_set.agg(F.sum("size")).first()[0] or 0
    hot = [bytes(r[0]) for r in by_set.filter(F.col("size") > max(WAYS, total // HOT_SHARE)).select("signature").collect()]
    full = spread_join(sets.filter("n > 0").select("doc_id", "text_hash", "n", "signature"), by_set.drop("size"), "signature", hot, WAYS, ["doc_id"])
    full = full.select("doc_id", "n", "component_id", "text_hash")
    empty = sets.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), "text_hash")
    kept_ = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return full.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept_.alias("kept"), "text_hash")
