"""Jaccard join on word n-grams with adaptive multi-match prefixes.

Every document is the set of its distinct shingles, as 64-bit hashes. One pass counts them in
a sketch of fixed size; the estimated frequency, then the hash, orders all shingles. With t
the least overlap that a document's size allows, its first n - t + l shingles hold at least
l of those that it shares with any partner. Each document lengthens its prefix to the l whose
estimated cost, postings read plus candidates verified, is lowest; two documents are
candidates only if their prefixes share at least the smaller of their two l.

Equal sets are one class. Classes that share prefix shingles are first compared with one hub
each, which joins groups of near copies without comparing all their pairs. The links so found
give components, and then every candidate pair of classes in different components is compared
exactly. So each link between components is found, and pairs inside one are never listed.

Pairs become rows only where a prefix shingle's classes in different components make at most
``LONG_LIST`` pairs for each class. Classes that share other shingles form families; a family is cut into blocks, each pair of blocks counts
its overlaps in arrays, and gives only the links that join components.

Each table that is written on the way is deleted when the last one that reads it is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import MOST_BROADCAST, drop, kept, map_rows, spread_join, stored, tidied
from tellerscope.llm.components import components

WORDS = 5
SIMILARITY = (8, 10)
SKETCH_BITS = 22
SKETCH_BLOCK = 4096
MOST_MATCHES = 64
LONG_LIST = 16
#: Sets and shingles of one block of a family.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 21
#: Cost of reading one shingle when a candidate is verified, in postings.
VERIFY_COST = 0.05
#: Bytes of words that a worker keeps the hashes of; each takes some 140 bytes besides its own.
MOST_WORD_BYTES = 32 << 20
WORD_BYTES = 140
HASHES = "word hashes"  # the name of that cache
HOT_SHARE = 1000
WAYS = 32
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- shingles ---------------------------------------------------------------------------


class WordHashes(dict):
    bytes = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        self.bytes += WORD_BYTES + len(word)
        return value

    def clear(self) -> None:
        super().clear()
        self.bytes = 0


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the text with A-Z in lower case.

    Words are separated by blanks and the characters 9 to 13. Fewer than k words are one
    shingle, none are no shingle.
    """
    cache = kept(HASHES, WordHashes)
    if cache.bytes > MOST_WORD_BYTES:
        cache.clear()
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    out = _mix(codes[: len(codes) - k + 1] + np.uint64(k))
    for j in range(1, k):
        out = _mix(out + codes[j : len(codes) - k + 1 + j])
    return np.unique(out)


def least_overlap(n: int, similarity: tuple[int, int]) -> int:
    """Shared shingles that any partner of a set of size n has at least."""
    return -(-similarity[0] * n // similarity[1])


# --- shingle frequencies -----------------------------------------------------------------


def sketch(docs: DataFrame, k: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Estimated frequency of each of 2**bits buckets of shingles, as 8 * log2, in bytes.

    All documents are counted; the size is fixed. A bucket's mean load is taken off, so
    what is left is the excess of frequent shingles.
    """
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(size, np.uint32), [], 0
        for batch in batches:
            for text in batch["text"]:
                found = shingles(text.as_py(), k)
                held.append((found >> np.uint64(64 - bits)).astype(np.int64))
                n += len(found)
                if n > 1 << 20:
                    total += np.bincount(np.concatenate(held), minlength=size).astype(np.uint32)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size).astype(np.uint32)
        if total.any():
            blocks = np.minimum(total, 65535).astype("<u2").reshape(-1, SKETCH_BLOCK)
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.arange(len(blocks)), pa.int32()), "counts": pa.array([b.tobytes() for b in blocks], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"]):
                own = sums.setdefault(block, np.zeros(SKETCH_BLOCK, np.int64))
                own += np.frombuffer(counts.as_py(), "<u2")
        if sums:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": pa.array([s.astype("<i8").tobytes() for s in sums.values()], pa.binary()), "sum": pa.array([int(s.sum()) for s in sums.values()], pa.int64())})

    schema = "block int, counts binary"
    counted = docs.select("text").mapInArrow(tidied(count, HASHES), schema).repartition(64, "block").mapInArrow(tidied(add), schema + ", sum long")
    counted = stored(counted, "sketch")
    mean = (counted.agg(F.sum("sum")).first()[0] or 0) / size

    def scale(batch: pa.RecordBatch) -> pa.RecordBatch:
        costs = [np.round(8 * np.log2(np.maximum(1, np.frombuffer(c.as_py(), "<i8") - mean))).astype(np.uint8).tobytes() for c in batch["counts"]]
        return pa.RecordBatch.from_pydict({"block": batch["block"], "costs": pa.array(costs, pa.binary())})

    out = np.zeros((size // SKETCH_BLOCK, SKETCH_BLOCK), np.uint8)
    for block, costs in map_rows(counted.select("block", "counts"), scale, "block int, costs binary").collect():
        out[block] = np.frombuffer(costs, np.uint8)
    drop(counted)
    return out.reshape(-1)


def prefix(found: np.ndarray, costs: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, int]:
    """(prefix shingles, matches it asks for) of a set of sorted hashes."""
    n = len(found)
    cost = costs[(found >> np.uint64(64 - (len(costs).bit_length() - 1))).astype(np.int64)]
    order = np.argsort(cost, kind="stable")  # equal estimates stay in order of the hash
    least = least_overlap(n, similarity)
    postings = np.cumsum(np.exp2(cost[order] / 8))
    matches = np.arange(1, min(least, MOST_MATCHES) + 1)
    read = postings[n - least + matches - 1]
    # A candidate takes as many of the postings read as it must match.
    total = read * (1 + VERIFY_COST * n / matches)
    best = int(matches[np.argmin(total)])
    return found[order[: n - least + best]], best


# --- the join ------------------------------------------------------------------------------


def document_sets(docs: DataFrame, k: int, similarity: tuple[int, int], costs: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, n, signature, matches, prefix) of every document.

    The signature names the set.
    """
    shared = docs.sparkSession.sparkContext.broadcast(costs)

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch["text"]:
            found = shingles(text.as_py(), k)
            tokens, matches = prefix(found, shared.value, similarity) if len(found) else (found, 0)
            rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), matches, tokens.view(np.int64)))
        sizes, names, matches, tokens = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "text_hash": batch["text_hash"],
                "n": pa.array(sizes, pa.int64()),
                "signature": pa.array(names, pa.binary()),
                "matches": pa.array(matches, pa.int32()),
                "prefix": pa.array(tokens, pa.list_(pa.int64())),
            }
        )

    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), sets, "doc_id long, text_hash long, n long, signature binary, matches int, prefix array<long>", HASHES)


def shared_postings(classes: DataFrame) -> DataFrame:
    """(token, class_id, n, hub) of the prefix shingles of two or more classes.

    A shingle's hub is its smallest class. Rows stream sorted by shingle, so that no list is
    gathered, however long.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = hub = size_of = None
        alone = False  # the last row was the first of its shingle and is not yet given
        for batch in batches:
            token, own, n = (batch[c].to_numpy() for c in ("token", "class_id", "n"))
            if last is not None:
                token, own, n = np.append(last, token), np.append(hub, own), np.append(size_of, n)
            if not len(token):
                continue
            start = np.append(True, token[1:] != token[:-1])
            first = np.flatnonzero(start)
            of = np.cumsum(start) - 1
            size = np.diff(np.append(first, len(token)))
            give = size[of] > 1
            if last is not None and not alone:
                give[0] = False  # its row was given before
            hubs = own[first][of]
            yield pa.RecordBatch.from_arrays([pa.array(x[give]) for x in (token, own, n, hubs)], ["token", "class_id", "n", "hub"])
            alone = bool(size[-1] == 1) and (alone or len(first) > 1 or last is None)
            last, hub, size_of = token[-1], own[first[-1]], n[first[-1]]

    postings = classes.select(F.explode("prefix").alias("token"), "class_id", "n")
    return postings.repartition("token").sortWithinPartitions("token", "class_id").mapInArrow(tidied(group), "token long, class_id long, n long, hub long")


def class_sets(docs: DataFrame, classes: DataFrame, named: DataFrame, k: int) -> DataFrame:
    """(class_id, shingles) of the classes that ``named`` (class_id) names."""
    listed = stored(classes.join(named.distinct(), "class_id", "left_semi").select("class_id", F.col("signature").alias("name"), F.col("first_doc").alias("doc")), "to-verify")
    wanted = F.broadcast(listed) if listed.count() <= MOST_BROADCAST else listed

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, found = [], []
        for own, name, text in zip(batch["class_id"].to_pylist(), batch["name"].to_pylist(), batch["text"]):
            one = shingles(text.as_py(), k)
            if xxhash.xxh3_128_digest(one.tobytes()) == name:
                ids.append(own)
                found.append(one.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["class_id", "shingles"])

    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc"])).select("class_id", "name", "text")
    found = map_rows(texts, sets, "class_id long, shingles array<long>", HASHES).dropDuplicates(["class_id"])
    found = stored(found, "sets")
    drop(listed)
    return found


def similar_pairs(found: DataFrame, pairs: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, b) whose sets in ``found`` are similar, with ``shared``, their overlap."""
    a, b = (found.select(F.col("class_id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    met = pairs.join(a, "a").join(b, "b").select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb")).alias("sizes"))
    similar = similarity[1] * F.col("shared") >= similarity[0] * (F.col("sizes") - F.col("shared"))
    return met.filter(similar).select("a", "b", "shared")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    sets = left + right
    lengths = [len(x) for x in sets]
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    often = np.bincount(at, minlength=len(tokens)) > 1
    number = np.cumsum(often) - 1
    row, column = row[often[at]], number[at[often[at]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for a in range(0, int(often.sum()), width):
        low, high = np.searchsorted(column, (a, a + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[low:high], column[low:high] - a] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out.astype(np.int64)


def family_links(members: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b, shared): links that join the components of each family.

    ``members``: family, class_id, root, shingles. Every two members of a family meet in the
    task of their pair of blocks; links inside a component known there are not given again.
    """
    sizes = members.groupBy("family").agg(F.count("*").alias("sets"), F.sum(F.size("shingles")).alias("total"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(sizes.select("family", blocks.alias("blocks")), "family")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("second"), "class_id", "root", "shingles")

    def links(family: tuple, rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        same = family[1] == family[2]
        left = [r for r in rows if same or not r[0]]
        right = left if same else [r for r in rows if r[0]]
        if not left or not right:
            return
        shared = overlaps([r[3] for r in left], [r[3] for r in right])
        sizes = [np.array([len(r[3]) for r in side]) for side in (left, right)]
        union = sizes[0][:, None] + sizes[1] - shared
        near = similarity[1] * shared >= similarity[0] * union
        ids = [np.array([r[1] for r in side]) for side in (left, right)]
        if same:
            near &= ids[0][:, None] < ids[1]
        _, root = np.unique([r[2] for r in left + right], return_inverse=True)
        for i in np.flatnonzero(near.any(axis=1)):
            there = np.flatnonzero(near[i])
            _, first = np.unique(root[len(left) + there], return_index=True)
            for j in there[first]:
                x, y = root[i], root[len(left) + j]
                if x != y:
                    root[root == y] = x
                    yield int(ids[0][i]), int(ids[1][j]), int(shared[i, j])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(now, rows):
            columns = list(zip(*links(now, rows))) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "shared"])

        now, rows = None, []
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("family", "p", "q")))
            lists = batch["shingles"]
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            for i, (key, second, own, root) in enumerate(zip(keys, *(batch[c].to_pylist() for c in ("second", "class_id", "root")))):
                if key != now:
                    if rows:
                        yield out(now, rows)
                    now, rows = key, []
                rows.append((second, own, root, flat[ends[i] : ends[i + 1]].copy()))
        if rows:
            yield out(now, rows)

    keys = ["family", "p", "q"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "class_id").mapInArrow(tidied(join), "a long, b long, shared long")


def _candidates(counted: DataFrame, classes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Of (a, b, common): pairs that share enough prefix shingles and fit in size.

    ``more`` of a class is how many of its prefix shingles ``common`` leaves out.
    """
    a, b = (classes.select(F.col("class_id").alias(c), F.col("n").alias(f"n{c}"), (F.col("matches")).alias(f"m{c}"), F.col("more").alias(f"l{c}")) for c in "ab")
    met = counted.join(a, "a").join(b, "b")
    fits = similarity[1] * F.least("na", "nb") >= similarity[0] * F.greatest("na", "nb")
    enough = F.col("common") + F.least("la", "lb") >= F.least("ma", "mb")
    return met.filter(enough & fits).select("a", "b", "common")


def ngram_join(docs: DataFrame, k: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    Documents: doc_id, n_shingles, component_id, text_hash, one row per row of ``docs``. Documents are
    linked where similarity[1] * intersection >= similarity[0] * union; ``component_id`` is
    the smallest id that links reach, the own one included. Links: first_a, first_b, shared:
    the verified links between sets, named by the smallest id that has the set; they span the
    components, pairs inside a component that need no check are not among them.

    A null or wordless text has no shingles and is linked with nothing. Rows that repeat an
    id take part each with its own text. A null id is never a ``component_id`` unless the
    component has no other. An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    costs = sketch(docs, k)
    sets = stored(document_sets(docs, k, similarity, costs), "document-sets")
    grouped = sets.filter("n > 0").groupBy("signature").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("matches").alias("matches"), F.first("prefix").alias("prefix"))
    # The ids are fixed by being written.
    classes = stored(grouped.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    # The prefixes, most of both tables, are in the postings from here on.
    own = stored(sets.drop("matches", "prefix"), "documents")
    drop(sets)
    info = stored(classes.drop("prefix"), "class-names")
    shared = stored(shared_postings(classes), "postings")
    drop(classes)

    spokes = shared.filter("class_id <> hub").groupBy(F.col("class_id").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("common"))
    alone = info.withColumn("more", F.lit(0))
    best = _candidates(spokes, alone, similarity).groupBy("a").agg(F.max_by("b", F.struct("common", "b")).alias("b"))
    best = stored(best, "star-pairs")
    found = class_sets(docs, info, best.select(F.explode(F.array("a", "b")).alias("class_id")), k)
    stars = stored(similar_pairs(found, best, similarity), "star-links")
    drop(found, best)
    near = components(stars)

    # All candidates between components. Shingles of few of them: pairs of components per
    # shingle, then their classes.
    grown = shared.join(near.withColumnRenamed("node", "class_id"), "class_id", "left")
    grown = stored(grown.select("token", "class_id", "n", "hub", F.coalesce("root", "class_id").alias("root")), "postings-by-component")
    drop(shared)
    held = grown.groupBy("token", "root").agg(F.count("*").alias("classes"), F.min("class_id").alias("one"), F.min("n").alias("low"), F.max("n").alias("high"))
    square = F.col("classes").cast("double") * F.col("classes")
    lists = held.groupBy("token").agg(F.count("*").alias("roots"), F.sum("classes").alias("all"), F.sum(square).alias("inside"))
    # Pairs of classes in different components, for each class of the list.
    each = (F.col("all") - F.col("inside") / F.col("all")) / 2
    lists = stored(lists.filter("roots > 1").select("token", (each > LONG_LIST).alias("long")), "lists-between")
    short, long = lists.filter("NOT long").select("token"), lists.filter("long").select("token")
    few = stored(held.join(short, "token"), "postings-between")
    a, b = (few.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("root", "classes", "one", "low", "high")]) for s in "ab")
    fits = (similarity[1] * F.col("high_a") >= similarity[0] * F.col("low_b")) & (similarity[1] * F.col("high_b") >= similarity[0] * F.col("low_a"))
    met = a.join(b, (a["token"] == b["token"]) & (F.col("root_a") < F.col("root_b")) & fits).drop(b["token"])
    met = met.drop("low_a", "low_b", "high_a", "high_b")
    rest = grown.join(short, "token", "left_semi")
    for s in "ab":
        many = met.filter(f"classes_{s} > 1").join(rest.select("token", F.col("root").alias(f"root_{s}"), F.col("class_id").alias(s)), ["token", f"root_{s}"])
        met = met.filter(f"classes_{s} = 1").withColumn(s, F.col(f"one_{s}")).unionByName(many)
    counted = met.groupBy("a", "b").agg(F.count("*").alias("common"))
    crowded = stored(grown.join(long, "token", "left_semi"), "long-lists")
    more = crowded.groupBy("class_id").agg(F.count("*").alias("more"))
    pairs = stored(_candidates(counted, info.join(more, "class_id", "left").fillna(0, ["more"]), similarity), "pairs")
    drop(grown, lists, few)

    # Shingles of many components: the classes that share them, by family.
    families = components(crowded.select(F.col("class_id").alias("a"), F.col("hub").alias("b")))
    members = crowded.select("class_id", "root").distinct().join(families.select(F.col("node").alias("class_id"), F.col("root").alias("family")), "class_id")
    members = stored(members, "families")
    drop(crowded)
    named = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).unionByName(members.select("class_id"))
    found = class_sets(docs, info, named, k)
    between = similar_pairs(found, pairs, similarity).unionByName(family_links(members.join(found, "class_id"), similarity))
    links = stored(stars.unionByName(between), "all-links")
    drop(stars, pairs, members, found)

    roots = components(links).withColumnRenamed("node", "class_id")
    named = info.join(roots, "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_set = stored(named.join(least, "root").select("signature", "component_id", "size"), "components")
    total = by_set.agg(F.sum("size")).first()[0] or 0
    hot = [bytes(r[0]) for r in by_set.filter(F.col("size") > max(WAYS, total // HOT_SHARE)).select("signature").collect()]
    full = spread_join(own.filter("n > 0").select("doc_id", "text_hash", "n", "signature"), by_set.drop("size"), "signature", hot, WAYS, ["doc_id"])
    out = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash")
    empty = own.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash")
    first = info.select("class_id", "first_doc")
    named_links = links.join(first.withColumnsRenamed({"class_id": "a", "first_doc": "first_a"}), "a").join(first.withColumnsRenamed({"class_id": "b", "first_doc": "first_b"}), "b")
    return out.unionByName(empty), named_links.select("first_a", "first_b", "shared")
