"""Ranked lexical search by the Best Position Algorithm.

A term's impact list holds the documents with the term by falling share of the score. For one
query the lists of its terms are read by direct access, always at the first positions of each
list that are not seen yet. A document met is scored whole by random access to the other
lists, and its positions there are seen as well. The best position of a list is the last one
before which all are seen: no unseen document stands higher in it. So the impacts at the best
positions add up to a bound for all unseen documents, which is never above the bound of the
last positions read; the search stops when it is strictly below the k-th score.

Documents are split into shards of a bounded number of postings. Each task goes through its
shards with the best k so far of each query, and the tasks' lists are merged. Queries run in
blocks of a bounded number of terms, and only postings of a block's terms are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerscope.llm.common import slices, stored, text_or_empty

TOP = 50
#: Postings of one shard, terms of one block of queries, and positions first read of a list.
SHARD_POSTINGS = 1 << 20
BLOCK_TERMS = 1 << 19
STEP = 16
SLICE_BYTES = 8 << 20
#: Scores are whole numbers: weights in thousandths, shares of a term in billionths.
WEIGHT_UNIT, SHARE_UNIT, LENGTH_SHARE = 1000, 1_000_000_000, 50
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_KEPT).split()


def weight(holders: int, documents: int) -> int:
    return math.floor(WEIGHT_UNIT * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document of ``lengths`` terms that holds it ``times``."""
    scale = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * documents // total
    return weights * (SHARE_UNIT * times // (1000 * times + 20 * scale))


# --- one shard ---------------------------------------------------------------------------


class Best:
    """The k best (score, id) so far: highest scores, ties by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.empty(0, np.int64)
        self.nulls = np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        if len(self.scores) == self.k:
            near = scores >= self.scores[-1]
            scores, ids, nulls = scores[near], ids[near], nulls[near]
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]

    @property
    def kth(self) -> int:
        """Score below which nothing can enter; 0 while there is room for any score above 0."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0


class ShardLists:
    """Impact lists of a shard: postings by term and falling impact, and by term and document."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray):
        held = impact > 0
        docs, terms, impact = docs[held], terms[held], impact[held]
        self.ids, self.nulls = ids, nulls
        order = np.lexsort((docs, -impact, terms))
        self.docs, self.impact = docs[order], impact[order]
        self.terms, first = np.unique(terms[order], return_index=True)
        self.bounds = np.append(first, len(order))
        by_doc = np.lexsort((docs, terms))
        self.sorted_docs = docs[by_doc]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.places = place[by_doc]

    def spans(self, terms: np.ndarray) -> list[tuple[int, int]]:
        """(begin, end) of the lists of those ``terms`` that the shard holds."""
        if not len(self.terms):
            return []
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        at = at[self.terms[at] == terms]
        return list(zip(self.bounds[at].tolist(), self.bounds[at + 1].tolist()))

    def search(self, terms: np.ndarray, best: Best, step: int = STEP) -> int:
        """Adds to ``best`` all documents that belong to it; gives the number scored."""
        spans = self.spans(terms)
        seen = [np.zeros(end - begin + 1, bool) for begin, end in spans]  # one more, never seen
        position = [0] * len(spans)  # how many from the top are seen without a gap
        scored = 0
        while True:
            fresh = [self.docs[begin + at : min(begin + at + step, end)][~own[at : min(at + step, end - begin)]] for (begin, end), own, at in zip(spans, seen, position)]
            fresh = np.unique(np.concatenate(fresh)) if fresh else np.empty(0, np.int64)
            if not len(fresh):
                return scored
            scored += len(fresh)
            scores = np.zeros(len(fresh), np.int64)
            bound = 0
            for i, (begin, end) in enumerate(spans):
                own = self.sorted_docs[begin:end]
                at = np.minimum(np.searchsorted(own, fresh), end - begin - 1)
                hit = own[at] == fresh
                places = self.places[begin + at[hit]]
                scores[hit] += self.impact[places]
                seen[i][places - begin] = True
                position[i] += int(seen[i][position[i] :].argmin())
                if position[i] < end - begin:
                    bound += int(self.impact[begin + position[i] - 1])
            best.add(scores, self.ids[fresh], self.nulls[fresh])
            if bound < best.kth:
                return scored
            step *= 2


# --- the search ----------------------------------------------------------------------------


def query_terms(queries: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(query, item_id, terms) of every row of ``queries``; ``query`` numbers the rows."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(dict.fromkeys(terms(t.as_py()))) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = queries.select(F.col(id_column).cast("long").alias("item_id"), text_or_empty(text_column).alias("text"))
    found = rows.mapInArrow(distinct, "item_id long, terms array<binary>")
    # The numbers are fixed by being written.
    return stored(found.withColumn("query", F.monotonically_increasing_id()), "query-terms")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times): length and postings of every document that has a term at all."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for part in slices(batch, batch["bytes"].to_pylist(), SLICE_BYTES):
                sizes, numbers, times, ends = [], [], [], [0]
                for text in part["text"]:
                    words = terms(text.as_py())
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    sizes.append(len(words))
                    numbers += found.keys()
                    times += found.values()
                    ends.append(len(numbers))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (numbers, times)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("bytes", F.octet_length("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<int>").filter("n > 0")


def _block(docs: DataFrame, asked: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """(query, doc_id, score): what each task's best k of the queries ``asked`` are."""
    vocabulary: dict[bytes, int] = {}
    wanted = [(query, np.array(sorted(vocabulary.setdefault(t, len(vocabulary)) for t in own), np.int64)) for query, own in asked]
    spark = docs.sparkSession
    held = stored(postings(docs, vocabulary), "postings")
    documents, total = held.agg(F.count("*"), F.sum("n")).first()
    holders = np.zeros(len(vocabulary), np.int64)
    for term, number in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[term] = number
    weights = np.array([weight(int(h), documents) for h in holders], np.int64)
    shared = spark.sparkContext.broadcast((wanted, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights = shared.value
        best = {query: Best(k) for query, _ in wanted}

        def run(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts).combine_chunks()
            if not rows.num_rows:
                return
            ids, nulls = rows["doc_id"].fill_null(0).to_numpy(), rows["doc_id"].is_null().to_numpy()
            lists = [rows[c].combine_chunks() for c in ("terms", "times")]
            docs = np.repeat(np.arange(rows.num_rows), lists[0].value_lengths().to_numpy())
            own, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            shard = ShardLists(ids, nulls, docs, own, impacts(weights[own], times, rows["n"].to_numpy()[docs], documents, total))
            for query, own in wanted:
                shard.search(own, best[query])

        parts, size = [], 0
        for batch in batches:
            for part in slices(batch, batch["terms"].value_lengths().to_pylist(), SHARD_POSTINGS // 4):
                parts.append(part)
                size += len(part["terms"].flatten())
                if size >= SHARD_POSTINGS:
                    run(parts)
                    parts, size = [], 0
        if parts:
            run(parts)
        for query, found in best.items():
            ids = pa.array(found.ids, mask=found.nulls)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query)), ids, pa.array(found.scores)], ["query", "doc_id", "score"])

    # As many tasks as the cluster has cores, and more only when the shards need them.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(int(holders.sum()) / SHARD_POSTINGS))
    return held.coalesce(tasks).mapInArrow(search, "query long, doc_id long, score long")


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``queries``.

    A document's score is the sum of the impacts of the query's distinct terms in it; those
    with a score above 0 are ranked, equal scores by ascending doc_id, a null id last. All
    numbers are taken over all documents that have a term.

    A null, empty or termless text is found by no query and finds nothing. Repeated rows of
    ``docs`` are documents of their own; repeated rows of ``queries`` each give their rows. An
    empty table gives no rows. Other columns are ignored. A block has about ``BLOCK_TERMS``
    terms, or the terms of one query if that alone has more; each block is one pass over ``docs``.
    """
    items = query_terms(queries, id_column, text_column)
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(total / BLOCK_TERMS)
    found = None
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).filter(F.size("terms") > 0)
        asked = [(r["query"], [bytes(t) for t in r["terms"]]) for r in own.select("query", "terms").collect()]
        if asked:
            some = stored(_block(docs, asked, k), "block-results")
            found = some if found is None else found.unionByName(some)
    if found is None:
        return items.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
