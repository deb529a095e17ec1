"""Exact top-k inner-product search with MaxScore, shard by shard.

The terms are the dimensions; a shard keeps one posting column per dimension. Each query
orders its terms by the largest contribution that the shard allows. Terms whose bounds sum
to less than the k-th best score so far are non-essential: no row can win by them alone. The
essential columns are traversed for a block of rows, rows that cannot reach the threshold
even with the bounds of all other terms are left, and the other columns are probed a few at
a time for the rest. Each shard reports its k best, which are merged per query.

The rows of a shard come first in a task, the queries stream past it. All queries meet all
shards, in blocks; nothing is broadcast and no pair of rows is ever a row of a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK = 1024
PROBE = 8
_EXACT = float(1 << 53)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector of longs floor(scale * x)), one row per id.

    Rows without id, without vector, or with a null or non-finite component are left out. Of
    rows that repeat an id the smallest vector counts.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    whole = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)
    rows = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled with zeros."""
    width = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(width) and (width == width[0]).all():
        return flat.reshape(len(width), int(width[0]))
    out = np.zeros((len(width), int(width.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < width[:, None]] = flat
    return out


class ShardIndex:
    """Posting columns of one shard with the bounds of each term."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.columns = ids, np.ascontiguousarray(rows.T)
        empty = not len(ids)
        self.high = np.zeros(len(self.columns)) if empty else rows.max(axis=0)
        self.low = np.zeros(len(self.columns)) if empty else rows.min(axis=0)
        self.most = max(1.0, float(np.abs(rows.astype(float)).max(initial=0)))
        self.floats = self.columns.astype(float)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows that are not ``own``, ties to smaller ids."""
        n = min(len(query), len(self.columns))
        query = query[:n]
        # Sums below 2**53 are exact in doubles; larger ones are summed as integers.
        exact = float(np.abs(query.astype(float)).max(initial=0)) * self.most * max(n, 1) < _EXACT
        columns, q = (self.floats, query.astype(float)) if exact else (self.columns, query)
        bound = np.maximum(q * self.high[:n], q * self.low[:n])
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
        best_ids, best = np.empty(0, np.int64), np.empty(0, q.dtype)
        for a in range(0, len(self.ids), BLOCK):
            rows = np.flatnonzero(self.ids[a : a + BLOCK] != own) + a
            floor = best[k - 1] if len(best) >= k else None
            # The essential terms: what is left after them stays below the threshold.
            done = n if floor is None else int(np.argmax(rest < max(floor, 1))) if (rest < max(floor, 1)).any() else n
            terms = order[:done]
            part = q[terms] @ columns[terms, a : a + BLOCK]
            part = part[rows - a]
            while floor is not None and len(rows):
                alive = part + rest[done] >= floor
                rows, part = rows[alive], part[alive]
                if done == n or not len(rows):
                    break
                terms = order[done : done + PROBE]
                part = part + q[terms] @ columns[np.ix_(terms, rows)]
                done = min(n, done + PROBE)
            ids, scores = np.append(best_ids, self.ids[rows]), np.append(best, part)
            top = np.lexsort((ids, -scores))[:k]
            best_ids, best = ids[top], scores[top]
        return best_ids, best.astype(np.int64)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the
    query's own; the score is the integer inner product, missing components counting as 0.
    Ties go to the smaller id. With fewer than ``k`` candidates all are returned; an empty
    table gives no rows. Which rows take part is said in ``quantised``. Other columns are
    ignored.
    """
    rows = quantised(vectors, scale).persist()
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    stored = rows.select(shard.alias("shard"), F.lit(0).alias("kind"), "vec_id", "vector")
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "vector")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, parts, index = None, [], [], None
        for batch in batches:
            shard, kind = batch["shard"].to_numpy(), batch["kind"].to_numpy()
            for own in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1):
                if not len(own):
                    continue
                part = batch.slice(int(own[0]), len(own))
                if shard[own[0]] != now:
                    now, ids, parts, index = shard[own[0]], [], [], None
                if kind[own[0]] == 0:
                    ids.append(part["vec_id"].to_numpy())
                    parts.append(part["vector"])
                    continue
                if index is None:
                    whole = _matrix(pa.concat_arrays(parts)) if parts else np.empty((0, 0), np.int64)
                    index = ShardIndex(np.concatenate([np.empty(0, np.int64), *ids]), whole)
                    parts = []
                out = [(q, *index.search(q, np.array(v, np.int64), k)) for q, v in zip(part["vec_id"].to_pylist(), part["vector"].to_pylist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]).astype(np.int64)),
                        "vec_id": pa.array(np.concatenate([i for _, i, _ in out])),
                        "score": pa.array(np.concatenate([s for _, _, s in out])),
                    }
                )

    tasks = max(shards, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = stored.unionByName(asked).repartition(tasks, "shard").sortWithinPartitions("shard", "kind", "vec_id")
    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
