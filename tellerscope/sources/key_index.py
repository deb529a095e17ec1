"""The keys that a target holds, kept so that a batch looks only where its own keys can be.

Keys lie in buckets by their hash, as folders, in the levels of ``levels``. A lookup prunes to
the buckets of the batch's keys, so the files it opens are at most those buckets times the
folders of the levels, which grow with the logarithm of the batches, never with the target.
Parquet Bloom filters spare the row groups where a batch of a few keys has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscope.sources import levels

BUCKETS = 256
#: Keys that are named in the filter of the scan, as Spark hands so few to the Bloom filters.
MOST_NAMED = 10
_BUCKET = "bucket_of_key"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write(keys: DataFrame, path: str) -> None:
    key = next(c for c in keys.columns if c != _BUCKET)
    dealt = keys.repartition(_BUCKET).sortWithinPartitions(_BUCKET, key)  # a file per bucket
    writer = dealt.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.partitionBy(_BUCKET).parquet(path)


def add(rows: DataFrame, path: str, batch_id: int, run: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Add the keys of ``rows``, which the index lacks, as one batch of a run."""
    keys = rows.select(key).withColumn(_BUCKET, _bucket(key, buckets))
    levels.append(keys, path, batch_id, run, lambda old: old.select(key, _BUCKET), write=_write)


def applied(spark: SparkSession, path: str, batch_id: int, run: str) -> bool:
    """Whether a run's batch is in the index already."""
    return levels.manifest(spark, path)["applied"].get(run, -1) >= batch_id


def is_empty(spark: SparkSession, path: str) -> bool:
    return not levels.manifest(spark, path)["applied"]


def present(keys: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> DataFrame | None:
    """The ``keys`` that the index holds; ``None`` if it holds none at all.

    ``buckets`` is that of ``add``. What reaches the driver are the numbers of the buckets,
    and the keys themselves if they are at most ``MOST_NAMED``.
    """
    kept = levels.read(keys.sparkSession, path)
    if kept is None:
        return None
    keys = keys.select(key)
    wanted = [r[0] for r in keys.select(_bucket(key, buckets).alias("b")).distinct().collect()]
    kept = kept.filter(F.col(_BUCKET).isin(wanted)).select(key)
    few = keys.distinct().limit(MOST_NAMED + 1).collect()
    if len(few) <= MOST_NAMED:
        kept = kept.filter(F.col(key).isin([r[0] for r in few]))
    return kept.join(keys.distinct(), key, "left_semi")
