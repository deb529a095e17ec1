"""Keyed writes onto plain parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.storagelevel import StorageLevel

from tellerscope.functions.sizing import input_bytes
from tellerscope.functions.skew import one_per_key, skew_hints, skew_join
from tellerscope.sources import folders, key_index

BATCH = "batch_id"


def read_target(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The folder's rows, or ``None`` while it has no data file yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# A source this many times smaller than the target is looked up in it instead.
LOOKUP_RATIO = 8


def new_rows(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``; rows without a key always are.

    A small source first reduces the target to the keys they share: Spark can then
    broadcast the source's keys and leave the target where it is.
    """
    keys = target.select(key)
    if input_bytes(source.select(key)) * LOOKUP_RATIO < input_bytes(keys):
        keys = keys.join(source.select(key).distinct(), key, "left_semi")
    hints = skew_hints(source, [key]) or {}
    return skew_join(source, keys, key, "left_anti", hot_left=hints.get(key))


def merge_insert_only(source: DataFrame, target_path: str, key: str = "id") -> None:
    """Append source rows with a key the target lacks; rows present never change.

    All source rows of a new key are appended, duplicates too, and rows with a NULL key
    on every run. Labels that arrive later do not reach loaded rows; see ``relabel``.
    """
    target = read_target(source.sparkSession, target_path)
    rows = source if target is None else new_rows(source, target, key)
    rows.write.mode("append").parquet(target_path)


def merge_into_bucketed(source: DataFrame, table: str, key: str = "id", buckets: int = 64, location: str | None = None) -> None:
    """As ``merge_insert_only``, into a catalog table whose files are bucketed by ``key``.

    Only the source is shuffled, to the table's buckets; the table is read bucket by bucket and
    never moved. The first call makes the table, with ``buckets`` of them, which then stay.
    The source should itself be a table or cheap to compute twice.
    """
    spark = source.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        buckets = int(spec["Num Buckets"])
        # Rows without a key are appended each time; they would only burden one bucket.
        keyed = source.filter(F.col(key).isNotNull()).join(spark.table(table).select(key), key, "left_anti")
        source = keyed.unionByName(source.filter(F.col(key).isNull()))
    dealt = source.repartition(buckets, key)  # one file per bucket
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).mode("append")
    if location and not exists:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def relabel(target: DataFrame, reports: DataFrame, key: str = "id") -> DataFrame:
    """Target rows, with labels that arrived after they were loaded (a fraud label wins).

    Write the result to a new folder; a parquet folder cannot be replaced while read.
    """
    late = reports.groupBy(key).agg(F.max("is_fraud").alias("__late"))
    hints = skew_hints(target, [key]) or {}
    joined = skew_join(target, late, key, "left", hot_left=hints.get(key))
    return joined.withColumn("is_fraud", F.coalesce("is_fraud", "__late")).select(*target.columns)


def folder_name(batch_id: int, run: str = "") -> str:
    return f"{run}-{batch_id}" if run else str(batch_id)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """Name of the runs on one checkpoint, kept beside it: the same after every restart."""
    path = f"{checkpoint.rstrip('/')}_run"
    known = read_target(spark, path, "run string")
    if known is None:
        new = spark.range(1).select(F.lit(uuid.uuid4().hex[:12]).alias("run"))
        new.write.mode("errorifexists").parquet(path)
        known = read_target(spark, path, "run string")
    return known.first()["run"]


def insert_if_absent(
    batch: DataFrame,
    target_path: str,
    batch_id: int,
    key: str = "id",
    order: Sequence[str] = ("timestamp",),
    run: str = "",
) -> None:
    """Insert each key once; the first writer wins and later rows are ignored.

    A batch owns the folder of its ``run`` and number and replaces it, so a retried batch
    changes nothing. A stream on a new checkpoint is another run (see ``run_name``): it counts
    from 0 again, but never touches the rows that were stored before. Within a batch the row
    lowest in ``order``, then in its other columns, is kept.
    """
    spark = batch.sparkSession
    name = folder_name(batch_id, run)
    ties = [c for c, t in batch.dtypes if c not in (key, *order) and not t.startswith("map")]
    first = one_per_key(
        batch.filter(F.col(key).isNotNull()), key, [*order, *ties], newest=False
    )
    first = first.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        target = read_target(spark, target_path)
        rows = first
        if target is not None:
            rows = first.join(_present(target, first, name, key), key, "left_anti")
        rows.select(*batch.columns).write.mode("overwrite").parquet(
            f"{target_path}/{BATCH}={name}"
        )
    finally:
        first.unpersist()


def insert_indexed(
    batch: DataFrame,
    target_path: str,
    batch_id: int,
    key: str = "id",
    order: Sequence[str] = ("timestamp",),
    run: str = "",
    buckets: int = key_index.BUCKETS,
) -> None:
    """As ``insert_if_absent``, with an index of the target's keys beside it.

    A batch opens only files of the index that can hold its keys, and none of the target, so its
    cost doesn't grow with what is stored. The index follows the rows: a batch that was lost
    between the two is written again with the same rows, and one that the index holds is done.
    All writers of a target have to use the index; a target that has none yet gets it first.
    """
    spark, index = batch.sparkSession, index_path(target_path)
    run = run or "batches"
    if key_index.is_empty(spark, index):
        stored = read_target(spark, target_path)
        if stored is not None:
            name = folder_name(batch_id, run)
            stored = stored.filter(F.col(BATCH).cast("string") != name)
            key_index.add(stored.select(key).distinct(), index, 0, "stored before", key, buckets)
    if key_index.applied(spark, index, batch_id, run):
        return
    ties = [c for c, t in batch.dtypes if c not in (key, *order) and not t.startswith("map")]
    first = one_per_key(
        batch.filter(F.col(key).isNotNull()), key, [*order, *ties], newest=False
    )
    first = first.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = key_index.present(first, index, key, buckets)
        rows = first if known is None else first.join(known, key, "left_anti")
        own = f"{target_path}/{BATCH}={folder_name(batch_id, run)}"
        rows.select(*batch.columns).write.mode("overwrite").parquet(own)
        key_index.add(spark.read.schema(batch.schema).parquet(own), index, batch_id, run, key, buckets)
    finally:
        first.unpersist()


def index_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}_keys"


def _present(target: DataFrame, batch: DataFrame, name: str, key: str) -> DataFrame:
    """Keys of ``batch`` that other batches wrote.

    The key range prunes row groups of the target, and the small batch side, not the
    target, is what Spark may broadcast.
    """
    low, high = batch.agg(F.min(key), F.max(key)).first()
    if low is None:
        return target.select(key).limit(0)
    keys = target.filter((F.col(BATCH).cast("string") != name) & F.col(key).between(low, high)).select(key)
    return keys.join(batch.select(key), key, "left_semi")


def read_scored(spark: SparkSession, target_path: str) -> DataFrame:
    return spark.read.parquet(target_path).drop(BATCH)


def reset(spark: SparkSession, target_path: str) -> None:
    """Empty the table but keep its schema. An index of its keys goes."""
    folders.remove(spark, index_path(target_path))
    current = read_target(spark, target_path)
    if current is None:
        return
    nothing = spark.createDataFrame([], current.schema)
    writer = nothing.write.mode("overwrite")
    if BATCH in current.columns:
        writer.option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(target_path)
        nothing.drop(BATCH).write.mode("overwrite").parquet(f"{target_path}/{BATCH}=-1")
    else:
        writer.parquet(target_path)


def drop_pipeline(spark: SparkSession, tables: Iterable[str] = (), views: Iterable[str] = ()) -> None:
    """Drop views, then tables; absent ones are ignored."""
    for name in views:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
