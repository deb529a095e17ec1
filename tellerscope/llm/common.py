"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerscope.session import work_dir


_KEPT: dict[Hashable, object] = {}
MOST_KEPT = 1


def kept(key: Hashable, make: Callable[[], object]):
    """What ``make`` gives, once per Python worker: a worker serves many tasks.

    A worker outlives a job, so only the last ``MOST_KEPT`` things stay: a step uses one at a time.
    """
    if key in _KEPT:
        _KEPT[key] = _KEPT.pop(key)  # now the newest
    else:
        while len(_KEPT) >= MOST_KEPT:
            del _KEPT[next(iter(_KEPT))]
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Freed memory to the system: the allocators of C and Arrow keep it, and a worker outlives the step."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def let_go(*own: Hashable) -> None:
    """Drops what other steps left in this worker, all but ``own``."""
    for key in [k for k in _KEPT if k not in own]:
        del _KEPT[key]


Batches = Iterator[pa.RecordBatch]


def tidied(run: Callable[[Batches], Batches], *own: Hashable) -> Callable[[Batches], Batches]:
    """``run``, for ``mapInArrow``, in a worker that keeps its ``own`` caches only.

    What others left goes before the first batch, what the task used after the last.
    """

    def tidied_run(batches: Batches) -> Batches:
        let_go(*own)
        give_back()
        yield from run(batches)
        give_back()

    return tidied_run


#: Bytes of a batch that goes to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Lets the workers import this package from the place where the driver found it.

    Also bounds the batches they get, as a task holds a batch, what it makes of it, and the
    copies of both in transit.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Gathers the folders that ``stored`` makes meanwhile."""
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield made
    finally:
        _SCRATCH.remove(made)


def discard(spark: SparkSession, folders: list[str], needed_by: DataFrame) -> None:
    """Deletes the work ``folders`` that ``needed_by`` does not read, and takes them off the list."""
    read = " ".join({f.rsplit("/", 1)[0] for f in needed_by.inputFiles()})
    for path in [p for p in folders if p.rsplit("/", 1)[-1] not in read]:
        _delete(spark, path)
        folders.remove(path)


def drop(*tables: DataFrame) -> None:
    """Deletes the folders of ``tables``, as ``stored`` gave them, which nothing reads from now on."""
    for made in tables:
        _delete(made.sparkSession, made.work_folder)
        for folders in _SCRATCH:
            if made.work_folder in folders:
                folders.remove(made.work_folder)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Deletes the shuffle files of an action at its end; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, purpose: str, partitions: str | None = None) -> DataFrame:
    """``df`` written to the shared work folder and read again.

    Cuts the lineage: what is behind it runs once, and a lost executor costs a re-read. The
    shuffle files behind it go with the write, its folder with ``drop`` or ``discard``.
    """
    path = work_dir(df.sparkSession, purpose)
    for made in _SCRATCH[-1:]:
        made.append(path)
    writer = df.write.option("compression", "zstd")
    if partitions:
        writer = writer.partitionBy(partitions)
    with _shuffles_deleted(df.sparkSession):
        writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.work_folder = path
    return out


def write_stream(path: str, chunks: Iterable[bytes]) -> None:
    """``chunks`` as the file at ``path``, in any file system that Arrow knows.

    The file appears whole, by a rename, so a task that is run again replaces it.
    """
    from pyarrow import fs
    from pyspark import TaskContext

    store, at = fs.FileSystem.from_uri(path)
    context = TaskContext.get()
    part = f"{at}.{context.taskAttemptId() if context else 0}.part"
    with store.open_output_stream(part, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    store.move(part, at)


def make_folder(path: str) -> str:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at, recursive=True)
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, *own: Hashable) -> DataFrame:
    """``fn`` over the Arrow batches of ``df``, one by one; workers keep its ``own`` caches only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(tidied(run, *own), schema)


def slices(batch: pa.RecordBatch, sizes, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` whose summed ``sizes`` stay near ``limit``."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


#: Rows up to which a list of keys is broadcast; longer ones are joined by shuffle.
MOST_BROADCAST = 200_000


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``dropped`` (doc_id, text_hash) names.

    ``text_hash`` is ``xxhash64`` of the text, null counting as empty: an id alone does not
    name a row where ids repeat. ``dropped`` should be a written table, as it is counted.
    """
    dropped = dropped.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    if dropped.count() <= MOST_BROADCAST:
        dropped = F.broadcast(dropped)
    own = docs["doc_id"].cast("long").eqNullSafe(dropped["__id"]) & (F.xxhash64(text_or_empty()) == dropped["__hash"])
    return docs.join(dropped, own, "left_anti")


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, hot: list[bytes], ways: int, by: list[str], how: str = "inner") -> DataFrame:
    """Join (inner or left) on a binary ``key`` that ``lookup`` holds once.

    Rows of the ``hot`` keys are dealt over ``ways`` tasks by a hash of the columns ``by``,
    with a copy of their lookup row in each.
    """
    if not hot:
        return rows.join(lookup, key, how)
    is_hot = F.col(key).isin([F.lit(h) for h in hot])
    salt = F.when(is_hot, F.pmod(F.xxhash64(*by), F.lit(ways)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    left, right = rows.withColumn("__way", salt), lookup.withColumn("__way", F.explode(copies))
    return left.join(right, [key, "__way"], how).drop("__way")
