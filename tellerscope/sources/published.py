"""A result that is replaced as a whole: readers see the old one or the new one, never a part.

``path/data/version=N`` holds a result. ``path/live`` holds an empty file per finished version,
written after its data; the newest names what readers read. Old versions go later, so that a
reader has time to finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellerscope.sources import folders

KEEP = 3


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, name) of the finished versions, oldest first."""
    found = [n.split(".", 1) for n in folders.names(spark, f"{path}/live")]
    return sorted((int(number), name) for number, name in found)


def _folder(path: str, number: int) -> str:
    return f"{path}/data/version={number}"


def write_version(df: DataFrame, path: str, number: int) -> None:
    """Data alone: nobody reads it before ``finish``, and the next attempt replaces it."""
    df.write.mode("overwrite").parquet(_folder(path, number))


def finish(spark: SparkSession, path: str, number: int, name: str) -> None:
    folders.put(spark, f"{path}/live/{number:012d}.{name}")


def publish(df: DataFrame, path: str, name: str, keep: int = KEEP) -> int:
    """Make ``df`` the result that readers see. One writer at a time.

    ``name`` tells the writer's step (a batch, for instance): a step that is repeated after
    it was finished changes nothing. The newest ``keep`` versions stay.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    if known and known[-1][1] == name:
        return known[-1][0]
    number = known[-1][0] + 1 if known else 0
    write_version(df, path, number)
    finish(spark, path, number, name)
    for old, old_name in known[: max(0, len(known) + 1 - keep)]:
        folders.remove(spark, f"{path}/live/{old:012d}.{old_name}")
        folders.remove(spark, _folder(path, old))
    return number


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version; ``None`` before the first."""
    known = versions(spark, path)
    return spark.read.parquet(_folder(path, known[-1][0])) if known else None
