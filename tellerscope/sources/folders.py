"""Names, markers and removal of folders, in any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order, hidden ones left out; none if it isn't there."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def put(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file that appears whole: written under a hidden name, then renamed."""
    folder, name = path.rsplit("/", 1)
    fs, at = _at(spark, path)
    _, part = _at(spark, f"{folder}/_{name}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, at):
        raise OSError(f"{path} is there already")


def get(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)
