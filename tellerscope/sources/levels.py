"""A keyed log kept small: folders in levels, merged when a level is full.

Each batch adds one folder to level 0. ``FANOUT`` folders of a level are reduced to one of the
next, so folders grow with the logarithm of the batches, and a row is rewritten once a level.
A manifest lists the folders that count; it is a small file that appears whole, and the newest
is the state. Readers of an older manifest still find its folders: those that no kept manifest
names go later.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tellerscope.sources import folders

FANOUT = 4
KEEP = 3


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return folders.names(spark, f"{path}/manifest")


def manifest(spark: SparkSession, path: str, name: str | None = None) -> dict:
    """{"folders": [[level, folder], ...], "applied": {run: last batch}}, newest folder last."""
    if name is None:
        known = _manifests(spark, path)
        name = known[-1] if known else None
    return json.loads(folders.get(spark, f"{path}/manifest/{name}")) if name else {"folders": [], "applied": {}}


def _read(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """The rows of some folders, which may be partitioned: each is read for itself."""
    rows = spark.read.parquet(f"{path}/data/{wanted[0]}")
    for name in wanted[1:]:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/data/{name}"))
    return rows


def _plain(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append(
    batch: DataFrame,
    path: str,
    batch_id: int,
    run: str,
    reduce: Callable[[DataFrame], DataFrame],
    fanout: int = FANOUT,
    write: Callable[[DataFrame, str], None] = _plain,
) -> None:
    """Add a batch, then merge the levels that are full. One writer at a time.

    ``reduce`` keeps what counts of any rows, and may be applied to its own results. Batches
    of a ``run`` come in order; one that is already in the state is not added again. ``write``
    puts rows into a new folder.
    """
    spark = batch.sparkSession
    state = manifest(spark, path)
    if state["applied"].get(run, -1) >= batch_id:
        return
    number = int(_manifests(spark, path)[-1]) + 1 if state["applied"] else 0
    name = f"{number:012d}-0"
    write(reduce(batch), f"{path}/data/{name}")
    now = [*map(tuple, state["folders"])]
    if folders.names(spark, f"{path}/data/{name}"):  # no rows may mean no file
        now.append((0, name))
    level = 0
    while len(full := [n for at, n in now if at == level]) >= fanout:
        name = f"{number:012d}-{level + 1}"
        write(reduce(_read(spark, path, full)), f"{path}/data/{name}")
        now = [(at, n) for at, n in now if at != level] + [(level + 1, name)]
        level += 1
    state = {"folders": now, "applied": {**state["applied"], run: batch_id}}
    folders.put(spark, f"{path}/manifest/{number:012d}", json.dumps(state))
    _retire(spark, path)


def _retire(spark: SparkSession, path: str) -> None:
    """Remove all but the newest manifests, and the folders that only others name."""
    known = _manifests(spark, path)
    named = {n for m in known[-KEEP:] for _, n in manifest(spark, path, m)["folders"]}
    for old in known[:-KEEP]:
        folders.remove(spark, f"{path}/manifest/{old}")
    for name in folders.names(spark, f"{path}/data"):
        if name not in named:
            folders.remove(spark, f"{path}/data/{name}")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the folders that count, not yet reduced across them; ``None`` at first."""
    wanted = [name for _, name in manifest(spark, path)["folders"]]
    return _read(spark, path, wanted) if wanted else None
