"""Size checks made before a plan is chosen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.session import work_dir

MAX_ROWS = 10_000
MAX_BYTES = 16 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of all inputs below ``df``, by Catalyst's statistics.

    Leaves are summed, since the estimate of a join multiplies its sides. An
    input without statistics counts as very large.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _as_text(df: DataFrame):
    """Bytes of a row's content, as text."""
    return F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))


def pin_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Materialise a result proven to be small and mark it for broadcast.

    At most ``max_rows + 1`` rows reach the driver. A larger result, in rows or bytes, is
    returned unchanged, without a hint, so Spark picks a shuffle join for it.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows or sum(len(str(r)) for r in rows) > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared work folder and read again: its plan runs once."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """A written table, marked for broadcast if it has few rows and bytes."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(_as_text(df), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df
