"""Change log to current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.functions.skew import one_per_key

# Change types that carry the state after the change; pre-images do not.
STATE_CHANGES = ("insert", "update_postimage", "delete")


def last_changes(
    log: DataFrame, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """The newest state-carrying change per key, deletes included."""
    return one_per_key(log.filter(F.col(change).isin(*STATE_CHANGES)), key, [seq])


def current_state(
    log: DataFrame, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """Current row per key; keys whose newest change is a delete are gone."""
    return last_changes(log, key, seq, change).filter(F.col(change) != "delete")


def _last_positions(log: DataFrame, key: str, seq: str, change: str) -> DataFrame:
    """Per key: rows, and the newest position of any state and of a delete.

    Positions are plain numbers, so this is a hash aggregate with map-side combine; no
    row content is carried.
    """
    state, gone = F.col(change).isin(*STATE_CHANGES), F.col(change) == "delete"
    return log.groupBy(key).agg(
        F.count(F.lit(1)).alias("changes"),
        F.max(F.when(state, F.col(seq))).alias("newest"),
        F.max(F.when(gone, F.col(seq))).alias("deleted"),
    )


def _alive() -> Column:
    return F.col("newest") > F.coalesce(F.col("deleted"), F.col("newest") - 1)


def newest_key(
    log: DataFrame, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """The surviving key that changed last (no row on an empty log)."""
    live = _last_positions(log, key, seq, change).filter(_alive())
    return live.orderBy(F.desc("newest"), key).limit(1).select(key)


def cdc_row_counts(
    log: DataFrame, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """(history_rows, live_rows) from a single scan of the log."""
    return _last_positions(log, key, seq, change).agg(
        F.coalesce(F.sum("changes"), F.lit(0)).alias("history_rows"),
        F.count_if(_alive()).alias("live_rows"),
    )
