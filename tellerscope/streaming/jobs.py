"""Structured Streaming jobs. Each is a micro-batch query; the work stays in the plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerscope.operators.cdc import STATE_CHANGES, current_state, last_changes
from tellerscope.operators.live import (
    bucket_counts,
    finish_metrics,
    flow_counts,
    metric_columns,
    top_flows,
)
from tellerscope.operators.medallion import TXN_RULES, observe_expectations, silver
from tellerscope.operators.ml import NUMERIC, predict
from tellerscope.schemas import SCORED
from tellerscope.sources.messages import parse_messages
from tellerscope.sources import levels, published
from tellerscope.sources.tables import folder_name, insert_indexed, run_name

MICRO_BATCH = {"processingTime": "2 seconds"}
ONCE = {"availableNow": True}

# Message column to model input column.
MODEL_INPUT = {
    "amount": "amount",
    "new_balance_dest": "newBalanceDest",
    "old_balance_dest": "oldBalanceDest",
    "diff_orig": "diffOrig",
    "diff_dest": "diffDest",
    "type": "type",
    "country_orig": "countryOrig_name",
    "country_dest": "countryDest_name",
}


def silver_stream(bronze_stream: DataFrame, reports: DataFrame, rules=TXN_RULES) -> DataFrame:
    """Transactions that pass the rules, labelled from a static report table.

    Spark re-reads ``reports`` for every micro-batch; rule counts are observed as
    ``expectations``.
    """
    return silver(observe_expectations(bronze_stream, "expectations", rules), reports)


def score_messages(messages: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Parsed and scored rows in the columns of the scored table (batch or stream).

    A time that is none becomes NULL; ``messages.rejected`` reports it.
    """
    parsed = parse_messages(messages)
    inputs = parsed.withColumns(
        {new: F.col(old).cast("float") if new in NUMERIC else F.col(old)
         for old, new in MODEL_INPUT.items() if new != old}
    )
    kept = [c for c in SCORED.fieldNames() if c in parsed.columns]
    scored = predict(inputs, model, threshold)
    return scored.select(
        *[F.col(c).try_cast(SCORED[c].dataType).alias(c) for c in kept],
        "fraud_prediction",
        "fraud_probability",
        F.current_timestamp().alias("scored_at"),
    )


def stream_score(
    messages: DataFrame,
    model: PipelineModel,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Parse, score and insert-if-absent; restart with the same checkpoint.

    A scoring error fails the batch, which is then retried as a whole.
    """

    run = run_name(messages.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        insert_indexed(batch, target, batch_id, run=run)

    return (
        score_messages(messages, model)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or MICRO_BATCH))
        .start()
    )


def stream_metrics(scored: DataFrame) -> DataFrame:
    """Running totals (complete mode)."""
    return finish_metrics(scored.groupBy().agg(*metric_columns()))


def stream_country_flows(scored: DataFrame) -> DataFrame:
    """Running counts per country pair (complete mode); cut with ``top_flows`` in the sink."""
    return flow_counts(scored)


def stream_time_buckets(
    scored: DataFrame, seconds: int = 10, delay: str | None = None, key: str | None = None
) -> DataFrame:
    """Counts per tumbling bucket.

    With ``delay`` the watermark bounds the state and rows later than it are dropped
    (append or update mode); without it every bucket is kept (complete mode). With ``key`` as
    well, rows of one key and time count once, and each late row is reported by itself: an
    aggregation alone reports them after they were combined. See ``progress.batches``.
    """
    rows = scored.withWatermark("timestamp", delay) if delay else scored
    if delay and key:
        rows = rows.dropDuplicates([key, "timestamp"])
    counts = rows.groupBy(F.window("timestamp", f"{seconds} seconds").alias("w")).agg(
        *bucket_counts()
    )
    return counts.select(
        F.unix_seconds("w.start").alias("timestamp"), "total", "fraud", "legit"
    )


def dedup(stream: DataFrame, key: str = "id", delay: str = "10 minutes") -> DataFrame:
    """One row per key among those that arrive within ``delay`` of each other.

    The watermark is on the time of arrival, so a row is never late, however old its own
    time, and no new key is lost. ``dedup_into`` keeps keys unique beyond ``delay``.
    """
    arrived = stream.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", delay)
    return arrived.dropDuplicatesWithinWatermark([key]).drop("__arrived")


def dedup_into(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    key: str = "id",
    order: tuple[str, ...] = ("timestamp",),
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Store the first row per key for good: each batch inserts only keys ``target`` lacks.

    Its keys are looked up in the index of the target's keys (see ``key_index``).
    """
    run = run_name(stream.sparkSession, checkpoint)
    writer = stream.writeStream.queryName(name) if name else stream.writeStream

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            insert_indexed(batch, target, batch_id, key, order, run)

    return (
        writer.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or MICRO_BATCH))
        .start()
    )


def publish_latest(
    result: DataFrame, target: str, checkpoint: str, mode: str = "complete",
    trigger: dict | None = None, top_n: int | None = None,
) -> StreamingQuery:
    """Keep ``target`` equal to the newest result of a running aggregate.

    Each batch is a version of its own, which ``read_latest`` sees once it is finished.
    """
    run = run_name(result.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = top_flows(batch, top_n) if top_n else batch
        published.publish(rows, target, folder_name(batch_id, run))

    return (
        result.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or MICRO_BATCH))
        .start()
    )


def read_latest(spark: SparkSession, target: str) -> DataFrame | None:
    """What ``publish_latest`` finished last, as a whole; ``None`` before its first batch."""
    return published.read(spark, target)


def stream_current(
    log_stream: DataFrame,
    target: str,
    checkpoint: str,
    key: str = "id",
    seq: str = "_lsn",
    change: str = "_change_type",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Reduce each batch of the log to the newest change per key and keep it.

    The kept log has levels that are merged when they are full: its folders, and what a read
    costs, grow with the logarithm of the batches (see ``levels``). A batch that is retried,
    or a stream on a new checkpoint, changes nothing that is stored. Deletes are kept, so that
    an older change that comes late doesn't bring a key back. ``read_current`` resolves them.
    """
    run = run_name(log_stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            levels.append(batch, target, batch_id, run, lambda rows: last_changes(rows, key, seq, change))

    return (
        log_stream.filter(F.col(change).isin(*STATE_CHANGES))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or MICRO_BATCH))
        .start()
    )


def read_current(
    spark: SparkSession, target: str, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """Current rows from the reduced log ``stream_current`` keeps."""
    kept = levels.read(spark, target)
    if kept is None:
        raise ValueError(f"{target} holds no change yet")
    return current_state(kept, key, seq, change)
