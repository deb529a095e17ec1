"""What a stream reports of each micro-batch, kept as a table.

A listener writes one row per batch: rows read, rows dropped as late, and observed metrics. The
row belongs to the run (the checkpoint) and the batch number and replaces an earlier one, so a
batch that runs again after a restart counts once. A batch's report comes after its commit: a
driver lost between the two leaves that batch out of the table, and only there.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tellerscope.sources import folders
from tellerscope.sources.tables import read_target, run_name

ROW = "run string, batch_id long, input_rows long, late_rows long, watermark string, metric string, name string, value long"


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the streams named ``run`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run
        self.ended: set[str] = set()
        self.changed = threading.Condition()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.run:
            try:
                self._write(event.progress)
            except Exception as error:  # raised by wait(), a listener can't stop a stream
                self.failure = error

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self, progress) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        head = (self.run, progress.batchId, progress.numInputRows, late, progress.eventTime.get("watermark"))
        observed = [
            (*head, metric, name, None if value is None else int(value))
            for metric, row in progress.observedMetrics.items()
            for name, value in row.asDict().items()
        ]
        rows = self.spark.createDataFrame([(*head, None, None, None), *observed], ROW)
        folder = f"{self.path}/run={self.run}/batch={progress.batchId}"
        if not progress.numInputRows and folders.names(self.spark, folder):
            return  # a sink that has the batch already skips it and reads nothing
        rows.drop("run").coalesce(1).write.mode("overwrite").parquet(folder)

    def wait(self, run_id: str, timeout: float) -> None:
        """Until the reports of a stream that has ended are written."""
        with self.changed:
            if not self.changed.wait_for(lambda: run_id in self.ended, timeout):
                raise TimeoutError("the stream's last report did not come")
        if self.failure:
            raise self.failure


@contextmanager
def recorded(spark: SparkSession, path: str, checkpoint: str, timeout: float = 120) -> Iterator[ProgressLog]:
    """Keeps the reports of the stream that is started inside with ``queryName(log.run)``.

    The stream must have ended inside; on leaving, its last report is waited for.
    """
    log = ProgressLog(spark, path, run_name(spark, checkpoint))
    started: list[str] = []
    log.onQueryStarted = lambda event: started.append(str(event.runId)) if event.name == log.run else None
    spark.streams.addListener(log)
    try:
        yield log
        for run_id in started:
            log.wait(run_id, timeout)
    finally:
        spark.streams.removeListener(log)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch_id, input_rows, late_rows, watermark), one row per batch."""
    found = read_target(spark, path, ROW)
    if found is None:
        return spark.createDataFrame([], ROW).select("run", "batch_id", "input_rows", "late_rows", "watermark")
    return found.filter("metric IS NULL").select("run", "batch_id", "input_rows", "late_rows", "watermark")


def observed(spark: SparkSession, path: str, metric: str) -> DataFrame:
    """(name, value): a metric's observed values, summed over all batches."""
    found = read_target(spark, path, ROW)
    rows = spark.createDataFrame([], ROW) if found is None else found
    return rows.filter(F.col("metric") == metric).groupBy("name").agg(F.sum("value").alias("value"))
