"""Key figures of the scored transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerscope.functions.columns import money_sum
from tellerscope.operators.analytics import latest, top

def _fraud() -> Column:
    return F.col("fraud_prediction")


def percent(part: Column, whole: Column) -> Column:
    """Exact decimal percentage with two digits; NULL when ``whole`` is 0."""
    ratio = part.cast("decimal(20,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, 2).cast("double")


def metric_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(_fraud()).alias("fraud_count"),
        F.count_if(~_fraud()).alias("legit_count"),
        F.round(money_sum("amount"), 2).alias("amount_sum"),
    ]


def finish_metrics(sums: DataFrame) -> DataFrame:
    rate = percent(F.col("fraud_count"), F.col("total_transactions"))
    return sums.select(
        "total_transactions",
        "fraud_count",
        "legit_count",
        F.coalesce(rate, F.lit(0.0)).alias("fraud_rate"),
        F.coalesce("amount_sum", F.lit(0.0)).alias("total_amount"),
    )


def live_metrics(scored: DataFrame) -> DataFrame:
    """Totals, fraud share and amount; zeros on an empty table."""
    return finish_metrics(scored.agg(*metric_columns()))


def flow_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy(
        F.col("country_orig").alias("source"), F.col("country_dest").alias("target")
    ).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(_fraud()).alias("fraud_count"),
        F.round(money_sum("amount"), 2).alias("total_amount"),
    )


def top_flows(flows: DataFrame, n: int = 30) -> DataFrame:
    return top(flows, n, F.desc("total_count"), "source", "target")


def live_flows(scored: DataFrame, n: int = 30) -> DataFrame:
    """Busiest country pairs."""
    return top_flows(flow_counts(scored), n)


def flow_bars(flows: DataFrame, n: int = 15) -> DataFrame:
    """Fraud share and length relative to the longest bar, for the first ``n`` flows."""
    # At most n rows are left, so one task may hold them all.
    longest = F.max("total_count").over(Window.partitionBy(F.lit(1)))
    return top_flows(flows, n).select(
        "source",
        "target",
        "total_count",
        (F.col("fraud_count") / F.col("total_count")).alias("fraud_ratio"),
        (F.col("total_count") / longest * 100).alias("bar_width"),
    )


def bucket(col: str, seconds: int) -> Column:
    """Start of the bucket in epoch seconds; a bucket holds its lower edge only."""
    epoch = F.unix_seconds(F.col(col))
    return epoch - F.pmod(epoch, F.lit(seconds))


def bucket_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(_fraud()).alias("fraud"),
        F.count_if(~_fraud()).alias("legit"),
    ]


def live_buckets(scored: DataFrame, seconds: int = 10, n: int = 60) -> DataFrame:
    """The newest ``n`` non-empty time buckets, oldest first."""
    counts = scored.groupBy(bucket("timestamp", seconds).alias("timestamp")).agg(*bucket_counts())
    return top(counts, n, F.desc("timestamp")).orderBy("timestamp")


def recent_fraud_rate(scored: DataFrame, as_of: datetime | str, minutes: int = 5) -> DataFrame:
    """Rows, frauds and fraud share of the last minutes; the share of nothing is NULL."""
    start = F.lit(str(as_of)).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    sums = scored.filter(F.col("scored_at") > start).agg(
        F.count(F.lit(1)).alias("rows_5m"), F.count_if(_fraud()).alias("fraud_5m")
    )
    return sums.withColumn("fraud_pct_5m", percent(F.col("fraud_5m"), F.col("rows_5m")))


def pipeline_health(scored: DataFrame, as_of: datetime | str) -> DataFrame:
    """Row count, id range, scoring time range and age of the newest row in seconds."""
    now = F.lit(str(as_of)).cast("timestamp")
    return scored.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.min("scored_at").alias("first_scored"),
        F.max("scored_at").alias("last_scored"),
    ).withColumn(
        "age_seconds",
        (F.unix_micros(now) - F.unix_micros("last_scored")) / F.lit(1_000_000),
    )


def since(scored: DataFrame, t: datetime | str) -> DataFrame:
    """Rows scored after ``t`` in scoring order."""
    return scored.filter(F.col("scored_at") > F.lit(str(t)).cast("timestamp")).orderBy(
        "scored_at", "id"
    )


def fraud_inbox(scored: DataFrame, n: int = 10, window: int | None = None) -> DataFrame:
    """Newest rows predicted as fraud; ``window`` looks at that many newest rows only."""
    rows = latest(scored, window) if window else scored
    return latest(rows.filter(_fraud()), n)
