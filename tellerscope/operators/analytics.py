"""Flows, breakdowns and series over gold and silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerscope.functions.columns import money_sum
from tellerscope.operators import ml

LARGE_AMOUNT = 350_000
FLOW = ("countryOrig", "countryDest", "type")


def large_amount(df: DataFrame, min_amount: float = LARGE_AMOUNT) -> DataFrame:
    return df.filter(F.col("amount") > min_amount)


def fraud_amount_by_country(
    gold: DataFrame, min_amount: float = LARGE_AMOUNT, n: int | None = 1000
) -> DataFrame:
    """Value of large frauds per route and type, highest first; ``n=None`` keeps all."""
    sums = (
        large_amount(gold, min_amount)
        .filter("is_fraud")
        .groupBy(*FLOW)
        .agg(money_sum("amount").alias("value"))
    )
    return top(sums, n, F.desc("value"), *FLOW) if n else sums


def country_flow(gold: DataFrame, min_amount: float = LARGE_AMOUNT, n: int = 20) -> DataFrame:
    """Number of large transactions per route and type, top ``n``."""
    counts = (
        large_amount(gold, min_amount).groupBy(*FLOW).agg(F.count("amount").alias("value"))
    )
    return top(counts, n, F.desc("value"), *FLOW)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Ordered head; always give key columns last, so that ties have one answer."""
    return df.orderBy(*order).limit(n)


def sankey_rollup(flow: DataFrame) -> DataFrame:
    return flow.groupBy("countryOrig", "countryDest").agg(F.sum("value").alias("value"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def sum_by(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.groupBy(key).agg(money_sum(col).alias(f"sum_{col}"))


def fraud_counts_by(gold: DataFrame, *keys: str) -> DataFrame:
    """Transactions per type and label, optionally per further key."""
    return counts_by(gold, "type", "is_fraud", *keys)


def type_bar(counts: DataFrame) -> DataFrame:
    return counts.groupBy("type").agg(F.sum("count").alias("count"))


def fraud_destinations(amounts: DataFrame) -> DataFrame:
    return amounts.select("countryDest").distinct()


def filter_values(df: DataFrame, col: str, predicate: Column) -> DataFrame:
    """Values a selector offers, each with the number of rows the other filters leave."""
    return df.groupBy(col).agg(F.count_if(predicate).alias("matching"))


def last_steps(df: DataFrame, hours: int = 720) -> DataFrame:
    """Rows of the last ``hours`` steps, both ends included.

    The newest step is a scalar subquery: one small aggregate, and the window reaches
    the rows as a plain filter instead of a join. No row lies beyond the newest step.
    """
    newest = df.agg(F.max("step")).scalar()
    return df.filter(F.col("step") >= newest - hours)


def fraud_over_time(gold: DataFrame, anchor_ts: datetime | str, hours: int = 720) -> DataFrame:
    """Hourly count and value of fraud; step 0 is ``anchor_ts`` (UTC).

    Gold is read once: it is reduced to one row per step, and the newest step is that of the
    small result, which one task may hold.
    """
    fraud = F.col("is_fraud")
    steps = gold.groupBy("step").agg(
        F.count_if(fraud).alias("nbFraudTransactions"),
        money_sum(F.when(fraud, F.col("amount"))).alias("sumFraudTransactions"),
    )
    newest = F.max("step").over(Window.partitionBy(F.lit(1)))
    hourly = steps.withColumn("newest", newest).filter(
        (F.col("step") >= F.col("newest") - hours) & (F.col("nbFraudTransactions") > 0)
    )
    anchor = F.lit(str(anchor_ts)).cast("timestamp_ntz")
    hour = F.make_dt_interval(hours=F.col("step").cast("int"))
    return hourly.select(
        (anchor + hour).alias("ts"), "nbFraudTransactions", "sumFraudTransactions"
    ).orderBy("ts")


def large_flows(gold: DataFrame, min_amount: float = LARGE_AMOUNT) -> DataFrame:
    """Rounded value of large transactions per route, type and label."""
    return (
        large_amount(gold, min_amount)
        .groupBy(*FLOW, "is_fraud")
        .agg(F.round(money_sum("amount"), 2).alias("value"))
        .orderBy("countryOrig", "countryDest", "type", "is_fraud")
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def max_id(df: DataFrame) -> DataFrame:
    """Highest id; NULL on an empty table."""
    return df.agg(F.max("id").alias("max_id"))


def distinct_codes(countries: DataFrame, pattern: str) -> DataFrame:
    return countries.select("alpha3_code").filter(F.col("alpha3_code").like(pattern)).distinct()


def customer_large(
    gold: DataFrame, email: str, min_amount: float = 300_000, n: int = 50
) -> DataFrame:
    """One customer's large transactions, in id order."""
    picked = large_amount(gold.filter(F.col("email") == email), min_amount)
    return top(picked, n, "id")


def customer_large_scored(
    gold: DataFrame, email: str, model: PipelineModel, min_amount: float = 300_000, n: int = 50
) -> DataFrame:
    """``customer_large`` with ``fraud_probability`` and ``fraud_prediction`` beside each row."""
    picked = customer_large(gold, email, min_amount, n)
    typed = {c: F.col(c).cast("float").alias(c) for c in ml.NUMERIC}
    answers = ml.predict(picked.select("id", *typed.values(), *ml.CATEGORICAL), model)
    answers = answers.select("id", "fraud_probability", "fraud_prediction")
    return picked.join(answers.dropDuplicates(["id"]), "id").orderBy("id")


def latest(df: DataFrame, n: int = 50, by: str = "scored_at", tie: str = "id") -> DataFrame:
    return top(df, n, F.desc(by), F.desc(tie))
