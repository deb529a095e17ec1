"""The risk baseline kept in parts that merge: counts and a quantile sketch per type and part.

A part is what one source file or load brought to gold. Only its rows are read when it comes;
reading the baseline merges the parts, which are a few rows each, and never scans gold. Ranks
are right within about 1.5 / K of the rows of a type, whatever the number of parts; up to K
rows of a type they are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscope.operators.risk import QUANTILES, fraud_rate, stats_columns

K = 4096
PART = "part"
_SCHEMA = f"type string, rows long, frauds long, amounts binary, {PART} string"


def add_parts(gold: DataFrame, path: str, part: Column | str) -> None:
    """Store the baseline of ``gold`` rows by ``part``: a name, or a column that holds it.

    A part that is stored already is replaced, so a load that is repeated changes nothing.
    Other parts stay.
    """
    name = F.lit(part) if isinstance(part, str) else part
    rows = gold.select(name.alias(PART), "type", "is_fraud", F.col("amount").cast("double").alias("amount"))
    parts = rows.groupBy(PART, "type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_fraud").alias("frauds"),
        F.expr(f"kll_sketch_agg_double(amount, {K})").alias("amounts"),
    )
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PART).parquet(path)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The baseline over all parts, in the columns of ``risk.type_stats``."""
    ranks = ", ".join(f"{q}D" for _, q in QUANTILES)
    kept = spark.read.schema(_SCHEMA).parquet(path).groupBy("type").agg(
        F.sum("rows").alias("rows"),
        F.sum("frauds").alias("frauds"),
        F.expr(f"kll_merge_agg_double(amounts, {K})").alias("amounts"),
    )
    quantiles = F.expr(
        "CASE WHEN kll_sketch_get_n_double(amounts) > 0"
        f" THEN kll_sketch_get_quantile_double(amounts, array({ranks})) END"
    )
    rated = kept.select("type", fraud_rate(F.col("frauds"), F.col("rows")).alias("fraud_rate_type"), quantiles.alias("q"))
    return rated.select("type", "fraud_rate_type", *stats_columns("q"))
