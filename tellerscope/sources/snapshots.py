"""Full versions of a dimension: publish, delete, read as of, restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscope.sources.tables import read_target

MANIFEST = "version int, operation string, rows long, published_at timestamp"


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version."""
    known = read_target(spark, f"{path}/manifest", MANIFEST)
    return spark.createDataFrame([], MANIFEST) if known is None else known


def latest_version(spark: SparkSession, path: str) -> int | None:
    return history(spark, path).agg(F.max("version")).first()[0]


def publish(df: DataFrame, path: str, operation: str = "publish") -> int:
    """Write ``df`` as the next version and return its number.

    The manifest row is written last; data without one is not a version and is
    replaced by the next attempt. One writer at a time.
    """
    spark = df.sparkSession
    last = latest_version(spark, path)
    version = 0 if last is None else last + 1
    target = f"{path}/data/version={version}"
    df.write.mode("overwrite").parquet(target)
    (
        spark.read.parquet(target)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.lit(version).alias("version"),
            F.lit(operation).alias("operation"),
            "rows",
            F.current_timestamp().alias("published_at"),
        )
        .write.mode("append")
        .parquet(f"{path}/manifest")
    )
    return version


def as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version, by default the newest. Only its own folder is listed and read."""
    version = latest_version(spark, path) if version is None else version
    if history(spark, path).filter(F.col("version") == version).isEmpty():
        raise ValueError(f"{path} has no version {version}")
    return spark.read.parquet(f"{path}/data/version={version}")


def delete_where(spark: SparkSession, path: str, condition: Column | str) -> int:
    """Publish the newest version without rows where ``condition`` is true."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    kept = as_of(spark, path).filter(~F.coalesce(condition, F.lit(False)))
    return publish(kept, path, "delete")


def restore(spark: SparkSession, path: str, version: int) -> int:
    """Publish an old version again as the newest."""
    return publish(as_of(spark, path, version), path, f"restore {version}")


def gold_impact(
    silver: DataFrame, customers: DataFrame, before: DataFrame, after: DataFrame
) -> DataFrame:
    """(change, rows): gold rows lost and gained between two versions of the countries.

    Only codes that one version lacks can move a row, so the joins run once, on the
    union of both versions, and silver shrinks to one row per customer on the way.
    """
    both = (
        before.withColumn("was", F.lit(True))
        .withColumn("is", F.lit(False))
        .unionByName(after.withColumn("was", F.lit(False)).withColumn("is", F.lit(True)))
        .groupBy("alpha3_code")
        .agg(F.count_if("was").alias("n_was"), F.count_if("is").alias("n_is"))
    )
    side = {
        s: both.select(
            F.col("alpha3_code").alias(f"country{s}"),
            F.col("n_was").alias(f"was{s}"),
            F.col("n_is").alias(f"is{s}"),
        )
        for s in ("Orig", "Dest")
    }
    per_customer = (
        silver.select("customer_id", "countryOrig", "countryDest")
        .join(side["Orig"], "countryOrig")
        .join(side["Dest"], "countryDest")
        .withColumn("more", F.expr("isOrig * isDest - wasOrig * wasDest"))
        .groupBy("customer_id")
        .agg(
            F.expr("sum(greatest(-more, 0))").alias("lost"),
            F.expr("sum(greatest(more, 0))").alias("gained"),
        )
    )
    rows = per_customer.join(
        customers.select(F.col("id").alias("customer_id")), "customer_id"
    )
    moved = rows.agg(
        F.expr("coalesce(sum(lost), 0)").alias("lost"),
        F.expr("coalesce(sum(gained), 0)").alias("gained"),
    )
    return moved.select(F.expr("stack(2, 'lost', lost, 'gained', gained) AS (change, rows)"))
