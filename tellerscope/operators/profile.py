"""Distribution profile of gold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tellerscope.functions.quantiles import exact_percentiles
from tellerscope.functions.sizing import pin_small, written

NUMERIC_FEATURES = ("amount", "newBalanceDest", "oldBalanceDest", "diffOrig", "diffDest")
PERCENTILES = (("p10", 0.10), ("p25", 0.25), ("p50", 0.50), ("p75", 0.75), ("p90", 0.90))


def numeric_profile(
    gold: DataFrame,
    features: Sequence[str] = NUMERIC_FEATURES,
    accuracy: int = 10_000,
    exact: bool = False,
) -> DataFrame:
    """Count and distribution of each feature per (type, is_fraud). A statistic without values is 0.

    All percentiles of a feature come from one sketch, merged map-side first, in one pass. With
    ``exact`` they are the values at the exact ranks; the features are then read again, which
    they are from memory or disk.
    """
    keys = ("type", "is_fraud")
    rows = gold.select("type", F.col("is_fraud").cast("int").alias("is_fraud"), *features)
    aggs = [F.count(F.lit(1)).alias("count")]
    for f in features:
        v = F.col(f).cast("double")
        aggs += [
            F.avg(v).alias(f"{f}_mean"),
            F.stddev(v).alias(f"{f}_stddev"),
            F.min(v).alias(f"{f}_min"),
            F.max(v).alias(f"{f}_max"),
        ]
        if not exact:
            quantiles = F.percentile_approx(v, [p for _, p in PERCENTILES], accuracy)
            aggs.append(quantiles.alias(f"{f}_q"))
    if exact:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stats = _with_exact(written(rows.groupBy(*keys).agg(*aggs), "profile"), rows, features)
        finally:
            rows.unpersist()
    else:
        stats = rows.groupBy(*keys).agg(*aggs)
    zero = F.lit(0.0)
    out = []
    for f in features:
        out += [
            F.coalesce(f"{f}_{s}", zero).alias(f"{f}_{s}") for s in ("mean", "stddev", "min", "max")
        ]
        out += [
            F.coalesce(F.get(f"{f}_q", F.lit(i)), zero).alias(f"{f}_{name}")
            for i, (name, _) in enumerate(PERCENTILES)
        ]
    return stats.select("type", "is_fraud", "count", *out).orderBy("type", "is_fraud")


def _with_exact(stats: DataFrame, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``stats`` with the exact percentiles of each feature as ``<feature>_q``."""
    found = exact_percentiles(rows, ["type", "is_fraud"], features, [p for _, p in PERCENTILES])
    pairs = F.map_from_entries(F.collect_list(F.struct("feature", "values")))  # one per feature
    wide = found.groupBy("type", "is_fraud").agg(pairs.alias("q"))
    wide = written(wide, "percentiles").withColumnsRenamed({"type": "t", "is_fraud": "f"})
    same = F.col("type").eqNullSafe(F.col("t")) & F.col("is_fraud").eqNullSafe(F.col("f"))
    return stats.join(wide, same, "left").select(
        *stats.columns, *[F.col("q")[f].alias(f"{f}_q") for f in features]
    )


def _share(part, whole, digits: int):
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows and frauds per key, from gold or from counts of a finer grouping."""
    if "fraud_count" in rows.columns:
        count, frauds = F.sum("count"), F.sum("fraud_count")
    else:
        count, frauds = F.count(F.lit(1)), F.count_if("is_fraud")
    zero = F.lit(0).cast("bigint")
    return rows.groupBy(*keys).agg(
        F.coalesce(count, zero).alias("count"), F.coalesce(frauds, zero).alias("fraud_count")
    )


def type_frequencies(gold: DataFrame) -> DataFrame:
    """Rows, frauds and share of all rows per type, most frequent first.

    The counts are made once and pinned while they are few; the total is theirs.
    """
    counts = pin_small(_counted(gold, "type"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("weight", _share(F.col("count"), total, 6)).orderBy(
        F.desc("count"), "type"
    )


def country_pairs(gold: DataFrame, n: int = 80) -> DataFrame:
    """Most frequent country pairs; weights are shares of these ``n`` pairs' total."""
    keys = ("countryOrig_name", "countryDest_name")
    pairs = _counted(gold, *keys).orderBy(F.desc("count"), *keys).limit(n)
    # At most n rows are left, so one task may hold them all.
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return pairs.withColumns(
        {
            "weight": _share(F.col("count"), total, 6),
            "fraud_rate": _share(F.col("fraud_count"), F.col("count"), 4),
        }
    ).orderBy(F.desc("count"), *keys)


def overall_stats(gold: DataFrame) -> DataFrame:
    return _counted(gold).select(
        F.col("count").alias("total_transactions"),
        F.col("fraud_count").alias("total_fraud"),
        _share(F.col("fraud_count"), F.col("count"), 6).alias("fraud_rate"),
    )


def customer_lookup(customers: DataFrame) -> DataFrame:
    """Compact customer table; a missing country is an empty text."""
    return customers.select(
        "id", "firstname", "lastname", F.coalesce("country", F.lit("")).alias("country")
    )


def write_profile(
    gold: DataFrame, path: str, profiled_at: datetime | None = None, exact: bool = False
) -> None:
    """Write each section, and the time it was made, as JSON below ``path``.

    Two passes over gold: one for the numeric features, one for counts per type and
    country pair, from which the other sections are summed up.
    """
    counts = _counted(gold, "type", "countryOrig_name", "countryDest_name").persist()
    sections = {
        "numeric_profiles": numeric_profile(gold, exact=exact),
        "overall": overall_stats(counts),
        "type_frequencies": type_frequencies(counts),
        "country_pairs": country_pairs(counts),
    }
    try:
        for name, section in sections.items():
            section.write.mode("overwrite").json(f"{path}/{name}")
    finally:
        counts.unpersist()
    at = F.lit(profiled_at) if profiled_at else F.current_timestamp()
    gold.sparkSession.range(1).select(at.alias("profiled_at")).write.mode("overwrite").json(
        f"{path}/metadata"
    )
