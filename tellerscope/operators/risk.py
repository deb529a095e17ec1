"""Explainable rule score, 0 to 100, for every transaction in one pass."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tellerscope.functions.quantiles import exact_percentiles
from tellerscope.functions.sizing import pin_small, written
from tellerscope.operators.cdc import current_state

# --- fixed values -----------------------------------------------------------
TYPE_PRIOR_RATE = Decimal("0.10")
DRAIN_SHARE = 0.90
LEFT_SHARE = 0.10
DEFAULT_P50 = 1000
POINTS_TYPE_PRIOR = 30
POINTS_DRAINS_ORIGIN = 30
POINTS_EMPTY_DEST = 20
POINTS_P99 = 20
POINTS_P95 = 10
MAX_SCORE = 100
MAX_SIGNALS = 3
TEXT_TYPE_PRIOR = "Transaction type %s has an elevated fraud rate (%s%%)."
TEXT_DRAINS_ORIGIN = "This transaction drains most of the origin account balance."
TEXT_EMPTY_DEST = "Funds were sent to a destination account with no prior balance."
TEXT_P99 = "Amount is extreme for this type (>= p99 ≈ %s)."
TEXT_P95 = "Amount is unusually large for this type (>= p95 ≈ %s)."
TEXT_NONE = "No strong red flags from basic rules."
TEXT_NOT_FOUND = "Transaction id not found."
TEXT_NOT_FOUND_LIVE = "Transaction id not found in live_transactions."
TEXT_SCORE = "Risk score %s/100. Key factors: %s"
TEXT_SCORE_LIVE = "Risk score %s/100 (live). Key factors: %s"
LIVE_SOURCE = "live_transactions"
# ----------------------------------------------------------------------------

BALANCES = ("oldBalanceOrig", "newBalanceOrig", "oldBalanceDest", "newBalanceDest")
COLLAPSED = ("customer_id", "type", "amount", *BALANCES)
QUANTILES = (("p50", 0.50), ("p90", 0.90), ("p95", 0.95), ("p99", 0.99))
LIVE_NAMES = {
    "old_balance_orig": "oldBalanceOrig",
    "new_balance_orig": "newBalanceOrig",
    "old_balance_dest": "oldBalanceDest",
    "new_balance_dest": "newBalanceDest",
}


def fraud_rate(frauds: Column, rows: Column) -> Column:
    """Fraud rate with five decimals, so 0.099996 counts as 0.10.

    A ratio of two counts: they merge map-side and cannot overflow as a decimal average would.
    """
    return (frauds.cast("decimal(20,0)") / rows.cast("decimal(20,0)")).cast("decimal(6,5)")


def stats_columns(quantiles: str) -> list[Column]:
    names = [f"{n}_amount_type" for n, _ in QUANTILES]
    return [F.get(quantiles, F.lit(i)).alias(name) for i, name in enumerate(names)]


def type_stats(gold: DataFrame, accuracy: int = 10_000, exact: bool = False) -> DataFrame:
    """Fraud rate and amount percentiles per type; ``exact`` gives exact ranks in more passes."""
    rate = fraud_rate(F.count_if("is_fraud"), F.count(F.lit(1))).alias("fraud_rate_type")
    if not exact:
        amounts = F.percentile_approx("amount", [q for _, q in QUANTILES], accuracy).alias("q")
        return gold.groupBy("type").agg(rate, amounts).select("type", "fraud_rate_type", *stats_columns("q"))
    rows = gold.select("type", "is_fraud", "amount").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rates = written(rows.groupBy("type").agg(rate), "fraud-rates")
        found = exact_percentiles(rows, ["type"], ["amount"], [q for _, q in QUANTILES])
        found = written(found.select(F.col("type").alias("t"), "values"), "percentiles")
    finally:
        rows.unpersist()
    joined = rates.join(found, F.col("type").eqNullSafe(F.col("t")), "left")
    return joined.select("type", "fraud_rate_type", *stats_columns("values"))


def baseline(gold: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """``type_stats`` computed once and pinned, so scoring does not shuffle by type."""
    return pin_small(type_stats(gold, accuracy))


def with_baseline(txns: DataFrame, stats: DataFrame) -> DataFrame:
    return txns.join(stats, "type", "left")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def risk_features(txns: DataFrame, stats: DataFrame, single: bool = False) -> DataFrame:
    """One row per id with the baseline of its type and five 0/1 flags.

    Rows sharing an id collapse to the maximum of each column before the shuffle.
    ``single`` collapses the whole (already filtered) input, giving a row even if empty.
    """
    groups = txns.groupBy() if single else txns.groupBy("id")
    one = groups.agg(
        F.count(F.lit(1)).alias("found_count"), *[F.max(c).alias(c) for c in COLLAPSED]
    )
    amount, old_orig, old_dest = F.col("amount"), F.col("oldBalanceOrig"), F.col("oldBalanceDest")
    rate = F.coalesce("fraud_rate_type", F.lit(Decimal("0.0")))
    return with_baseline(one, stats).withColumns(
        {
            "flag_type_prior": _flag(rate >= F.lit(TYPE_PRIOR_RATE)),
            "flag_large_p95": _flag(amount >= F.col("p95_amount_type")),
            "flag_large_p99": _flag(amount >= F.col("p99_amount_type")),
            "flag_drains_origin": _flag(
                (old_orig > 0)
                & (amount >= DRAIN_SHARE * old_orig)
                & (F.col("newBalanceOrig") <= LEFT_SHARE * old_orig)
            ),
            "flag_empty_dest": _flag(
                (old_dest == 0)
                & (amount >= F.coalesce("p50_amount_type", F.lit(float(DEFAULT_P50))))
            ),
        }
    )


def _score() -> Column:
    points = (
        F.col("flag_type_prior") * POINTS_TYPE_PRIOR
        + F.col("flag_drains_origin") * POINTS_DRAINS_ORIGIN
        + F.col("flag_empty_dest") * POINTS_EMPTY_DEST
        + F.when(F.col("flag_large_p99") == 1, POINTS_P99)
        .when(F.col("flag_large_p95") == 1, POINTS_P95)
        .otherwise(0)
    )
    return (
        F.when(F.col("found_count") == 0, 0)
        .otherwise(F.least(F.lit(MAX_SCORE), points))
        .cast("int")
    )


def _signals(live: bool) -> Column:
    raised = {name: F.col(f"flag_{name}") == 1 for name in (
        "type_prior", "drains_origin", "empty_dest", "large_p99", "large_p95")}
    percent = F.round(F.col("fraud_rate_type") * 100, 1).cast("string")
    # In order of importance; the first three are reported.
    texts = [
        F.when(raised["type_prior"], F.format_string(TEXT_TYPE_PRIOR, "type", percent)),
        F.when(raised["drains_origin"], F.lit(TEXT_DRAINS_ORIGIN)),
        F.when(raised["empty_dest"], F.lit(TEXT_EMPTY_DEST)),
        F.when(
            raised["large_p99"],
            F.format_string(TEXT_P99, F.round("p99_amount_type", 2).cast("string")),
        ).when(
            raised["large_p95"],
            F.format_string(TEXT_P95, F.round("p95_amount_type", 2).cast("string")),
        ),
    ]
    shown = F.slice(F.array_compact(F.array(*texts)), 1, MAX_SIGNALS)
    missing = TEXT_NOT_FOUND_LIVE if live else TEXT_NOT_FOUND
    return (
        F.when(F.col("found_count") == 0, F.array(F.lit(missing)))
        .when(F.size(shown) > 0, shown)
        .otherwise(F.array(F.lit(TEXT_NONE)))
    )


def _feature_map(live: bool) -> Column:
    rate = F.round(F.coalesce("fraud_rate_type", F.lit(Decimal("0.0"))), 4)
    values = {
        "found_count": F.col("found_count"),
        **{c: F.col(c) for c in ("type", "amount", *BALANCES)},
        "fraud_rate_type": rate,
        **{c: F.col(c) for c in (f"{n}_amount_type" for n, _ in QUANTILES)},
        **{
            f"flag_{n}": F.col(f"flag_{n}")
            for n in ("type_prior", "drains_origin", "empty_dest", "large_p95", "large_p99")
        },
    }
    if live:
        values["source"] = F.lit(LIVE_SOURCE)
    return F.create_map(
        *[part for name, v in values.items() for part in (F.lit(name), v.cast("string"))]
    )


def add_risk(features: DataFrame, live: bool = False) -> DataFrame:
    """Add ``risk_score``, ``top_signals``, ``explanation`` and ``features``."""
    text = TEXT_SCORE_LIVE if live else TEXT_SCORE
    return (
        features.withColumn("risk_score", _score())
        .withColumn("top_signals", _signals(live))
        .withColumn(
            "explanation",
            F.format_string(text, F.col("risk_score"), F.concat_ws(" ", "top_signals")),
        )
        .withColumn("features", _feature_map(live))
    )


RESULT = ("risk_score", "top_signals", "explanation", "features")


def risk_scores(txns: DataFrame, stats: DataFrame, live: bool = False) -> DataFrame:
    """(id, score, signals, explanation, features) of every transaction."""
    return add_risk(risk_features(txns, stats), live).select("id", *RESULT)


def live_transactions(
    log: DataFrame, key: str = "id", seq: str = "_lsn", change: str = "_change_type"
) -> DataFrame:
    """Current state of the change log under the column names the rules use."""
    rows = current_state(log, key, seq, change).withColumnsRenamed({**LIVE_NAMES, key: "id"})
    for name in COLLAPSED:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows.select("id", *COLLAPSED)


def _as_key(df: DataFrame, key: str, tx_id: str) -> Column:
    """The asked id in the type of the column, so the filter reaches the scan."""
    return F.lit(str(tx_id)).try_cast(df.schema[key].dataType)


def explain(gold: DataFrame, tx_id: str, stats: DataFrame | None = None) -> DataFrame:
    """Exactly one row for one id. Pass a stored baseline to avoid scanning gold for it."""
    stats = type_stats(gold) if stats is None else stats
    found = gold.filter(F.col("id") == _as_key(gold, "id", tx_id))
    return add_risk(risk_features(found, stats, single=True)).select(*RESULT)


def explain_live(
    log: DataFrame,
    gold: DataFrame,
    tx_id: str,
    stats: DataFrame | None = None,
    key: str = "id",
    seq: str = "_lsn",
    change: str = "_change_type",
) -> DataFrame:
    """As ``explain`` for the current state of one live id; the baseline stays gold's."""
    stats = type_stats(gold) if stats is None else stats
    one = log.filter(F.col(key) == _as_key(log, key, tx_id))
    found = live_transactions(one, key, seq, change)
    return add_risk(risk_features(found, stats, single=True), live=True).select(*RESULT)


def _register(spark: SparkSession, name: str, scores: DataFrame, nothing: DataFrame) -> None:
    scores.createOrReplaceTempView(f"{name}_scores")
    nothing.createOrReplaceTempView(f"{name}_missing")
    id_type = dict(scores.dtypes)["id"]
    columns = ", ".join(f"coalesce(s.{c}, m.{c}) AS {c}" for c in RESULT)
    # The one-row "not found" answer is kept unless the id has a score.
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(tx_id STRING)
        RETURNS TABLE (risk_score INT, top_signals ARRAY<STRING>,
                       explanation STRING, features MAP<STRING, STRING>)
        RETURN SELECT {columns}
               FROM {name}_missing m LEFT JOIN {name}_scores s
               ON s.id = try_cast(tx_id AS {id_type})
    """)


def register_functions(
    spark: SparkSession, gold: DataFrame, log: DataFrame | None = None, stats: DataFrame | None = None
) -> None:
    """SQL table functions ``explain_transaction_risk(id)`` and, with a change log,
    ``explain_live_transaction_risk(id)``. The id filter reaches the scan of the view.

    ``stats`` is pinned if left out. With that of ``baseline_store.merged`` each call reads the
    stored parts; after new files, ``refresh_functions`` makes them seen."""
    stats = baseline(gold) if stats is None else stats
    empty = gold.limit(0)
    _register(
        spark,
        "explain_transaction_risk",
        risk_scores(gold, stats),
        add_risk(risk_features(empty, stats, single=True)).select(*RESULT),
    )
    if log is not None:
        _register(
            spark,
            "explain_live_transaction_risk",
            risk_scores(live_transactions(log), stats, live=True),
            add_risk(risk_features(empty, stats, single=True), live=True).select(*RESULT),
        )


def refresh_functions(spark: SparkSession) -> None:
    """Let the registered functions see files that came to gold, the log or a stored baseline.

    Only the lists of files are made anew; no row is read.
    """
    for name in ("explain_transaction_risk", "explain_live_transaction_risk"):
        for view in (f"{name}_scores", f"{name}_missing"):
            if spark.catalog.tableExists(view):
                spark.catalog.refreshTable(view)
