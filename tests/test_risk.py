"""Rule score: flags one by one, exact texts, unknown ids, SQL functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tellerscope.operators import risk

STATS = (
    "type string, fraud_rate_type decimal(6,5), p50_amount_type double, p90_amount_type double, "
    "p95_amount_type double, p99_amount_type double"
)
TXN = (
    "id string, customer_id string, type string, amount double, oldBalanceOrig double, "
    "newBalanceOrig double, oldBalanceDest double, newBalanceDest double"
)


@pytest.fixture
def stats(spark):
    return spark.createDataFrame(
        [("TRANSFER", Decimal("0.33333"), 100.0, 200.0, 300.0, 400.0),
         ("DEBIT", Decimal("0.09999"), 100.0, 200.0, 300.0, 400.5)],
        STATS,
    )


def score(spark, stats, *row):
    txns = spark.createDataFrame([("1", "7", *row)], TXN)
    return risk.risk_scores(txns, stats).first()


QUIET = (1000.0, 999.0, 5.0, 6.0)


@pytest.mark.parametrize(
    "row, points, texts",
    [
        (("DEBIT", 1.0, *QUIET), 0, ["No strong red flags from basic rules."]),
        (("TRANSFER", 1.0, *QUIET), 30,
         ["Transaction type TRANSFER has an elevated fraud rate (33.3%)."]),
        (("DEBIT", 90.0, 100.0, 10.0, 5.0, 5.0), 30,
         ["This transaction drains most of the origin account balance."]),
        (("DEBIT", 90.0, 100.0, 10.01, 5.0, 5.0), 0, ["No strong red flags from basic rules."]),
        (("DEBIT", 100.0, 1e6, 9e5, 0.0, 0.0), 20,
         ["Funds were sent to a destination account with no prior balance."]),
        (("DEBIT", 99.0, 1e6, 9e5, 0.0, 0.0), 0, ["No strong red flags from basic rules."]),
        (("DEBIT", 300.0, 1e6, 9e5, 5.0, 5.0), 10,
         ["Amount is unusually large for this type (>= p95 ≈ 300.0)."]),
        (("DEBIT", 400.5, 1e6, 9e5, 5.0, 5.0), 20,
         ["Amount is extreme for this type (>= p99 ≈ 400.5)."]),
        (("TRANSFER", 500.0, 500.0, 0.0, 0.0, 5.0), 100, None),
        (("TRANSFER", None, None, None, None, None), 30, None),
        (("UNSEEN", 5000.0, 1e6, 9e5, 0.0, 0.0), 20, None),
        (("UNSEEN", 999.0, 1e6, 9e5, 0.0, 0.0), 0, None),
        ((None, 1.0, *QUIET), 0, None),
    ],
)
def test_each_rule(spark, stats, row, points, texts):
    got = score(spark, stats, *row)
    assert got.risk_score == points
    if texts:
        assert got.top_signals == texts
        assert got.explanation == f"Risk score {points}/100. Key factors: {' '.join(texts)}"


def test_three_signals_at_most_in_order(spark, stats):
    got = score(spark, stats, "TRANSFER", 500.0, 500.0, 0.0, 0.0, 5.0)
    assert got.top_signals == [
        "Transaction type TRANSFER has an elevated fraud rate (33.3%).",
        "This transaction drains most of the origin account balance.",
        "Funds were sent to a destination account with no prior balance.",
    ]


def test_feature_map(spark, stats):
    got = score(spark, stats, "TRANSFER", 500.0, 500.0, 0.0, 0.0, 5.0).features
    assert len(got) == 17
    assert got["fraud_rate_type"] == "0.3333" and got["amount"] == "500.0"
    assert got["found_count"] == "1" and got["flag_large_p99"] == "1"
    assert score(spark, stats, None, 1.0, *QUIET).features["fraud_rate_type"] == "0.0000"


def test_rows_of_one_id_collapse(spark, stats):
    rows = [("1", "7", "DEBIT", 1.0, *QUIET), ("1", "8", "TRANSFER", 9.0, *QUIET)]
    got = risk.risk_scores(spark.createDataFrame(rows, TXN), stats).collect()
    assert len(got) == 1 and got[0].features["found_count"] == "2"
    assert got[0].features["type"] == "TRANSFER" and got[0].features["amount"] == "9.0"


def test_rate_is_rounded_to_five_decimals(spark):
    gold = spark.range(250_000).select(
        F.lit("T").alias("type"), F.lit(1.0).alias("amount"), (F.col("id") < 24_999).alias("is_fraud")
    )
    rate = risk.type_stats(gold).first().fraud_rate_type
    assert rate == Decimal("0.10000")  # 0.099996


def test_scores_are_in_range(bank):
    scores = risk.risk_scores(bank.gold, risk.baseline(bank.gold))
    low, high, n, ids = scores.agg(
        F.min("risk_score"), F.max("risk_score"), F.count("*"), F.countDistinct("id")
    ).first()
    assert 0 <= low <= high <= 100 and n == ids


def test_explain_one_row_always(bank):
    stats = risk.baseline(bank.gold)
    found = bank.gold.select("id").first().id
    one = risk.explain(bank.gold, found, stats).collect()
    many = risk.risk_scores(bank.gold, stats).filter(F.col("id") == found).collect()
    assert len(one) == 1 and one[0].explanation == many[0].explanation
    none = risk.explain(bank.gold, "nope").collect()
    assert len(none) == 1 and none[0].risk_score == 0
    assert none[0].explanation == "Risk score 0/100. Key factors: Transaction id not found."
    live = risk.explain_live(bank.history, bank.gold, "not a number", stats).first()
    assert live.explanation == (
        "Risk score 0/100 (live). Key factors: Transaction id not found in live_transactions."
    )
    assert live.features["source"] == "live_transactions" and len(live.features) == 18


def test_sql_functions(spark, bank):
    risk.register_functions(spark, bank.gold, bank.history)
    gold_id = bank.gold.select("id").first().id
    for name, key in (("explain_transaction_risk", gold_id), ("explain_live_transaction_risk", "15")):
        rows = spark.sql(f"SELECT * FROM {name}('{key}')").collect()
        assert len(rows) == 1 and rows[0].features["found_count"] == "1"
    for name, key in (("explain_transaction_risk", "zz"), ("explain_live_transaction_risk", "11"),
                      ("explain_live_transaction_risk", "zz")):
        rows = spark.sql(f"SELECT * FROM {name}('{key}')").collect()
        assert len(rows) == 1 and rows[0].features["found_count"] == "0"


def test_live_log_with_other_column_names(spark, bank, stats):
    renamed = bank.history.withColumnsRenamed(
        {"_lsn": "_pg_lsn", "_change_type": "_pg_change_type"}
    )
    got = risk.explain_live(
        renamed, bank.gold, "15", stats, seq="_pg_lsn", change="_pg_change_type"
    ).first()
    assert got.features["found_count"] == "1"
