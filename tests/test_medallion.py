"""Bronze, silver and gold semantics on small literal frames."""

import pytest
from pyspark.sql import functions as F

from tellerscope.functions import sizing
from tellerscope.operators import medallion
from tellerscope.operators.medallion import Rule
from tellerscope.plans import pipeline
from tellerscope.schemas import BRONZE
from tellerscope.sources import tables

BASE = dict(
    id="1", step="3", type="TRANSFER", amount="10.5", customer_id="7", nameOrig="C7",
    nameDest="D1", countryOrig="--GBR", countryDest="FRA--", oldBalanceOrig="100",
    newBalanceOrig="89.5", oldBalanceDest="0", newBalanceDest="10.5",
)


def bronze(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], BRONZE)


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, is_fraud int")


@pytest.fixture
def dims(spark):
    countries = spark.createDataFrame(
        [("United Kingdom", "GB", "GBR", 826, 54.0, -2.0), ("France", "FR", "FRA", 250, 46.0, None)],
        "country string, alpha2_code string, alpha3_code string, numeric_code int, "
        "lat_avg double, long_avg double",
    )
    customers = spark.createDataFrame(
        [("7", "Ann", "Lee", "a@example.org", "USA")],
        "id string, firstname string, lastname string, email string, country string",
    )
    return countries, customers


def test_silver_cleans_casts_and_labels(spark):
    rows = bronze(spark, {}, {"id": "2", "countryOrig": "--", "newBalanceOrig": "n/a"}, {"id": None})
    out = {r.id: r for r in medallion.silver(rows, reports(spark, ("1", 1), ("9", 0))).collect()}
    assert (out["1"].countryOrig, out["1"].countryDest) == ("GBR", "FRA")
    assert (out["1"].diffOrig, out["1"].diffDest, out["1"].is_fraud) == (-10.5, 10.5, 1)
    assert out["2"].countryOrig == "" and out["2"].is_fraud is None
    assert out["2"].newBalanceOrig is None and out["2"].diffOrig is None
    assert out[None].is_fraud is None and len(out) == 3


def test_duplicate_reports_fan_out(spark):
    out = medallion.silver(bronze(spark, {}), reports(spark, ("1", 1), ("1", 0), ("1", 1)))
    assert sorted(r.is_fraud for r in out.collect()) == [0, 1, 1]


def test_landing_columns_stop_at_bronze(spark):
    rows = bronze(spark, {}).withColumn("_rescued_data", F.lit("x")).withColumn(
        "source_file", F.lit("f.csv")
    )
    columns = medallion.silver(rows, reports(spark, ("1", 1))).columns
    assert "_rescued_data" not in columns and "source_file" in columns


def test_gold_drops_unknown_codes_and_customers(spark, dims):
    rows = bronze(
        spark, {}, {"id": "2", "countryDest": "XXX"}, {"id": "3", "customer_id": "8"},
        {"id": "4", "amount": "bad"},
    )
    silver = medallion.silver(rows, reports(spark, ("1", 1)))
    gold = medallion.gold(silver, *dims)
    out = {r.id: r for r in gold.collect()}
    assert set(out) == {"1", "4"}
    assert out["1"].is_fraud is True and out["4"].is_fraud is False
    assert out["1"].amount == 10.5 and out["4"].amount is None
    assert out["1"].countryDest_name == "France" and out["1"].countryLongDest_long is None
    # The filter is on the customer's own country, not on the route.
    assert medallion.gold_by_country(gold, "USA").count() == 2
    assert medallion.gold_by_country(gold, "GBR").count() == 0
    lost = {r.reason: r.rows for r in medallion.gold_unmatched(silver, *dims).collect()}
    assert lost == {
        "unknown origin country": 0, "unknown destination country": 1, "unknown customer": 1,
    }


def test_expectations(spark):
    rows = bronze(
        spark, {}, {"amount": "0"}, {"amount": "-1"}, {"amount": None}, {"amount": "x"},
        {"id": None}, {"customer_id": None},
    )
    clean, metrics = medallion.apply_expectations(rows)
    assert clean.count() == 3  # NULL ids and customers are only counted
    assert {(r.rule, r.on_violation, r.violations, r.total_rows) for r in metrics.collect()} == {
        ("correct_data", "keep", 1, 7),
        ("correct_customer_id", "keep", 1, 7),
        ("correct_amount", "drop", 4, 7),
    }
    own = [Rule("small", "step < 2", drop=True)]
    assert medallion.keep_valid(rows, own).count() == 0


def test_observed_expectations(spark):
    from pyspark.sql import Observation

    seen = Observation("rules")
    rows = bronze(spark, {}, {"amount": "0"})
    first, *others = medallion._counts(medallion.TXN_RULES)
    assert medallion.keep_valid(rows.observe(seen, first, *others)).count() == 1
    assert seen.get == {
        "total_rows": 2, "correct_data": 0, "correct_customer_id": 0, "correct_amount": 1,
    }


def test_merge_inserts_only(spark, folder):
    target = f"{folder}/silver"
    first = medallion.silver(bronze(spark, {}, {"id": None}), reports(spark))
    tables.merge_insert_only(first, target)
    late = reports(spark, ("1", 1), ("2", 1))
    again = medallion.silver(bronze(spark, {}, {"id": None}, {"id": "2"}, {"id": "2"}), late)
    tables.merge_insert_only(again, target)
    rows = [(r.id, r.is_fraud) for r in spark.read.parquet(target).collect()]
    # The late label stays out, the NULL id comes again, both new copies are in.
    assert sorted(rows, key=repr) == sorted(
        [("1", None), (None, None), (None, None), ("2", 1), ("2", 1)], key=repr
    )
    fixed = tables.relabel(spark.read.parquet(target), late)
    assert {(r.id, r.is_fraud) for r in fixed.collect()} == {("1", 1), ("2", 1), (None, None)}


def test_pipeline_reruns(spark, folder, dims):
    landing = f"{folder}/landing"
    bronze(spark, {}, {"id": "2"}).write.option("header", True).csv(landing)
    labels = reports(spark, ("2", 1))
    for _ in range(2):
        pipeline.load_bronze(spark, landing, folder)
        pipeline.load_silver(spark.read.parquet(f"{folder}/bronze"), labels, folder)
    silver = spark.read.parquet(f"{folder}/silver")
    assert silver.count() == 2
    pipeline.register_views(
        spark, spark.read.parquet(f"{folder}/bronze"), labels, *dims, silver_rows=silver
    )
    got = spark.sql("SELECT is_fraud, count(*) AS n FROM gold_transactions GROUP BY is_fraud")
    assert {(r.is_fraud, r.n) for r in got.collect()} == {(True, 1), (False, 1)}


def test_gold_is_part_of_silver(bank):
    assert bank.gold.select("id").join(bank.silver, "id", "left_anti").isEmpty()


def test_unreadable_balances_are_counted(spark):
    rows = spark.createDataFrame(
        [("1", "5", "c", "1.5", "abc", None, "2"), ("2", "5", "c", "1", "2", "3", "4")],
        "id string, amount string, customer_id string, newBalanceOrig string, oldBalanceOrig string, "
        "newBalanceDest string, oldBalanceDest string",
    )
    clean, metrics = medallion.apply_expectations(rows, medallion.BALANCE_RULES)
    counts = {r.rule: r.violations for r in metrics.collect()}
    assert clean.count() == 2 and counts["readable_balances"] == 1 and counts["correct_amount"] == 0


def test_small_sides_are_broadcast_by_their_size_alone(spark, bank):
    """Without statistics a checked country table is broadcast; one over the limit is not."""
    rows = spark.range(50).selectExpr("id", "repeat('x', 100) AS text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = medallion.gold(bank.silver, bank.countries, bank.customers)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2
        for limits, hinted in (({}, True), ({"max_rows": 49}, False), ({"max_bytes": 4000}, False)):
            for fn in (sizing.broadcast_if_small, sizing.pin_small):
                side = fn(rows, **limits)
                joined = spark.range(9).join(side, "id")._jdf.queryExecution().executedPlan().toString()
                assert ("BroadcastHashJoin" in joined) == hinted and side.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
