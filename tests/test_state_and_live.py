"""Change log, key figures, analytics and profile on small literal frames."""

import math

from pyspark.sql import functions as F

from tellerscope.operators import analytics, cdc, live, profile

LOG = "id int, v string, _change_type string, _lsn long"
SCORED = (
    "id long, timestamp timestamp, type string, amount double, country_orig string, "
    "country_dest string, fraud_prediction boolean, scored_at timestamp"
)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def scored(spark, *rows):
    out = []
    for i, (at, amount, route, fraud) in enumerate(rows):
        out.append((i, at, "T", amount, route[0], route[1], fraud, at))
    text = SCORED.replace(" timestamp,", " string,").replace("scored_at timestamp", "scored_at string")
    df = spark.createDataFrame(out, text)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("timestamp", "scored_at")})


def test_current_state(spark):
    rows = log(
        spark,
        (1, "a", "insert", 1), (1, "old", "update_preimage", 2), (1, "b", "update_postimage", 3),
        (2, "a", "insert", 4), (2, "a", "delete", 5), (2, "again", "insert", 6),
        (3, "a", "delete", 7),
        (4, "a", "insert", 8), (4, "pre", "update_preimage", 9),
    )
    got = {(r.id, r.v) for r in cdc.current_state(rows).collect()}
    assert got == {(1, "b"), (2, "again"), (4, "a")}
    assert cdc.newest_key(rows).first().id == 4
    assert cdc.cdc_row_counts(rows).first().asDict() == {"history_rows": 9, "live_rows": 3}
    assert cdc.newest_key(rows.limit(0)).isEmpty()
    assert cdc.cdc_row_counts(rows.limit(0)).first().asDict() == {"history_rows": 0, "live_rows": 0}


def test_current_state_has_unique_ids(bank):
    state = cdc.current_state(bank.history)
    assert state.count() == state.select("id").distinct().count()


def test_buckets_hold_their_lower_edge(spark):
    day = "2024-01-01 00:00:"
    rows = scored(
        spark, (day + "09.4", 1.0, "AB", True), (day + "09.6", 1.0, "AB", False),
        (day + "10", 1.0, "AB", False), (day + "19.999999", 1.0, "AB", True),
        ("1969-12-31 23:59:59", 1.0, "AB", False),
    )
    got = [tuple(r) for r in live.live_buckets(rows).collect()]
    start = 1704067200
    assert got == [(-10, 1, 0, 1), (start, 2, 1, 1), (start + 10, 2, 1, 1)]
    assert [r.timestamp for r in live.live_buckets(rows, n=2).collect()] == [start, start + 10]


def test_empty_figures(spark, bank):
    none = bank.scored.limit(0)
    assert live.live_metrics(none).first().asDict() == {
        "total_transactions": 0, "fraud_count": 0, "legit_count": 0, "fraud_rate": 0.0,
        "total_amount": 0.0,
    }
    assert live.live_flows(none).isEmpty() and live.live_buckets(none).isEmpty()
    assert live.flow_bars(live.live_flows(none)).isEmpty()
    recent = live.recent_fraud_rate(none, "2024-01-01").first()
    assert (recent.rows_5m, recent.fraud_5m, recent.fraud_pct_5m) == (0, 0, None)
    health = live.pipeline_health(none, "2024-01-01").first()
    assert health.total_rows == 0 and health.max_id is None and health.age_seconds is None
    assert analytics.max_id(none).first().max_id is None
    assert profile.overall_stats(bank.gold.limit(0)).first().asDict() == {
        "total_transactions": 0, "total_fraud": 0, "fraud_rate": 0.0,
    }


def test_recent_inbox_and_latest(spark):
    rows = scored(
        spark, ("2024-01-01 00:00:00", 1.0, "AB", True), ("2024-01-01 00:05:00", 2.0, "AB", True),
        ("2024-01-01 00:09:00", 3.0, "BA", False), ("2024-01-01 00:09:00", 3.0, "BA", False),
    )
    recent = live.recent_fraud_rate(rows, "2024-01-01 00:10:00").first()
    assert (recent.rows_5m, recent.fraud_5m, recent.fraud_pct_5m) == (2, 0, 0.0)
    assert [r.id for r in analytics.latest(rows, 2).collect()] == [3, 2]
    assert [r.id for r in live.fraud_inbox(rows).collect()] == [1, 0]
    assert live.fraud_inbox(rows, window=2).isEmpty()
    assert [r.id for r in live.since(rows, "2024-01-01 00:05:00").collect()] == [2, 3]
    bars = live.flow_bars(live.live_flows(rows)).collect()
    assert [(b.source, b.fraud_ratio, b.bar_width) for b in bars] == [("A", 1.0, 100.0), ("B", 0.0, 100.0)]


def test_window_keeps_both_ends(spark):
    gold = spark.range(0, 1001).select(
        F.col("id").cast("int").alias("step"), F.lit(1.0).alias("amount"), F.lit(True).alias("is_fraud")
    )
    assert analytics.last_steps(gold).agg(F.min("step"), F.count("*")).first()[:] == (280, 721)
    series = analytics.fraud_over_time(gold, "2024-01-01 00:00:00", hours=1).collect()
    assert [str(r.ts) for r in series] == ["2024-02-11 15:00:00", "2024-02-11 16:00:00"]


def test_pair_weights_are_of_the_pairs_shown(spark):
    gold = spark.createDataFrame(
        [("A", "B", True)] * 6 + [("A", "C", False)] * 2 + [("D", "E", False)],
        "countryOrig_name string, countryDest_name string, is_fraud boolean",
    )
    got = [(r.countryDest_name, r.weight, r.fraud_rate) for r in profile.country_pairs(gold, 2).collect()]
    assert got == [("B", 0.75, 1.0), ("C", 0.25, 0.0)]


def test_numeric_profile_without_values(spark):
    gold = spark.createDataFrame(
        [("T", False, 1.0), ("T", False, None), ("U", True, None)],
        "type string, is_fraud boolean, amount double",
    )
    t, u = profile.numeric_profile(gold, ["amount"]).collect()
    assert (t["count"], t.amount_mean, t.amount_stddev, t.amount_p90) == (2, 1.0, 0.0, 1.0)
    assert (u["count"], u.is_fraud, u.amount_mean, u.amount_p50) == (1, 1, 0.0, 0.0)


def test_profile_matches_its_sections(spark, bank, folder):
    profile.write_profile(bank.gold, folder)
    read = {n: spark.read.json(f"{folder}/{n}") for n in
            ("overall", "type_frequencies", "numeric_profiles", "country_pairs", "metadata")}
    assert read["overall"].first().total_transactions == bank.gold.count()
    for name, direct in (("type_frequencies", profile.type_frequencies(bank.gold)),
                         ("country_pairs", profile.country_pairs(bank.gold))):
        want = {tuple(r) for r in direct.collect()}
        assert {tuple(r) for r in read[name].select(*direct.columns).collect()} == want
    assert read["metadata"].count() == 1


def test_money_sums_are_exact(spark):
    df = spark.createDataFrame([("A", 0.1)] * 10, "countryOrig string, amount double")
    assert analytics.sum_by(df, "countryOrig", "amount").first().sum_amount == 1.0
    assert math.fsum([0.1] * 10) == 1.0


def test_money_is_rounded_after_the_sum(spark):
    from tellerscope.functions.columns import money_sum

    def total(*amounts):
        rows = spark.createDataFrame([(a,) for a in amounts], "amount double")
        return rows.agg(money_sum("amount").alias("s")).first().s

    assert abs(total(*[0.004] * 1000) - 4.0) < 1e-9
    assert total(1e17, 1.5) == 1e17 + 1.5 and total(1e20, 1.0) == 1e20 + 1.0
    assert total() is None and total(None, 2.0) == 2.0
    assert total(float("nan"), 1.0) != total(float("nan"), 1.0)
    assert total(float("inf"), 1.0) == float("inf")
