"""Streams give the batch answer, survive restarts, and bound their state."""

import pytest
from pyspark.sql import functions as F

from tellerscope.operators import cdc, live, ml
from tellerscope.plans.bank_tables import scored_from
from tellerscope.sources import tables
from tellerscope.streaming import jobs


@pytest.fixture
def events(spark, bank, folder):
    """Event files, delivered in three parts."""
    path = f"{folder}/events"
    bank.table("events").repartition(3).write.parquet(path)
    schema = bank.table("events").schema
    return scored_from(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    )


def finish(spark, folder, result, mode, **options):
    target = f"{folder}/result"
    jobs.publish_latest(
        result, target, f"{folder}/checkpoint", mode, jobs.ONCE, **options
    ).awaitTermination()
    return jobs.read_latest(spark, target)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_metrics_equal_batch(spark, bank, folder, events):
    assert same(finish(spark, folder, jobs.stream_metrics(events), "complete"), live.live_metrics(bank.scored))


def test_flows_equal_batch(spark, bank, folder, events):
    got = finish(spark, folder, jobs.stream_country_flows(events), "complete", top_n=30)
    assert same(got, live.live_flows(bank.scored))


def test_buckets_equal_batch(spark, bank, folder, events):
    got = finish(spark, folder, jobs.stream_time_buckets(events), "complete")
    assert same(got, live.live_buckets(bank.scored, n=10**6))


def test_watermark_drops_late_rows_and_closes_buckets(spark, folder):
    path = f"{folder}/in"
    schema = "timestamp timestamp, fraud_prediction boolean"
    deliveries = [["2024-01-01 00:00:01", "2024-01-01 00:10:00"], ["2024-01-01 00:00:02"],
                  ["2024-01-01 01:00:00"]]
    for times in deliveries:
        df = spark.createDataFrame([(t, True) for t in times], "timestamp string, fraud_prediction boolean")
        df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode(
            "append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        (jobs.stream_time_buckets(stream, delay="1 minute").writeStream.outputMode("append")
         .format("parquet").option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(**jobs.ONCE).start()
         .awaitTermination())
    got = {(r.timestamp, r.total) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {(1704067200, 1), (1704067800, 1)}


def test_dedup_across_batches(spark, bank, folder, events):
    twice = events.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    (jobs.dedup(twice, delay="60 days").writeStream.format("parquet").option("path", f"{folder}/out")
     .option("checkpointLocation", f"{folder}/checkpoint").trigger(**jobs.ONCE).start()
     .awaitTermination())
    ids = spark.read.parquet(f"{folder}/out").select("id")
    assert ids.count() == ids.distinct().count() == bank.scored.count()


def test_current_state_over_deliveries(spark, bank, folder):
    path, target = f"{folder}/log", f"{folder}/current"
    parts = bank.history.randomSplit([1.0, 1.0, 1.0], seed=5)
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(bank.history.schema).parquet(path)
        jobs.stream_current(stream, target, f"{folder}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    assert same(jobs.read_current(spark, target), cdc.current_state(bank.history))


def test_silver_stream_applies_rules(spark, bank, folder):
    path = f"{folder}/bronze"
    bank.bronze.withColumn("amount", F.col("amount") - 100_000).write.parquet(path)
    schema = spark.read.parquet(path).schema
    out = jobs.silver_stream(spark.readStream.schema(schema).parquet(path), bank.reports)
    query = (out.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(**jobs.ONCE).start())
    query.awaitTermination()
    counted = [p.observedMetrics["expectations"] for p in query.recentProgress if p.observedMetrics]
    dropped = bank.bronze.filter("amount <= 100000").count()
    assert sum(m.correct_amount for m in counted) == dropped > 0
    assert sum(m.total_rows for m in counted) == bank.bronze.count()
    got = spark.read.parquet(f"{folder}/out")
    want = bank.silver.withColumn("amount", F.col("amount") - 100_000).filter("amount > 0")
    assert same(got.select("id", "amount", "is_fraud"), want.select("id", "amount", "is_fraud"))


def test_scoring_stream_restarts(spark, bank, folder):
    model = ml.fit_rf(ml.features(bank.gold, with_label=True), trees=3, depth=3)
    inbox, target = f"{folder}/inbox", f"{folder}/scored"
    lines = [
        '{"id": 1, "timestamp": "2024-01-01 00:00:00", "type": "TRANSFER", "amount": 400000, '
        '"customer_id": 3, "country_orig": "NATION_1", "country_dest": "Nowhere", '
        '"old_balance_orig": 400000, "new_balance_orig": 0, "old_balance_dest": 0, '
        '"new_balance_dest": 400000, "diff_orig": -400000, "diff_dest": 400000}',
        '{"id": 1, "timestamp": "2024-01-01 00:00:09", "type": "DEBIT", "amount": 1}',
        "not json",
    ]
    for text in (lines, ['{"id": 1, "amount": 5}', '{"id": 2, "type": "DEBIT"}']):
        spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.mode(
            "append").text(inbox)
        for _ in range(2):
            jobs.stream_score(
                spark.readStream.text(inbox), model, target, f"{folder}/checkpoint", jobs.ONCE
            ).awaitTermination()
    rows = {r.id: r for r in tables.read_scored(spark, target).collect()}
    assert set(rows) == {1, 2}
    assert rows[1].type == "TRANSFER" and rows[1].old_balance_orig == 400000.0
    assert 0.0 <= rows[1].fraud_probability <= 1.0 and rows[1].scored_at is not None
    assert rows[1].fraud_prediction == (rows[1].fraud_probability >= 0.5)


def test_dedup_keeps_late_new_keys(spark, folder):
    schema = "id long, timestamp timestamp, v string"
    deliveries = [[(1, "2024-01-02", "a")], [(2, "2024-01-01", "b"), (1, "2024-01-01", "x")], [(3, "2023-01-01", "c")]]
    for n, rows in enumerate(deliveries):
        df = spark.createDataFrame(rows, "id long, timestamp string, v string")
        df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        (jobs.dedup(stream).writeStream.format("parquet").option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/one").trigger(**jobs.ONCE).start().awaitTermination())
        jobs.dedup_into(stream, f"{folder}/kept", f"{folder}/two-{n}", trigger=jobs.ONCE).awaitTermination()
    assert {(r.id, r.v) for r in spark.read.parquet(f"{folder}/out").collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert {(r.id, r.v) for r in tables.read_scored(spark, f"{folder}/kept").collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_a_message_without_time_does_not_stop_the_stream(spark, bank, folder):
    model = ml.fit_rf(ml.features(bank.gold, with_label=True), trees=2, depth=2)
    texts = ['{"id": 1, "timestamp": "not a time", "type": "DEBIT", "amount": 1}', '{"id": 2, "timestamp": "2024-01-01 00:00:00"}']
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{folder}/inbox")
    stream = spark.readStream.text(f"{folder}/inbox")
    jobs.stream_score(stream, model, f"{folder}/scored", f"{folder}/checkpoint", jobs.ONCE).awaitTermination()
    got = {r.id: r.timestamp for r in tables.read_scored(spark, f"{folder}/scored").collect()}
    assert set(got) == {1, 2} and got[1] is None and got[2] is not None
