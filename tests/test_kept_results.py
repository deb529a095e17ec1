"""Results that readers see whole, logs that stay small, baselines that merge, reports of streams."""

import math
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tellerscope.operators import baseline_store, cdc, ml, risk
from tellerscope.sources import folders, key_index, levels, published, tables
from tellerscope.streaming import jobs, progress


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def values(df):
    return sorted(r.v for r in df.collect())


def test_a_reader_between_two_writes_sees_the_old_result(spark, folder):
    assert published.read(spark, folder) is None
    assert published.publish(numbers(spark, 1), folder, "run-0") == 0
    before = published.read(spark, folder)
    published.write_version(numbers(spark, 2, 3), folder, 1)  # data is there, the marker not yet
    assert values(published.read(spark, folder)) == [1]
    published.finish(spark, folder, 1, "run-1")
    assert values(published.read(spark, folder)) == [2, 3]
    assert values(before) == [1]  # a reader that began earlier still has its files


def test_a_lost_attempt_is_replaced_and_a_repeated_step_changes_nothing(spark, folder):
    published.publish(numbers(spark, 1), folder, "run-0")
    published.write_version(numbers(spark, 8, 8, 8), folder, 1)  # a driver that was lost here
    published.publish(numbers(spark, 2), folder, "run-1")
    assert published.publish(numbers(spark, 9), folder, "run-1") == 1
    assert values(published.read(spark, folder)) == [2]


def test_old_versions_go(spark, folder):
    for i in range(7):
        published.publish(numbers(spark, i), folder, f"run-{i}", keep=2)
    assert [n for n, _ in published.versions(spark, folder)] == [5, 6]
    assert sorted(os.listdir(f"{folder}/data")) == ["version=5", "version=6"]
    with pytest.raises(OSError):
        folders.put(spark, f"{folder}/live/000000000006.run-6")


def test_a_new_checkpoint_publishes_on_top(spark, bank, folder):
    path = f"{folder}/in"
    schema = "timestamp timestamp, country_orig string, country_dest string, amount double, fraud_prediction boolean"
    for n in (1, 2):
        one = spark.createDataFrame([(None, "A", "B", 1.0, True)] * n, schema)
        one.write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        flows = jobs.stream_country_flows(stream)
        jobs.publish_latest(flows, f"{folder}/out", f"{folder}/checkpoint-{n}", trigger=jobs.ONCE).awaitTermination()
    assert [r.total_count for r in jobs.read_latest(spark, f"{folder}/out").collect()] == [3]


# --- levels


def newest(df):
    return df.groupBy("k").agg(F.max("v").alias("v"))


def test_folders_grow_with_the_logarithm_of_the_batches(spark, folder):
    r, want, most = random.Random(1), {}, 0
    for batch in range(22):
        rows = [(r.randrange(30), batch) for _ in range(5)]
        want |= dict(rows)
        levels.append(spark.createDataFrame(rows, "k int, v int").coalesce(1), folder, batch, "run", newest, fanout=3)
        most = max(most, len(levels.manifest(spark, folder)["folders"]))
    assert most <= 2 * 3  # of levels 0 to 2, at most two each stay unmerged
    assert {row.k: row.v for row in newest(levels.read(spark, folder)).collect()} == want
    assert len(os.listdir(f"{folder}/manifest")) - len([n for n in os.listdir(f"{folder}/manifest") if n.startswith(".")]) == levels.KEEP
    assert len(folders.names(spark, f"{folder}/data")) <= 6 + levels.KEEP * 3


def test_a_reader_during_a_merge_sees_one_version(spark, folder):
    for batch in range(3):
        levels.append(spark.createDataFrame([(1, batch), (batch + 10, 0)], "k int, v int"), folder, batch, "run", newest, fanout=4)
    before = levels.read(spark, folder)
    levels.append(spark.createDataFrame([(1, 3)], "k int, v int"), folder, 3, "run", newest, fanout=4)  # merges all four
    assert len(levels.manifest(spark, folder)["folders"]) == 1
    assert {r.k: r.v for r in newest(before).collect()} == {1: 2, 10: 0, 11: 0, 12: 0}
    assert {r.k: r.v for r in levels.read(spark, folder).collect()} == {1: 3, 10: 0, 11: 0, 12: 0}
    # Data that no manifest names, of a lost driver, is no part of the state.
    spark.createDataFrame([(1, 99)], "k int, v int").write.parquet(f"{folder}/data/lost-0")
    assert {r.k: r.v for r in levels.read(spark, folder).collect()} == {1: 3, 10: 0, 11: 0, 12: 0}


def test_a_retried_batch_is_not_added_again(spark, folder):
    one = spark.createDataFrame([(1, 5)], "k int, v int")
    for batch in (0, 1, 1, 0):
        levels.append(one, folder, batch, "run", newest)
    assert len(levels.manifest(spark, folder)["folders"]) == 2
    levels.append(one, folder, 0, "other", newest)  # another run counts from 0 again
    assert levels.manifest(spark, folder)["applied"] == {"run": 1, "other": 0}


def test_current_state_of_many_batches(spark, bank, folder):
    log, target = f"{folder}/log", f"{folder}/current"
    bank.history.repartition(11).write.parquet(log)
    stream = spark.readStream.schema(bank.history.schema).option("maxFilesPerTrigger", 1).parquet(log)
    jobs.stream_current(stream, target, f"{folder}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    got, want = jobs.read_current(spark, target), cdc.current_state(bank.history)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert len(levels.manifest(spark, target)["folders"]) < 8
    with pytest.raises(ValueError):
        jobs.read_current(spark, f"{folder}/nothing")


# --- baseline in parts


def test_merged_ranks_stay_within_their_error(spark, folder):
    """Forty parts of skewed amounts, a type in few of them, amounts that are all NULL."""
    n = 400_000
    rows = spark.range(n).selectExpr("id % 40 AS part", "'A' AS type", "id % 10 = 0 AS is_fraud", "exp(12 * rand(7)) AS amount")
    rows = rows.unionByName(spark.range(50).selectExpr("1L", "'B'", "false", "CAST(id AS DOUBLE)").toDF(*rows.columns))
    rows = rows.unionByName(spark.createDataFrame([(3, "C", True, None)], rows.schema)).persist()
    baseline_store.add_parts(rows, folder, F.col("part").cast("string"))
    found = {r.type: r for r in baseline_store.merged(spark, folder).collect()}
    assert float(found["A"].fraud_rate_type) == 0.1 and float(found["C"].fraud_rate_type) == 1.0
    for name, p in risk.QUANTILES:
        below = rows.filter((F.col("type") == "A") & (F.col("amount") <= found["A"][f"{name}_amount_type"])).count()
        assert abs(below / n - p) < 1.5 / baseline_store.K
        assert found["B"][f"{name}_amount_type"] == math.ceil(50 * p) - 1
        assert found["C"][f"{name}_amount_type"] is None
    rows.unpersist()


def test_a_repeated_load_replaces_its_part(spark, bank, folder):
    for part in ("a", "b", "b"):
        baseline_store.add_parts(bank.gold.filter(F.col("step") % 2 == int(part == "a")), folder, part)
    want = {r.type: tuple(r) for r in risk.type_stats(bank.gold, accuracy=1_000_000).collect()}
    assert {r.type: tuple(r) for r in baseline_store.merged(spark, folder).collect()} == want


# --- reports of streams


def test_a_batch_that_runs_again_counts_once(spark, folder):
    schema = "id long, timestamp timestamp"
    rows = spark.createDataFrame([(i, None) for i in range(9)], schema)
    rows.repartition(3).write.parquet(f"{folder}/in")
    for _ in range(2):  # the second start forgets the last commit, so its batch runs again
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        seen = stream.observe("counts", F.count(F.lit(1)).alias("rows"), F.max("id").alias("top"))
        with progress.recorded(spark, f"{folder}/log", f"{folder}/checkpoint") as log:
            (seen.writeStream.format("parquet").queryName(log.run).option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(**jobs.ONCE).start().awaitTermination())
        for name in ("2", ".2.crc"):
            if os.path.exists(f"{folder}/checkpoint/commits/{name}"):
                os.remove(f"{folder}/checkpoint/commits/{name}")
    found = progress.batches(spark, f"{folder}/log")
    assert sorted((r.batch_id, r.input_rows) for r in found.filter("input_rows > 0").collect()) == [(0, 3), (1, 3), (2, 3)]
    assert {r["name"]: r["value"] for r in progress.observed(spark, f"{folder}/log", "counts").collect()}["rows"] == 9
    assert progress.batches(spark, f"{folder}/none").count() == 0
    assert progress.observed(spark, f"{folder}/log", "other").count() == 0


def test_late_rows_are_counted_one_by_one(spark, folder):
    """Three late rows of one bucket and task are three, not one."""
    schema = "id long, timestamp timestamp, fraud_prediction boolean"
    deliveries = [[(1, "2024-01-01 00:00:01"), (2, "2024-01-01 00:10:00")], [(3, "2024-01-01 00:00:02"), (4, "2024-01-01 00:00:03"), (5, "2024-01-01 00:00:04"), (2, "2024-01-01 00:10:00")], [(6, "2024-01-01 01:00:00")]]
    for part, rows in enumerate(deliveries):
        df = spark.createDataFrame([(i, t, True) for i, t in rows], "id long, t string, fraud_prediction boolean")
        df.select("id", F.col("t").cast("timestamp").alias("timestamp"), "fraud_prediction").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        with progress.recorded(spark, f"{folder}/log", f"{folder}/checkpoint") as log:
            (jobs.stream_time_buckets(stream, delay="1 minute", key="id").writeStream.outputMode("append").format("parquet")
             .queryName(log.run).option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(**jobs.ONCE).start().awaitTermination())
    assert {(r.timestamp, r.total) for r in spark.read.parquet(f"{folder}/out").collect()} == {(1704067200, 1), (1704067800, 1)}
    assert progress.batches(spark, f"{folder}/log").agg(F.sum("late_rows")).first()[0] == 3


# --- index of keys, bucketed merge


def scans(df):
    """(files, rows) that the scans of ``df`` read, after it ran."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return [m.get("numFiles").get().value() for m in metrics if m.contains("numFiles")]


def test_files_read_by_a_lookup_do_not_grow(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for batch in range(16):
            rows = spark.range(batch * 400, (batch + 1) * 400)
            key_index.add(rows, f"{folder}/keys", batch, "run", buckets=32)
            if batch in (3, 15):
                few = spark.createDataFrame([(7,), (100_000,), (399,)], "id long")
                found = key_index.present(few, f"{folder}/keys", buckets=32)
                read[batch] = max(scans(found))
                assert sorted(r.id for r in found.collect()) == [7, 399]
        assert read[3] == read[15] <= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_batch_lost_before_its_keys_were_stored_is_written_again(spark, folder):
    schema = "id long, timestamp timestamp, v string"
    batch = spark.createDataFrame([(1, None, "a"), (2, None, "b")], schema)
    tables.insert_indexed(batch, f"{folder}/t", 0, run="run")
    index = tables.index_path(f"{folder}/t")
    shutil.rmtree(index)  # the driver was lost between rows and keys: batch 0 runs again
    tables.insert_indexed(batch, f"{folder}/t", 0, run="run")
    tables.insert_indexed(batch, f"{folder}/t", 0, run="run")  # lost after its keys: nothing to do
    tables.insert_indexed(spark.createDataFrame([(2, None, "x"), (3, None, "c"), (None, None, "n")], schema), f"{folder}/t", 1, run="run")
    assert sorted((r.id, r.v) for r in tables.read_scored(spark, f"{folder}/t").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    tables.reset(spark, f"{folder}/t")
    assert tables.read_scored(spark, f"{folder}/t").count() == 0
    tables.insert_indexed(batch, f"{folder}/t", 5, run="run")
    assert tables.read_scored(spark, f"{folder}/t").count() == 2


def test_a_bucketed_target_is_not_moved(spark, folder):
    """The only exchanges of a merge are above the source."""
    table = "bucketed_" + os.path.basename(folder).replace("-", "_")
    rows = spark.range(500).selectExpr("id", "id * 2 AS v")
    tables.merge_into_bucketed(rows, table, buckets=4, location=f"{folder}/t")
    tables.merge_into_bucketed(spark.range(400, 600).selectExpr("id", "-1L AS v"), table)
    tables.merge_into_bucketed(spark.createDataFrame([(None, 0), (None, 0)], "id long, v long"), table)
    assert spark.table(table).count() == 602 and spark.table(table).filter("v = -1").count() == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        source = spark.range(400, 700).selectExpr("id", "-2L AS v")
        plan = source.join(spark.table(table).select("id"), "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
        right = plan[plan.index("Scan parquet") - 400 :]
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "Exchange" not in right.split("Scan parquet")[1]
        assert plan.index("Exchange") < plan.index("Scan parquet")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    tables.drop_pipeline(spark, [table])


def test_ranked_area(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.4, 0), (0.8, 1), (0.9, 0), (0.9, 1), (None, 1), (0.5, None)]
    df = spark.createDataFrame(rows, "fraud_probability double, label int")
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    pairs = [(s > t) + (s == t) / 2 for s, y in known if y for t, z in known if not z]
    for parts in (1, 3, 50):
        found = ml.ranked_auc(df, parts=parts).first()
        assert tuple(found) == (3, 4, pytest.approx(100 * sum(pairs) / len(pairs)))
    assert tuple(ml.ranked_auc(df.filter("label = 1")).first()) == (4 - 1, 0, None)
    assert tuple(ml.ranked_auc(df.limit(0)).first()) == (0, 0, None)
