"""File ingest, static loads, messages, keyed writes and versions."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tellerscope.operators import profile
from tellerscope.schemas import COUNTRIES, FRAUD_REPORTS
from tellerscope.sources import files, messages, snapshots, tables

REPORT = FRAUD_REPORTS


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def ingest(spark, folder, **options):
    target = f"{folder}/out"
    files.ingest_files(spark, f"{folder}/in", REPORT, target, f"{folder}/checkpoint", **options)
    return spark.read.parquet(target) if os.path.exists(target) else None


def test_each_file_once(spark, folder):
    put(f"{folder}/in", "a.csv", "id,is_fraud\n1,0\n2,1\n")
    put(f"{folder}/in", "empty.csv", "")
    assert ingest(spark, folder).count() == 2
    put(f"{folder}/in", "b.csv", "id,is_fraud\n3,1\n")
    rows = ingest(spark, folder)
    assert {r.id for r in rows.collect()} == {"1", "2", "3"} and rows.count() == 3
    assert {os.path.basename(r.source_file) for r in rows.select("source_file").collect()} == {
        "a.csv", "b.csv"
    }
    assert rows.filter("processing_time IS NULL OR _metadata.file_size IS NULL").isEmpty()


def test_existing_files_can_be_skipped(spark, folder):
    put(f"{folder}/in", "old.csv", "id,is_fraud\n1,0\n")
    os.utime(f"{folder}/in/old.csv", (time.time() - 60,) * 2)
    assert ingest(spark, folder, include_existing=False).count() == 0
    put(f"{folder}/in", "new.csv", "id,is_fraud\n2,1\n")
    os.utime(f"{folder}/in/new.csv", (time.time() + 5,) * 2)
    assert [r.id for r in ingest(spark, folder, include_existing=False).collect()] == ["2"]


def test_json_into_a_table(spark, folder):
    put(f"{folder}/in", "a.json", '{"id": "1", "is_fraud": 1}\n')
    files.ingest_files(
        spark, f"{folder}/in", REPORT, "ingested_reports", f"{folder}/checkpoint", "json",
        columns=["id", "is_fraud", "source_file"],
    )
    assert spark.table("ingested_reports").columns == ["id", "is_fraud", "source_file"]
    assert spark.table("ingested_reports").count() == 1
    tables.drop_pipeline(spark, tables=["ingested_reports", "never_there"], views=["no_view"])
    assert not spark.catalog.tableExists("ingested_reports")


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError):
        ingest(spark, folder, fmt="xml")
    with pytest.raises(ValueError):
        files.pull_csv(spark, folder, "t", fmt="json")


def test_inferred_types(spark, folder):
    put(folder, "a.csv", "id,amount\n1,2.5\n2,3\n")
    kinds = {f.name: f.dataType.simpleString() for f in files.infer_schema(spark, folder)}
    assert kinds == {"id": "int", "amount": "double"}
    bare = files.read_files(spark, folder, header=False)
    assert bare.columns == ["_c0", "_c1"] and bare.count() == 3


def test_ragged_rows(spark, folder):
    put(folder, "c.csv", "country,alpha2_code,alpha3_code,numeric_code,lat_avg,long_avg\n"
        "Aruba,AW,ABW,533,12.5,-69.9667\n\"Here, There\",HT,HTX,1,-17\n")
    got = {r.alpha3_code: r for r in files.read_with_rescue(spark, folder, COUNTRIES).collect()}
    assert got["HTX"].country == "Here, There" and got["HTX"].long_avg is None
    assert got["HTX"].lat_avg == -17.0
    assert got["ABW"]._rescued_data is None and "HTX" in got["HTX"]._rescued_data


def test_static_tables(spark, folder):
    put(folder, "a.csv", "id,is_fraud,more\n1,0,x\n")
    try:
        assert files.load_static(spark, folder, "static_t") is True
        assert files.load_static(spark, folder, "static_t") is False
        with pytest.raises(AnalysisException):
            files.load_static(spark, f"{folder}/missing", "static_u")
        put(folder, "b.csv", "id,is_fraud,more\n2,1,y\n")
        files.replace_static(spark, folder, "static_t")
        assert spark.table("static_t").count() == 2
        files.pull_csv(spark, folder, "static_t", ["is_fraud", "id"])
        assert spark.table("static_t").columns == ["is_fraud", "id"]
    finally:
        tables.drop_pipeline(spark, tables=["static_t", "static_u"])


def test_export(spark, folder):
    files.export_csv(spark.range(100).repartition(4), f"{folder}/one", single=True)
    parts = [f for f in os.listdir(f"{folder}/one") if f.endswith(".csv")]
    assert len(parts) == 1
    assert files.read_files(spark, f"{folder}/one").agg(F.sum("id")).first()[0] == 4950


def test_messages(spark):
    texts = [
        '{"id": 1, "amount": 2.5, "type": "T", "extra": 1}', '{"id": "2", "amount": 1}',
        '{"amount": 3}', '{"id": "x"}', "{broken", '{"id": 4, "amount": "many"}', None,
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    got = messages.parse_messages(raw.select(F.col("value").cast("binary").alias("value")))
    rows = {r.id: r.amount for r in got.collect()}
    assert rows == {1: 2.5, 2: 1.0, 4: None}
    assert "extra" not in got.columns


def test_kafka_options():
    plain = messages.kafka_options("h:9092", "txns")
    assert plain["subscribe"] == "txns" and plain["startingOffsets"] == "latest"
    assert "kafka.security.protocol" not in plain
    safe = messages.kafka_options("h:9092", "txns", "u", "p")
    assert 'username="u" password="p"' in safe["kafka.sasl.jaas.config"]


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, timestamp string, v string")


def test_first_writer_wins(spark, folder):
    target = f"{folder}/scored"
    tables.insert_if_absent(batch(spark, (1, "2", "late"), (1, "1", "early"), (None, "1", "x")), target, 0)
    second = batch(spark, (1, "0", "other"), (2, "1", "new"))
    for _ in range(2):
        tables.insert_if_absent(second, target, 1)
    tables.insert_if_absent(batch(spark).limit(0), target, 2)
    got = {(r.id, r.v) for r in tables.read_scored(spark, target).collect()}
    assert got == {(1, "early"), (2, "new")}
    tables.reset(spark, target)
    assert tables.read_scored(spark, target).count() == 0
    assert set(tables.read_scored(spark, target).columns) == {"id", "timestamp", "v"}
    tables.insert_if_absent(second, target, 3)
    assert tables.read_scored(spark, target).count() == 2


def test_a_retried_batch_replaces_a_partial_one(spark, folder):
    target = f"{folder}/scored"
    tables.insert_if_absent(batch(spark, (1, "1", "a")), target, 0)
    tables.insert_if_absent(batch(spark, (1, "1", "a"), (2, "1", "b")), target, 0)
    assert tables.read_scored(spark, target).count() == 2


def test_customer_lookup(spark, folder):
    put(folder, "c.json", '{"id": "1", "firstname": "A", "lastname": "B"}\n'
        '{"id": "2", "firstname": "C", "lastname": "D", "country": "USA", "email": "x"}\n')
    got = profile.customer_lookup(files.read_files(spark, folder, "json")).collect()
    assert {tuple(r) for r in got} == {("1", "A", "B", ""), ("2", "C", "D", "USA")}


def test_versions(spark, folder, bank):
    path = f"{folder}/dim"
    dim = spark.createDataFrame([("RUS", "a"), ("ROU", "b"), (None, "c")], "alpha3_code string, n string")
    assert snapshots.publish(dim, path) == 0
    assert snapshots.delete_where(spark, path, "alpha3_code = 'RUS'") == 1
    assert {r.n for r in snapshots.as_of(spark, path).collect()} == {"b", "c"}
    assert snapshots.as_of(spark, path, 0).count() == 3
    assert snapshots.restore(spark, path, 0) == 2
    assert snapshots.as_of(spark, path).count() == 3
    past = [(r.version, r.operation, r.rows) for r in snapshots.history(spark, path).orderBy("version").collect()]
    assert past == [(0, "publish", 3), (1, "delete", 2), (2, "restore 0", 3)]
    with pytest.raises(ValueError):
        snapshots.as_of(spark, path, 9)
    with pytest.raises(ValueError):
        snapshots.as_of(spark, f"{folder}/none")


def test_unfinished_version_is_not_seen(spark, folder):
    path = f"{folder}/dim"
    snapshots.publish(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/data/version=1")  # a writer that died
    assert snapshots.as_of(spark, path).count() == 3
    assert snapshots.publish(spark.range(5), path) == 1
    assert snapshots.as_of(spark, path).count() == 5


def test_impact_both_ways(spark, bank):
    after = bank.countries.filter("alpha3_code <> 'N05'")
    lost = {r.change: r.rows for r in snapshots.gold_impact(
        bank.silver, bank.customers, bank.countries, after).collect()}
    back = {r.change: r.rows for r in snapshots.gold_impact(
        bank.silver, bank.customers, after, bank.countries).collect()}
    hit = bank.gold.filter("countryOrig = 'N05' OR countryDest = 'N05'").count()
    assert lost == {"lost": hit, "gained": 0} and back == {"lost": 0, "gained": hit} and hit > 0


def test_small_source_is_looked_up(spark, folder):
    spark.range(20_000).selectExpr("cast(id AS string) AS id", "id AS v").write.parquet(f"{folder}/target")
    rows = [("5", 1), ("5", 2), ("new", 3), ("new", 4), (None, 5)]
    spark.createDataFrame(rows, "id string, v long").write.parquet(f"{folder}/source")
    source, target = (spark.read.parquet(f"{folder}/{n}") for n in ("source", "target"))
    found = tables.new_rows(source, target)
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.v for r in found.collect()) == [3, 4, 5]
    other_way = tables.new_rows(target, source)
    assert "LeftSemi" not in other_way._jdf.queryExecution().optimizedPlan().toString()
    assert other_way.count() == 19_999


def test_a_new_run_leaves_stored_rows(spark, folder):
    target = f"{folder}/scored"
    tables.insert_if_absent(batch(spark, (1, "1", "a")), target, 0, run="first")
    tables.insert_if_absent(batch(spark, (2, "1", "b"), (1, "0", "x")), target, 0, run="second")
    assert {(r.id, r.v) for r in tables.read_scored(spark, target).collect()} == {(1, "a"), (2, "b")}
    names = [tables.run_name(spark, f"{folder}/{c}") for c in ("one", "one", "two")]
    assert names[0] == names[1] != names[2]


def test_ties_have_one_answer(spark, folder):
    rows = [(1, "1", "b"), (1, "1", "a"), (1, "1", None)]
    for n, order in enumerate((rows, rows[::-1])):
        tables.insert_if_absent(batch(spark, *order).repartition(3), f"{folder}/{n}", 0)
    got = [tables.read_scored(spark, f"{folder}/{n}").collect() for n in range(2)]
    assert got[0] == got[1] and len(got[0]) == 1


def test_types_are_inferred_from_all_files(spark, folder):
    for i, value in enumerate(("1", "2", "2.5")):
        put(folder, f"{i}.csv", f"amount\n{value}\n")
    schema = files.infer_schema(spark, folder)
    assert schema["amount"].dataType.simpleString() == "double"


def test_rejected_messages(spark):
    texts = ['{"id": 1, "timestamp": "2024-01-01 00:00:00"}', '{"id": 2, "timestamp": "soon"}', '{"id": 3}',
             '{"amount": 3}', '{"id": "x"}', "{broken", None]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [(r.value, r.reason) for r in messages.rejected(raw).collect()]
    assert got == [(texts[1], "no time"), (texts[3], "no id"), (texts[4], "no id"), (texts[5], "unreadable"), (None, "unreadable")]
