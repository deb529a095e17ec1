"""Skew handling must never change a result: compared with a nested loop in Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tellerscope.functions import skew
from tellerscope.functions.sizing import input_bytes, pin_small
from tellerscope.functions.skew import heavy_keys, one_per_key, skew_hints, skew_join


def _sides(seed):
    rng = random.Random(seed)
    keys = ["hot", "warm", None, *[f"k{i}" for i in range(20)]]
    weights = [40, 10, 20, *[1] * 20]
    left = [(k, i) for i, k in enumerate(rng.choices(keys, weights, k=300))]
    right = [(k, -i) for i, k in enumerate(rng.choices(keys, [5, 30, 5, *[1] * 20], k=60))]
    right += [("only right", 1)]
    left += [("only left", 7)] * 3
    return left, right


def _loop(left, right, how):
    out = []
    for k, a in left:
        hits = [b for j, b in right if k is not None and j == k]
        if how == "inner":
            out += [(k, a, b) for b in hits]
        elif how == "left":
            out += [(k, a, b) for b in hits] or [(k, a, None)]
        elif (how == "left_semi") == bool(hits):
            out.append((k, a))
    return sorted(out, key=repr)


HOT = [([], []), (["hot", "only left"], []), ([], ["warm", "only right"]), (["hot", "warm"], ["hot", "warm"])]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, *HOT])
def test_skew_join_is_exact(spark, how, hot):
    left, right = _sides(1)
    a = spark.createDataFrame(left, "k string, a int")
    b = spark.createDataFrame(right, "other string, b int")
    hot_left, hot_right = hot or (None, None)
    got = skew_join(a, b, "k", how, "other", hot_left, hot_right, spread_by=["a"], ways=5)
    assert got.columns == (["k", "a"] if how.startswith("left_") else ["k", "a", "b"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _loop(left, right, how)


def test_hot_and_missing_keys_are_spread(spark):
    a = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").alias("k"), F.col("id").alias("a")
    )
    b = spark.createDataFrame([("hot", 1)], "k string, b int")
    for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(f"spark.sql.{name}", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew_join(a, b, "k", "left", hot_left=["hot"], spread_by=["a"])
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_heavy_keys_misses_none(spark):
    rows = ["a"] * 500 + ["b"] * 300 + [str(i) for i in range(700)] + [None] * 500
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(r, i % 7) for i, r in enumerate(rows)], "k string, n int")
    found = heavy_keys(df, ["k", "n"], support=0.1)
    assert {"a", "b"} <= set(found["k"]) and None not in found["k"]
    assert set(found["n"]) == set(range(7))


def test_hints_only_for_large_input(spark, bank, monkeypatch):
    assert skew_hints(bank.table("orders"), ["o_custkey"]) is None
    monkeypatch.setattr(skew, "LOOK_FOR_SKEW_BYTES", 0)
    assert set(skew_hints(bank.table("orders"), ["o_custkey"])) == {"o_custkey"}
    assert input_bytes(bank.table("nation")) < 1 << 20


def test_pipeline_is_the_same_with_skew_handling(spark, bank, monkeypatch):
    from conftest import SF

    from tellerscope.plans.bank_tables import Bank

    plain = bank.gold
    monkeypatch.setattr(skew, "LOOK_FOR_SKEW_BYTES", 0)
    salted = Bank(spark, SF)
    assert salted.hints
    assert salted.gold.columns == plain.columns
    assert salted.gold.exceptAll(plain).isEmpty() and plain.exceptAll(salted.gold).isEmpty()


@pytest.mark.parametrize("newest", [True, False])
def test_one_per_key(spark, newest):
    rows = [(k, s, v) for k, (s, v) in itertools.product(
        [1, 2, None], [(None, "none"), (3, "low"), (9, "high")])]
    df = spark.createDataFrame(rows, "k int, s int, v string")
    got = one_per_key(df, "k", ["s"], newest)
    assert got.columns == ["k", "s", "v"]
    assert {(r.k, r.v) for r in got.collect()} == {
        (k, "high" if newest else "none") for k in (1, 2, None)
    }


def test_filter_on_the_key_reaches_the_scan(spark, bank):
    one = one_per_key(bank.table("orders"), "o_orderkey", ["o_totalprice"])
    plan = one.filter("o_orderkey = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,5)" in plan


def test_pin_small(spark):
    few, many = spark.range(5), spark.range(6)
    assert "broadcast" in pin_small(few, 5)._jdf.queryExecution().analyzed().toString()
    assert pin_small(many, 5) is many
