"""Exact percentiles against sorting, whatever the values and however small the limit."""

import math
import random

import pytest

from tellerscope.functions import quantiles
from tellerscope.functions.quantiles import exact_medians, exact_percentiles, values_at_ranks
from tellerscope.operators import ml, profile, risk

PROBS = (0.0, 0.5, 0.99, 1.0)


def expected(values, p):
    n = len(values)
    return sorted(values)[max(1, n - math.floor(n - n * p)) - 1]


@pytest.fixture(scope="module")
def samples():
    r = random.Random(3)
    groups = {
        "even": [r.random() for _ in range(900)],
        "ties": [float(r.choice([1, 1, 1, 2, 7])) for _ in range(1200)],
        "one": [3.5],
        "same": [2.0] * 700,
        "scales": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(800)],
        "spiked": [5.0] * 500 + [r.gauss(5, 1e-9) for _ in range(300)] + [-1e300, 1e300],
        None: [float(x) for x in range(650)],
    }
    return groups


@pytest.mark.parametrize("most,steps", [(100_000, 500), (0, 25)])
def test_percentiles_of_all_shapes(spark, samples, monkeypatch, most, steps):
    monkeypatch.setattr(quantiles, "STEPS", steps)
    rows = [(g, v, v / 3) for g, values in samples.items() for v in values] + [("even", None, None), ("empty", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    found = {(r.g, r.feature): list(r["values"]) for r in exact_percentiles(df, ["g"], ["a", "b"], PROBS, most).collect()}
    for g, values in samples.items():
        assert found.pop((g, "a")) == [expected(values, p) for p in PROBS]
        assert found.pop((g, "b")) == [expected([v / 3 for v in values], p) for p in PROBS]
    assert found == {("empty", "b"): [1.0] * len(PROBS)}


def test_ranks_of_nothing(spark):
    rows = spark.createDataFrame([(1, None)], "g int, value double")
    assert values_at_ranks(rows, ["g"], quantiles.median_ranks()).count() == 0
    assert values_at_ranks(rows.limit(0), ["g"], quantiles.median_ranks()).count() == 0


@pytest.mark.parametrize("most", [100_000, 1])
def test_medians(spark, most):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (9.0, 7.0), (4.0, 6.0)], "x double, y double")
    assert {r.feature: r.median for r in exact_medians(df, ["x", "y"], most).collect()} == {"x": 3.0, "y": 6.0}


def test_exact_forms_agree_with_exact_sketches(spark, bank, monkeypatch):
    """At this size a sketch holds every value, so both forms must give the same rows."""
    monkeypatch.setattr(quantiles, "MOST_SORTED", 100)
    for name, fn in (("profile", profile.numeric_profile), ("stats", risk.type_stats)):
        one, other = fn(bank.gold, exact=True), fn(bank.gold, accuracy=1_000_000)
        loose = [c for c in one.columns if c.endswith(("_mean", "_stddev"))]
        assert sorted(map(str, one.drop(*loose).collect())) == sorted(map(str, other.drop(*loose).collect())), name


def test_gaps_are_filled_with_the_median(spark):
    rows = [(1.0, None), (float("nan"), None), (None, None), (4.0, None)]
    frame = spark.createDataFrame([(a, b, 0.0, 0.0, 0.0, "T", "A", "D") for a, b in rows] + [(None, None, 0.0, 0.0, 0.0, "U", "B", "C")], "amount float, newBalanceDest float, oldBalanceDest float, diffOrig float, diffDest float, type string, countryOrig_name string, countryDest_name string")
    from pyspark.ml import PipelineModel

    out = PipelineModel(ml.fit_preprocessing(frame)[:1]).transform(frame).collect()
    assert [r.amount_f for r in out] == [1.0, 2.5, 2.5, 4.0, 2.5]
    assert all(r.newBalanceDest_f is None for r in out)
