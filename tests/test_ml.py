"""Model steps: split, filling, codes, training, metrics, choice."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tellerscope.operators import ml


@pytest.fixture(scope="module")
def rows(bank):
    """Gold with a label the model can learn: large transfers are fraud."""
    gold = bank.gold.withColumn(
        "is_fraud", (F.col("type") == "TRANSFER") & (F.col("amount") > 150_000)
    )
    return ml.features(gold, with_label=True).persist()


@pytest.fixture(scope="module")
def model(rows):
    return ml.fit_rf(ml.split(rows)[0], trees=10, depth=6)


def test_split_is_stable(rows):
    train, test = ml.split(rows)
    n = rows.count()
    assert train.count() + test.count() == n
    assert abs(train.count() / n - 0.8) < 0.05
    again = ml.split(rows.repartition(7))[0]
    assert again.select("id").exceptAll(train.select("id")).isEmpty()
    other = ml.split(rows, seed=1)[0]
    assert not other.select("id").exceptAll(train.select("id")).isEmpty()


def test_filling_and_codes(spark):
    data = [("1", 1.0, "A", 0.0), ("2", None, "A", 0.0), ("3", 3.0, None, 1.0), ("4", 100.0, "it's", 1.0)]
    train = spark.createDataFrame(data, "id string, amount float, type string, label float")
    for c in ml.NUMERIC[1:]:
        train = train.withColumn(c, F.lit(0.0).cast("float"))
    for c in ml.CATEGORICAL[1:]:
        train = train.withColumn(c, F.lit("x"))
    assert ml.category_values(train)["type"] == ["A", "it's"]
    prep = PipelineModel(ml.fit_preprocessing(train))
    got = {r.id: r for r in prep.transform(train).withColumn("f", vector_to_array("features")).collect()}
    assert got["2"].amount_f == 3.0 and got["3"].type_f == "A"
    assert got["3"].f[5:7] == [1.0, 0.0] and got["4"].f[5:7] == [0.0, 1.0]
    unseen = prep.transform(train.withColumn("type", F.lit("new"))).select(vector_to_array("features"))
    assert unseen.first()[0][5:7] == [0.0, 0.0]


def test_model_learns_and_is_repeatable(rows, model):
    train, test = ml.split(rows)
    scored = ml.predict(test, model).cache()
    metrics = ml.evaluate(scored, prediction="fraud_prediction").first()
    assert metrics.f1 > 80 and ml.roc_auc(scored) > 0.95
    again = ml.predict(test, ml.fit_rf(train, trees=10, depth=6))
    a = {r.id: r.fraud_probability for r in scored.collect()}
    b = {r.id: r.fraud_probability for r in again.collect()}
    assert a.keys() == b.keys()
    assert sum(abs(a[i] - b[i]) > 0.2 for i in a) < len(a) * 0.05


def test_threshold(rows, model):
    low = ml.predict(rows, model, threshold=0.0)
    assert low.filter("NOT fraud_prediction").isEmpty()


def test_model_survives_saving(rows, model, folder):
    model.write().overwrite().save(f"{folder}/model")
    loaded = PipelineModel.load(f"{folder}/model")
    one = rows.orderBy("id").limit(20)
    assert ml.predict(one, loaded).collect() == ml.predict(one, model).collect()


def test_importances(rows, model):
    got = {r.feature: r.importance for r in ml.importances(model, rows).collect()}
    assert {"amount", "type_TRANSFER", "countryOrig_name_NATION_1"} <= set(got)
    assert abs(sum(got.values()) - 1) < 0.05
    assert max(got, key=got.get) in ("type_TRANSFER", "amount")


def test_evaluate_by_hand(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    got = ml.evaluate(spark.createDataFrame(pairs, "label int, prediction int")).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (4, 2, 1, 3)
    want = (70.0, 60.0, 75.0, 2 * 60 * 75 / 135, (75 + 400 / 6) / 2)
    assert (got.accuracy, got.precision, got.recall, got.f1, got.auc) == pytest.approx(want)
    one_class = ml.evaluate(spark.createDataFrame([(0, 0)], "label int, prediction int")).first()
    assert (one_class.accuracy, one_class.f1, one_class.auc) == (100.0, 0.0, None)


def test_grid_and_choice(rows):
    results, models = ml.grid_search(*ml.split(rows), grid=((2, 2), (5, 5)))
    assert results.count() == 2 and set(models) == {(2, 2), (5, 5)}
    chosen = ml.best(results).first()
    assert chosen.f1 == results.agg(F.max("f1")).first()[0]


def test_scoring_beside_observed_metrics(spark, rows, model):
    from pyspark.sql import Observation

    seen = Observation("beside")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 3}
    assert ml.predict(rows, model).count() == rows.count()


def test_importance_names_keep_the_text_of_the_category(spark):
    rows = [(str(i), float(i), 1.0, 2.0, 0.0, 0.0, "a_fee" if i % 2 else "b_f_v_", "X_f", "Y", float(i % 2)) for i in range(40)]
    columns = "id string, amount float, newBalanceDest float, oldBalanceDest float, diffOrig float, diffDest float, type string, countryOrig_name string, countryDest_name string, label float"
    train = spark.createDataFrame(rows, columns)
    names = {r.feature for r in ml.importances(ml.fit_rf(train, trees=2, depth=2), train).collect()}
    assert {"type_a_fee", "type_b_f_v_", "countryOrig_name_X_f", "countryDest_name_Y", "amount"} <= names
