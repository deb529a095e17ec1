"""Fraud model on Spark ML: nothing is pulled to the driver but metrics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tellerscope.functions.quantiles import exact_medians
from tellerscope.functions.sizing import written

NUMERIC = ("amount", "newBalanceDest", "oldBalanceDest", "diffOrig", "diffDest")
CATEGORICAL = ("type", "countryOrig_name", "countryDest_name")
GRID = tuple((trees, depth) for trees in (10, 20) for depth in (10, 20))


def features(df: DataFrame, with_label: bool = False) -> DataFrame:
    """Model input: id, five floats, three categories and, if asked, ``label``."""
    label = [F.col("is_fraud").cast("int").cast("float").alias("label")] if with_label else []
    return df.select(
        "id", *[F.col(c).cast("float").alias(c) for c in NUMERIC], *CATEGORICAL, *label
    )


def split(df: DataFrame, pct: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the id: the same rows on every run and partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    draw = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % 100
    return df.filter(draw < pct), df.filter(draw >= pct)


def category_counts(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """(feature, value, count) of each categorical column in one pass, NULL left out."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])
    )
    rows = df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL")
    return rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def category_values(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> dict[str, list[str]]:
    """Distinct values per column, most frequent first (by value on ties).

    What reaches the driver is one row per category, as many as the model has one-hot
    inputs: any such model holds them there.
    """
    counts = category_counts(df, columns).orderBy("feature", F.desc("count"), "value")
    rows = counts.collect()
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        values[row["feature"]].append(row["value"])
    return values


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _filled(column: str, median: float | None) -> str:
    """SQL of a number with its gaps (NULL or NaN) filled by the median, if there is one."""
    known = f"nanvl({column}, CAST(NULL AS FLOAT))"
    return f"{known} AS {column}_f" if median is None else f"coalesce({known}, CAST({median!r}D AS FLOAT)) AS {column}_f"


def fit_preprocessing(train: DataFrame) -> list:
    """Fitted stages: exact medians, most frequent categories, one-hot codes, assembly.

    The median of an even number of values is the mean of the two in the middle. A category
    unseen in training becomes an all-zero code. The passes over ``train`` are one for the
    categories, and two and a few over ever smaller parts for the medians.
    """
    values = category_values(train)
    known = train.select(*[F.nanvl(F.col(c), F.lit(None).cast("float")).alias(c) for c in NUMERIC])
    medians = {r["feature"]: r["median"] for r in exact_medians(known, NUMERIC).collect()}
    numeric = ", ".join(_filled(c, medians.get(c)) for c in NUMERIC)
    filled = ", ".join(
        f"coalesce({c}, {_quoted(values[c][0])}) AS {c}_f" if values[c] else f"{c} AS {c}_f"
        for c in CATEGORICAL
    )
    numbers = [f"{c}_f" for c in NUMERIC]
    index = [f"{c}_i" for c in CATEGORICAL]
    code = [f"{c}_v" for c in CATEGORICAL]
    # One model per column: label lists of unequal length do not fit one model.
    indexers = [
        StringIndexerModel.from_labels(
            sorted(values[c]), inputCol=f"{c}_f", outputCol=f"{c}_i", handleInvalid="keep"
        )
        for c in CATEGORICAL
    ]
    # Sizes come from the indexer's column metadata; the dropped last slot is the one
    # for unseen values.
    encoder = OneHotEncoder(inputCols=index, outputCols=code, dropLast=True)
    stages = [
        SQLTransformer(statement=f"SELECT *, {numeric}, {filled} FROM __THIS__"),
        *indexers,
    ]
    return [
        *stages,
        encoder.fit(PipelineModel(stages).transform(train.limit(0))),
        VectorAssembler(inputCols=[*numbers, *code], outputCol="features"),
    ]


def _fit_forest(ready: DataFrame, trees: int, depth: int, seed: int):
    """Forest on prepared rows, without the summary of its training.

    The summary holds the session; tasks that score would carry it along, and fail to
    once the session observes metrics. A copy of the model has none.
    """
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features"
    )
    return forest.fit(ready).copy()


def fit_rf(train: DataFrame, trees: int = 10, depth: int = 10, seed: int = 0) -> PipelineModel:
    """Preprocessing and random forest in one model. ``train`` is read once and kept."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = fit_preprocessing(train)
        ready = PipelineModel(stages).transform(train).select("label", "features")
        return PipelineModel([*stages, _fit_forest(ready, trees, depth, seed)])
    finally:
        train.unpersist()


def predict(df: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """``df`` with ``fraud_probability`` and ``fraud_prediction``."""
    own = df.columns
    scored = model.transform(df).withColumn(
        "fraud_probability", F.get(vector_to_array("probability"), F.lit(1))
    )
    return scored.select(
        *own, "fraud_probability", (F.col("fraud_probability") >= threshold).alias("fraud_prediction")
    )


def score(gold: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Predictions on the feature projection of ``gold``."""
    return predict(features(gold), model, threshold)


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts and percentages of hard predictions, from one aggregate.

    ``auc`` is that of the hard labels; see ``roc_auc`` for the ranked one. A ratio with
    an empty denominator is 0, ``auc`` NULL without both classes.
    """
    actual, said = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    counts = pred.agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    auc = (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2
    return counts.select(
        "tn",
        "fp",
        "fn",
        "tp",
        (ratio(tp + tn, tp + tn + fp + fn) * 100).alias("accuracy"),
        (ratio(tp, tp + fp) * 100).alias("precision"),
        (ratio(tp, tp + fn) * 100).alias("recall"),
        (ratio(2 * tp, 2 * tp + fp + fn) * 100).alias("f1"),
        (auc * 100).alias("auc"),
    )


def ranked_auc(
    scored: DataFrame, label: str = "label", score: str = "fraud_probability", parts: int = 256
) -> DataFrame:
    """(positives, negatives, auc): the ranked area under the curve, in percent, ties by half.

    Labels are counted per distinct score; those rows are dealt to ranges of the score, each
    range sums up its own, and the sums of the ranges (at most ``parts`` rows) place them behind
    each other. So no task holds all scores. ``auc`` is NULL without both classes; rows
    without label or score do not count.
    """
    positive = F.col(label).cast("int") == 1
    rows = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = rows.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranged = counts.repartitionByRange(parts, "score").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "score-ranges")  # a range keeps its number
    sums = ranged.groupBy("part").agg(F.sum("neg").alias("neg"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("below"))
    inside = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    placed = ranged.withColumn("own", own).join(F.broadcast(sums), "part")
    wins = 2 * (F.col("below") + F.col("own")) + F.col("neg")  # of each positive, in halves
    total = placed.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(F.col("pos").cast("decimal(18,0)") * wins.cast("decimal(19,0)")).alias("wins"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return total.select("positives", "negatives", F.try_divide(F.col("wins").cast("double") * 50, pairs).alias("auc"))


def roc_auc(scored: DataFrame, label: str = "label") -> float:
    """Area under the ROC curve of ``fraud_probability``."""
    return BinaryClassificationEvaluator(
        rawPredictionCol="fraud_probability", labelCol=label, metricName="areaUnderROC"
    ).evaluate(scored)


def grid_search(
    train: DataFrame, test: DataFrame, grid: Iterable[tuple[int, int]] = GRID, seed: int = 0
) -> tuple[DataFrame, dict[tuple[int, int], PipelineModel]]:
    """(one metrics row per setting, models). Features are prepared once for all fits."""
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    stages = fit_preprocessing(train)
    prep = PipelineModel(stages)
    ready = prep.transform(train).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    ready.count()
    train.unpersist()  # from here on only the prepared rows are read
    held_out = prep.transform(test).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    rows, models = [], {}
    try:
        for trees, depth in grid:
            forest = _fit_forest(ready, trees, depth, seed)
            models[trees, depth] = PipelineModel([*stages, forest])
            metrics = evaluate(forest.transform(held_out)).first().asDict()
            rows.append({"n_estimators": trees, "max_depth": depth, **metrics})
    finally:
        for kept in (ready, held_out):
            kept.unpersist()
    schema = "n_estimators int, max_depth int, tn long, fp long, fn long, tp long, " + ", ".join(
        f"{m} double" for m in ("accuracy", "precision", "recall", "f1", "auc")
    )
    return spark.createDataFrame(rows, schema), models


def best(results: DataFrame, metric: str = "f1") -> DataFrame:
    """The grid row with the highest metric (fewest trees, then least depth, on ties)."""
    return results.orderBy(F.desc(metric), "n_estimators", "max_depth").limit(1)


def importances(model: PipelineModel, scored_input: DataFrame) -> DataFrame:
    """(feature, importance) with one row per one-hot category, largest first."""
    labels = {s.getInputCol(): s.labels for s in model.stages if isinstance(s, StringIndexerModel)}
    # The assembled vector: the numbers, then each category's labels in the indexer's order.
    names = [*NUMERIC, *[f"{c}_{value}" for c in CATEGORICAL for value in labels[f"{c}_f"]]]
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, round(float(w), 3)) for name, w in zip(names, weights, strict=True)]
    return scored_input.sparkSession.createDataFrame(
        rows, "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
