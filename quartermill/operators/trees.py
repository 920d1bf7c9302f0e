"""Gradient-boosted trees over the pooled panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.operators.linear import prepare
from quartermill.operators.scaling import SERIES, inverse_zscore, zscore, zscore_stats
from quartermill.session import materialise

# Settings of the untuned model.
DEFAULTS = {"maxIter": 200, "stepSize": 0.05, "maxDepth": 3, "minInstancesPerNode": 15,
            "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}


def _assembled(df: DataFrame, features: Sequence[str], keys: Sequence[str]):
    """Scaled features and target per series, so that one forest serves series of any level."""
    scaled, _, kept = prepare(df, features, keys)
    target = zscore_stats(df, ["y"], ~F.col("is_test"), keys)
    labelled = zscore(scaled.withColumn("actual", F.col("y")), ["y"], ~F.col("is_test"), keys)
    return VectorAssembler(inputCols=kept, outputCol="x").transform(labelled), target, kept


def last_block(df: DataFrame, keys: Sequence[str] = SERIES, folds: int = 5) -> DataFrame:
    """Adds ``_stop``: true for the last walk-forward block of each series' training rows.

    The block has n // (folds + 1) of its n training rows, as the last fold validates.
    """
    series = Window.partitionBy(*keys, "is_test")
    place = F.row_number().over(series.orderBy(F.desc("date")))
    size = F.floor(F.count(F.lit(1)).over(series) / (folds + 1))
    return df.withColumn("_stop", ~F.col("is_test") & (place <= size))


def fit(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES, early_stopping: bool = True,
        **settings) -> tuple[GBTRegressionModel, DataFrame, DataFrame, list[str]]:
    """``(model, prepared rows, target statistics, features)``.

    With ``early_stopping``, the last walk-forward block of the training rows decides when boosting
    ends; the trees learn from the rows before it.
    """
    rows, target, kept = prepared(df, features, keys)
    return fit_prepared(rows, early_stopping, **settings), rows, target, kept


def prepared(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES) -> tuple[DataFrame, DataFrame, list[str]]:
    """``(rows, target statistics, features)``, written once for any number of fits."""
    rows, target, kept = _assembled(df, features, keys)
    return materialise(last_block(rows, keys), "boosting"), target, kept


def fit_prepared(rows: DataFrame, early_stopping: bool = True, **settings) -> GBTRegressionModel:
    learner = GBTRegressor(featuresCol="x", labelCol="y", predictionCol="y_hat", **{**DEFAULTS, **settings})
    train = rows.filter(~F.col("is_test"))
    if early_stopping and not train.filter("_stop").isEmpty():
        learner = learner.setValidationIndicatorCol("_stop")
    return learner.fit(train)


def fit_predict(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES, **settings) -> DataFrame:
    """``(keys, date, y, y_hat)`` for the test rows, in the units of y."""
    model, rows, target, _ = fit(df, features, keys, **settings)
    return predict_prepared(model, rows, target, keys)


def predict_prepared(model: GBTRegressionModel, rows: DataFrame, target: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    predicted = model.transform(rows.filter("is_test")).select(*keys, "date", F.col("actual").alias("y"), "y_hat")
    return inverse_zscore(predicted, target, {"y_hat": "y"}, keys)


def importance(model: GBTRegressionModel, features: Sequence[str], spark, top: int = 20) -> DataFrame:
    """``(feature, importance)`` of the most important features; one row per feature, so tiny."""
    weights = model.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights, strict=True)]
    listing = spark.createDataFrame(rows, "feature string, importance double")
    return listing.orderBy(F.desc("importance"), "feature").limit(top)
