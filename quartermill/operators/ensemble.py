"""Model comparison on walk-forward folds: stacking, parameter search, feature ablation."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.operators import histogram_trees, linear, trees
from quartermill.operators.accuracy import cv_rmse, evaluate_forecast
from quartermill.operators.forecast import Fitted
from quartermill.operators.splits import walk_forward_folds
from quartermill.session import materialise

FOLD_KEYS = ("series_id", "fold")


def training_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Walk-forward folds of the training rows; ``is_test`` marks each fold's validation block."""
    rows = walk_forward_folds(df.filter(~F.col("is_test")), folds)
    return rows.withColumn("is_test", F.col("role") == "val").drop("role")


def predict(df: DataFrame, features: Sequence[str], model: str, keys: Sequence[str] = ("series_id",),
            settings: Mapping[str, float] | None = None) -> DataFrame:
    """Test predictions of one model family; ``gbt`` and ``trees`` are pooled, the others are fitted per group."""
    if model == "trees":
        return histogram_trees.fit_predict(df, features, keys, histogram_trees.Settings(**(settings or {})))
    if model == "gbt":
        return trees.fit_predict(df, features, keys, **(settings or {}))
    return linear.fit_predict(df, features, model, keys, **(settings or {}))


def fold_predictions(folds: DataFrame, features: Sequence[str], model: str, n_folds: int,
                     settings: Mapping[str, float] | None = None) -> DataFrame:
    """``(series_id, fold, date, y, y_hat)`` of the validation blocks, each from its own past only.

    Models fitted per series and histogram trees take all folds together; Spark's trees need one fit per fold.
    """
    if model != "gbt":
        return predict(folds, features, model, FOLD_KEYS, settings)
    parts = [predict(folds.filter(F.col("fold") == k), features, model, FOLD_KEYS, settings)
             for k in range(1, n_folds + 1)]
    return reduce(DataFrame.unionByName, parts)


def second_level(df: DataFrame, features: Sequence[str], models: Mapping[str, Mapping[str, float]], n_folds: int = 5) -> DataFrame:
    """``(series_id, date, y, is_test, <model>...)``: out-of-fold predictions of training rows, plain ones of test rows.

    Rows no fold ever validates have no out-of-fold prediction and stay out of the second level.
    """
    folds = materialise(training_folds(df, n_folds), "folds")
    names = list(models)
    inner = [fold_predictions(folds, features, m, n_folds, s).select("series_id", "date", F.lit(m).alias("model"), "y_hat") for m, s in models.items()]
    outer = [predict(df, features, m, settings=s).select("series_id", "date", F.lit(m).alias("model"), "y_hat") for m, s in models.items()]
    wide = reduce(DataFrame.unionByName, inner + outer).groupBy("series_id", "date").pivot("model", names).agg(F.first("y_hat"))
    return materialise(wide.join(df.select("series_id", "date", "y", "is_test"), ["series_id", "date"]), "level_two")


def stacking(df: DataFrame, features: Sequence[str], models: Mapping[str, Mapping[str, float]],
             n_folds: int = 5, alpha: float = 1.0) -> DataFrame:
    """Ridge over the out-of-fold predictions of the base models: ``(series_id, date, y, y_hat)``."""
    return linear.fit_predict(second_level(df, features, models, n_folds), list(models), "ridge", alpha=alpha)


def stacked_forecaster(df: DataFrame, features: Sequence[str], models: Mapping[str, Mapping[str, float]], n_folds: int = 5,
                       alpha: float = 1.0) -> Fitted:
    """The stack as a model that a recursion can go on with; its base models are fitted on the training rows."""
    names = list(models)
    weights = linear.fit_coefficients(second_level(df, features, models, n_folds), names, "ridge", alpha=alpha)
    coefficients = {m: linear.fit_coefficients(df, features, m, **s) for m, s in models.items() if m != "trees"}
    forest, scales = histogram_trees.fit(df, features, histogram_trees.Settings(**models["trees"])) if "trees" in models else (None, None)
    return Fitted(tuple(features), coefficients, forest, scales, weights, tuple(names))


def random_trials(n: int, space: Mapping[str, tuple[float, float, str]], seed: int = 42) -> list[dict[str, float]]:
    """Seeded settings; a dimension is ``(low, high, "log" or "linear")``."""
    draw = random.Random(seed)

    def one(low: float, high: float, scale: str) -> float:
        if scale == "log":
            return math.exp(draw.uniform(math.log(low), math.log(high)))
        return draw.uniform(low, high)

    return [{name: one(*dim) for name, dim in space.items()} for _ in range(n)]


def param_search(df: DataFrame, features: Sequence[str], model: str, trials: Sequence[Mapping[str, float]],
                 n_folds: int = 5) -> DataFrame:
    """``(series_id, trial, <params>, cv_rmse)``: the setting with the smallest mean fold error.

    Folds are scaled once; every (series, fold) then tries all settings in one task, so the search
    spreads over the cluster like any other grouped job.
    """
    names = list(trials[0])
    scaled, _, kept = linear.prepare(training_folds(df, n_folds), features, FOLD_KEYS)
    errors = linear.solve_trials(scaled, kept, model, FOLD_KEYS, trials)
    means = errors.groupBy("series_id", "trial").agg(F.avg("rmse").alias("cv_rmse"))
    best = means.groupBy("series_id").agg(
        F.min_by("trial", F.struct("cv_rmse", "trial")).alias("trial"), F.min("cv_rmse").alias("cv_rmse"))
    settings = F.element_at(F.array(*[F.struct(*[F.lit(float(t[n])).alias(n) for n in names]) for t in trials]),
                            F.col("trial") + 1)
    return best.withColumn("_s", settings).select("series_id", "trial", *[f"_s.{n}" for n in names], "cv_rmse")


# The search space of the boosted trees, ``(low, high, scale)`` per dimension.
TREE_SPACE = {
    "maxIter": (50, 400, "linear"), "stepSize": (0.01, 0.3, "log"), "leaves": (7, 63, "linear"), "minInstancesPerNode": (5, 50, "linear"),
    "subsamplingRate": (0.5, 1.0, "linear"), "featureShare": (0.4, 1.0, "linear"), "minInfoGain": (1e-8, 1e-2, "log"), "maxBins": (16, 64, "linear"),
}


def tree_settings(trial: Mapping[str, float]) -> dict:
    """Settings of the learner from a point of the space.

    Spark's trees are bounded by depth, so a number of leaves becomes the depth that can hold them; they
    have no penalty on leaf values, for which the least gain of a split stands in.
    """
    return {
        "maxIter": round(trial["maxIter"]), "stepSize": trial["stepSize"], "maxDepth": math.ceil(math.log2(trial["leaves"])),
        "minInstancesPerNode": round(trial["minInstancesPerNode"]), "subsamplingRate": trial["subsamplingRate"],
        "featureSubsetStrategy": f"{trial['featureShare']:.6f}", "minInfoGain": trial["minInfoGain"], "maxBins": round(trial["maxBins"]),
    }


def tree_search(df: DataFrame, features: Sequence[str], trials: Sequence[Mapping[str, float]], n_folds: int = 5,
                parallelism: int = 8) -> DataFrame:
    """``(trial, <params>, cv_rmse, best)``: the mean fold error of every setting of the boosted trees.

    A pooled fit per setting and fold; ``parallelism`` of them run at once, each of them distributed. The
    trial table has one row per setting.
    """
    folds = materialise(training_folds(df, n_folds), "folds")
    ready = {k: trees.prepared(folds.filter(F.col("fold") == k), features, FOLD_KEYS)[:2] for k in range(1, n_folds + 1)}

    def error(job: tuple[int, int]) -> tuple[int, float]:
        trial, fold = job
        rows, target = ready[fold]
        model = trees.fit_prepared(rows, **tree_settings(trials[trial]))
        predicted = trees.predict_prepared(model, rows, target, FOLD_KEYS)
        return trial, cv_rmse(predicted).agg(F.avg("cv_rmse").alias("e")).first()["e"]

    jobs = [(t, k) for t in range(len(trials)) for k in range(1, n_folds + 1)]
    with ThreadPool(parallelism) as pool:
        errors = pool.map(inheritable_thread_target(df.sparkSession)(error), jobs)
    means = [sum(e for t, e in errors if t == i) / n_folds for i in range(len(trials))]
    best = min(range(len(trials)), key=lambda i: (means[i], i))
    names = list(trials[0])
    rows = [(i, *[float(t[n]) for n in names], means[i], i == best) for i, t in enumerate(trials)]
    return df.sparkSession.createDataFrame(rows, "trial int, " + ", ".join(f"{n} double" for n in names) + ", cv_rmse double, best boolean")


def exog_ablation(df: DataFrame, subsets: Mapping[str, Sequence[str]], model: str = "ridge", n_folds: int = 5,
                  settings: Mapping[str, float] | None = None, with_cv: bool = True) -> DataFrame:
    """One row per feature subset: mean metrics over the series and the change against the first.

    The verdict says whether leaving the exogenous features out lowers the error.
    """
    folds = materialise(training_folds(df, n_folds), "folds") if with_cv else None
    rows = None
    for position, (label, features) in enumerate(subsets.items()):
        scores = evaluate_forecast(predict(df, features, model, settings=settings)).agg(
            *[F.avg(m).alias(m) for m in ("mape", "rmse", "mae")])
        if with_cv:
            cv = cv_rmse(fold_predictions(folds, features, model, n_folds, settings)).agg(F.avg("cv_rmse"))
            scores = scores.withColumn("cv_rmse", cv.scalar())
        one = scores.select(F.lit(position).alias("position"), F.lit(label).alias("subset"), "*")
        rows = one if rows is None else rows.unionByName(one)
    rows = materialise(rows, "ablation")
    base = rows.filter("position = 0").select("mape").scalar()
    verdict = F.when(F.col("position") == 0, "baseline").when(
        F.col("delta_mape") < 0, "exogenous features are noise").otherwise("exogenous features help or do not matter")
    return rows.withColumn("delta_mape", F.col("mape") - base).withColumn("verdict", verdict).drop("position")
