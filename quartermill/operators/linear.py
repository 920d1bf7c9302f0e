"""Linear forecasters fitted per series.

Imputing and scaling are Spark aggregates; only the p x p solve runs in Python, one task per group.
A group is one series (or one series and fold), bounded by the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.operators.scaling import SERIES, impute_median, zscore, zscore_stats
from quartermill.session import materialise

RIDGE_ALPHA = 1.0
ELASTICNET_ALPHA, ELASTICNET_L1_RATIO = 1.0, 0.5
MAX_SWEEPS, SWEEP_TOLERANCE = 5000, 1e-6
TINY = 1e-12


def solve_ridge(x: np.ndarray, y: np.ndarray, alpha: float | np.ndarray = RIDGE_ALPHA) -> np.ndarray:
    """Coefficients for centred x and y: squared error + alpha * |w|^2, one row per alpha."""
    values, vectors = np.linalg.eigh(x.T @ x)
    target = vectors.T @ (x.T @ y)
    return (target / (np.maximum(values, 0.0) + np.atleast_1d(alpha)[:, None])) @ vectors.T


def solve_elasticnet(x: np.ndarray, y: np.ndarray, alpha: float | np.ndarray = ELASTICNET_ALPHA,
                     l1_ratio: float | np.ndarray = ELASTICNET_L1_RATIO) -> np.ndarray:
    """Coordinate descent on half the mean squared error + alpha (rho |w|_1 + (1 - rho)/2 |w|^2).

    One row of coefficients per setting; all settings advance together, coordinate by coordinate.
    """
    alpha, l1_ratio = np.broadcast_arrays(np.atleast_1d(alpha), np.atleast_1d(l1_ratio))
    moments, target = x.T @ x / len(y), x.T @ y / len(y)
    threshold, shrink = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros((len(alpha), x.shape[1]))
    for _ in range(MAX_SWEEPS):
        before = w.copy()
        for j in range(x.shape[1]):
            partial = target[j] - w @ moments[j] + moments[j, j] * w[:, j]
            size = np.maximum(np.abs(partial) - threshold, 0.0)
            w[:, j] = np.sign(partial) * size / np.maximum(moments[j, j] + shrink, TINY)
        limit = np.maximum(np.abs(w).max(axis=1, initial=0.0), TINY)
        if np.all(np.abs(w - before).max(axis=1, initial=0.0) <= SWEEP_TOLERANCE * limit):
            break
    return w


SOLVERS = {"ridge": solve_ridge, "elasticnet": solve_elasticnet}


def prepare(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES) -> tuple[DataFrame, DataFrame, list[str]]:
    """Median-impute and z-score with training statistics: ``(scaled, stats, kept features)``.

    A small aggregate over ``df`` runs at once to find empty features, so pass a stored table when
    its rows are expensive.
    """
    train = ~F.col("is_test")
    filled = impute_median(df, features, train, keys)
    kept = [c for c in features if c in filled.columns]
    stats = zscore_stats(filled, kept, train, keys)
    scaled = zscore(filled, kept, train, keys)
    # a column one series never knows in training has no statistics there and adds nothing
    return scaled.fillna(0.0, subset=kept), stats.fillna({f"_std_{c}": 1.0 for c in kept}).fillna(
        {f"_mean_{c}": 0.0 for c in kept}), kept


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def solve_groups(scaled: DataFrame, features: Sequence[str], model: str, keys: Sequence[str],
                 **fixed: float) -> DataFrame:
    """``(keys, date, y, y_hat)`` for the test rows of prepared groups."""
    solver = SOLVERS[model]
    keys, features = list(keys), list(features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        train, test = pdf[~pdf["is_test"]], pdf[pdf["is_test"]].sort_values("date")
        out = test[[*keys, "date", "y"]].copy()
        if train.empty:
            out["y_hat"] = np.nan
            return out
        level = train["y"].mean()
        w = solver(train[features].to_numpy(float), train["y"].to_numpy(float) - level, **fixed)[0]
        out["y_hat"] = test[features].to_numpy(float) @ w + level
        return out

    schema = f"{_key_schema(scaled, keys)}, date date, y double, y_hat double"
    rows = scaled.select(*keys, "date", "y", "is_test", *features)
    fitted = spread(rows, *keys).groupBy(*keys).applyInPandas(fit, schema)
    return fitted.withColumn("y_hat", F.nanvl("y_hat", F.lit(None).cast("double")))


def solve_trials(scaled: DataFrame, features: Sequence[str], model: str, keys: Sequence[str],
                 trials: Sequence[Mapping[str, float]]) -> DataFrame:
    """``(keys, trial, rmse)``: test error of every setting on every prepared group.

    The settings travel with the task, so a group's rows are shuffled once for all of them.
    """
    solver = SOLVERS[model]
    keys, features, n_trials = list(keys), list(features), len(trials)
    settings = {name: np.array([float(t[name]) for t in trials]) for name in trials[0]}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        train, test = pdf[~pdf["is_test"]], pdf[pdf["is_test"]]
        first = [pdf[k].iloc[0] for k in keys]
        if train.empty or test.empty:
            return pd.DataFrame(columns=[*keys, "trial", "rmse"])
        x, y = train[features].to_numpy(float), train["y"].to_numpy(float)
        ahead, actual = test[features].to_numpy(float), test["y"].to_numpy(float)
        level = y.mean()
        error = solver(x, y - level, **settings) @ ahead.T + level - actual
        out = pd.DataFrame({"trial": np.arange(n_trials), "rmse": np.sqrt((error * error).mean(axis=1))})
        return out.assign(**dict(zip(keys, first, strict=True)))[[*keys, "trial", "rmse"]]

    schema = f"{_key_schema(scaled, keys)}, trial int, rmse double"
    rows = spread(scaled.select(*keys, "y", "is_test", *features), *keys)
    return rows.groupBy(*keys).applyInPandas(fit, schema)


def fit_predict(df: DataFrame, features: Sequence[str], model: str = "ridge", keys: Sequence[str] = SERIES,
                **fixed: float) -> DataFrame:
    """``(keys, date, y, y_hat)`` for the test rows of every group; ``df`` needs ``is_test``."""
    scaled, _, kept = prepare(df, features, keys)
    return solve_groups(scaled, kept, model, keys, **fixed)


def fit_coefficients(df: DataFrame, features: Sequence[str], model: str = "ridge", **fixed: float) -> DataFrame:
    """``(series_id, intercept, b_<feature>...)`` in the units of the raw features."""
    scaled, stats, kept = prepare(df, features)
    solver = SOLVERS[model]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        train = pdf[~pdf["is_test"]]
        level = train["y"].mean()
        w = solver(train[kept].to_numpy(float), train["y"].to_numpy(float) - level, **fixed)[0]
        return pd.DataFrame([[pdf["series_id"].iloc[0], level, *w]], columns=["series_id", "level", *kept])

    schema = "series_id string, level double, " + ", ".join(f"{c} double" for c in kept)
    rows = spread(scaled.select("series_id", "date", "y", "is_test", *kept), "series_id")
    fitted = rows.groupBy("series_id").applyInPandas(fit, schema)
    joined = fitted.join(stats, "series_id")
    raw = {c: F.col(c) / F.col(f"_std_{c}") for c in kept}
    intercept = F.col("level")
    for c in kept:
        intercept = intercept - raw[c] * F.col(f"_mean_{c}")
    model = joined.select("series_id", intercept.alias("intercept"), *[raw[c].alias(f"b_{c}") for c in kept])
    # a fitted model is a small table; storing it also keeps plans that use it short
    return materialise(model, "coefficients")


def trend_season_design(df: DataFrame, hinges: int = 5, harmonics: int = 2) -> tuple[DataFrame, list[str]]:
    """Columns of an additive trend and season model: time, slope changes, yearly waves.

    Time is scaled by the training length; slope changes are spread over the first 80 % of it.
    """
    order = Window.partitionBy("series_id").orderBy("date")
    n_train = F.sum((~F.col("is_test")).cast("int")).over(Window.partitionBy("series_id"))
    t = (F.row_number().over(order) - 1) / F.greatest(n_train - 1, F.lit(1))
    out = df.withColumn("t", t)
    columns = {f"hinge_{j}": F.greatest(F.lit(0.0), F.col("t") - 0.8 * j / (hinges + 1)) for j in range(1, hinges + 1)}
    for k in range(1, harmonics + 1):
        angle = F.lit(2 * math.pi * k) * (F.month("date") - 1) / 12
        columns |= {f"season_sin_{k}": F.sin(angle), f"season_cos_{k}": F.cos(angle)}
    return out.withColumns(columns), ["t", *columns]


def trend_season_fit_predict(df: DataFrame, hinges: int = 5, harmonics: int = 2, alpha: float = 0.1) -> DataFrame:
    """Least squares on the trend and season columns, lightly penalised to keep slope changes small."""
    design, names = trend_season_design(df, hinges, harmonics)
    return fit_predict(design, names, "ridge", alpha=alpha)


def seasonal_ar_terms(df: DataFrame, season: int = 4) -> DataFrame:
    """Adds ``z``, the series differenced once and seasonally, and its lags 1 and ``season``."""
    order = Window.partitionBy("series_id").orderBy("date")
    z = (F.col("y") - F.lag("y", 1).over(order)) - (F.lag("y", season).over(order) - F.lag("y", season + 1).over(order))
    base = F.lag("y", 1).over(order) + F.lag("y", season).over(order) - F.lag("y", season + 1).over(order)
    return df.withColumns({"z": z, "base": base}).withColumns(
        {"z1": F.lag("z", 1).over(order), "zs": F.lag("z", season).over(order)})


def seasonal_ar_coefficients(df: DataFrame, season: int = 4) -> DataFrame:
    """``(series_id, phi_1, phi_s)``: least squares of z on its two lags over the training rows.

    The 2 x 2 normal equations are five sums per series, solved in closed form. A singular system
    gives NULL coefficients.
    """
    rows = seasonal_ar_terms(df, season).filter(~F.col("is_test") & F.col("zs").isNotNull())
    sums = rows.groupBy("series_id").agg(
        F.sum(F.col("z1") * F.col("z1")).alias("a"), F.sum(F.col("z1") * F.col("zs")).alias("b"),
        F.sum(F.col("zs") * F.col("zs")).alias("c"), F.sum(F.col("z1") * F.col("z")).alias("d"),
        F.sum(F.col("zs") * F.col("z")).alias("e"))
    det = F.col("a") * F.col("c") - F.col("b") * F.col("b")
    return sums.select(
        "series_id",
        F.try_divide(F.col("c") * F.col("d") - F.col("b") * F.col("e"), det).alias("phi_1"),
        F.try_divide(F.col("a") * F.col("e") - F.col("b") * F.col("d"), det).alias("phi_s"))
