"""Trend with chosen changes of slope, plus a season, per series.

Many candidate changes are spread over the training rows, and an absolute penalty on their sizes keeps most of them at zero;
level, slope and season are not penalised. Projecting the unpenalised columns out leaves a small lasso, solved by
coordinate descent. The penalty is that of a Laplace prior: it follows from the noise, which is estimated along with the fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.operators.linear import _key_schema
from quartermill.operators.scaling import SERIES

CANDIDATES, HARMONICS = 25, 2
#: Share of the training rows that candidates are spread over, scale of the prior (values are divided by their largest), rounds for the noise.
SHARE, PRIOR, NOISE_ROUNDS = 0.8, 0.05, 5
MAX_SWEEPS, CHECK, STEADY = 40_000, 25, 1e-12
PATHS = 400


def design(df: DataFrame, candidates: int = CANDIDATES, harmonics: int = HARMONICS, keys: Sequence[str] = SERIES) -> tuple[DataFrame, list[str], list[str]]:
    """``(rows, free, penalised)``: time from 0 at the first to 1 at the last training row, the season, and a hinge for each candidate."""
    series = Window.partitionBy(*keys)
    n = F.sum((~F.col("is_test")).cast("int")).over(series)
    rows = df.withColumn("t", (F.row_number().over(series.orderBy("date")) - 1) / F.greatest(n - 1, F.lit(1)))
    waves = {}
    for k in range(1, harmonics + 1):
        angle = F.lit(2 * math.pi * k) * (F.month("date") - 1) / 12
        waves |= {f"season_sin_{k}": F.sin(angle), f"season_cos_{k}": F.cos(angle)}
    hinges = {f"hinge_{j}": F.greatest(F.lit(0.0), F.col("t") - SHARE * j / (candidates + 1)) for j in range(1, candidates + 1)}
    return rows.withColumns(waves | hinges), ["t", *waves], list(hinges)


def lasso(x: np.ndarray, y: np.ndarray, threshold: float, start: np.ndarray | None = None) -> tuple[np.ndarray, bool]:
    """Weights of half the mean squared error plus ``threshold`` times their absolute sum, and whether they are the optimum.

    Sweeps over the coordinates find which weights are not zero; given these and their signs, the weights are the solution of a
    linear system, which is taken once it keeps the signs and leaves no gradient above the threshold.
    """
    moments, target, w = x.T @ x / len(y), x.T @ y / len(y), np.zeros(x.shape[1]) if start is None else start.copy()
    usable = np.flatnonzero(np.diag(moments) > 1e-14)
    for sweep in range(MAX_SWEEPS):
        for j in usable:
            partial = target[j] - moments[j] @ w + moments[j, j] * w[j]
            w[j] = np.sign(partial) * max(abs(partial) - threshold, 0.0) / moments[j, j]
        if sweep % CHECK == CHECK - 1:
            used = np.flatnonzero(w)
            exact = np.zeros_like(w)
            if len(used):
                exact[used] = np.linalg.lstsq(moments[np.ix_(used, used)], target[used] - threshold * np.sign(w[used]), rcond=None)[0]
            gradient = np.abs(target - moments @ exact)[usable]
            if (np.sign(exact[used]) == np.sign(w[used])).all() and (gradient <= threshold * (1 + 1e-9) + STEADY).all():
                return exact, True
    return w, False


def _fit_one(free: np.ndarray, hinges: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, bool]:
    """Free weights, slope changes, noise, threshold and whether it converged, for values of the order of 1."""
    q = np.linalg.svd(free, full_matrices=False)[0][:, :np.linalg.matrix_rank(free)]
    bare_y, bare_x = y - q @ (q.T @ y), hinges - q @ (q.T @ hinges)
    noise, w = float((bare_y**2).mean()), None
    for _ in range(NOISE_ROUNDS):
        threshold = noise / (PRIOR * len(y))
        w, ended = lasso(bare_x, bare_y, threshold, w)
        left = bare_y - bare_x @ w
        noise = max(float((left**2).mean()), 1e-12)
    base = np.linalg.lstsq(free, y - hinges @ w, rcond=None)[0]
    return base, w, math.sqrt(noise), threshold, ended


def fit_predict(df: DataFrame, keys: Sequence[str] = SERIES, seed: int = 42) -> DataFrame:
    """``(keys, date, y, y_hat, lower_80, upper_80, n_changes, threshold, converged, weights)`` of the test rows.

    ``weights`` are those of level, time, season and hinges, in the units of y. The interval adds future changes, as often and as large as
    those that were found, to the noise. Null values of training rows are left out; a series without any gets null forecasts. A
    series is bounded by the calendar.
    """
    rows, free, hinges = design(df, keys=keys)
    keys = list(keys)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        train, test = pdf[~pdf["is_test"] & pdf["y"].notna()], pdf[pdf["is_test"]]
        out = test[[*keys, "date", "y"]].copy()
        if train.empty:
            return out.assign(y_hat=None, lower_80=None, upper_80=None, n_changes=0, threshold=None, converged=False, weights=None)
        y = train["y"].to_numpy(float)
        scale = float(np.abs(y).max()) or 1.0
        columns = lambda part: np.column_stack([np.ones(len(part)), part[free].to_numpy(float)])
        base, w, noise, threshold, ended = _fit_one(columns(train), train[hinges].to_numpy(float), y / scale)
        path = columns(test) @ base + test[hinges].to_numpy(float) @ w
        found = w[np.abs(w) > 1e-9]
        rng = np.random.default_rng(seed)
        ahead, step = test["t"].to_numpy(float), 1 / max(len(train) - 1, 1)
        size = float(np.abs(found).mean()) if len(found) else 0.0
        change = rng.laplace(0, size, (PATHS, len(ahead))) * (rng.random((PATHS, len(ahead))) < len(found) / max(len(train) * SHARE, 1)) if size else np.zeros((PATHS, len(ahead)))
        drift = np.cumsum(np.cumsum(change, axis=1), axis=1) * step
        low, high = np.quantile(path + drift + rng.normal(0, noise, drift.shape), [0.1, 0.9], axis=0)
        weights = (np.concatenate([base, w]) * scale).tolist()
        return out.assign(y_hat=path * scale, lower_80=low * scale, upper_80=high * scale, n_changes=len(found), threshold=threshold * scale, converged=ended,
                          weights=[weights] * len(out))

    schema = f"{_key_schema(df, keys)}, date date, y double, y_hat double, lower_80 double, upper_80 double, n_changes int, threshold double, converged boolean, weights array<double>"
    picked = rows.select(*keys, "date", "y", "is_test", *free, *hinges)
    return spread(picked, *keys).groupBy(*keys).applyInPandas(one, schema)
