"""Search of parameters that learns from the trials made so far.

Trials are split at a quantile of their errors. New ones are drawn where good trials are dense and the others are not: from
a mixture of kernels around the good ones, the draws with the largest ratio of both densities are tried next. A batch is
tried at once, and only those of its trials that do well on the first folds go on to the rest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.operators import linear
from quartermill.operators.ensemble import FOLD_KEYS, training_folds
from quartermill.session import materialise

Space = Mapping[str, tuple[float, float, str]]
#: Share of the trials that count as good, draws for each new trial, bounds of a kernel's width.
GOOD, DRAWS, NARROWEST, WIDEST = 0.2, 8, 0.15, 0.3


def to_setting(point: np.ndarray, space: Space) -> dict[str, float]:
    """A point of the unit cube as a setting."""
    out = {}
    for x, (name, (low, high, scale)) in zip(point, space.items()):
        out[name] = math.exp(math.log(low) + x * (math.log(high) - math.log(low))) if scale == "log" else low + x * (high - low)
    return out


def _density(points: np.ndarray, centres: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Log of a mixture of kernels around the centres and an even part, dimension by dimension."""
    gap = (points[:, None, :] - centres[None]) / width
    kernels = np.exp(-0.5 * gap**2) / (width * math.sqrt(2 * math.pi))
    return np.log((kernels.sum(axis=1) + 1) / (len(centres) + 1)).sum(axis=1)


def propose(points: np.ndarray, errors: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` new points of the unit cube from the trials so far; without a good and a bad one, even draws."""
    dims = points.shape[1]
    if len(points) < 4:
        return rng.random((n, dims))
    order = np.argsort(errors, kind="stable")
    cut = max(2, math.ceil(GOOD * len(points)))
    good, rest = points[order[:cut]], points[order[cut:]]
    width = lambda own: np.clip(own.std(axis=0) * len(own) ** (-1 / (dims + 4)), NARROWEST, WIDEST)
    wide, broad = width(good), width(rest)
    out = np.zeros((0, dims))
    for _ in range(n):
        centre = good[rng.integers(len(good), size=DRAWS)]
        drawn = np.abs(centre + rng.normal(size=(DRAWS, dims)) * wide)
        drawn = np.clip(np.where(drawn > 1, 2 - drawn, drawn), 0.0, 1.0)
        ratio = _density(drawn, good, wide) - _density(drawn, rest, broad)
        out = np.concatenate([out, drawn[[int(np.argmax(ratio))]]])
    return out


def search(errors_of: Callable[[Sequence[Mapping[str, float]], Sequence[int]], np.ndarray], space: Space, folds: int, trials: int = 30, batch: int = 10,
           seed: int = 42, first: int = 2) -> list[dict]:
    """``trials`` trials as ``{trial, setting, error, folds}``, best first; ``folds`` says how many of them a trial was tried on.

    ``errors_of(settings, folds)`` gives an error for every setting and fold. After the first batch a trial whose mean over the ``first`` folds
    is above the median of all trials so far stops there.
    """
    rng = np.random.default_rng(seed)
    points, means, short, used = np.zeros((0, len(space))), np.zeros(0), np.zeros(0), []
    settings: list[dict[str, float]] = []
    every = list(range(1, folds + 1))
    while len(settings) < trials:
        new = propose(points, means, min(batch, trials - len(settings)), rng)
        made = [to_setting(p, space) for p in new]
        begun = errors_of(made, every[:first]).reshape(len(made), -1)
        early = begun.mean(axis=1)
        go = np.ones(len(made), bool) if not len(short) else early <= np.median(np.concatenate([short, early]))
        total = early.copy()
        if go.any() and folds > first:
            rest = errors_of([m for m, g in zip(made, go) if g], every[first:]).reshape(int(go.sum()), -1)
            total[go] = np.concatenate([begun[go], rest], axis=1).mean(axis=1)
        # A stopped trial counts as bad as its first folds are against those of the trials that went on.
        if len(means) and (~go).any():
            total[~go] = np.maximum(total[~go], np.median(means))
        points, means, short = np.concatenate([points, new]), np.concatenate([means, total]), np.concatenate([short, early])
        settings += made
        used += [folds if g or folds <= first else first for g in go]
    rows = [{"trial": k, "setting": s, "error": float(e), "folds": n} for k, (s, e, n) in enumerate(zip(settings, means, used))]
    return sorted(rows, key=lambda r: (r["folds"] < folds, r["error"], r["trial"]))


def linear_search(df: DataFrame, features: Sequence[str], model: str, space: Space, trials: int = 30, batch: int = 10, n_folds: int = 5, seed: int = 42) -> DataFrame:
    """``(trial, <params>, folds, cv_rmse, best)`` of a model that is fitted per series, by its mean fold error over the series.

    Folds are scaled once; each batch is one job over all series and folds, whose errors are averaged before they come to the driver. Series
    are weighed by the mean of their values, so that large ones don't decide alone.
    """
    names = list(space)
    scaled, _, kept = linear.prepare(training_folds(df, n_folds), features, FOLD_KEYS)
    scaled = materialise(scaled, "search_folds")
    level = scaled.groupBy("series_id").agg(F.avg(F.abs("y")).alias("_level"))

    def errors_of(settings: Sequence[Mapping[str, float]], folds: Sequence[int]) -> np.ndarray:
        own = linear.solve_trials(scaled.filter(F.col("fold").isin(list(folds))), kept, model, FOLD_KEYS, settings)
        means = own.join(level, "series_id").groupBy("trial", "fold").agg(F.avg(F.try_divide("rmse", "_level")).alias("e"), F.avg("rmse").alias("r")).collect()  # trials x folds
        out = np.full((len(settings), len(folds)), np.inf)
        for r in means:
            out[r["trial"], list(folds).index(r["fold"])] = r["e"]
        return out

    found = search(errors_of, space, n_folds, trials, batch, seed)
    rows = [(r["trial"], *[float(r["setting"][n]) for n in names], r["folds"], r["error"], k == 0) for k, r in enumerate(found)]
    return df.sparkSession.createDataFrame(rows, "trial int, " + ", ".join(f"{n} double" for n in names) + ", folds int, cv_rmse double, best boolean")
