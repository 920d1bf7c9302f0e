"""Additive Holt-Winters per series: a fold over the ordered values inside the JVM, and a fit of its parameters.

Given the three smoothing parameters, all errors are linear in the starting state, so the best state
is a small least squares problem and only the parameters have to be searched.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.session import materialise

ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.0, 0.1, 0.3, 0.5)
GAMMAS = (0.0, 0.1, 0.3, 0.5)


def ordered_values(df: DataFrame) -> DataFrame:
    """``(series_id, last_date, ys)``: one array per series, bounded by the calendar."""
    pairs = F.array_sort(F.collect_list(F.struct("date", "y")))
    return df.groupBy("series_id").agg(F.max("date").alias("last_date"), pairs.alias("_p")).select(
        "series_id", "last_date", F.transform("_p", lambda p: p["y"]).alias("ys"))


def _mean(values: Column, size: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / size


def first_state(ys: Column, period: int) -> Column:
    """``struct(level, trend, season, sse)`` after the first season, as its values and the second season's mean suggest."""
    first, second = F.slice(ys, 1, period), F.slice(ys, period + 1, period)
    level = _mean(first, period)
    return F.struct(
        level.alias("level"), ((_mean(second, period) - level) / period).alias("trend"),
        F.transform(first, lambda v: v - level).alias("season"), F.lit(0.0).alias("sse"))


def smooth(ys: Column, alpha: Column, beta: Column, gamma: Column, period: int) -> Column:
    """Final ``struct(level, trend, season, sse)``; the first season sets the starting state."""
    rest = F.slice(ys, F.lit(period + 1), F.size(ys) - period)
    return smooth_from(rest, first_state(ys, period), alpha, beta, gamma, period)


def smooth_from(ys: Column, start: Column, alpha: Column, beta: Column, gamma: Column, period: int) -> Column:
    """The state after ``ys`` and the squared errors on the way, from the state ``start`` before them."""

    def step(state: Column, y: Column) -> Column:
        expected = state["level"] + state["trend"]
        season = state["season"][0]
        error = y - expected - season
        new_level = alpha * (y - season) + (1 - alpha) * expected
        return F.struct(
            new_level.alias("level"),
            (beta * (new_level - state["level"]) + (1 - beta) * state["trend"]).alias("trend"),
            F.concat(F.slice(state["season"], 2, period - 1),
                     F.array(gamma * (y - expected) + (1 - gamma) * season)).alias("season"),
            (state["sse"] + error * error).alias("sse"))

    return F.aggregate(ys, start, step)


def holt_winters_fit(df: DataFrame, period: int = 4, alphas: Sequence[float] = ALPHAS,
                     betas: Sequence[float] = BETAS, gammas: Sequence[float] = GAMMAS) -> DataFrame:
    """``(series_id, last_date, alpha, beta, gamma, sse, state)`` with the smallest in-sample error.

    Every series meets every setting in the same task; only the best setting is kept. Series
    shorter than two seasons have no starting trend and get no model.
    """
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(g).alias("gamma"))
                     for a, b, g in product(alphas, betas, gammas)])
    series = ordered_values(df).filter(F.size("ys") >= 2 * period)
    tried = series.select("series_id", "last_date", "ys", F.inline(grid)).withColumn(
        "state", smooth(F.col("ys"), F.col("alpha"), F.col("beta"), F.col("gamma"), period))
    best = F.struct("alpha", "beta", "gamma", "last_date", "state")
    order = F.struct("state.sse", "alpha", "beta", "gamma")
    return tried.groupBy("series_id").agg(F.min_by(best, order).alias("m")).select(
        "series_id", "m.last_date", "m.alpha", "m.beta", "m.gamma", F.col("m.state.sse").alias("sse"), "m.state")


def holt_winters_forecast(model: DataFrame, horizon: int, period: int = 4, months: int = 3) -> DataFrame:
    """``(series_id, step, date, y_hat)`` for the periods after the last fitted one."""
    steps = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    season = F.get(F.col("state.season"), F.pmod(F.col("step") - 1, F.lit(period)))
    return steps.select(
        "series_id", "step", F.add_months("last_date", F.col("step") * months).alias("date"),
        (F.col("state.level") + F.col("step") * F.col("state.trend") + season).alias("y_hat"))


# Fit of the parameters. Steps of the search are these multiples of the last one, which is the precision of the result.
PRECISION, WIDEST = 1e-3, 128
PASS_STEPS, MAX_PASSES = 60, 20


def _errors(y: np.ndarray, known: np.ndarray, params: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, c)`` such that the squared errors are ``x a x + 2 b x + c`` for a starting state ``x``.

    ``y`` and ``known`` are series x periods, ``params`` series x settings x 3. A state is level, trend and all but the last
    of the seasons, which add up to zero. Error by error, the recursion runs once for the values from a
    state of zero and once for each part of the state.
    """
    series, settings = params.shape[:2]
    alpha, beta, gamma = (params[..., k, None] for k in range(3))
    parts = period + 2
    level, trend = np.zeros((series, settings, parts)), np.zeros((series, settings, parts))
    season = np.zeros((period, series, settings, parts))
    level[..., 1] = trend[..., 2] = 1.0
    for k in range(period - 1):
        season[k, ..., 3 + k], season[period - 1, ..., 3 + k] = 1.0, -1.0
    moments = np.zeros((series, settings, parts, parts))
    for t in range(y.shape[1]):
        error = -(level + trend + season[t % period])
        error[..., 0] += y[:, t, None]
        error *= known[:, t, None, None]
        moments += error[..., :, None] * error[..., None, :]
        level += (trend + alpha * error) * known[:, t, None, None]
        trend += alpha * beta * error
        season[t % period] += gamma * error
    return moments[..., 1:, 1:], moments[..., 1:, 0], moments[..., 0, 0]


def _best_start(y: np.ndarray, known: np.ndarray, params: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squared errors of every setting and the starting state that gives them."""
    a, b, c = _errors(y, known, params, period)
    steady = 1e-12 * np.trace(a, axis1=-2, axis2=-1)[..., None, None] * np.eye(a.shape[-1])
    x = -np.linalg.solve(a + steady, b[..., None])[..., 0]
    sse = c + 2 * (b * x).sum(axis=-1) + np.einsum("...i,...ij,...j->...", x, a, x)
    return np.maximum(sse, 0.0), x


def _search(y: np.ndarray, known: np.ndarray, params: np.ndarray, size: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moves every series' parameters to the best of the points around them, or else halves its step, ``PASS_STEPS`` times at most.

    Gives parameters, the next step (0 when no point at the last step is better) and squared errors.
    """
    around = np.array([p for p in product((-1, 0, 1), repeat=3) if any(p)], float)
    best = _best_start(y, known, params[:, None], period)[0][:, 0]
    for _ in range(PASS_STEPS):
        open_ = np.flatnonzero(size)
        if not len(open_):
            break
        points = np.clip(params[open_, None] + PRECISION * size[open_, None, None] * around, 0.0, 1.0)
        sse = _best_start(y[open_], known[open_], points, period)[0]
        nearest = sse.argmin(axis=1)
        found = sse[np.arange(len(open_)), nearest]
        better = found < best[open_] * (1 - 1e-12)
        params[open_[better]], best[open_[better]] = points[better, nearest[better]], found[better]
        size[open_[~better]] //= 2
    return params, size, best


def holt_winters_optimised(df: DataFrame, period: int = 4) -> DataFrame:
    """``(series_id, last_date, alpha, beta, gamma, start, sse, state, converged)`` with the smallest squared errors of all values.

    The starting state is estimated, as are the parameters between 0 and 1: from the best point of a coarse grid the search
    goes on in ever smaller steps, down to 0.001, until no point around is better. Series advance together, a batch in a task, and
    only those that have not ended go into the next pass. ``converged`` is false where the passes did not suffice. Null
    values are left out; series shorter than two seasons get no model. A series is bounded by the calendar.
    """
    grid = np.array(list(product(ALPHAS, BETAS, GAMMAS)))
    series = ordered_values(df.filter(F.col("y").isNotNull())).filter(F.size("ys") >= 2 * period)
    fields = "series_id string, last_date date, ys array<double>, params array<double>, size int, sse double"

    def batch(pdf: pd.DataFrame):
        lengths = pdf["ys"].map(len).to_numpy()
        known = np.arange(lengths.max()) < lengths[:, None]
        y = np.zeros(known.shape)
        y[known] = np.concatenate(list(pdf["ys"]))
        level = (y.sum(axis=1) / lengths)[:, None]
        spread_ = np.sqrt((np.where(known, y - level, 0.0) ** 2).sum(axis=1) / lengths)[:, None]
        return np.where(known, (y - level) / np.where(spread_ > 0, spread_, 1.0), 0.0), known.astype(float), level[:, 0], np.where(spread_ > 0, spread_, 1.0)[:, 0]

    def advance(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                some = pdf.iloc[at:at + 500]
                y, known, _, scale = batch(some)
                if "params" in some:
                    params, size = np.stack(list(some["params"])), some["size"].to_numpy().copy()
                else:
                    sse = _best_start(y, known, np.broadcast_to(grid, (len(some), *grid.shape)), period)[0]
                    params, size = grid[sse.argmin(axis=1)], np.full(len(some), WIDEST)
                params, size, sse = _search(y, known, params, size, period)
                yield some[["series_id", "last_date", "ys"]].assign(params=list(params), size=size.astype(np.int32), sse=sse * scale**2)

    def finish(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                some = pdf.iloc[at:at + 500]
                y, known, level, scale = batch(some)
                x = _best_start(y, known, np.stack(list(some["params"]))[:, None], period)[1][:, 0] * scale[:, None]
                seasons = np.column_stack([x[:, 2:], -x[:, 2:].sum(axis=1)])
                yield some[["series_id", "last_date", "ys", "params", "size", "sse"]].assign(level=x[:, 0] + level, trend=x[:, 1], season=list(seasons))

    now = materialise(spread(series, "series_id").mapInPandas(advance, fields), "smoothing")
    done = now.filter("size = 0")
    for _ in range(MAX_PASSES - 1):
        rest = now.filter("size > 0")
        if rest.isEmpty():
            break
        now = materialise(spread(rest, "series_id").mapInPandas(advance, fields), "smoothing")
        done = done.unionByName(now.filter("size = 0"))
    done = done.unionByName(now.filter("size > 0"))
    fitted = done.mapInPandas(finish, fields + ", level double, trend double, season array<double>")
    start = F.struct("level", "trend", "season", F.lit(0.0).alias("sse"))
    rows = fitted.select("series_id", "last_date", "ys", *[F.col("params")[k].alias(n) for k, n in enumerate(("alpha", "beta", "gamma"))],
                         start.alias("start"), (F.col("size") == 0).alias("converged"))
    state = smooth_from(F.col("ys"), F.col("start"), F.col("alpha"), F.col("beta"), F.col("gamma"), period)
    return rows.withColumn("state", state).select("series_id", "last_date", "alpha", "beta", "gamma", "start", F.col("state.sse").alias("sse"), "state", "converged")


def holt_winters(df: DataFrame, period: int = 4, optimised: bool = False) -> DataFrame:
    """Fit on the training rows, forecast the test rows: ``(series_id, date, y, y_hat)``."""
    test = df.filter("is_test").select("series_id", "date", "y")
    horizon = test.groupBy("series_id").count().agg(F.max("count")).first()[0] or 0
    if not horizon:
        return test.withColumn("y_hat", F.lit(None).cast("double"))
    fit = holt_winters_optimised if optimised else holt_winters_fit
    forecast = holt_winters_forecast(fit(df.filter(~F.col("is_test")), period), horizon, period)
    return test.join(forecast.select("series_id", "date", "y_hat"), ["series_id", "date"])
