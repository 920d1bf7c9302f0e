"""Recursive forecasts beyond the last known period."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.operators.accuracy import prediction_interval
from quartermill.operators.features import LAGS, WINDOWS
from quartermill.operators.histogram_trees import Forest
from quartermill.operators.smoothing import ordered_values

AGGREGATE_SERIES = "ALL"


def _next_features(known: np.ndarray, month: np.ndarray) -> dict[str, np.ndarray]:
    """Own-history features of the next period for many series at once (newest value last)."""
    out = {f"y_lag_{k}": known[:, -k] for k in LAGS}
    for w in WINDOWS:
        out[f"y_roll_mean_{w}"] = known[:, -w:].mean(axis=1)
        out[f"y_roll_std_{w}"] = known[:, -w:].std(axis=1, ddof=1)
    before = np.where(known[:, -5] == 0, np.nan, known[:, -5])
    out["y_yoy_pct"] = (known[:, -1] - known[:, -5]) / before * 100
    angle = 2 * math.pi * month / 12
    return out | {"month_sin": np.sin(angle), "month_cos": np.cos(angle)}


def recursive_forecast(panel: DataFrame, coefficients: DataFrame, horizon: int, months: int = 3) -> DataFrame:
    """``(series_id, step, date, y_hat)`` for ``horizon`` periods after each series' last row.

    Every step first adds the future period, computes its features from the values known or
    predicted so far, then predicts; dates advance by the panel's own spacing. One row per series
    carries the last few values, and an Arrow batch of series advances together. Coefficients of
    features that are not own history apply to the last known value of that column, carried forward.
    """
    names = [c[2:] for c in coefficients.columns if c.startswith("b_")]
    own = [n for n in names if n.startswith(("y_lag_", "y_roll_", "y_yoy_", "month_"))]
    carried = [n for n in names if n not in own]
    # the longest lag or window bounds what a step can see
    reach = max(*LAGS, *WINDOWS, 5)
    state = ordered_values(panel).withColumn(
        "_tail", F.when(F.size("ys") > reach, F.slice("ys", -reach, reach)).otherwise(F.col("ys"))).drop("ys")
    if carried:
        last = panel.groupBy("series_id").agg(
            *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("date"))).alias(f"_x_{c}") for c in carried])
        state = state.join(last, "series_id")
    constant = F.col("intercept")
    for c in carried:
        constant = constant + F.col(f"b_{c}") * F.coalesce(f"_x_{c}", F.lit(0.0))
    rows = state.join(coefficients, "series_id").select(
        "series_id", "last_date", "_tail", constant.alias("_constant"), F.array(*[f"b_{n}" for n in own]).alias("_b"))

    @F.pandas_udf("array<double>")
    def advance(tail: pd.Series, month: pd.Series, start: pd.Series, weights: pd.Series) -> pd.Series:
        if len(tail) == 0:
            return pd.Series([], dtype=object)
        known = np.full((len(tail), reach), np.nan)
        for i, values in enumerate(tail):
            known[i, reach - len(values):] = values
        b = np.stack([np.asarray(w, dtype=float) for w in weights])
        for step in range(1, horizon + 1):
            ahead = (month.to_numpy() - 1 + step * months) % 12 + 1
            features = _next_features(known[:, -reach:], ahead)
            x = np.column_stack([features[n] for n in own])
            known = np.column_stack([known, start.to_numpy() + (x * b).sum(axis=1)])
        return pd.Series(list(known[:, -horizon:]))

    path = advance("_tail", F.month("last_date"), "_constant", "_b")
    points = rows.withColumn("_points", path).select("series_id", "last_date", F.posexplode("_points").alias("_i", "y_hat"))
    return points.select(
        "series_id", (F.col("_i") + 1).alias("step"),
        F.add_months("last_date", (F.col("_i") + 1) * months).alias("date"),
        F.nanvl("y_hat", F.lit(None).cast("double")).alias("y_hat"))


@dataclass(frozen=True)
class Fitted:
    """A forecaster of any kind as the recursion needs it; every table has one row for each series.

    ``linear`` are models ``(series_id, intercept, b_<feature>)`` in raw units, ``forest`` is one for scaled values, whose scaling
    is in ``scales`` ``(series_id, _mean_<c>, _std_<c>)`` for the features and y. With ``stack``, a model of the same form as
    the linear ones whose features are ``names``, it weighs the others; without, there is one model only.
    """

    features: tuple[str, ...]
    linear: Mapping[str, DataFrame] = field(default_factory=dict)
    forest: Forest | None = None
    scales: DataFrame | None = None
    stack: DataFrame | None = None
    names: tuple[str, ...] = ()


def recursive_fitted(panel: DataFrame, model: Fitted, horizon: int, months: int = 3) -> DataFrame:
    """``(series_id, step, date, y_hat)``: as :func:`recursive_forecast`, with trees, linear models or a stack of them.

    Features that are not own history keep their last known value. A linear model takes a missing one for zero, as
    :func:`recursive_forecast` does, a tree goes the way it learned for missing values. Series without a model get null.
    """
    features, reach = model.features, max(*LAGS, *WINDOWS, 5)
    own = [n for n in features if n.startswith(("y_lag_", "y_roll_", "y_yoy_", "month_"))]
    carried = [n for n in features if n not in own]
    state = ordered_values(panel).withColumn("_tail", F.when(F.size("ys") > reach, F.slice("ys", -reach, reach)).otherwise(F.col("ys"))).drop("ys")
    kept = panel.groupBy("series_id").agg(F.count(F.lit(1)).alias("_n"), *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("date"))).alias(f"_x_{c}") for c in carried])
    rows = state.join(kept, "series_id")
    double = lambda names: F.array(*[F.col(n).cast("double") for n in names]).cast("array<double>")
    rows = rows.select("series_id", "last_date", "_tail", double([f"_x_{c}" for c in carried]).alias("_carried"))
    tables = [(f"_l_{k}", table, ["intercept", *[f"b_{n}" for n in features]]) for k, table in enumerate(model.linear.values())]
    if model.scales is not None:
        tables.append(("_scales", model.scales, [f"_{part}_{c}" for c in (*features, "y") for part in ("mean", "std")]))
    if model.stack is not None:
        tables.append(("_stack", model.stack, ["intercept", *[f"b_{n}" for n in model.names]]))
    for name, table, columns in tables:
        rows = rows.join(table.select("series_id", double([c for c in columns if c in table.columns]).alias(name)), "series_id", "left")
        missing = [c for c in columns if c not in table.columns]
        if missing:  # a feature that is empty in training has no column there
            raise ValueError(f"{name} lacks {missing}")
    kinds, forest, model_names, widths = list(model.linear), model.forest, model.names, [(name, len(columns)) for name, _, columns in tables]
    order = {n: k for k, n in enumerate(features)}

    def filled(values: pd.Series, size: int) -> np.ndarray:
        return np.array([[np.nan] * size if v is None else [np.nan if e is None else e for e in v] for v in values], float).reshape(len(values), size)

    @F.pandas_udf("array<double>")
    def advance(tail: pd.Series, month: pd.Series, fixed: pd.Series, numbers: pd.DataFrame) -> pd.Series:
        if len(tail) == 0:
            return pd.Series([], dtype=object)
        known = np.full((len(tail), reach), np.nan)
        for i, values in enumerate(tail):
            known[i, reach - len(values):] = values
        x = np.full((len(tail), len(features)), np.nan)
        x[:, [order[c] for c in carried]] = filled(fixed, len(carried))
        given = {name: filled(numbers[name], width) for name, width in widths}
        for step in range(1, horizon + 1):
            ahead = (month.to_numpy() - 1 + step * months) % 12 + 1
            now = _next_features(known[:, -reach:], ahead)
            for name in own:
                x[:, order[name]] = now[name]
            zeroed = np.where(np.isnan(x) & np.isin(features, carried), 0.0, x)
            said = {kind: given[f"_l_{k}"][:, 0] + (zeroed * given[f"_l_{k}"][:, 1:]).sum(axis=1) for k, kind in enumerate(kinds)}
            if forest is not None:
                mean, std = given["_scales"][:, 0::2], given["_scales"][:, 1::2]
                said["trees"] = forest.predict((x - mean[:, :-1]) / std[:, :-1]) * std[:, -1] + mean[:, -1]
            if "_stack" in given:
                value = given["_stack"][:, 0] + (np.column_stack([said[n] for n in model_names]) * given["_stack"][:, 1:]).sum(axis=1)
            else:
                (value,) = said.values()
            known = np.column_stack([known, value])
        return pd.Series(list(known[:, -horizon:]))

    path = advance("_tail", F.month("last_date"), "_carried", F.struct(*[F.col(name) for name, _ in widths]))
    points = rows.withColumn("_points", path).select("series_id", "last_date", F.posexplode("_points").alias("_i", "y_hat"))
    return points.select("series_id", (F.col("_i") + 1).alias("step"), F.add_months("last_date", (F.col("_i") + 1) * months).alias("date"),
                         F.nanvl("y_hat", F.lit(None).cast("double")).alias("y_hat"))


def with_interval(forecast: DataFrame, errors: DataFrame) -> DataFrame:
    """80 % interval from each series' test error ``(series_id, rmse)``."""
    return prediction_interval(forecast.join(errors.select("series_id", "rmse"), "series_id", "left")).drop("rmse")


def append_forecast(panel: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and predicted rows in one table, marked by ``predicted``."""
    known = panel.select("series_id", "date", "y", F.lit(False).alias("predicted"))
    return known.unionByName(forecast.select("series_id", "date", F.col("y_hat").alias("y"), F.lit(True).alias("predicted")))


def with_aggregate_series(panel: DataFrame) -> DataFrame:
    """The panel plus one series that sums all others per period."""
    total = panel.groupBy("date").agg(F.sum(F.col("y").cast("decimal(28,2)")).cast("double").alias("y"))
    return panel.select("series_id", "date", "y").unionByName(
        total.select(F.lit(AGGREGATE_SERIES).alias("series_id"), "date", "y"))


def forecast_all_series(forecast: DataFrame, wanted: DataFrame) -> DataFrame:
    """Forecast rows for every wanted series; an unknown one gets the aggregate series' forecast.

    ``forecast`` must cover :data:`AGGREGATE_SERIES`.
    """
    known = forecast.select("series_id").distinct().withColumn("source_id", F.col("series_id"))
    source = wanted.select("series_id").distinct().join(known, "series_id", "left").withColumn(
        "source_id", F.coalesce("source_id", F.lit(AGGREGATE_SERIES)))
    return source.join(forecast.withColumnRenamed("series_id", "source_id"), "source_id")
