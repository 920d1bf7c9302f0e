"""Forecast accuracy: every metric is one grouped aggregate over ``(y, y_hat)``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 1e-8
INTERVAL_Z = 1.28
INTERVAL_FALLBACK = 0.05


def rmse(y: str = "y", y_hat: str = "y_hat") -> Column:
    error = F.col(y) - F.col(y_hat)
    return F.sqrt(F.avg(error * error))


def mae(y: str = "y", y_hat: str = "y_hat") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(y_hat)))


def mape(y: str = "y", y_hat: str = "y_hat") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(y_hat)) / (F.abs(F.col(y)) + EPSILON)) * 100


def with_direction(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Adds ``same_direction``: 1 or 0 per step, NULL on the first row; two zero steps match."""
    order = Window.partitionBy(*keys).orderBy("date")
    actual = F.signum(F.col("y") - F.lag("y").over(order))
    predicted = F.signum(F.col("y_hat") - F.lag("y_hat").over(order))
    return df.withColumn("same_direction", (actual == predicted).cast("double"))


def directional_accuracy(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Share of steps moving the right way; a group with fewer than two rows is an error."""
    n = F.count(F.lit(1))
    checked = F.when(n < 2, F.raise_error(F.lit("directional accuracy needs at least 2 rows")).cast("double"))
    return with_direction(df, keys).groupBy(*keys).agg(
        checked.otherwise(F.avg("same_direction")).alias("da")
    )


def evaluate_forecast(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """All four metrics per group in one pass."""
    return with_direction(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), rmse().alias("rmse"), mae().alias("mae"),
        mape().alias("mape"), F.avg("same_direction").alias("da"),
    )


def cv_rmse(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Mean of the folds' errors, not the error of the pooled folds."""
    per_fold = df.groupBy(*keys, "fold").agg(rmse().alias("_rmse"))
    return per_fold.groupBy(*keys).agg(F.avg("_rmse").alias("cv_rmse"))


def prediction_interval(df: DataFrame, point: str = "y_hat", spread: str = "rmse") -> DataFrame:
    """80 % interval: point +- 1.28 rmse, or 5 % of the point when no rmse is known."""
    sigma = F.coalesce(F.col(spread), F.col(point) * INTERVAL_FALLBACK) * INTERVAL_Z
    return df.withColumns({
        "lower_80": F.round(F.col(point) - sigma, 2),
        "upper_80": F.round(F.col(point) + sigma, 2),
    }).withColumn(point, F.round(point, 2))


def chi2_upper_tail(x: Column, df: int, terms: int = 400) -> Column:
    """P(X > x) for a chi-squared variable, from the power series of the incomplete gamma function.

    A fold over the series keeps the computation inside the JVM; beyond x = 300 the tail is zero to
    more digits than a double holds for the degrees of freedom used here.
    """
    a, z = df / 2, x / 2
    first = F.pow(z, F.lit(a)) * F.exp(-z) / math.gamma(a + 1)

    def add(state: Column, n: Column) -> Column:
        term = state["term"] * z / (n + a)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    start = F.struct(first.alias("term"), first.alias("total"))
    lower = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), start, add, lambda s: s["total"])
    return F.when(x > 300, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - lower))


def ljung_box(df: DataFrame, value: str = "resid", lags: int = 10, significance: float = 0.05) -> DataFrame:
    """``(series_id, lag, q_stat, p_value, autocorrelated)`` for residuals ordered by date."""
    order = Window.partitionBy("series_id").orderBy("date")
    whole = Window.partitionBy("series_id")
    centred = df.dropna(subset=[value]).withColumn("_e", F.col(value) - F.avg(value).over(whole))
    products = [F.sum(F.col("_e") * F.col(f"_e{k}")).alias(f"_c{k}") for k in range(1, lags + 1)]
    moments = (
        centred.withColumns({f"_e{k}": F.lag("_e", k).over(order) for k in range(1, lags + 1)})
        .groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_e") * F.col("_e")).alias("_c0"), *products)
    )
    running = F.lit(0.0)
    rows = []
    for k in range(1, lags + 1):
        rho = F.coalesce(F.col(f"_c{k}") / F.col("_c0"), F.lit(0.0))
        running = running + rho * rho / (F.col("_n") - k)
        q = F.col("_n") * (F.col("_n") + 2) * running
        rows.append(F.struct(F.lit(k).alias("lag"), q.alias("q_stat"),
                             chi2_upper_tail(q, k).alias("p_value")))
    out = moments.filter(F.col("_n") > lags).select("series_id", F.inline(F.array(*rows)))
    flagged = F.max((F.col("p_value") < significance).cast("int")).over(whole) == 1
    return out.withColumn("autocorrelated", flagged)


def leaderboard(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """Models ordered by ``by`` ascending, best first (ties by name)."""
    return metrics.orderBy(by, "model")


def best_model(metrics: DataFrame, by: str = "mape", keys: Sequence[str] = ()) -> DataFrame:
    """The model with the smallest ``by``; every fitted model takes part in the choice."""
    rank = F.struct(by, "model")
    return metrics.groupBy(*keys).agg(
        F.min_by("model", rank).alias("model"), F.min(by).alias(by)
    )
