import math

import numpy as np
import pytest
from conftest import month_starts

from quartermill.operators import accuracy, verdicts
from quartermill.operators.aggregates import histogram


def pairs(spark, actual, predicted):
    rows = [("s", d, float(a), float(p)) for d, a, p in zip(month_starts(len(actual)), actual, predicted, strict=True)]
    return spark.createDataFrame(rows, "series_id string, date date, y double, y_hat double")


def value(df, column):
    return df.agg(column.alias("v")).first()["v"]


@pytest.mark.parametrize("actual, predicted, expected", [([2, 4, 6], [1, 3, 5], 1.0), ([10, 20], [7, 20], math.sqrt(4.5))])
def test_rmse(spark, actual, predicted, expected):
    assert value(pairs(spark, actual, predicted), accuracy.rmse()) == pytest.approx(expected)


def test_mae_and_mape(spark):
    assert value(pairs(spark, [3, 6, 9], [2, 5, 7]), accuracy.mae()) == pytest.approx(4 / 3)
    assert value(pairs(spark, [100, 200], [110, 220]), accuracy.mape()) == pytest.approx(10.0, abs=1e-6)
    assert math.isfinite(value(pairs(spark, [0, 1], [1, 1]), accuracy.mape()))


@pytest.mark.parametrize("actual, predicted, expected", [
    ([1, 2, 3, 4], [1, 1.5, 2.5, 3.5], 1.0), ([1, 2, 3, 4], [4, 3, 2, 1], 0.0), ([1, 2, 1, 2], [1, 2, 2, 1], 1 / 3)])
def test_directional_accuracy(spark, actual, predicted, expected):
    got = accuracy.directional_accuracy(pairs(spark, actual, predicted)).first()["da"]
    assert got == pytest.approx(expected)


def test_directional_accuracy_needs_two_rows(spark):
    with pytest.raises(Exception, match="at least 2"):
        accuracy.directional_accuracy(pairs(spark, [1], [1])).collect()


def test_chi_squared_tail_against_closed_forms(spark):
    df = spark.createDataFrame([(0.5,), (3.0,), (12.0,), (40.0,)], "x double")
    out = df.select("x", *[accuracy.chi2_upper_tail(df["x"], k).alias(f"k{k}") for k in (1, 2, 3, 4)]).collect()
    for r in out:
        h = r["x"] / 2
        assert r["k1"] == pytest.approx(math.erfc(math.sqrt(h)), abs=1e-12)
        assert r["k2"] == pytest.approx(math.exp(-h), abs=1e-12)
        assert r["k3"] == pytest.approx(math.erfc(math.sqrt(h)) + 2 * math.sqrt(h / math.pi) * math.exp(-h), abs=1e-12)
        assert r["k4"] == pytest.approx(math.exp(-h) * (1 + h), abs=1e-12)


def test_ljung_box_flags_only_the_correlated_series(spark):
    rng = np.random.default_rng(1)
    noise = rng.normal(size=120)
    trend = np.cumsum(rng.normal(size=120))
    dates = month_starts(120)
    rows = [("noise", d, float(v)) for d, v in zip(dates, noise, strict=True)]
    rows += [("walk", d, float(v)) for d, v in zip(dates, trend, strict=True)]
    out = accuracy.ljung_box(spark.createDataFrame(rows, "series_id string, date date, resid double")).collect()
    e = noise - noise.mean()
    rho = [(e[k:] * e[:-k]).sum() / (e * e).sum() for k in range(1, 11)]
    expected = 120 * 122 * sum(r * r / (120 - k) for k, r in enumerate(rho, 1))
    assert next(r for r in out if r["series_id"] == "noise" and r["lag"] == 10)["q_stat"] == pytest.approx(expected)
    assert {r["series_id"] for r in out if r["autocorrelated"]} == {"walk"}


def test_histogram_puts_the_top_edge_into_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert {r["bin"]: r["n"] for r in histogram(df, "v", 5).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_interval_falls_back_to_five_percent(spark):
    df = spark.createDataFrame([("a", 100.0, 10.0), ("b", 100.0, None)], "series_id string, y_hat double, rmse double")
    out = {r["series_id"]: r for r in accuracy.prediction_interval(df).collect()}
    assert (out["a"]["lower_80"], out["a"]["upper_80"]) == (87.2, 112.8)
    assert (out["b"]["lower_80"], out["b"]["upper_80"]) == (93.6, 106.4)


def test_leakage_verdict_margins(spark):
    def verdict(best, base):
        sweep = spark.createDataFrame([(best,), (9.0,)], "mape double")
        return verdicts.leakage_verdict(sweep, spark.createDataFrame([(base,)], "mape double")).first()

    assert verdict(1.0, 2.6)["leak_check"] == "warning" and verdict(2.35, 2.6)["leak_check"] == "confirmed"
    assert verdict(2.35, 3.2)["drift_check"] == "warning" and verdict(2.35, 2.6)["drift_check"] == "ok"
