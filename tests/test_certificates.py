"""Certificates must fail for wrong fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.operators import features, linear, spectral, splits
from quartermill.plans.certificates import component_certificate, optimality


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    rows = [(s, f"20{10 + i // 12:02d}-{1 + i % 12:02d}-01", float(100 + i + 9 * np.sin(i) + rng.normal())) for s in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "series_id string, date string, y double").withColumn("date", F.to_date("date"))
    return splits.holdout_split(features.build_features(df, lags=[1, 2], windows=[3]), 6).cache()


@pytest.mark.parametrize(("model", "alpha", "ratio"), [("ridge", linear.RIDGE_ALPHA, 0.0), ("elasticnet", linear.ELASTICNET_ALPHA, linear.ELASTICNET_L1_RATIO)])
def test_optimality_holds_for_the_penalty_of_the_fit_only(panel, model, alpha, ratio):
    names = features.feature_columns(panel)
    right = [r["violation"] for r in optimality(panel, names, model, alpha, ratio).collect()]
    wrong = [r["violation"] for r in optimality(panel, names, model, 3 * alpha, ratio).collect()]
    assert max(right) < 1e-5 < min(wrong)


def test_components_must_be_those_of_the_data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4)) @ np.diag([4.0, 2.0, 1.0, 0.5])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "vec array<double>")
    sigma, v = spectral.svd_spectrum(df, "vec", 4)
    right = component_certificate(df, "vec", v, sigma**2, 1.0).collect()
    assert all(r["error"] < 1e-9 and r["overlap"] < 1e-9 for r in right)
    turned = v.copy()
    turned[:, 0], turned[:, 1] = (v[:, 0] + v[:, 1]) / 2**0.5, (v[:, 0] - v[:, 1]) / 2**0.5
    assert max(r["overlap"] for r in component_certificate(df, "vec", turned, sigma**2, 1.0).collect()) > 0.01
    assert max(r["error"] for r in component_certificate(df, "vec", v, sigma[::-1] ** 2, 1.0).collect()) > 0.01
