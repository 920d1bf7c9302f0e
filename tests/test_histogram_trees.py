"""Histogram trees against a plain grower, and forecasts that go on with them."""

import numpy as np
import pytest
from conftest import month_starts
from pyspark.sql import functions as F

from quartermill.operators import ensemble, features, forecast, linear, splits
from quartermill.operators import histogram_trees as H


def table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[rng.random((n, 4)) < 0.15] = np.nan
    y = np.where(np.isnan(x[:, 0]), 1.5, np.sin(2 * np.nan_to_num(x[:, 0]))) + 0.5 * np.nan_to_num(x[:, 1]) + rng.normal(scale=0.1, size=n)
    return x, y, rng.random(n) < 0.2


def frame(spark, x, y, stop, job=None):
    rows = [(int(0 if job is None else job[i]), float(y[i]), bool(stop[i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(len(y))]
    return spark.createDataFrame(rows, "job int, y double, stop boolean, a double, b double, c double, d double").repartition(3)


def plain_forest(x, y, stop, s, trees):
    """Grows on raw values, one leaf after the other, with every cut between known values tried for both sides of missing ones."""
    train = ~stop
    base = y[train].mean()
    margin = np.full(len(y), base)
    errors = [((margin - y)[stop] ** 2).mean() if stop.any() else 0]
    cuts = [np.unique(c[train & ~np.isnan(c)]) for c in x.T]

    def split(rows):
        g = (margin - y)[rows]
        score = lambda g: g.sum() ** 2 / (len(g) + s.l2)
        best = None
        for f, values in enumerate(cuts):
            own = x[rows, f]
            for missing_left in (True, False):
                for cut in values:
                    left = np.where(np.isnan(own), missing_left, own <= cut)
                    if left.sum() < s.min_rows or (~left).sum() < s.min_rows:
                        continue
                    gain = score(g[left]) + score(g[~left]) - score(g)
                    if gain > s.min_gain and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, f, cut, missing_left
        return best

    for _ in range(trees):
        everything = np.arange(len(y))
        leaves = [(everything, split(np.flatnonzero(train)))]
        while len(leaves) < s.leaves and any(b for _, b in leaves):
            k = max((k for k, (_, b) in enumerate(leaves) if b), key=lambda k: leaves[k][1][0])
            rows, (_, f, cut, missing_left) = leaves.pop(k)
            left = np.where(np.isnan(x[rows, f]), missing_left, x[rows, f] <= cut)
            for own in (rows[left], rows[~left]):
                leaves.append((own, split(own[train[own]])))
        before = margin.copy()
        for rows, _ in leaves:
            own = rows[train[rows]]
            margin[rows] += -s.rate * (before - y)[own].sum() / (len(own) + s.l2)
        errors.append(((margin - y)[stop] ** 2).mean() if stop.any() else 0)
    return margin, errors


@pytest.mark.parametrize("leaves", [2, 7])
def test_forest_equals_a_plain_grower(spark, leaves):
    x, y, _ = table(150)
    stop = np.zeros(len(y), bool)
    s = H.Settings(rounds=11, leaves=leaves, bins=500, min_rows=20, feature_share=1.0, rate=0.3, l2=0.7)
    forest = H.grow(frame(spark, x, y, stop), ["a", "b", "c", "d"], s)[0]
    want, _ = plain_forest(x, y, stop, s, 11)
    assert len(forest.roots) == 11 and np.allclose(forest.predict(x), want, atol=1e-9)


def test_stopping_rows_end_the_boosting_and_jobs_share_passes(spark):
    x, y, stop = table(300)
    job = np.arange(300) % 2
    s = H.Settings(rounds=30, leaves=4, bins=500, min_rows=5, feature_share=1.0, rate=0.8, patience=3)
    both = H.grow(frame(spark, x, y, stop, job), ["a", "b", "c", "d"], s)
    for k in (0, 1):
        own = job == k
        kept = len(both[k].roots)
        _, errors = plain_forest(x[own], y[own], stop[own], s, kept + 3)
        want, _ = plain_forest(x[own], y[own], stop[own], s, kept)
        assert kept == int(np.argmin(errors)) < 30 and np.allclose(both[k].predict(x[own]), want)


def test_quantile_bins_and_odd_inputs(spark):
    x, y, stop = table(2000)
    s = H.Settings(rounds=12, rate=0.3, leaves=8, bins=16, feature_share=0.75)
    forest = H.grow(frame(spark, x, y, stop), ["a", "b", "c", "d"], s)[0]
    assert np.mean((forest.predict(x) - y) ** 2) < 0.2 * np.var(y) and forest.gains.sum() > 0
    df = frame(spark, x[:50], y[:50], stop[:50]).withColumns({"a": F.lit(None).cast("double"), "b": F.lit(float("nan")), "c": F.lit(1.0)})
    forest = H.grow(df.withColumn("y", F.when(F.rand(1) > 0.2, F.col("y"))), ["a", "b", "c"], s)[0]
    assert np.isfinite(forest.predict(np.full((2, 3), np.nan))).all()
    assert H.grow(df.limit(0), ["a", "b"], s) == {}


def test_panel_with_missing_features_is_fitted_as_it_is(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(6):
        x = rng.normal(size=40)
        rows += [(f"s{k}", d, float(100 * k + 10 * v), bool(i >= 32), float(v) if rng.random() > 0.1 else None) for i, (d, v) in enumerate(zip(month_starts(40), x))]
    df = spark.createDataFrame(rows, "series_id string, date date, y double, is_test boolean, x double")
    out = H.fit_predict(df, ["x"], s=H.Settings(min_rows=5, rounds=15, rate=0.5)).collect()
    assert len(out) == 48 and all(r["y_hat"] is not None for r in out)
    known = {(r["series_id"], r["date"]): r for r in df.filter("x IS NOT NULL").collect()}
    errors = [abs(r["y"] - r["y_hat"]) for r in out if (r["series_id"], r["date"]) in known]
    assert np.mean(errors) < 4


def exog_panel(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(3):
        x = rng.normal(size=44)
        y = 200 + 50 * k + 3 * np.arange(44) + 15 * np.sin(np.arange(44) * np.pi / 2) + 8 * x
        rows += [(f"s{k}", d, float(a), None if (i + k) % 5 == 0 else float(b)) for i, (d, a, b) in enumerate(zip(month_starts(44, step=3), y, x))]
    return spark.createDataFrame(rows, "series_id string, date date, y double, x double")


def plain_features(known, month, last_x):
    """The features of the next period from all values so far."""
    y = np.array(known)
    out = {f"y_lag_{k}": y[-k] for k in (1, 2, 4, 8)}
    for w in (2, 4, 8):
        out |= {f"y_roll_mean_{w}": y[-w:].mean(), f"y_roll_std_{w}": y[-w:].std(ddof=1)}
    return out | {"y_yoy_pct": (y[-1] - y[-5]) / y[-5] * 100, "month_sin": np.sin(2 * np.pi * month / 12), "month_cos": np.cos(2 * np.pi * month / 12), "x": last_x}


def test_recursion_equals_a_plain_loop_for_trees_linear_models_and_stacks(spark):
    panel = exog_panel(spark)
    df = splits.holdout_split(features.build_features(panel), 6)
    names = [n for n in features.feature_columns(df) if n.startswith(("y_", "month_")) or n == "x"]
    settings = {"rounds": 8, "min_rows": 8, "leaves": 5}
    forest, scales = H.fit(df, names, H.Settings(**settings))
    ridge = linear.fit_coefficients(df, names, "ridge")
    stack = ensemble.stacked_forecaster(df, names, {"trees": settings, "ridge": {"alpha": 1.0}}, n_folds=3)
    scale = {r["series_id"]: r for r in scales.collect()}
    rows = {s: sorted((r for r in panel.collect() if r["series_id"] == s), key=lambda r: r["date"]) for s in ("s0", "s1", "s2")}

    def weigh(table):
        found = {r["series_id"]: r for r in table.collect()}
        return lambda s, f: found[s]["intercept"] + sum(found[s][f"b_{n}"] * f[n] for n in f)

    def trees(s, f):
        z = [[(f[n] - scale[s][f"_mean_{n}"]) / scale[s][f"_std_{n}"] for n in names]]
        return stack_forest.predict(np.array(z))[0] * scale[s]["_std_y"] + scale[s]["_mean_y"]

    stack_forest = forest
    linear_model, level_two = weigh(ridge), weigh(stack.stack)
    pick = lambda f: {n: f[n] for n in names}
    stacked = lambda s, f: level_two(s, {"trees": trees(s, f), "ridge": linear_model(s, f)})
    for model, plain in ((forecast.Fitted(tuple(names), forest=forest, scales=scales), trees),
                         (forecast.Fitted(tuple(names), {"ridge": ridge}), linear_model), (stack, stacked)):
        got = {(r["series_id"], r["step"]): r["y_hat"] for r in forecast.recursive_fitted(panel, model, 5).collect()}
        for s, own in rows.items():
            known, last_x = [r["y"] for r in own], [r["x"] for r in own if r["x"] is not None][-1]
            for step in range(1, 6):
                month = (own[-1]["date"].month - 1 + 3 * step) % 12 + 1
                known.append(plain(s, pick(plain_features(known, month, last_x))))
                assert got[s, step] == pytest.approx(known[-1], rel=1e-9)
