import datetime as dt
import math

import numpy as np
import pytest
from conftest import PANEL, month_starts
from pyspark.sql import functions as F

from quartermill.operators import accuracy, adaptive, changepoints, ensemble, features, forecast, linear, seasonal_arma, smoothing, splits, trees


def featured(panel, horizon=6):
    return splits.holdout_split(features.build_features(panel), horizon)


def noisy_panel(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(3):
        y = 300 + 2 * np.arange(n) + 20 * np.sin(np.arange(n) * np.pi / 2) + rng.normal(scale=2, size=n)
        rows += [(f"s{s}", d, float(v)) for d, v in zip(month_starts(n, dt.date(2000, 3, 1), 3), y, strict=True)]
    return spark.createDataFrame(rows, PANEL)


def test_ridge_equals_the_closed_form(spark):
    df = featured(noisy_panel(spark)).cache()
    names = features.feature_columns(df)
    got = {r["date"]: r["y_hat"] for r in linear.fit_predict(df, names, alpha=1.0).filter("series_id = 's1'").collect()}
    pdf = df.filter("series_id = 's1'").toPandas().sort_values("date")
    train, test = pdf[~pdf["is_test"]], pdf[pdf["is_test"]]
    x, mean, std = train[names].to_numpy(float), train[names].mean().to_numpy(), train[names].std(ddof=0).to_numpy()
    std = np.where(std == 0, 1, std)
    z, y = (x - mean) / std, train["y"].to_numpy()
    w = np.linalg.solve(z.T @ z + np.eye(len(names)), z.T @ (y - y.mean()))
    want = ((test[names].to_numpy(float) - mean) / std) @ w + y.mean()
    assert np.allclose([got[d] for d in test["date"]], want, rtol=1e-9)


def test_coefficients_in_raw_units_give_the_same_predictions(spark):
    df = featured(noisy_panel(spark))
    names = ["y_lag_1", "y_lag_4", "month_sin"]
    model = linear.fit_coefficients(df, names)
    raw = df.filter("is_test").join(model, "series_id").select(
        "series_id", "date", (F.col("intercept") + sum(F.col(f"b_{n}") * F.col(n) for n in names)).alias("raw"))
    both = linear.fit_predict(df, names).join(raw, ["series_id", "date"]).collect()
    assert len(both) == 18 and all(r["y_hat"] == pytest.approx(r["raw"], rel=1e-9) for r in both)


def test_elasticnet_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ np.array([3.0, 0, 0, -2, 0, 0.2]) + rng.normal(size=50)
    y -= y.mean()
    for alpha, rho in ((1.0, 0.5), (0.3, 0.9)):
        w = linear.solve_elasticnet(x, y, alpha, rho)[0]
        slope = x.T @ (y - x @ w) / 50 - alpha * (1 - rho) * w
        active = w != 0
        assert np.allclose(slope[active], alpha * rho * np.sign(w[active]), atol=1e-4)
        assert np.all(np.abs(slope[~active]) <= alpha * rho + 1e-4)


def test_solvers_handle_many_settings_at_once():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(20, 4)), rng.normal(size=20)
    many = linear.solve_ridge(x, y, np.array([0.1, 5.0]))
    assert np.allclose(many[1], np.linalg.solve(x.T @ x + 5 * np.eye(4), x.T @ y))


def test_a_column_one_series_never_knows_does_not_spoil_it(spark):
    df = featured(noisy_panel(spark)).withColumn("x", F.when(F.col("series_id") != "s0", F.col("y_lag_1")))
    out = linear.fit_predict(df, ["y_lag_1", "x"])
    assert out.filter(F.col("y_hat").isNull()).count() == 0 and out.count() == 18


def test_holt_winters_continues_an_exact_pattern(seasonal_panel):
    out = smoothing.holt_winters(splits.holdout_split(seasonal_panel, 8)).collect()
    assert len(out) == 16
    assert max(abs(r["y"] - r["y_hat"]) for r in out) < 8  # the level starts at the mean of the first year


def test_seasonal_ar_is_exact_on_line_plus_season(seasonal_panel):
    df = splits.holdout_split(seasonal_panel.withColumn("y", F.col("y")), 8)
    terms = linear.seasonal_ar_terms(df).filter("zs IS NOT NULL")
    assert terms.filter(F.abs("z") > 1e-9).count() == 0


def plain_smoothing_error(ys, alpha, beta, gamma, level, trend, season, period=4):
    season, total = list(season), 0.0
    for i, y in enumerate(ys):
        old = season[i % period]
        total += (y - level - trend - old) ** 2
        before, level = level, alpha * (y - old) + (1 - alpha) * (level + trend)
        season[i % period] = gamma * (y - before - trend) + (1 - gamma) * old
        trend = beta * (level - before) + (1 - beta) * trend
    return total


def test_fitted_smoothing_is_not_beaten_nearby_or_at_random(spark):
    panel = noisy_panel(spark)
    rng = np.random.default_rng(3)
    ys = {r["series_id"]: r["ys"] for r in smoothing.ordered_values(panel).collect()}
    fits = smoothing.holt_winters_optimised(panel).collect()
    assert len(fits) == len(ys) and all(f["converged"] for f in fits)
    for f in fits:
        y, start = ys[f["series_id"]], f["start"]
        own = plain_smoothing_error(y, f["alpha"], f["beta"], f["gamma"], start["level"], start["trend"], start["season"])
        assert own == pytest.approx(f["sse"], rel=1e-9) and abs(sum(start["season"])) < 1e-6
        params = np.array([f["alpha"], f["beta"], f["gamma"]])
        for _ in range(300):
            near = np.clip(params + rng.choice([-1e-3, 0, 1e-3], 3), 0, 1)
            state = np.array([start["level"], start["trend"], *start["season"]]) + rng.normal(size=6) * rng.choice([0, 1e-3, 1])
            assert plain_smoothing_error(y, *near, state[0], state[1], state[2:]) >= own * (1 - 1e-9)
    coarse = {r["series_id"]: r["sse"] for r in smoothing.holt_winters_fit(panel).collect()}
    assert all(f["sse"] <= coarse[f["series_id"]] * 1.5 for f in fits)  # of all values, where the grid counts from the second season on


def test_fitted_smoothing_recovers_an_exact_pattern_and_says_when_it_did_not_end(seasonal_panel, monkeypatch):
    out = smoothing.holt_winters(splits.holdout_split(seasonal_panel, 8), optimised=True).collect()
    assert len(out) == 16 and max(abs(r["y"] - r["y_hat"]) for r in out) < 1e-6
    short = seasonal_panel.filter("date < '2001-09-01'").withColumn("y", F.when(F.col("date") > "2000-06-01", F.col("y")))
    assert smoothing.holt_winters_optimised(short).count() == 0
    monkeypatch.setattr(smoothing, "PASS_STEPS", 1)
    monkeypatch.setattr(smoothing, "MAX_PASSES", 2)
    assert {r["converged"] for r in smoothing.holt_winters_optimised(seasonal_panel).collect()} == {False}


def arma_panel(spark, n=400, ar=0.5, seasonal=0.4, ma=0.6):
    rng = np.random.default_rng(8)
    rows = []
    for name in ("a", "b"):
        shocks, z = rng.normal(size=n), np.zeros(n)
        for t in range(5, n):
            z[t] = ar * z[t - 1] + seasonal * z[t - 4] - ar * seasonal * z[t - 5] + shocks[t] + ma * shocks[t - 1]
        y = np.zeros(n)
        for t in range(n):
            y[t] = z[t] + (y[t - 1] if t else 0) + (y[t - 4] if t > 3 else 0) - (y[t - 5] if t > 4 else 0)
        rows += [(name, d, float(v)) for d, v in zip(month_starts(n, dt.date(1901, 3, 1), 3), y)]
    return spark.createDataFrame(rows, "series_id string, date date, y double")


def test_seasonal_arma_finds_planted_terms(spark):
    fits = seasonal_arma.coefficients(splits.holdout_split(arma_panel(spark), 8)).collect()
    for f in fits:
        assert f["converged"]
        assert f["ma"] > 0.25 and abs(f["ar"] - 0.5) < 0.3 and abs(f["seasonal_ar"] - 0.4) < 0.2


def test_forecasts_do_not_read_held_out_values(spark):
    df = splits.holdout_split(arma_panel(spark, 60), 8)
    changed = df.withColumn("y", F.when(F.col("is_test"), F.lit(-1e6)).otherwise(F.col("y")))
    for predict in (seasonal_arma.predict, lambda d: smoothing.holt_winters(d, optimised=True), linear.trend_season_fit_predict):
        one, two = ({(r["series_id"], r["date"]): r["y_hat"] for r in predict(d).collect()} for d in (df, changed))
        assert len(one) == 16 and one == {k: pytest.approx(v, rel=1e-9) for k, v in two.items()}


def test_seasonal_arma_continues_line_and_season(seasonal_panel):
    out = seasonal_arma.predict(splits.holdout_split(seasonal_panel, 8)).collect()
    assert len(out) == 16 and max(abs(r["y"] - r["y_hat"]) for r in out) < 1e-3


def test_a_planted_break_is_found_and_the_season_is_not_penalised(spark):
    rng = np.random.default_rng(2)
    wave, rows = [30.0, -10.0, -30.0, 10.0], []
    for name, at in (("early", 20), ("late", 40), ("none", 999)):
        rows += [(name, d, 500 + 4.0 * i - (12.0 * max(0, i - at)) + wave[i % 4] + float(rng.normal(scale=0.5))) for i, d in enumerate(month_starts(80, dt.date(1990, 3, 1), 3))]
    df = splits.holdout_split(spark.createDataFrame(rows, PANEL), 8)
    out = changepoints.fit_predict(df).collect()
    assert len(out) == 24 and all(r["converged"] and abs(r["y"] - r["y_hat"]) < 12 and r["lower_80"] < r["y_hat"] < r["upper_80"] for r in out)
    weights = {r["series_id"]: np.array(r["weights"][2 + 2 * changepoints.HARMONICS:]) for r in out}
    places = np.array([changepoints.SHARE * j / (changepoints.CANDIDATES + 1) for j in range(1, changepoints.CANDIDATES + 1)]) * 71
    for name, at in (("early", 20), ("late", 40)):
        w = weights[name]
        assert abs((places * np.abs(w)).sum() / np.abs(w).sum() - at) < 2 and abs(w.sum() / 71 + 12) < 1.5
    assert np.abs(weights["none"]).sum() < 0.1 * np.abs(weights["late"]).sum()
    gone = df.withColumn("y", F.when(F.col("is_test") | (F.col("series_id") != "none"), F.col("y")))
    assert {r["y_hat"] is None for r in changepoints.fit_predict(gone).filter("series_id = 'none'").collect()} == {True}


def test_trend_season_regression_learns_line_and_season(seasonal_panel):
    out = linear.trend_season_fit_predict(splits.holdout_split(seasonal_panel, 8), alpha=0.01)
    assert accuracy.evaluate_forecast(out).agg(F.max("mape")).first()[0] < 3


def test_recursive_forecast_follows_an_exact_lag_model(spark, seasonal_panel):
    model = spark.createDataFrame([("up", 12.0, 1.0), ("down", -8.0, 1.0)], "series_id string, intercept double, b_y_lag_4 double")
    out = forecast.recursive_forecast(seasonal_panel, model, 6).orderBy("series_id", "step").collect()
    wave = [10.0, -4.0, -8.0, 2.0]
    up = [r for r in out if r["series_id"] == "up"]
    assert [r["y_hat"] for r in up] == pytest.approx([200 + 3.0 * i + wave[i % 4] for i in range(40, 46)])
    # the first step is the first unknown quarter, and steps are quarters apart
    assert [r["date"] for r in up[:2]] == [dt.date(2010, 3, 1), dt.date(2010, 6, 1)]


def test_recursive_features_equal_the_batch_features(spark):
    panel = noisy_panel(spark)
    df = splits.holdout_split(features.build_features(panel), 1)
    names = features.feature_columns(df)
    model = linear.fit_coefficients(df, names)
    one_step = {r["series_id"]: r["y_hat"] for r in linear.fit_predict(df, names).collect()}
    shortened = panel.join(df.filter("is_test").select("series_id", "date"), ["series_id", "date"], "left_anti")
    recursive = {r["series_id"]: r["y_hat"] for r in forecast.recursive_forecast(shortened, model, 1).collect()}
    assert recursive == {k: pytest.approx(v, rel=1e-9) for k, v in one_step.items()}


def test_unknown_series_take_the_aggregate_forecast(spark, seasonal_panel):
    everything = forecast.with_aggregate_series(seasonal_panel)
    assert everything.filter("series_id = 'ALL'").count() == 40
    points = everything.groupBy("series_id").agg(F.max("date").alias("date"), F.max("y").alias("y_hat"))
    wanted = spark.createDataFrame([("up",), ("nowhere",)], "series_id string")
    out = {r["series_id"]: r["source_id"] for r in forecast.forecast_all_series(points, wanted).collect()}
    assert out == {"up": "up", "nowhere": "ALL"}


def test_param_search_finds_the_best_of_the_trials(spark):
    df = featured(noisy_panel(spark))
    trials = [{"alpha": a} for a in (0.1, 10.0, 1e6)]
    names = features.feature_columns(df)
    best = ensemble.param_search(df, names, "ridge", trials).collect()
    folds = ensemble.training_folds(df)
    for r in best:
        scores = []
        for t in trials:
            predicted = linear.fit_predict(folds, names, "ridge", ["series_id", "fold"], **t)
            scores.append(accuracy.cv_rmse(predicted).filter(F.col("series_id") == r["series_id"]).first()["cv_rmse"])
        assert r["trial"] == int(np.argmin(scores)) and r["cv_rmse"] == pytest.approx(min(scores))


def test_stacking_uses_only_validated_rows_and_predicts_the_test(spark):
    df = featured(noisy_panel(spark))
    out = ensemble.stacking(df, features.feature_columns(df), {"ridge": {"alpha": 1.0}, "elasticnet": {}})
    assert out.count() == 18 and accuracy.evaluate_forecast(out).agg(F.max("mape")).first()[0] < 15


def test_ablation_reports_the_change_against_the_first_subset(spark):
    df = featured(noisy_panel(spark)).withColumn("noise", F.rand(1))
    own = features.feature_columns(df, "own")
    out = {r["subset"]: r for r in ensemble.exog_ablation(df, {"all": [*own, "noise"], "own": own}).collect()}
    assert out["all"]["delta_mape"] == 0
    assert out["own"]["delta_mape"] == pytest.approx(out["own"]["mape"] - out["all"]["mape"])


def test_trees_beat_the_training_mean_and_rank_their_features(spark):
    df = featured(noisy_panel(spark)).cache()
    names = features.feature_columns(df)
    settings = {"maxIter": 20, "minInstancesPerNode": 3}
    out = trees.fit_predict(df, names, **settings)
    level = df.filter(~F.col("is_test")).groupBy("series_id").agg(F.avg("y").alias("y_hat"))
    flat = df.filter("is_test").select("series_id", "date", "y").join(level, "series_id")

    def error(predicted):
        return accuracy.evaluate_forecast(predicted).agg(F.avg("rmse")).first()[0]

    assert out.count() == 18 and error(out) < error(flat)
    model, _, _, kept = trees.fit(df, names, **settings)
    top = trees.importance(model, kept, spark, 3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[2]["importance"] > 0


def test_adaptive_search_is_repeatable_and_beats_random_trials_on_a_planted_surface():
    space = {"a": (1e-4, 1.0, "log"), "b": (0.0, 1.0, "linear"), "c": (1.0, 100.0, "log"), "d": (-1.0, 1.0, "linear")}
    calls = []

    def errors_of(settings, folds):
        calls.append((len(settings), tuple(folds)))
        value = [(math.log10(s["a"]) + 2) ** 2 + 9 * (s["b"] - 0.7) ** 2 + 2 * (math.log10(s["c"]) - 0.5) ** 2 + (s["d"] + 0.4) ** 2 for s in settings]
        return np.array(value)[:, None] + 0.01 * np.array(folds)

    wins = 0
    for seed in range(12):
        found = adaptive.search(errors_of, space, 4, trials=40, batch=8, seed=seed)
        assert len(found) == 40 and found[0]["folds"] == 4 and any(r["folds"] == 2 for r in found)
        rng = np.random.default_rng(1000 + seed)
        plain = min(float(errors_of([adaptive.to_setting(p, space)], [1, 2, 3, 4]).mean()) for p in rng.random((40, 4)))
        wins += found[0]["error"] < plain
    assert wins >= 9
    again = adaptive.search(errors_of, space, 4, trials=40, batch=8, seed=11)
    assert again == found


def test_adaptive_search_of_a_linear_model(spark):
    df = featured(noisy_panel(spark))
    names = ["y_lag_1", "y_lag_4", "month_sin"]
    out = adaptive.linear_search(df, names, "ridge", {"alpha": (1e-3, 100.0, "log")}, trials=8, batch=4, n_folds=3).collect()
    assert len(out) == 8 and [r["best"] for r in out] == [True] + [False] * 7
    assert out[0]["cv_rmse"] == min(r["cv_rmse"] for r in out if r["folds"] == 3)
