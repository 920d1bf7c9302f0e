"""Named queries: forecasters, ensembles and recursive forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermill.operators import accuracy, adaptive, changepoints, ensemble, features, forecast, histogram_trees, linear, seasonal_arma, smoothing, splits, trees, verdicts
from quartermill.plans import inputs
from quartermill.plans.catalog import cte, query, rounded, with_
from quartermill.plans.timeseries import _MODELS_SQL, model_scores, split, staged_merged, staged_panel

HORIZON = 8

cte("one_stats", """
  SELECT series_id, avg(y_lag_1) AS m, CASE WHEN stddev_pop(y_lag_1) = 0 THEN 1 ELSE stddev_pop(y_lag_1) END AS s,
         avg(y) AS level, count(*) AS n FROM split WHERE NOT is_test GROUP BY 1""", "split")
cte("one_sums", """
  SELECT series_id, sum((y_lag_1 - m) / s * (y - level)) AS zy, sum(((y_lag_1 - m) / s) ** 2) AS zz
  FROM split JOIN one_stats USING (series_id) WHERE NOT is_test GROUP BY 1""", "split", "one_stats")


def model_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Merged panel with features and the hold-out mark, written once for the model queries."""
    return inputs.stage(spark, ("model_rows", sf), lambda: splits.holdout_split(
        features.build_features(staged_merged(spark, sf)), HORIZON))


def own_rows(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.stage(spark, ("own_rows", sf), lambda: split(spark, sf))


def _points(df: DataFrame) -> DataFrame:
    return rounded(df.select("series_id", "date", "y", "y_hat"), y_hat=2)


@query("ridge_fit_predict")
def ridge_fit_predict(spark, sf):
    df = model_rows(spark, sf)
    return linear.fit_predict(df, features.feature_columns(df), "ridge", alpha=linear.RIDGE_ALPHA)


@query("ridge_one_feature", with_("one_sums", """
SELECT series_id, date, y, round(level + zy / (zz + 1) * (y_lag_1 - m) / s, 2) + 0.0 AS y_hat
FROM split JOIN one_stats USING (series_id) JOIN one_sums USING (series_id) WHERE is_test"""))
def ridge_one_feature(spark, sf):
    return _points(linear.fit_predict(own_rows(spark, sf), ["y_lag_1"], "ridge", alpha=1.0))


@query("elasticnet_fit_predict")
def elasticnet_fit_predict(spark, sf):
    df = model_rows(spark, sf)
    return linear.fit_predict(df, features.feature_columns(df), "elasticnet")


@query("elasticnet_one_feature", with_("one_sums", """
SELECT series_id, date, y, round(level + sign(zy) * greatest(abs(zy / n) - 0.5, 0) / (zz / n + 0.5) * (y_lag_1 - m) / s, 2)
       + 0.0 AS y_hat
FROM split JOIN one_stats USING (series_id) JOIN one_sums USING (series_id) WHERE is_test"""))
def elasticnet_one_feature(spark, sf):
    return _points(linear.fit_predict(own_rows(spark, sf), ["y_lag_1"], "elasticnet"))


@query("gbt_fit_predict")
def gbt_fit_predict(spark, sf):
    df = model_rows(spark, sf)
    return trees.fit_predict(df, features.feature_columns(df))


@query("top_importance")
def top_importance(spark, sf):
    df = model_rows(spark, sf)
    model, _, _, names = trees.fit(df, features.feature_columns(df))
    return trees.importance(model, names, spark)


#: One tree of two leaves, every known value a bin, so that the best cut can be stated in SQL.
STUMP = histogram_trees.Settings(rounds=1, leaves=2, bins=1000, min_rows=5, rate=0.5, l2=1.0, feature_share=1.0)


def _stump_sql(rows: str, features: list[str]) -> str:
    """CTEs ``scale``, ``z`` and ``best``: every cut of every feature, with missing values on either side."""
    stats = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}" for f in (*features, "y"))
    scaled = ", ".join(f"(r.{f} - m_{f}) / s_{f} AS z_{f}" for f in (*features, "y"))
    cases = " UNION ALL ".join(f"SELECT {k} AS f, z_{f} AS x, g FROM train" for k, f in enumerate(features))
    return f"""
, scale AS (SELECT series_id, {stats} FROM {rows} WHERE NOT is_test GROUP BY 1),
z AS (SELECT r.series_id, r.date, r.y, r.is_test, {scaled} FROM {rows} r JOIN scale USING (series_id)),
train AS (SELECT *, avg(z_y) OVER () AS base, avg(z_y) OVER () - z_y AS g FROM z WHERE NOT is_test),
cells AS ({cases}),
whole AS (SELECT sum(g) AS gw, count(*) AS nw, any_value(base) AS base FROM train),
cuts AS (SELECT DISTINCT f, x AS cut, ml FROM cells, (VALUES (true), (false)) AS m(ml) WHERE x IS NOT NULL),
tried AS (SELECT c.f, cut, ml, sum(g) FILTER (CASE WHEN x IS NULL THEN ml ELSE x <= cut END) AS gl, count(*) FILTER (CASE WHEN x IS NULL THEN ml ELSE x <= cut END) AS nl
          FROM cuts c JOIN cells USING (f) GROUP BY 1, 2, 3),
best AS (SELECT f, cut, ml, base - 0.5 * gl / (nl + 1) AS below, base - 0.5 * (gw - gl) / (nw - nl + 1) AS above FROM tried, whole WHERE nl >= 5 AND nw - nl >= 5
         ORDER BY round(gl * gl / (nl + 1) + (gw - gl) * (gw - gl) / (nw - nl + 1), 9) DESC, f, cut, ml DESC LIMIT 1)"""


cte("gapped", "SELECT series_id, date, y, is_test, y_lag_1, CASE WHEN month(date) IN (3, 9) THEN y_lag_4 END AS x_gapped FROM split", "split")


@query("tree_stump", with_("gapped", _stump_sql("gapped", ["y_lag_1", "x_gapped"]) + """
SELECT z.series_id, z.date, z.y, round(m_y + s_y * CASE WHEN CASE f WHEN 0 THEN coalesce(z_y_lag_1 <= cut, ml) ELSE coalesce(z_x_gapped <= cut, ml) END
       THEN below ELSE above END, 2) + 0.0 AS y_hat FROM z JOIN scale USING (series_id), best WHERE is_test"""))
def tree_stump(spark, sf):
    """One boosting round over a full feature and one that is missing every other quarter."""
    df = own_rows(spark, sf).withColumn("x_gapped", F.when(F.month("date").isin(3, 9), F.col("y_lag_4")))
    return _points(histogram_trees.fit_predict(df, ["y_lag_1", "x_gapped"], s=STUMP, early_stopping=False))


@query("tree_forecast")
def tree_forecast(spark, sf):
    """Histogram trees over all features, missing ones included, stopped by the last walk-forward block."""
    df = model_rows(spark, sf)
    return _points(histogram_trees.fit_predict(df, features.feature_columns(df)))


def _values(numbers) -> str:
    return ", ".join(f"{float(n)}::DOUBLE" for n in numbers)


@query("holt_winters", with_("panel", f"""
, p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS i,
               row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test FROM panel),
init AS (SELECT series_id, avg(y) FILTER (i <= 4) AS l, (avg(y) FILTER (i BETWEEN 5 AND 8) - avg(y) FILTER (i <= 4)) / 4 AS t,
                min(y) FILTER (i = 1) AS y1, min(y) FILTER (i = 2) AS y2, min(y) FILTER (i = 3) AS y3, min(y) FILTER (i = 4) AS y4,
                count(*) FILTER (NOT is_test) AS n FROM p GROUP BY 1),
grid AS (SELECT a, b, g FROM (SELECT unnest([{_values(smoothing.ALPHAS)}]) AS a), (SELECT unnest([{_values(smoothing.BETAS)}]) AS b),
                             (SELECT unnest([{_values(smoothing.GAMMAS)}]) AS g)),
walk AS (
  SELECT series_id, a, b, g, CAST(4 AS BIGINT) AS i, l, t, y1 - l AS s1, y2 - l AS s2, y3 - l AS s3, y4 - l AS s4,
         CAST(0.0 AS DOUBLE) AS sse FROM init, grid
  UNION ALL
  SELECT w.series_id, a, b, g, w.i + 1, a * (y - s1) + (1 - a) * (l + t),
         b * (a * (y - s1) + (1 - a) * (l + t) - l) + (1 - b) * t, s2, s3, s4,
         g * (y - (l + t)) + (1 - g) * s1, sse + (y - (l + t) - s1) ** 2
  FROM walk w JOIN p ON p.series_id = w.series_id AND p.i = w.i + 1 AND NOT p.is_test),
best AS (SELECT walk.* FROM walk JOIN init USING (series_id) WHERE i = n
         QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY sse, a, b, g) = 1)
SELECT p.series_id, p.date, p.y, round(l + (p.i - best.i) * t
       + CASE (p.i - best.i - 1) % 4 WHEN 0 THEN s1 WHEN 1 THEN s2 WHEN 2 THEN s3 ELSE s4 END, 2) + 0.0 AS y_hat
FROM p JOIN best ON p.series_id = best.series_id WHERE p.is_test""", recursive=True))
def holt_winters(spark, sf):
    return _points(smoothing.holt_winters(splits.holdout_split(staged_panel(spark, sf), HORIZON)))


_AR_SQL = """
, p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test,
               y - lag(y) OVER s - (lag(y, 4) OVER s - lag(y, 5) OVER s) AS z,
               lag(y) OVER s + lag(y, 4) OVER s - lag(y, 5) OVER s AS base
        FROM panel WINDOW s AS (PARTITION BY series_id ORDER BY date)),
q AS (SELECT *, lag(z) OVER s AS z1, lag(z, 4) OVER s AS z4 FROM p WINDOW s AS (PARTITION BY series_id ORDER BY date)),
m AS (SELECT series_id, sum(z1 * z1) AS a, sum(z1 * z4) AS b, sum(z4 * z4) AS c, sum(z1 * z) AS d, sum(z4 * z) AS e
      FROM q WHERE NOT is_test AND z4 IS NOT NULL GROUP BY 1),
phi AS (SELECT series_id, (c * d - b * e) / (a * c - b * b) AS phi_1, (a * e - b * d) / (a * c - b * b) AS phi_s FROM m)"""


@query("seasonal_ar", with_("panel", _AR_SQL + """
SELECT series_id, round(phi_1, 6) + 0.0 AS phi_1, round(phi_s, 6) + 0.0 AS phi_s FROM phi"""))
def seasonal_ar(spark, sf):
    df = splits.holdout_split(staged_panel(spark, sf), HORIZON)
    return rounded(linear.seasonal_ar_coefficients(df), phi_1=6, phi_s=6)


_ARMA_SQL = """
, tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test FROM panel) WHERE NOT is_test),
z0 AS (SELECT series_id, date, y, y - lag(y) OVER s - (lag(y, 4) OVER s - lag(y, 5) OVER s) AS z FROM tr WINDOW s AS (PARTITION BY series_id ORDER BY date)),
zz AS (SELECT *, lag(z) OVER s AS z1, lag(z, 4) OVER s AS z4, lag(z, 5) OVER s AS z5 FROM z0 WINDOW s AS (PARTITION BY series_id ORDER BY date)),
n3 AS (SELECT series_id, sum(z1*z1) AS a, sum(z1*z4) AS b, sum(z1*z5) AS c, sum(z4*z4) AS d, sum(z4*z5) AS e, sum(z5*z5) AS f,
              sum(z1*z) AS p, sum(z4*z) AS q, sum(z5*z) AS r FROM zz WHERE z5 IS NOT NULL GROUP BY 1),
-- the three equations by elimination: first z1 from the others, then z4 from the last
el AS (SELECT *, d - b*b/a AS d2, e - b*c/a AS e2, f - c*c/a AS f2, q - b*p/a AS q2, r - c*p/a AS r2 FROM n3),
psi AS (SELECT *, (q2 - e2 * k5) / d2 AS k4, (p - b * (q2 - e2 * k5) / d2 - c * k5) / a AS k1
        FROM (SELECT *, (r2 - e2*q2/d2) / (f2 - e2*e2/d2) AS k5 FROM el)),
res AS (SELECT zz.*, z - k1*z1 - k4*z4 - k5*z5 AS e FROM zz JOIN psi USING (series_id)),
inn AS (SELECT *, lag(e) OVER (PARTITION BY series_id ORDER BY date) AS e1 FROM res),
m AS (SELECT series_id, sum(z*z1) AS zx, sum(z*z4) AS zs, sum(z*z5) AS zp, sum(z*e1) AS ze, sum(z1*z1) AS xx, sum(z1*z4) AS xs, sum(z1*z5) AS xp,
             sum(z1*e1) AS xe, sum(z4*z4) AS ss, sum(z4*z5) AS sp, sum(z4*e1) AS se, sum(z5*z5) AS pp, sum(z5*e1) AS pe, sum(e1*e1) AS ee
      FROM inn WHERE e1 IS NOT NULL GROUP BY 1),
turn AS (
  SELECT series_id, 0 AS k, 0.0::DOUBLE AS ar, 0.0::DOUBLE AS sar, 0.0::DOUBLE AS ma, 0.0::DOUBLE AS moved FROM m
  UNION ALL
  SELECT series_id, k + 1, ar2, sar2, ma2, greatest(abs(ar2 - ar), abs(sar2 - sar), abs(ma2 - ma)) FROM (
    SELECT *, ((zs - ar2*xs - ma2*se) - ar2 * (zp - ar2*xp - ma2*pe)) / (ss - 2*ar2*sp + ar2*ar2*pp) AS sar2 FROM (
      SELECT *, (xw*ee - xe2*we) / (x2*ee - xe2*xe2) AS ar2, (x2*we - xe2*xw) / (x2*ee - xe2*xe2) AS ma2 FROM (
        SELECT t.k, t.ar, t.sar, t.ma, m.*, xx - 2*sar*xp + sar*sar*pp AS x2, xe - sar*pe AS xe2, ze - sar*se AS we, zx - sar*(xs + zp) + sar*sar*sp AS xw
        FROM turn t JOIN m ON m.series_id = t.series_id AND t.k < 200)))),
fit AS (SELECT series_id, ar, sar, ma, moved FROM turn WHERE k = 200)"""


@query("seasonal_arma", with_("panel", _ARMA_SQL + """
SELECT series_id, round(ar, 6) + 0.0 AS ar, round(sar, 6) + 0.0 AS seasonal_ar, round(ma, 6) + 0.0 AS ma, moved <= 1e-8 AS converged FROM fit""", recursive=True))
def seasonal_arma_fit(spark, sf):
    df = splits.holdout_split(staged_panel(spark, sf), HORIZON)
    return rounded(seasonal_arma.coefficients(df), ar=6, seasonal_ar=6, ma=6)


@query("seasonal_ar_forecast", with_("panel", _ARMA_SQL + """
, ends AS (SELECT inn.*, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back FROM inn),
state AS (
  SELECT series_id, 0 AS step, any_value(ar) AS ar, any_value(sar) AS sar, any_value(ma) AS ma,
         max(y) FILTER (back = 1) AS y1, max(y) FILTER (back = 2) AS y2, max(y) FILTER (back = 3) AS y3, max(y) FILTER (back = 4) AS y4, max(y) FILTER (back = 5) AS y5,
         max(z) FILTER (back = 1) AS w1, max(z) FILTER (back = 2) AS w2, max(z) FILTER (back = 3) AS w3, max(z) FILTER (back = 4) AS w4, max(z) FILTER (back = 5) AS w5,
         max(z - ar*z1 - sar*z4 + ar*sar*z5 - ma*e1) FILTER (back = 1) AS shock
  FROM ends JOIN fit USING (series_id) GROUP BY 1
  UNION ALL
  SELECT series_id, step + 1, ar, sar, ma, y1 + y4 - y5 + w, y1, y2, y3, y4, w, w1, w2, w3, w4, 0.0
  FROM (SELECT *, ar*w1 + sar*w4 - ar*sar*w5 + ma*shock AS w FROM state WHERE step < 8)),
test AS (SELECT series_id, date, y, 9 - back AS step FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back FROM panel) WHERE back <= 8)
SELECT t.series_id, t.date, t.y, round(s.y1, 2) + 0.0 AS y_hat FROM test t JOIN state s ON s.series_id = t.series_id AND s.step = t.step""", recursive=True))
def seasonal_ar_forecast(spark, sf):
    """Eight steps from the end of the training rows; no value of the test rows is read."""
    return _points(seasonal_arma.predict(splits.holdout_split(staged_panel(spark, sf), HORIZON)))


@query("holt_winters_fitted")
def holt_winters_fitted(spark, sf):
    """Forecasts with parameters and starting state fitted; ``holt_winters_optimality`` certifies the fit."""
    return _points(smoothing.holt_winters(splits.holdout_split(staged_panel(spark, sf), HORIZON), optimised=True))


@query("trend_season_regression")
def trend_season_regression(spark, sf):
    return linear.trend_season_fit_predict(splits.holdout_split(staged_panel(spark, sf), HORIZON))


@query("stacking")
def stacking(spark, sf):
    """Histogram trees, ridge and elastic net below, ridge above."""
    df = model_rows(spark, sf)
    base = {"trees": {}, "ridge": {"alpha": 1.0}, "elasticnet": {}}
    return ensemble.stacking(df, features.feature_columns(df), base)


@query("changepoint_forecast")
def changepoint_forecast(spark, sf):
    """Trend with chosen slope changes and season, with intervals; ``changepoint_optimality`` certifies the fit."""
    out = changepoints.fit_predict(splits.holdout_split(staged_panel(spark, sf), HORIZON))
    return rounded(out.select("series_id", "date", "y", "y_hat", "lower_80", "upper_80", "n_changes"), y_hat=2, lower_80=2, upper_80=2)


def fitted_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """``(model, series_id, date, y, y_hat)`` of every fitted forecaster on the hold-out, written once."""

    def build() -> DataFrame:
        df, own = model_rows(spark, sf), splits.holdout_split(staged_panel(spark, sf), HORIZON)
        names = features.feature_columns(df)
        forecasts = {
            "ridge": linear.fit_predict(df, names, "ridge"), "elasticnet": linear.fit_predict(df, names, "elasticnet"),
            "gbt": trees.fit_predict(df, names), "holt_winters": smoothing.holt_winters(own, optimised=True),
            "seasonal_ar": seasonal_arma.predict(own), "stacking": stacking(spark, sf), "trend_season": changepoints.fit_predict(own),
        }
        out = None
        for model, rows in forecasts.items():
            one = rows.select(F.lit(model).alias("model"), "series_id", "date", "y", "y_hat")
            out = one if out is None else out.unionByName(one)
        return out

    return inputs.stage(spark, ("fitted_forecasts", sf), build)


@query("leaderboard_fitted")
def leaderboard_fitted(spark, sf):
    """The fitted forecasters by mean error over the series, best first, and their place by MAPE."""
    scores = accuracy.evaluate_forecast(fitted_forecasts(spark, sf), ["model", "series_id"])
    means = scores.groupBy("model").agg(*[F.avg(m).alias(m) for m in ("rmse", "mae", "mape", "da")])
    place = F.row_number().over(Window.orderBy("mape", "model"))  # one row per model
    return accuracy.leaderboard(means.withColumn("mape_rank", place))


@query("best_model_fitted")
def best_model_fitted(spark, sf):
    return accuracy.best_model(accuracy.evaluate_forecast(fitted_forecasts(spark, sf), ["model", "series_id"]), keys=["series_id"])


@query("forecast_rows", with_("split", """
SELECT model, series_id, COUNT(*) AS n_rows, MIN(date) AS first_date, round(SUM(y), 2) AS total, COUNT(*) AS n_forecasts
FROM split, (VALUES ('ridge'), ('elasticnet'), ('gbt'), ('holt_winters'), ('seasonal_ar'), ('stacking'), ('trend_season')) AS m(model)
WHERE is_test GROUP BY 1, 2"""))
def forecast_rows(spark, sf):
    """Every fitted model answers every held-out row once."""
    return rounded(fitted_forecasts(spark, sf).groupBy("model", "series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.sum(F.col("y").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count("y_hat").alias("n_forecasts")), total=2)


@query("param_search")
def param_search(spark, sf):
    trials = ensemble.random_trials(30, {"alpha": (1e-3, 10.0, "log"), "l1_ratio": (0.05, 0.95, "linear")})
    df = model_rows(spark, sf)
    return ensemble.param_search(df, features.feature_columns(df), "elasticnet", trials)


@query("adaptive_search")
def adaptive_search(spark, sf):
    """Thirty trials in batches of ten, drawn from what the ones before have shown; the error is relative to the level of a series."""
    df = model_rows(spark, sf)
    space = {"alpha": (1e-3, 10.0, "log"), "l1_ratio": (0.05, 0.95, "linear")}
    return adaptive.linear_search(df, features.feature_columns(df), "elasticnet", space)


@query("tree_search")
def tree_search(spark, sf):
    """Thirty settings over eight dimensions, each on five walk-forward folds."""
    df = model_rows(spark, sf)
    return ensemble.tree_search(df, features.feature_columns(df), ensemble.random_trials(30, ensemble.TREE_SPACE))


@query("exog_ablation")
def exog_ablation(spark, sf):
    df = model_rows(spark, sf)
    subsets = {"all": features.feature_columns(df), "own": features.feature_columns(df, "own")}
    return ensemble.exog_ablation(df, subsets)


@query("exog_ablation_trees")
def exog_ablation_trees(spark, sf):
    df = model_rows(spark, sf)
    subsets = {"all": features.feature_columns(df), "own": features.feature_columns(df, "own")}
    return ensemble.exog_ablation(df, subsets, "trees")


# ---- forecasts beyond the data ---------------------------------------------------------------

_PATH = """
, coef AS (SELECT series_id, zy / (zz + 1) / s AS b, level - zy / (zz + 1) / s * m AS a
           FROM one_stats JOIN one_sums USING (series_id)),
last AS (SELECT series_id, max(date) AS d, arg_max(y, date) AS y FROM {panel} GROUP BY 1),
path AS (SELECT series_id, CAST(1 AS INTEGER) AS step, a + b * y AS y_hat FROM last JOIN coef USING (series_id)
         UNION ALL SELECT path.series_id, step + 1, a + b * y_hat FROM path JOIN coef ON coef.series_id = path.series_id
         WHERE step < 8),
dated AS (SELECT path.series_id, step, CAST(d + to_months(3 * step) AS DATE) AS date, y_hat
          FROM path JOIN last ON last.series_id = path.series_id)"""


def one_lag_forecast(spark: SparkSession, sf: str) -> DataFrame:
    df = own_rows(spark, sf)
    return forecast.recursive_forecast(staged_panel(spark, sf), linear.fit_coefficients(df, ["y_lag_1"]), HORIZON)


@query("recursive_forecast", with_("one_sums", _PATH.format(panel="panel") + """
, err AS (SELECT series_id, sqrt(avg((y - (level + zy / (zz + 1) * (y_lag_1 - m) / s)) ** 2)) AS rmse
          FROM split JOIN one_stats USING (series_id) JOIN one_sums USING (series_id) WHERE is_test GROUP BY 1)
SELECT dated.series_id, step, date, round(y_hat, 2) + 0.0 AS y_hat, round(y_hat - 1.28 * rmse, 2) + 0.0 AS lower_80,
       round(y_hat + 1.28 * rmse, 2) + 0.0 AS upper_80 FROM dated JOIN err ON err.series_id = dated.series_id""",
    recursive=True))
def recursive_forecast(spark, sf):
    """Eight steps of a one-lag model with intervals from its hold-out error."""
    test = linear.fit_predict(own_rows(spark, sf), ["y_lag_1"], "ridge")
    errors = test.groupBy("series_id").agg(accuracy.rmse().alias("rmse"))
    return forecast.with_interval(one_lag_forecast(spark, sf), errors)


@query("recursive_forecast_full")
def recursive_forecast_full(spark, sf):
    """All own-history features, with the exogenous columns carried forward."""
    df = model_rows(spark, sf)
    names = features.feature_columns(df, "engineered") + ["cpi", "unemployment_rate"]
    return forecast.recursive_forecast(staged_merged(spark, sf), linear.fit_coefficients(df, names), HORIZON)


@query("recursive_stump", with_("split", _stump_sql("split", ["y_lag_4"]) + """
, back AS (SELECT series_id, date, y, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS k FROM panel),
path AS (SELECT series_id, 0 AS step, max(y) FILTER (k = 1) AS y1, max(y) FILTER (k = 2) AS y2, max(y) FILTER (k = 3) AS y3, max(y) FILTER (k = 4) AS y4,
                max(date) AS d FROM back GROUP BY 1
         UNION ALL
         SELECT p.series_id, step + 1, m_y + s_y * CASE WHEN (y4 - m_y_lag_4) / s_y_lag_4 <= cut THEN below ELSE above END, y1, y2, y3, d
         FROM path p JOIN scale ON scale.series_id = p.series_id, best WHERE step < 8)
SELECT series_id, step, CAST(d + to_months(3 * step) AS DATE) AS date, round(y1, 2) + 0.0 AS y_hat FROM path WHERE step > 0""", recursive=True))
def recursive_stump(spark, sf):
    """Eight steps of a tree, each from the values predicted before."""
    forest, scales = histogram_trees.fit(own_rows(spark, sf), ["y_lag_4"], STUMP, early_stopping=False)
    return rounded(forecast.recursive_fitted(staged_panel(spark, sf), forecast.Fitted(("y_lag_4",), forest=forest, scales=scales), HORIZON), y_hat=2)


def carried_features(df: DataFrame) -> list[str]:
    return features.feature_columns(df, "engineered") + ["cpi", "unemployment_rate", "interest_rate_90d"]


@query("recursive_forecast_trees")
def recursive_forecast_trees(spark, sf):
    """Boosted trees carried on for eight quarters; exogenous columns keep their last value, missing ones stay missing."""
    df = model_rows(spark, sf)
    names = carried_features(df)
    forest, scales = histogram_trees.fit(df, names)
    return forecast.recursive_fitted(staged_merged(spark, sf), forecast.Fitted(tuple(names), forest=forest, scales=scales), HORIZON)


@query("recursive_forecast_stack")
def recursive_forecast_stack(spark, sf):
    """A stack of trees, ridge and elastic net carried on for eight quarters."""
    df = model_rows(spark, sf)
    names = features.feature_columns(df, "engineered") + ["cpi", "unemployment_rate"]
    model = ensemble.stacked_forecaster(df, names, {"trees": {}, "ridge": {"alpha": 1.0}, "elasticnet": {}})
    return forecast.recursive_fitted(staged_merged(spark, sf), model, HORIZON)


@query("append_forecast", with_("one_sums", _PATH.format(panel="panel") + """
SELECT series_id, date, round(y, 2) + 0.0 AS y, FALSE AS predicted FROM panel
UNION ALL SELECT series_id, date, round(y_hat, 2) + 0.0, TRUE FROM dated""", recursive=True))
def append_forecast(spark, sf):
    return rounded(forecast.append_forecast(staged_panel(spark, sf), one_lag_forecast(spark, sf)), y=2)




cte("panel_all", """
  SELECT series_id, date, y FROM panel
  UNION ALL SELECT 'ALL', date, CAST(SUM(CAST(y AS DECIMAL(28,2))) AS DOUBLE) FROM panel GROUP BY date""", "panel")
cte("all_split", """
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test FROM (
    SELECT *, lag(y) OVER s AS y_lag_1, lag(y, 8) OVER s AS y_lag_8 FROM panel_all
    WINDOW s AS (PARTITION BY series_id ORDER BY date)) WHERE y_lag_8 IS NOT NULL""", "panel_all")


@query("forecast_all_series", with_("all_split", """
, one_stats AS (SELECT series_id, avg(y_lag_1) AS m, stddev_pop(y_lag_1) AS s, avg(y) AS level FROM all_split
                WHERE NOT is_test GROUP BY 1),
one_sums AS (SELECT series_id, sum((y_lag_1 - m) / s * (y - level)) AS zy, sum(((y_lag_1 - m) / s) ** 2) AS zz
             FROM all_split JOIN one_stats USING (series_id) WHERE NOT is_test GROUP BY 1)"""
    + _PATH.format(panel="panel_all") + """
, wanted AS (SELECT DISTINCT c_mktsegment AS id FROM customer UNION SELECT n_name FROM nation),
src AS (SELECT id, coalesce(k.series_id, 'ALL') AS source_id FROM wanted LEFT JOIN (SELECT DISTINCT series_id FROM dated) k
        ON k.series_id = id)
SELECT id AS series_id, source_id, step, date, round(y_hat, 1) + 0.0 AS y_hat FROM src JOIN dated ON series_id = source_id""",
    recursive=True))
def forecast_all_series(spark, sf):
    """Segments get their own forecast; the nations have no series and get the aggregate one."""
    everything = inputs.stage(spark, ("panel_all", sf), lambda: forecast.with_aggregate_series(staged_panel(spark, sf)))
    df = splits.holdout_split(features.build_features(everything), HORIZON)
    coefficients = linear.fit_coefficients(df, ["y_lag_1"])
    wanted = inputs.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id")).distinct().unionByName(
        inputs.table(spark, sf, "nation").select(F.col("n_name").alias("series_id")))
    points = forecast.recursive_forecast(everything, coefficients, HORIZON)
    return rounded(forecast.forecast_all_series(points, wanted), y_hat=1)


@query("leakage_verdict", with_("split", _MODELS_SQL + """
, v AS (SELECT series_id, min(mape) AS best_mape, min(mape) FILTER (model = 'y_lag_4') AS baseline_mape FROM scores GROUP BY 1)
SELECT *, CASE WHEN abs(best_mape - 0.95) < 0.3 THEN 'warning' ELSE 'confirmed' END AS leak_check,
       CASE WHEN abs(baseline_mape - 2.58) > 0.5 THEN 'warning' ELSE 'ok' END AS drift_check FROM v"""))
def leakage_verdict(spark, sf):
    scores = model_scores(spark, sf)
    baseline = scores.filter("model = 'y_lag_4'").select("series_id", "mape")
    return verdicts.leakage_verdict(scores, baseline, ["series_id"])
