"""Certificates of fitted models: what must hold of a right fit, next to the SQL that states it from the tables.

A fit cannot be written in SQL, but the conditions that single it out can: no gradient is left at the
optimum, scores of different components are orthogonal, what a projection loses is the tail of the
spectrum. The numbers come from the data and the fitted parameters, not from the solver.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.operators import accuracy, adaptive, changepoints, ensemble, features, interactions, linear, nmf, recommend, scaling, smoothing, spectral, splits, text, trees, vectors
from quartermill.plans import inputs
from quartermill.plans.catalog import query, rounded, with_
from quartermill.plans.decompose import _STOP as STOP_LIST
from quartermill.plans.decompose import DIM, INDUSTRY_TOPICS, TEXT_TOPICS, embeddings, evaluate_fitted, fitted_recs, standard, svd_factors
from quartermill.plans.models import HORIZON, best_model_fitted, fitted_forecasts, leaderboard_fitted, model_rows
from quartermill.plans.purchases import item_text, kept, train_test
from quartermill.plans.timeseries import staged_panel
from quartermill.session import materialise

_TRAIN_ROWS = with_("split", "SELECT series_id, COUNT(*) AS n_rows, CAST(0 AS DOUBLE) AS violation FROM split WHERE NOT is_test GROUP BY 1")


def optimality(df: DataFrame, names: list[str], model: str, alpha: float, l1_ratio: float) -> DataFrame:
    """``(series_id, n_rows, violation)``: the largest gradient left, as a share of the largest at zero weights.

    ``l1_ratio`` 0 is ridge with the penalty ``alpha / 2 |w|^2`` on half the squared error; otherwise it
    is the elastic net on half the mean squared error, whose weights at zero may have any gradient within
    the threshold.
    """
    scaled, stats, cols = linear.prepare(df, names)
    weights = linear.fit_coefficients(df, names, model).join(stats, "series_id")
    filled = scaled.filter(~F.col("is_test")).join(
        weights.select("series_id", *[(F.col(f"b_{c}") * F.col(f"_std_{c}")).alias(f"w_{c}") for c in cols]), "series_id")
    level = F.avg("y").over(Window.partitionBy("series_id"))
    residual = F.col("y") - F.col("level") - sum((F.col(c) * F.col(f"w_{c}") for c in cols), F.lit(0.0))
    rows = filled.withColumn("level", level).withColumn("r", residual).withColumn("y0", F.col("y") - F.col("level"))
    sums = rows.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(F.col(c) * F.col("r")).alias(f"g_{c}") for c in cols],
        *[F.sum(F.col(c) * F.col("y0")).alias(f"z_{c}") for c in cols], *[F.first(f"w_{c}").alias(f"w_{c}") for c in cols])
    n = F.col("n_rows") if l1_ratio else F.lit(1.0)

    def left(c: str):
        gradient, w = F.col(f"g_{c}") / n, F.col(f"w_{c}")
        smooth = gradient - alpha * (1 - l1_ratio) * w
        if not l1_ratio:
            return F.abs(smooth)
        active = F.abs(smooth - alpha * l1_ratio * F.signum(w))
        return F.when(F.abs(w) > 1e-9, active).otherwise(F.greatest(F.lit(0.0), F.abs(gradient) - alpha * l1_ratio))

    worst = F.greatest(*[left(c) for c in cols]) / F.greatest(*[F.abs(F.col(f"z_{c}")) / n for c in cols])
    return sums.select("series_id", "n_rows", worst.alias("violation"))


@query("ridge_optimality", _TRAIN_ROWS)
def ridge_optimality(spark, sf):
    df = model_rows(spark, sf)
    return rounded(optimality(df, features.feature_columns(df), "ridge", linear.RIDGE_ALPHA, 0.0), violation=6)


@query("elasticnet_optimality", _TRAIN_ROWS)
def elasticnet_optimality(spark, sf):
    df = model_rows(spark, sf)
    return rounded(optimality(df, features.feature_columns(df), "elasticnet", linear.ELASTICNET_ALPHA, linear.ELASTICNET_L1_RATIO), violation=4)


@query("holt_winters_optimality", with_("panel", """
SELECT series_id, COUNT(*) - 8 AS n_rows, CAST(0 AS DOUBLE) AS violation, CAST(0 AS DOUBLE) AS moved_start, false AS above_grid, true AS converged FROM panel GROUP BY 1"""))
def holt_winters_optimality(spark, sf):
    """The fold in the JVM finds no smaller squared errors around a fit: not for parameters 0.001 away, not for a
    starting state moved in one part, and not for any point of the grid with a starting state of its own."""
    train = splits.holdout_split(staged_panel(spark, sf), HORIZON).filter("NOT is_test")
    period = 4
    fits = smoothing.holt_winters_optimised(train, period).join(smoothing.ordered_values(train).select("series_id", "ys"), "series_id")
    params, step = ("alpha", "beta", "gamma"), smoothing.PRECISION
    error = lambda start, a, b, c: smoothing.smooth_from(F.col("ys"), start, a, b, c, period)["sse"]
    shifts = [p for p in product((-1, 0, 1), repeat=3) if any(p)]
    near = F.explode(F.array(*[F.array(*[F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(n) + step * k)) for n, k in zip(params, p)]) for p in shifts])).alias("_p")
    around = fits.select("series_id", "ys", "start", near).groupBy("series_id").agg(F.min(error(F.col("start"), *[F.col("_p")[k] for k in range(3)])).alias("around"))
    scale = F.aggregate("ys", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v))) * 1e-4
    part = lambda level, trend, season: F.struct((F.col("start.level") + level).alias("level"), (F.col("start.trend") + trend).alias("trend"), season.alias("season"), F.lit(0.0).alias("sse"))
    same, none = F.col("start.season"), F.lit(0.0)
    bent = lambda k, by: F.transform(F.col("start.season"), lambda v, i: F.when(i == k, v + by).otherwise(v))
    moves = [m for by in (scale, -scale) for m in (part(by, none, same), part(none, by, same), *[part(none, none, bent(k, by)) for k in range(period)])]
    starts = fits.select("series_id", "ys", *params, F.explode(F.array(*moves)).alias("_s")).groupBy("series_id").agg(F.min(error(F.col("_s"), *map(F.col, params))).alias("starts"))
    grid = F.inline(F.array(*[F.struct(*[F.lit(v).alias(f"_{n}") for n, v in zip(params, g)]) for g in product(smoothing.ALPHAS, smoothing.BETAS, smoothing.GAMMAS)]))
    first = smoothing.first_state(F.col("ys"), period)
    before = F.struct((first["level"] - first["trend"]).alias("level"), first["trend"].alias("trend"), first["season"].alias("season"), F.lit(0.0).alias("sse"))
    coarse = fits.select("series_id", "ys", grid).groupBy("series_id").agg(F.min(error(before, *[F.col(f"_{n}") for n in params])).alias("coarse"))
    rows = fits.join(around, "series_id").join(starts, "series_id").join(coarse, "series_id")
    gap = lambda other: F.greatest(F.lit(0.0), 1 - F.col(other) / F.col("sse"))
    return rounded(rows.select("series_id", F.size("ys").cast("bigint").alias("n_rows"), gap("around").alias("violation"), gap("starts").alias("moved_start"),
                               (F.col("sse") > F.col("coarse")).alias("above_grid"), "converged"), violation=9, moved_start=9)


@query("changepoint_optimality", with_("panel", """
SELECT series_id, COUNT(*) - 8 AS n_rows, CAST(0 AS DOUBLE) AS free_gradient, CAST(0 AS DOUBLE) AS violation, true AS converged FROM panel GROUP BY 1"""))
def changepoint_optimality(spark, sf):
    """No gradient is left for level, slope and season; that of a slope change is the threshold where it is used, and not above it elsewhere."""
    df = splits.holdout_split(staged_panel(spark, sf), HORIZON)
    fits = changepoints.fit_predict(df).groupBy("series_id").agg(F.first("weights").alias("w"), F.first("threshold").alias("threshold"), F.first("converged").alias("converged"))
    rows, free, hinges = changepoints.design(df)
    columns = ["one", *free, *hinges]
    rows = rows.filter("NOT is_test").withColumn("one", F.lit(1.0)).join(fits, "series_id")
    rows = rows.withColumn("r", F.col("y") - sum((F.col(c) * F.col("w")[k] for k, c in enumerate(columns)), F.lit(0.0)))
    sums = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs("y")).alias("scale"), F.first("w").alias("w"), F.first("threshold").alias("threshold"),
                                         F.first("converged").alias("converged"), *[F.avg(F.col(c) * F.col("r")).alias(f"g_{c}") for c in columns])
    gradient = lambda c: F.col(f"g_{c}") / F.col("scale")
    limit = F.col("threshold") / F.col("scale")
    at = {c: F.col("w")[k] for k, c in enumerate(columns)}
    over = [F.when(F.abs(at[c]) > 1e-9 * F.col("scale"), F.abs(gradient(c) - limit * F.signum(at[c]))).otherwise(F.greatest(F.lit(0.0), F.abs(gradient(c)) - limit)) for c in hinges]
    return rounded(sums.select("series_id", "n_rows", F.greatest(*[F.abs(gradient(c)) for c in ["one", *free]]).alias("free_gradient"), F.greatest(*over).alias("violation"), "converged"),
                   free_gradient=8, violation=8)


def component_certificate(df: DataFrame, vec: str, components: np.ndarray, values: np.ndarray, divisor: float) -> DataFrame:
    """``(k, error, overlap)``: how far the mean square of each component's scores is from its value, and the
    largest product with another component's scores, both as shares of the first value."""
    size = components.shape[1]
    moments = vectors.gram(df.select(vectors.apply_matrix(F.col(vec), components).alias("s")), "s", size) / divisor
    top = max(values[0], 1e-300)
    rows = [(k + 1, float(abs(moments[k, k] - values[k]) / top), float(np.abs(np.delete(moments[k], k)).max(initial=0.0) / top)) for k in range(size)]
    return df.sparkSession.createDataFrame(rows, "k int, error double, overlap double")


_COMPONENTS = f"""
SELECT CAST(unnest(range(1, {DIM + 1})) AS INTEGER) AS k, CAST(0 AS DOUBLE) AS error, CAST(0 AS DOUBLE) AS overlap,
       (SELECT COUNT(*) FROM embeddings) AS n_rows"""


@query("svd_certificate", _COMPONENTS)
def svd_certificate(spark, sf):
    """Scores on the right singular vectors are orthogonal and have the squared singular values as their squares."""
    df = standard(spark, sf)
    sigma, v = spectral.svd_spectrum(df, "vec", DIM)
    out = rounded(component_certificate(df, "vec", v, sigma**2, 1.0), error=6, overlap=6)
    return out.withColumn("n_rows", df.agg(F.count(F.lit(1))).scalar())


@query("pca_certificate", _COMPONENTS)
def pca_certificate(spark, sf):
    df = embeddings(spark, sf)
    mean, values, components = spectral.pca_fit(df, "vec", DIM)
    centred = df.select(spectral.shift_scale(F.col("vec"), mean).alias("vec"))
    n = centred.count()
    out = rounded(component_certificate(centred, "vec", components, values, max(n - 1, 1)), error=6, overlap=6)
    return out.withColumn("n_rows", F.lit(n).cast("bigint"))


@query("rank3_certificate", with_("z64", """
SELECT COUNT(DISTINCT vec_id) AS n_rows, round(SUM(z * z), 3) AS energy, CAST(0 AS DOUBLE) AS excess, CAST(0 AS DOUBLE) AS moved FROM z64"""))
def rank3_certificate(spark, sf):
    """What rank 3 keeps and loses adds up, the loss is the tail of the spectrum, and a second projection moves nothing."""
    df = standard(spark, sf)
    sigma, v = spectral.svd_spectrum(df, "vec", DIM)
    once = spectral.svd_reconstruct(df.withColumn("full", F.col("vec")), "vec", v, 3)
    twice = spectral.svd_reconstruct(once.withColumn("once", F.col("vec")), "vec", v, 3)
    square = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
    length = lambda x: F.aggregate(x, F.lit(0.0), lambda s, e: s + e * e)
    sums = twice.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(length("once")).alias("held"), F.sum(square("full", "once")).alias("lost"),
        F.sum(square("once", "vec")).alias("moved"))
    tail = float((sigma[3:] ** 2).sum())
    return rounded(sums.select("n_rows", (F.col("held") + F.col("lost")).alias("energy"), (F.col("lost") / tail - 1).alias("excess"), "moved"),
                   energy=3, excess=6, moved=6)


@query("truncated_svd_certificate", with_("train", """
SELECT COUNT(*) AS n_cells, (SELECT COUNT(DISTINCT user_id) FROM train) AS n_users, CAST(0 AS DOUBLE) AS overlap, CAST(0 AS DOUBLE) AS residual
FROM (SELECT DISTINCT user_id, item_id FROM train)"""))
def truncated_svd_certificate(spark, sf):
    """Both factor tables are orthogonal with the singular values as their squares, and the first pair fits the matrix."""
    train, _ = train_test(spark, sf)
    users, items, sigma = svd_factors(spark, sf)
    size = len(sigma)
    worst = 0.0
    for side in (users, items):
        moments = vectors.gram(side, "vec", size) / sigma[0]
        worst = max(worst, float(np.abs(moments - np.diag(sigma / sigma[0])).max()))
    product = vectors.weighted_sum(train.join(items, "item_id"), "user_id", "weight", "vec", size)
    both = product.withColumnRenamed("vec", "image").join(users, "user_id")
    gap = F.col("image")[0] - float(sigma[0]) * F.col("vec")[0]
    residual = both.agg((F.sqrt(F.sum(gap * gap)) / F.sqrt(F.sum(F.col("image")[0] * F.col("image")[0]))).alias("residual"))
    counts = train.agg(F.countDistinct("user_id", "item_id").alias("n_cells"), F.countDistinct("user_id").alias("n_users"))
    return rounded(counts.withColumns({"overlap": F.lit(worst), "residual": F.lit(residual.first()["residual"])}), overlap=5, residual=3)


@query("als_optimality", with_("train", """
SELECT COUNT(*) AS n_cells, COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT item_id) AS n_items, CAST(0 AS DOUBLE) AS item_gradient, true AS users_settled FROM train"""))
def als_optimality(spark, sf):
    """The gradient of the loss that is left after the last half-step, from sums over the cells in the JVM.

    For the items, solved last, it is zero; that of the users is small beside what the cells alone would give.
    """
    train, _ = train_test(spark, sf)
    size, reg = 16, 0.1
    weighted = materialise(interactions.bm25_weights(train, kept(spark, sf)).select("user_id", "item_id", F.col("bm25").alias("c")), "weighted")
    users, items = (materialise(t, "factors") for t in recommend.als_factors(train, kept(spark, sf), rank=size, iterations=15, reg=reg))
    cells = weighted.join(users.withColumnRenamed("vec", "u"), "user_id").join(items.withColumnRenamed("vec", "v"), "item_id")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    pull = F.col("c") - (F.col("c") - 1) * dot  # of a cell on one side along the vector of the other

    def left(key: str, side: str, own: DataFrame, other: DataFrame) -> float:
        gram = vectors.gram(other, "vec", size) + reg * np.eye(size)
        sums = vectors.weighted_sum(cells.withColumn("pull", pull), key, "pull", side, size).withColumnRenamed("vec" if side == "vec" else side, "sum")
        both = sums.join(own.withColumn("held", vectors.apply_matrix(F.col("vec"), gram)), key)
        square = lambda x: F.aggregate(x, F.lit(0.0), lambda s, e: s + e * e)
        gap = both.agg(F.sqrt(F.sum(square(F.zip_with("sum", "held", lambda a, b: a - b))) / F.sum(square("sum"))).alias("gap"))
        return gap.first()["gap"]

    item_gap, user_gap = left("item_id", "u", items, users), left("user_id", "v", users, items)
    counts = train.agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"))
    return rounded(counts.withColumns({"item_gradient": F.lit(item_gap), "users_settled": F.lit(bool(user_gap < 0.05))}), item_gradient=9)


@query("nmf_certificate", with_("industry", f"""
SELECT COUNT(DISTINCT date) AS n_rows, COUNT(DISTINCT industry) AS n_columns, CAST({INDUSTRY_TOPICS} AS INTEGER) AS n_topics,
       CAST(0 AS BIGINT) AS n_negative, true AS falling, true AS same_error FROM industry"""))
def nmf_certificate(spark, sf):
    """Weights and topics are not negative, the error never rises, and it is the one the written factors leave."""
    scaled = scaling.minmax(inputs.industry(spark, sf), ["value"], ["industry"])
    topics = nmf.fit_topics(scaled, "date", "industry", "value", INDUSTRY_TOPICS)
    return topic_certificate(scaled, topics, "date", "industry", "value")


def topic_certificate(cells: DataFrame, topics: nmf.Topics, row: str, col: str, value: str) -> DataFrame:
    """Sizes, negative weights, whether the error fell and is that of the written factors: cells that are not there count as zero."""
    spark = cells.sparkSession
    names = spark.createDataFrame([(n, [float(x) for x in topics.h[:, i]]) for i, n in enumerate(topics.names)], "_name string, h array<double>")
    grid = cells.select(row, F.col(col).alias("_name"), value).join(topics.rows, row).join(names, "_name")
    fitted = F.aggregate(F.zip_with("vec", "h", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    square = topics.h @ topics.h.T
    held = vectors.gram(topics.rows, "vec", len(square))
    whole = float((held * square).sum())  # what the fitted values add up to, squared, over all cells
    sums = grid.agg(F.sum(F.col(value) * F.col(value) - 2 * F.col(value) * fitted).alias("error"), F.countDistinct(row).alias("n_rows"),
                    F.countDistinct("_name").alias("n_columns"), F.sum(F.exists("vec", lambda x: x < 0).cast("bigint")).alias("n_negative"))
    errors = topics.errors
    falling = all(b <= a * (1 + 1e-9) for a, b in zip(errors, errors[1:])) and float(topics.h.min()) >= 0
    return sums.select("n_rows", "n_columns", F.lit(len(square)).alias("n_topics"), "n_negative", F.lit(falling).alias("falling"),
                       (F.abs(F.col("error") + whole - errors[-1]) <= 1e-6 * errors[0]).alias("same_error"))


@query("text_topic_certificate", with_("items", f"""
, t AS (SELECT item_id, list_filter(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({STOP_LIST})) AS w
        FROM part JOIN items ON item_id = CAST(p_partkey AS VARCHAR)),
g AS (SELECT item_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM t),
c AS (SELECT item_id, term, COUNT(*) AS tf FROM g GROUP BY 1, 2),
v AS (SELECT term FROM c GROUP BY 1 HAVING COUNT(*) >= 2 ORDER BY SUM(tf) DESC, term LIMIT 5000)
SELECT COUNT(DISTINCT item_id) AS n_rows, COUNT(DISTINCT term) AS n_columns, CAST({TEXT_TOPICS} AS INTEGER) AS n_topics, CAST(0 AS BIGINT) AS n_negative,
       true AS falling, true AS same_error FROM c JOIN v USING (term)"""))
def text_topic_certificate(spark, sf):
    """The same for the topics of the items' names."""
    weights = materialise(text.tfidf(item_text(spark, sf), "item_id", "p_name"), "weights")
    topics = nmf.fit_topics(weights, "item_id", "term", "weight", TEXT_TOPICS)
    return topic_certificate(weights, topics, "item_id", "term", "weight")


@query("importance_total", "SELECT CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS n_negative")
def importance_total(spark, sf):
    df = model_rows(spark, sf)
    model, _, _, names = trees.fit(df, features.feature_columns(df))
    every = trees.importance(model, names, spark, top=len(names))
    return rounded(every.agg(F.sum("importance").alias("total"), F.sum((F.col("importance") < 0).cast("bigint")).alias("n_negative")), total=9)


@query("stacking_rows", with_("split", """
SELECT series_id, COUNT(*) AS n_rows, MIN(date) AS first_date, COUNT(*) AS n_forecasts FROM split WHERE is_test GROUP BY 1"""))
def stacking_rows(spark, sf):
    """Stacking answers every held-out row once."""
    df = model_rows(spark, sf)
    out = ensemble.stacking(df, features.feature_columns(df), {"ridge": {"alpha": 1.0}, "elasticnet": {}})
    return out.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.count("y_hat").alias("n_forecasts"))


@query("search_agrees", """
SELECT CAST(30 AS BIGINT) AS n_trials, CAST(1 AS BIGINT) AS n_best, CAST(0 AS BIGINT) AS n_better, CAST(0 AS DOUBLE) AS gap, COUNT(DISTINCT c_mktsegment) AS n_series
FROM customer JOIN orders ON o_custkey = c_custkey""")
def search_agrees(spark, sf):
    """The best trial of the adaptive search has the error that a search over its setting alone gives, and no whole trial beats it."""
    df = model_rows(spark, sf)
    names = features.feature_columns(df)
    found = materialise(adaptive.linear_search(df, names, "elasticnet", {"alpha": (1e-3, 10.0, "log"), "l1_ratio": (0.05, 0.95, "linear")}), "trials")
    best = found.filter("best").first()
    own = ensemble.param_search(df, names, "elasticnet", [{"alpha": best["alpha"], "l1_ratio": best["l1_ratio"]}])
    folds = ensemble.training_folds(df).groupBy("series_id").agg(F.avg(F.abs("y")).alias("level"))
    again = own.join(folds, "series_id").agg(F.avg(F.col("cv_rmse") / F.col("level")).alias("e"), F.count(F.lit(1)).alias("n_series")).first()
    counts = found.agg(F.count(F.lit(1)).alias("n_trials"), F.sum(F.col("best").cast("bigint")).alias("n_best"),
                       F.sum(((F.col("cv_rmse") < best["cv_rmse"]) & (F.col("folds") == 5)).cast("bigint")).alias("n_better"))
    return rounded(counts.withColumns({"gap": F.lit(abs(again["e"] / best["cv_rmse"] - 1)), "n_series": F.lit(again["n_series"]).cast("bigint")}), gap=6)


@query("leaderboard_agrees", with_("split", """
SELECT model, COUNT(DISTINCT series_id) AS n_series, CAST(0 AS DOUBLE) AS rmse_gap, CAST(0 AS DOUBLE) AS mape_gap, CAST(0 AS BIGINT) AS n_wrong_best, true AS in_order
FROM split, (VALUES ('ridge'), ('elasticnet'), ('gbt'), ('holt_winters'), ('seasonal_ar'), ('stacking'), ('trend_season')) AS m(model) GROUP BY 1"""))
def leaderboard_agrees(spark, sf):
    """The fitted leaderboard against errors from the written forecasts by a second formula (norms of arrays), its order, and
    the best model of each series against the least error by a plain comparison."""
    points = fitted_forecasts(spark, sf)
    gaps = F.collect_list(F.abs(F.col("y") - F.col("y_hat")))
    relative = F.collect_list(F.abs(F.col("y") - F.col("y_hat")) / (F.abs("y") + F.lit(1e-8)))
    own = points.groupBy("model", "series_id").agg(gaps.alias("d"), relative.alias("p"))
    total = lambda c, f: F.aggregate(c, F.lit(0.0), f)
    own = materialise(own.select("model", "series_id", F.sqrt(total("d", lambda s, x: s + x * x) / F.size("d")).alias("r"), (total("p", lambda s, x: s + x) / F.size("p") * 100).alias("m")), "errors")
    board = leaderboard_fitted(spark, sf).select("model", "rmse", "mape", F.row_number().over(Window.orderBy("rmse", "model")).alias("place"), "mape_rank")  # a row for each model
    means = own.groupBy("model").agg(F.count(F.lit(1)).alias("n_series"), F.avg("r").alias("r"), F.avg("m").alias("m"))
    means = means.withColumns({"r_place": F.row_number().over(Window.orderBy("r", "model")), "m_place": F.row_number().over(Window.orderBy("m", "model"))})
    chosen = best_model_fitted(spark, sf).select("series_id", F.col("model").alias("chosen"))
    least = own.groupBy("series_id").agg(F.min("m").alias("least"))
    wrong = own.join(chosen, "series_id").join(least, "series_id").filter((F.col("model") == F.col("chosen")) & (F.col("m") > F.col("least") * (1 + 1e-12))).count()
    rows = board.join(means, "model").select("model", "n_series", F.abs(F.col("rmse") / F.col("r") - 1).alias("rmse_gap"), F.abs(F.col("mape") / F.col("m") - 1).alias("mape_gap"),
                                             F.lit(wrong).cast("bigint").alias("n_wrong_best"), ((F.col("place") == F.col("r_place")) & (F.col("mape_rank") == F.col("m_place"))).alias("in_order"))
    return rounded(rows, rmse_gap=9, mape_gap=9)


RECOMMENDERS = ("Popularity", "Truncated SVD", "ALS", "Content-based", "Hybrid")


@query("evaluation_agrees", with_("test", """
SELECT model, COUNT(DISTINCT user_id) AS n_users, CAST(0 AS BIGINT) AS n_wrong, true AS same_verdict
FROM test, (VALUES ('Popularity'), ('Truncated SVD'), ('ALS'), ('Content-based'), ('Hybrid')) AS m(model) GROUP BY 1"""))
def evaluation_agrees(spark, sf):
    """The metrics of the fitted recommenders against a second count from the written lists, user by user, and the verdicts from it."""
    recs, (_, test) = fitted_recs(spark, sf), train_test(spark, sf)
    lists = recs.groupBy("model", "user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("l"))  # at most 50 rows each
    models = test.select("user_id", "item_id", F.explode(F.array(*[F.lit(m) for m in RECOMMENDERS])).alias("model"))
    place = F.array_position(F.transform("l", lambda x: x["item_id"]), F.col("item_id"))
    users = models.join(lists, ["model", "user_id"], "left").withColumn("at", F.coalesce(place, F.lit(0)))
    metrics = {}
    for k in (10, 20, 50):
        hit = (F.col("at") > 0) & (F.col("at") <= k)
        metrics |= {f"recall_{k}": hit.cast("double"), f"ndcg_{k}": F.when(hit, F.log(2.0, F.lit(2.0)) / F.log(2.0, F.col("at") + 1)).otherwise(0.0), f"map_{k}": F.when(hit, 1 / F.col("at")).otherwise(0.0)}
    again = materialise(users.groupBy("model").agg(F.count(F.lit(1)).alias("n_users"), *[F.avg(v).alias(f"_{n}") for n, v in metrics.items()]), "counted_again")
    both = evaluate_fitted(spark, sf).drop("n_users").join(again, "model")
    wrong = sum((F.abs(F.col(n) - F.col(f"_{n}")) > 1e-9).cast("bigint") for n in metrics)
    base = again.filter("model = 'Popularity'").select("_recall_10").scalar()
    gain = F.col("_recall_10") - base
    verdict = F.when(F.col("model") == "Popularity", F.col("verdict")).when(gain > 0.005, "beats").when(gain >= -0.005, "ties").otherwise("loses")
    return both.select("model", "n_users", wrong.cast("bigint").alias("n_wrong"), (F.col("verdict") == verdict).alias("same_verdict"))
