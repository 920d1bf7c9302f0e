"""Named queries: spectra, low-rank models, topics, term weights and fitted recommenders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermill.functions.stopwords import ENGLISH
from quartermill.operators import (
    accuracy, ensemble, features, linear, nmf, ranking, recommend, scaling, spectral, text, trees, vectors, verdicts,
)
from quartermill.plans import inputs
from quartermill.plans.catalog import cte, query, rounded, with_
from quartermill.plans.models import model_rows
from quartermill.plans.purchases import K, catalogue, item_text, kept, popularity_order, train_test
from quartermill.session import materialise

DIM = 64
SVD_RANK = 50
INDUSTRY_TOPICS = 5
TEXT_TOPICS = 20

cte("cells64", """
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS j FROM embeddings""")
cte("z64", """
  SELECT vec_id, label, j, (x - avg(x) OVER c) / CASE WHEN stddev_pop(x) OVER c = 0 THEN 1 ELSE stddev_pop(x) OVER c END AS z
  FROM cells64 WINDOW c AS (PARTITION BY j)""", "cells64")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def standard(spark: SparkSession, sf: str) -> DataFrame:
    return spectral.zscore_vectors(embeddings(spark, sf), "vec", DIM)


@query("svd_spectrum")
def svd_spectrum(spark, sf):
    sigma, _ = spectral.svd_spectrum(standard(spark, sf), "vec", DIM)
    return spectral.cumulative_variance(spectral.spectrum_table(spark, sigma))


@query("svd_energy", with_("z64", """
SELECT COUNT(DISTINCT vec_id) AS n_rows, round(SUM(z * z), 4) AS energy FROM z64"""))
def svd_energy(spark, sf):
    """The squared singular values add up to the squared entries of the matrix."""
    df = standard(spark, sf)
    sigma, _ = spectral.svd_spectrum(df, "vec", DIM)
    energy = spectral.spectrum_table(spark, sigma).agg(F.sum("energy")).scalar()
    return rounded(df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("energy", energy), energy=4)


@query("svd_reconstruct", with_("z64", "SELECT vec_id, CAST(j AS INTEGER) AS j, round(z, 6) + 0.0 AS z FROM z64"))
def svd_reconstruct(spark, sf):
    """At full rank the reconstruction gives the matrix back."""
    df = standard(spark, sf)
    _, v = spectral.svd_spectrum(df, "vec", DIM)
    out = spectral.svd_reconstruct(df, "vec", v, DIM).select("vec_id", F.posexplode("vec").alias("_j", "z"))
    return rounded(out.select("vec_id", (F.col("_j") + 1).alias("j"), "z"), z=6)


@query("svd_reconstruct_rank3")
def svd_reconstruct_rank3(spark, sf):
    df = standard(spark, sf)
    _, v = spectral.svd_spectrum(df, "vec", DIM)
    return spectral.svd_reconstruct(df, "vec", v, 3).select("vec_id", "vec")


@query("pca_fit")
def pca_fit(spark, sf):
    _, values, _ = spectral.pca_fit(embeddings(spark, sf), "vec", DIM)
    rows = [(k + 1, float(v)) for k, v in enumerate(values)]
    return spectral.cumulative_variance(spark.createDataFrame(rows, "k int, energy double"))


@query("pca_total_variance", with_("cells64", """
, v AS (SELECT j, var_samp(x) AS v FROM cells64 GROUP BY 1) SELECT round(SUM(v), 6) AS total_variance FROM v"""))
def pca_total_variance(spark, sf):
    return rounded(pca_fit(spark, sf).agg(F.sum("energy").alias("total_variance")), total_variance=6)


@query("pca_scores", with_("cells64", """
, m AS (SELECT j, avg(x) AS m FROM cells64 GROUP BY 1)
SELECT vec_id, round(SUM((x - m) ** 2), 6) AS squared_length FROM cells64 JOIN m USING (j) GROUP BY 1"""))
def pca_scores(spark, sf):
    """Scores on all components keep each centred row's length."""
    df = embeddings(spark, sf)
    mean, _, components = spectral.pca_fit(df, "vec", DIM)
    scores = spectral.pca_transform(df, "vec", mean, components)
    length = vectors.l2_norm(F.col("vec"))
    return rounded(scores.select("vec_id", (length * length).alias("squared_length")), squared_length=6)


@query("cumulative_variance", with_("cells64", """
, e AS (SELECT j, SUM(x * x) AS energy FROM cells64 GROUP BY 1),
r AS (SELECT row_number() OVER (ORDER BY energy DESC) AS k, energy FROM e)
SELECT CAST(k AS INTEGER) AS k, round(energy / SUM(energy) OVER (), 6) AS explained,
       round(SUM(energy) OVER (ORDER BY k) / SUM(energy) OVER (), 6) AS cumulative FROM r"""))
def cumulative_variance(spark, sf):
    return rounded(_axis_spectrum(spark, sf).drop("energy"), explained=6, cumulative=6)


def _axis_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    """Energy per axis in descending order: 64 rows from one aggregate, ranked without any model."""
    df = embeddings(spark, sf)
    sums = df.agg(*[F.sum(F.col("vec")[j] * F.col("vec")[j]).alias(str(j)) for j in range(DIM)])
    axes = sums.unpivot([], [str(j) for j in range(DIM)], "axis", "energy")
    ranked = axes.withColumn("k", F.row_number().over(Window.orderBy(F.desc("energy"))))
    return spectral.cumulative_variance(ranked.select("k", "energy"))


@query("components_needed", with_("cells64", """
, e AS (SELECT j, SUM(x * x) AS energy FROM cells64 GROUP BY 1),
r AS (SELECT row_number() OVER (ORDER BY energy DESC) AS k, SUM(energy) OVER (ORDER BY energy DESC) / SUM(energy) OVER () AS c FROM e)
SELECT CAST(MIN(k) FILTER (c >= 0.9) AS INTEGER) AS k90, CAST(MIN(k) FILTER (c >= 0.95) AS INTEGER) AS k95,
       CAST(NULL AS INTEGER) AS k101 FROM r"""))
def components_needed(spark, sf):
    """A threshold the spectrum never reaches gives NULL."""
    cumulative = _axis_spectrum(spark, sf)
    out = spectral.components_needed(cumulative, 0.9).withColumnRenamed("k", "k90")
    return out.withColumns({name: spectral.components_needed(cumulative, threshold).scalar()
                            for name, threshold in (("k95", 0.95), ("k101", 1.01))})


@query("dominant_feature", with_("cells64", """
, v AS (SELECT label AS k, 'x' || j AS feature, avg(x) AS loading FROM cells64 GROUP BY 1, 2)
SELECT k, feature FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY abs(loading) DESC, feature) = 1"""))
def dominant_feature(spark, sf):
    return spectral.dominant_feature(_label_loadings(spark, sf))


@query("top_loadings", with_("cells64", """
, v AS (SELECT label AS k, 'x' || j AS feature, avg(x) AS loading FROM cells64 GROUP BY 1, 2)
SELECT k, feature, round(loading, 6) + 0.0 AS loading, CAST(row_number() OVER (PARTITION BY k ORDER BY abs(loading) DESC, feature)
  AS INTEGER) AS rank FROM v QUALIFY rank <= 3"""))
def top_loadings(spark, sf):
    return rounded(spectral.top_loadings(_label_loadings(spark, sf)), loading=6)


def _label_loadings(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of each axis per label, standing in for given loadings."""
    means = embeddings(spark, sf).groupBy(F.col("label").alias("k")).agg(
        *[F.avg(F.col("vec")[j]).alias(f"x{j + 1}") for j in range(DIM)])
    return means.unpivot(["k"], [f"x{j + 1}" for j in range(DIM)], "feature", "loading")


# ---- low-rank forecasting models -------------------------------------------------------------


def pooled_matrix(spark: SparkSession, sf: str, subset: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows ``(series_id, date, is_test, actual, y, vec)`` with features and target scaled per series."""
    df = model_rows(spark, sf)
    scaled, _, names = linear.prepare(df, features.feature_columns(df, subset))
    target = scaling.zscore_stats(df, ["y"], ~F.col("is_test"))
    both = scaling.zscore(scaled.withColumn("actual", F.col("y")), ["y"], ~F.col("is_test"))
    rows = both.select("series_id", "date", "is_test", "actual", "y", F.array(*names).alias("vec"))
    return materialise(rows, "pooled"), target, names


def rank_errors(rows: DataFrame, target: DataFrame, size: int, ranks: list[int]) -> DataFrame:
    """``(k, mape, rmse, da)``: ridge on rank-k features, metrics averaged over the series."""
    predicted, _ = spectral.low_rank_ridge(rows, size, ranks)
    long = predicted.unpivot(["series_id", "date", "actual"], [f"pred_{k}" for k in ranks], "model", "y_hat")
    back = scaling.inverse_zscore(long, target, {"y_hat": "y"}).withColumnRenamed("actual", "y")
    scores = accuracy.evaluate_forecast(back, ["model", "series_id"]).groupBy("model").agg(
        *[F.avg(m).alias(m) for m in ("mape", "rmse", "da")])
    return scores.select(F.substring("model", 6, 9).cast("int").alias("k"), "mape", "rmse", "da")


@query("svd_rank_ablation")
def svd_rank_ablation(spark, sf):
    """Error of ridge on rank-k reconstructions and its change against all components."""
    rows, target, names = pooled_matrix(spark, sf, "engineered")
    size = len(names)
    ranks = sorted({k for k in (1, 2, 3, 5, 10) if k < size} | {size})
    scores = materialise(rank_errors(rows, target, size, ranks), "rank_errors")
    full = scores.filter(F.col("k") == size).select("mape").scalar()
    return scores.withColumn("delta_mape", F.col("mape") - full)


@query("pca_sweep")
def pca_sweep(spark, sf):
    """Explained variance, ridge error and tree error per number of components."""
    rows, target, names = pooled_matrix(spark, sf, "all")
    size = len(names)
    ranks = sorted({min(k, size) for k in (2, 5, 10, 15, 20)} | {size})
    train = rows.filter(~F.col("is_test"))
    mean, values, components = spectral.pca_fit(train, "vec", size)
    ridge = rank_errors(rows, target, size, ranks).withColumnsRenamed(
        {"k": "n_components", "mape": "ridge_mape", "rmse": "ridge_rmse", "da": "ridge_da"})
    spectrum = spark.createDataFrame([(k + 1, float(v)) for k, v in enumerate(values)], "k int, energy double")
    shares = spectral.cumulative_variance(spectrum).select(
        F.col("k").alias("n_components"), (F.col("cumulative") * 100).alias("explained_var"))
    trees_rows = None
    for n in ranks:
        scores = spectral.pca_transform(rows, "vec", mean, components[:, :n])
        wide = scores.select("series_id", "date", F.col("actual").alias("y"), "is_test",
                             *[F.col("vec")[j].alias(f"pc_{j + 1}") for j in range(n)])
        predicted = trees.fit_predict(wide, [f"pc_{j + 1}" for j in range(n)])
        one = accuracy.evaluate_forecast(predicted).agg(
            F.avg("mape").alias("gbt_mape"), F.avg("rmse").alias("gbt_rmse"), F.avg("da").alias("gbt_da"))
        one = one.select(F.lit(n).alias("n_components"), "*")
        trees_rows = one if trees_rows is None else trees_rows.unionByName(one)
    return shares.join(ridge, "n_components").join(trees_rows, "n_components")


@query("leakage_verdict_sweep")
def leakage_verdict_sweep(spark, sf):
    """The gates on the sweep of components: its best error, and ridge on all components against itself."""
    sweep = materialise(pca_sweep(spark, sf), "sweep")
    size = sweep.agg(F.max("n_components")).scalar()
    baseline = sweep.filter(F.col("n_components") == size).select(F.col("ridge_mape").alias("mape"))
    expected = baseline.first()["mape"]
    return verdicts.leakage_verdict(sweep.select(F.col("ridge_mape").alias("mape")), baseline, leaked=0.0, expected=expected)


# ---- industry topics -------------------------------------------------------------------------


def industry_topics(spark: SparkSession, sf: str) -> nmf.Topics:
    scaled = scaling.minmax(inputs.industry(spark, sf), ["value"], ["industry"])
    return nmf.fit_topics(scaled, "date", "industry", "value", INDUSTRY_TOPICS)


@query("nmf_topics")
def nmf_topics(spark, sf):
    """Topic weights per quarter of the min-max scaled industry matrix."""
    topics = industry_topics(spark, sf)
    return topics.rows.select("date", *[F.col("vec")[j].alias(f"topic_{j + 1}") for j in range(INDUSTRY_TOPICS)])


@query("nmf_topic_terms")
def nmf_topic_terms(spark, sf):
    table = nmf.topic_table(spark, industry_topics(spark, sf))
    return nmf.top_terms(table, 3).join(nmf.topic_labels(table), "topic")


@query("topic_ablation")
def topic_ablation(spark, sf):
    """Ridge error with and without the lagged industry topics."""
    names = [f"topic_{j + 1}" for j in range(INDUSTRY_TOPICS)]
    weights = nmf_topics(spark, sf)
    base = model_rows(spark, sf)
    df = materialise(nmf.join_lagged_topics(base, weights, names), "with_topics")
    plain = features.feature_columns(base)
    return ensemble.exog_ablation(df, {"baseline": plain, "with_topics": plain + [f"{n}_lag1" for n in names]},
                                  with_cv=False).drop("verdict")


_GIVEN = inputs.BRANDS


@query("join_lagged_topics", with_("split industry", """
, w AS (SELECT date, """ + ", ".join(f"min(value) FILTER (industry = '{b}') AS t{i}" for i, b in enumerate(_GIVEN, 1)) + """
        FROM industry GROUP BY date),
l AS (SELECT date, """ + ", ".join(f"lag(t{i}) OVER (ORDER BY date) AS t{i}_lag1" for i in range(1, len(_GIVEN) + 1)) + """ FROM w)
SELECT series_id, date, """ + ", ".join(f"t{i}_lag1" for i in range(1, len(_GIVEN) + 1)) + """ FROM split LEFT JOIN l USING (date)"""))
def join_lagged_topics(spark, sf):
    names = [f"t{i}" for i in range(1, len(_GIVEN) + 1)]
    wide = inputs.industry(spark, sf).groupBy("date").pivot("industry", _GIVEN).agg(F.first("value"))
    weights = wide.toDF("date", *names)
    rows = model_rows(spark, sf).select("series_id", "date", "is_test")
    return nmf.join_lagged_topics(rows, weights, names).drop("is_test")


@query("topic_coverage", with_("split industry", """
, w AS (SELECT date, """ + ", ".join(f"min(value) FILTER (industry = '{b}') AS t{i}" for i, b in enumerate(_GIVEN, 1)) + """
        FROM industry GROUP BY date),
l AS (SELECT date, """ + ", ".join(f"lag(t{i}) OVER (ORDER BY date) AS t{i}" for i in range(1, len(_GIVEN) + 1)) + """ FROM w)
SELECT is_test, round(least(""" + ", ".join(f"avg((t{i} IS NOT NULL)::INTEGER)" for i in range(1, len(_GIVEN) + 1)) + """), 6) AS coverage
FROM split LEFT JOIN l USING (date) GROUP BY 1"""))
def topic_coverage(spark, sf):
    """Topics lag by a quarter, so they cover all but the first rows."""
    names = [f"t{i}" for i in range(1, len(_GIVEN) + 1)]
    wide = inputs.industry(spark, sf).groupBy("date").pivot("industry", _GIVEN).agg(F.first("value")).toDF("date", *names)
    rows = nmf.join_lagged_topics(model_rows(spark, sf).select("series_id", "date", "is_test"), wide, names)
    return rounded(nmf.topic_coverage(rows, names), coverage=6)


@query("top_terms", with_("industry", """
, h AS (SELECT 'topic_' || year(date) AS topic, industry AS term, SUM(CAST(value AS DECIMAL(28,2))) AS weight FROM industry GROUP BY 1, 2),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS INTEGER) AS rank FROM h)
SELECT topic, term, rank, first(topic || ' (' || term || ')') OVER (PARTITION BY topic ORDER BY rank) AS label
FROM t QUALIFY rank <= 5"""))
def top_terms(spark, sf):
    """Strongest brands per year, with yearly totals standing in for a given topic matrix."""
    table = inputs.industry(spark, sf).groupBy(
        F.concat(F.lit("topic_"), F.year("date").cast("string")).alias("topic"), F.col("industry").alias("term")
    ).agg(F.sum(F.col("value").cast("decimal(28,2)")).alias("weight"))
    return nmf.top_terms(table, 5).join(nmf.topic_labels(table), "topic").select("topic", "term", "rank", "label")


# ---- texts -----------------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in ENGLISH)


@query("tfidf", f"""
WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({_STOP})) AS w
           FROM documents),
g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM t),
c AS (SELECT doc_id, term, COUNT(*) AS tf FROM g GROUP BY 1, 2),
v AS (SELECT term, COUNT(*) AS df FROM c GROUP BY 1 HAVING COUNT(*) >= 2 ORDER BY SUM(tf) DESC, term LIMIT 5000),
x AS (SELECT doc_id, term, tf * (ln((1 + (SELECT COUNT(*) FROM documents)) / (1 + df)) + 1) AS w FROM c JOIN v USING (term))
SELECT doc_id, term, round(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""")
def tfidf(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return rounded(text.tfidf(docs, "doc_id", "text"), weight=6)


def item_topics(spark: SparkSession, sf: str) -> tuple[DataFrame, nmf.Topics]:
    """Unit-length topic vectors of the catalogue from the items' names."""
    weights = text.tfidf(item_text(spark, sf), "item_id", "p_name")
    topics = nmf.fit_topics(weights, "item_id", "term", "weight", TEXT_TOPICS)
    zeros = F.array_repeat(F.lit(0.0), TEXT_TOPICS)
    every = catalogue(spark, sf).join(topics.rows, "item_id", "left").withColumn("vec", F.coalesce("vec", zeros))
    return materialise(vectors.normalise(every), "item_topics"), topics


@query("nmf_text_topics")
def nmf_text_topics(spark, sf):
    return item_topics(spark, sf)[0]


# ---- fitted recommenders ---------------------------------------------------------------------


def svd_factors(spark: SparkSession, sf: str):
    train, _ = train_test(spark, sf)
    return spectral.truncated_svd_factors(train, catalogue(spark, sf), SVD_RANK)


@query("truncated_svd_factors")
def truncated_svd_factors(spark, sf):
    users, items, _ = svd_factors(spark, sf)
    return users.select(F.lit("user").alias("side"), F.col("user_id").cast("string").alias("id"), "vec").unionByName(
        items.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), "vec"))


@query("interaction_spectrum", with_("train", f"""
SELECT round(SUM(weight * weight), 4) AS energy, CAST({SVD_RANK} AS INTEGER) AS n_components, true AS within FROM train"""))
def interaction_spectrum(spark, sf):
    """Energy of the interaction matrix; the truncated spectrum must stay within it."""
    shares = svd_shares(spark, sf)
    energy = train_test(spark, sf)[0].agg(F.sum(F.col("weight") * F.col("weight"))).scalar()
    out = shares.agg(F.count(F.lit(1)).cast("int").alias("n_components"), F.max("cumulative").alias("held"))
    return rounded(out.select(energy.alias("energy"), "n_components", (F.col("held") <= 1.0).alias("within")), energy=4)


def svd_shares(spark: SparkSession, sf: str) -> DataFrame:
    """``(k, sigma, cumulative)``: share of the whole matrix that the first k components explain."""
    train, _ = train_test(spark, sf)
    _, _, sigma = svd_factors(spark, sf)
    total = train.agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).first()["s"]
    held = [float(x) for x in (sigma**2).cumsum() / total]
    return spark.createDataFrame([(k + 1, float(s), c) for k, (s, c) in enumerate(zip(sigma, held))], "k int, sigma double, cumulative double")


@query("svd_variance")
def svd_variance(spark, sf):
    """Explained share per component, and the components needed for 90 and 95 %; NULL where the rank does not suffice."""
    shares = svd_shares(spark, sf)
    return shares.withColumns({f"k{p}": spectral.components_needed(shares, p / 100).scalar() for p in (90, 95)})


@query("text_topic_terms")
def text_topic_terms(spark, sf):
    """The strongest words of every text topic."""
    return nmf.top_terms(nmf.topic_table(spark, item_topics(spark, sf)[1]), 10)


@query("fitted_loadings")
def fitted_loadings(spark, sf):
    """Strongest loadings and the dominant feature of every component of the fitted lag features."""
    rows, _, names = pooled_matrix(spark, sf, "engineered")
    _, _, components = spectral.pca_fit(rows.filter(~F.col("is_test")), "vec", len(names))
    table = spectral.loadings_table(spark, components, names)
    return spectral.top_loadings(table).join(spectral.dominant_feature(table).withColumnRenamed("feature", "dominant"), "k")


@query("rec_svd")
def rec_svd(spark, sf):
    train, test = train_test(spark, sf)
    users, items, _ = svd_factors(spark, sf)
    return recommend.rec_factors(users, items, train, test, K)


@query("scoring_blocks", with_("train", """
SELECT COUNT(DISTINCT user_id) AS n_users, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_unvisited FROM train"""))
def scoring_blocks(spark, sf):
    """Small blocks of items in falling order of length give every user the list that one block gives."""
    train, _ = train_test(spark, sf)
    users, items, _ = svd_factors(spark, sf)
    state, _ = vectors.top_k_state(users, items, K, train, item_block=200)
    whole, _ = vectors.top_k_state(users, items, K, train)
    both = state.select("user_id", "best", "visited").join(whole.select("user_id", F.col("best").alias("other")), "user_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n_users"), F.sum((~F.col("best").eqNullSafe(F.col("other"))).cast("bigint")).alias("n_changed"),
                    F.sum((F.coalesce("visited", F.lit(0)) < 1).cast("bigint")).alias("n_unvisited"))


@query("rec_als")
def rec_als(spark, sf):
    train, test = train_test(spark, sf)
    users, items = recommend.als_factors(train, kept(spark, sf))
    return recommend.rec_factors(users, items, train, test, K)


def fitted_recs(spark: SparkSession, sf: str, k: int = 50) -> DataFrame:
    """Lists of the five fitted recommenders, in long form and written once."""

    def build() -> DataFrame:
        train, test = train_test(spark, sf)
        users, items, _ = svd_factors(spark, sf)
        als = recommend.als_factors(train, kept(spark, sf))
        topics = item_topics(spark, sf)[0]
        lists = {
            "Popularity": recommend.rec_popularity(train, test, k, popularity_order(spark, sf)),
            "Truncated SVD": recommend.rec_factors(users, items, train, test, k),
            "ALS": recommend.rec_factors(*als, train, test, k),
            "Content-based": recommend.rec_content(train, topics, test, TEXT_TOPICS, k),
            "Hybrid": recommend.rec_hybrid(users, items, topics, train, test, SVD_RANK, TEXT_TOPICS, k),
        }
        out = None
        for model, recs in lists.items():
            one = recs.select(F.lit(model).alias("model"), "user_id", "item_id", F.col("rank").cast("int").alias("rank"), "score")
            out = one if out is None else out.unionByName(one)
        return out

    return inputs.stage(spark, ("fitted_recs", sf), build)


@query("evaluate_fitted")
def evaluate_fitted(spark, sf):
    """Ranking metrics of the five fitted recommenders and their verdict against popularity."""
    scores = inputs.stage(spark, ("fitted_scores", sf), lambda: ranking.evaluate_all(fitted_recs(spark, sf), train_test(spark, sf)[1]))
    return scores.join(ranking.beat_popularity(scores), "model")


@query("fitted_lists", with_("train test pairs", """
, items AS (SELECT COUNT(DISTINCT item_id) AS n FROM pairs),
seen AS (SELECT user_id, COUNT(DISTINCT item_id) AS n FROM train GROUP BY 1),
wanted AS (SELECT CAST(SUM(least(50, items.n - coalesce(seen.n, 0))) AS BIGINT) AS n_rows, COUNT(*) AS n_users
           FROM (SELECT DISTINCT user_id FROM test) t LEFT JOIN seen USING (user_id), items)
SELECT model, n_rows, n_users, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_misplaced
FROM wanted, (VALUES ('Popularity'), ('Truncated SVD'), ('ALS'), ('Content-based'), ('Hybrid')) AS m(model)"""))
def fitted_lists(spark, sf):
    """Every list is whole: as long as asked for or as there are unseen items, nothing seen or twice, best first."""
    recs, (train, _) = fitted_recs(spark, sf), train_test(spark, sf)
    return list_faults(recs, train)


def list_faults(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Rows, users, and seen, repeated and misplaced rows of the lists of each model; the rows of a list meet once."""
    seen = train.groupBy("user_id").agg(F.collect_set("item_id").alias("_seen"))  # at most the catalogue
    row = F.struct((-F.col("score")).alias("score"), F.col("rank"), F.col("item_id"))
    lists = recs.groupBy("model", "user_id").agg(F.array_sort(F.collect_list(row)).alias("_l")).join(seen, "user_id", "left")  # at most 50 rows each
    ids = F.col("_l.item_id")
    known = F.when(F.arrays_overlap(ids, "_seen"), F.size(F.filter(ids, lambda x: F.array_contains("_seen", x)))).otherwise(0)
    sums = {"n_rows": F.size("_l"), "n_seen": known, "n_repeated": F.size("_l") - F.size(F.array_distinct(ids)),
            "n_misplaced": F.size(F.filter("_l", lambda x, i: x["rank"] != i + 1))}
    return lists.groupBy("model").agg(F.count("user_id").alias("n_users"), *[F.sum(v).alias(n) for n, v in sums.items()]).select(
        "model", "n_rows", "n_users", "n_seen", "n_repeated", "n_misplaced")


@query("rec_content_topics")
def rec_content_topics(spark, sf):
    train, test = train_test(spark, sf)
    return recommend.rec_content(train, item_topics(spark, sf)[0], test, TEXT_TOPICS, K)


@query("rec_hybrid_fitted")
def rec_hybrid_fitted(spark, sf):
    train, test = train_test(spark, sf)
    users, items, _ = svd_factors(spark, sf)
    return recommend.rec_hybrid(users, items, item_topics(spark, sf)[0], train, test, SVD_RANK, TEXT_TOPICS, K)
