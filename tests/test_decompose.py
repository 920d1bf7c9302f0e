import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.operators import nmf, spectral, text, vectors


def matrix(spark, x):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, vec array<double>")


def test_singular_values_equal_numpy_and_planted_rank_is_found(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 8))
    df = matrix(spark, x)
    sigma, v = spectral.svd_spectrum(df, "vec", 8)
    assert np.allclose(sigma[:3], np.linalg.svd(x, compute_uv=False)[:3])
    table = spectral.cumulative_variance(spectral.spectrum_table(spark, sigma))
    assert spectral.components_needed(table, 0.999999).first()["k"] == 3
    assert spectral.components_needed(table, 1.1).first()["k"] is None
    back = np.stack([r["vec"] for r in spectral.svd_reconstruct(df, "vec", v, 3).orderBy("i").collect()])
    assert np.allclose(back, x, atol=1e-6)


def test_pca_centres_and_explains_all_variance(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(100, 4)) * [5, 2, 1, 0.1] + 7
    mean, values, components = spectral.pca_fit(matrix(spark, x), "vec", 4)
    assert np.allclose(mean, x.mean(0)) and np.allclose(values, np.linalg.eigvalsh(np.cov(x.T))[::-1])
    scores = np.stack([r["vec"] for r in spectral.pca_transform(matrix(spark, x), "vec", mean, components[:, :2]).collect()])
    assert np.allclose(scores.mean(0), 0, atol=1e-9) and np.allclose(scores.var(0, ddof=1), values[:2])


def test_low_rank_ridge_equals_ridge_on_reconstructed_features(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    x -= x[:50].mean(0)
    y = x @ rng.normal(size=5)
    y -= y[:50].mean()
    rows = [(i, i >= 50, float(y[i]), x[i].tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, is_test boolean, y double, vec array<double>")
    out, _ = spectral.low_rank_ridge(df, 5, [2, 5])
    got = out.orderBy("i").toPandas()
    _, _, vt = np.linalg.svd(x[:50], full_matrices=False)
    for k in (2, 5):
        p = vt[:k].T @ vt[:k]
        xk = x[:50] @ p
        w = np.linalg.solve(xk.T @ xk + np.eye(5), xk.T @ y[:50])
        assert np.allclose(got[f"pred_{k}"], x[50:] @ p @ w)


def test_truncated_svd_equals_numpy_on_a_planted_matrix(spark):
    rng = np.random.default_rng(3)
    x = np.maximum(rng.random((40, 4)) @ rng.random((4, 30)), 0)
    train = spark.createDataFrame([(u, f"i{i:02d}", float(x[u, i])) for u in range(40) for i in range(30)],
                                  "user_id bigint, item_id string, weight double")
    items = train.select("item_id").distinct().unionByName(spark.createDataFrame([("never",)], "item_id string"))
    users, factors, sigma = spectral.truncated_svd_factors(train, items, 4, iterations=3)
    assert np.allclose(sigma, np.linalg.svd(x, compute_uv=False)[:4], rtol=1e-6)
    u = np.stack([r["vec"] for r in users.orderBy("user_id").collect()])
    got = {r["item_id"]: r["vec"] for r in factors.collect()}
    v = np.stack([got[f"i{i:02d}"] for i in range(30)])
    assert np.allclose(u @ v.T, x, atol=1e-6) and got["never"] == [0.0] * 4
    assert np.allclose(np.diag(u.T @ u), sigma, rtol=1e-6)


def test_nmf_error_never_rises_and_finds_planted_topics(spark):
    rng = np.random.default_rng(4)
    w, h = rng.random((60, 2)), np.array([[1, 1, 1, 0, 0, 0], [0, 0, 0, 1, 1, 1]], dtype=float)
    x = w @ h
    rows = [(i, f"c{j}", float(x[i, j])) for i in range(60) for j in range(6)]
    df = spark.createDataFrame([*rows, (99, "c0", 0.0)], "i int, c string, x double")
    out = nmf.fit_topics(df, "i", "c", "x", 2, max_iter=60, tolerance=1e-9)
    assert all(b <= a + 1e-9 for a, b in zip(out.errors, out.errors[1:], strict=False))
    assert out.errors[-1] < 1e-3 * (x * x).sum() and (out.h >= 0).all()
    one, two = (nmf.fit_topics(df, "i", "c", "x", 2, max_iter=4, tolerance=0.0, seed=seed) for seed in (1, 7))
    assert np.allclose(one.h, two.h, atol=1e-4)  # the start does not depend on the seed
    assert nmf.fit_topics(df, "i", "c", "x", 2, max_iter=4, tolerance=0.9).converged
    assert not nmf.fit_topics(df, "i", "c", "x", 2, max_iter=1).converged
    weights = {r["i"]: r["vec"] for r in out.rows.collect()}
    assert weights[99] == [0.0, 0.0] and min(min(v) for v in weights.values()) >= 0
    table = nmf.topic_table(spark, out)
    groups = {frozenset(r["term"] for r in nmf.top_terms(table, 3).filter(F.col("topic") == t).collect()) for t in ("topic_1", "topic_2")}
    assert groups == {frozenset({"c0", "c1", "c2"}), frozenset({"c3", "c4", "c5"})}


def test_lagged_topics_only_show_the_previous_period(spark):
    weights = spark.createDataFrame([(dt.date(2020, m, 1), float(m)) for m in (3, 6, 9)], "date date, t double")
    rows = spark.createDataFrame([(dt.date(2020, m, 1), m > 6) for m in (3, 6, 9, 12)], "date date, is_test boolean")
    joined = nmf.join_lagged_topics(rows, weights, ["t"])
    assert [r["t_lag1"] for r in joined.orderBy("date").collect()] == [None, 3.0, 6.0, None]
    assert {r["is_test"]: r["coverage"] for r in nmf.topic_coverage(joined, ["t"]).collect()} == {False: 0.5, True: 0.5}


def test_terms_of_a_document_do_not_move(spark):
    docs = spark.createDataFrame([(i % 7, f"red ring {i} red") for i in range(20)], "d bigint, t string")
    counts = text.term_counts(docs, "d", "t")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    got = {(r["d"], r["term"]): r["tf"] for r in counts.collect()}
    assert got[(0, "red")] == 6 and got[(0, "red ring")] == 3 and got[(6, "red")] == 4


def test_tfidf_against_a_direct_computation(spark):
    docs = {1: "The red ring and the RED box", 2: "red ring ring", 3: "a blue box é çà", 4: "", 5: None}
    df = spark.createDataFrame(list(docs.items()), "d int, t string")
    got = {(r["d"], r["term"]): r["weight"] for r in text.tfidf(df, "d", "t", stop_words=("the", "and")).collect()}
    counts = {1: {"red": 2, "ring": 1, "box": 1, "red ring": 1, "ring red": 1, "red box": 1},
              2: {"red": 1, "ring": 2, "red ring": 1, "ring ring": 1},
              3: {"blue": 1, "box": 1, "çà": 1, "blue box": 1, "box çà": 1}}
    df_of = {}
    for c in counts.values():
        for term in c:
            df_of[term] = df_of.get(term, 0) + 1
    want = {}
    for d, c in counts.items():
        raw = {t: n * (np.log(6 / (1 + df_of[t])) + 1) for t, n in c.items() if df_of[t] >= 2}
        norm = np.sqrt(sum(v * v for v in raw.values()))
        want |= {(d, t): v / norm for t, v in raw.items()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_vocabulary_ties_are_alphabetical_and_whole_texts_count(spark):
    long_text = " ".join(["zz"] * 30_000 + ["tail", "end"])
    df = spark.createDataFrame([(1, long_text), (2, "tail end zz"), (3, "mm nn"), (4, "nn mm")], "d int, t string")
    counts = text.term_counts(df, "d", "t", 1, ())
    assert counts.filter("d = 1 AND term = 'end'").count() == 1
    assert [r["term"] for r in text.vocabulary(counts, 3).collect()] == ["zz", "end", "mm"]


def test_gram_and_normalise(spark):
    x = np.random.default_rng(5).normal(size=(50, 3))
    assert np.allclose(vectors.gram(matrix(spark, x).repartition(4), "vec", 3), x.T @ x)
    out = vectors.normalise(matrix(spark, np.array([[3.0, 4.0], [0.0, 0.0]]))).orderBy("i").collect()
    assert out[0]["vec"] == [0.6, 0.8] and out[1]["vec"] == [0.0, 0.0]
