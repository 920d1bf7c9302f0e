"""Singular values, principal components and low-rank models of tall matrices.

A matrix is a table ``(..., vec)`` with one row per observation and a short feature vector, or a
table of triples for the user x item case. Only p x p matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermill.operators import grid
from quartermill.operators.vectors import apply_matrix, gram
from quartermill.session import materialise

OVERSAMPLE = 10
POWER_ITERATIONS = 5


def column_stats(df: DataFrame, vec: str, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, means and population deviations per component, from one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for j in range(size):
        x = F.col(vec)[j].cast("double")
        aggs += [F.avg(x).alias(f"m{j}"), F.stddev_pop(x).alias(f"s{j}")]
    row = df.agg(*aggs).first()
    mean = np.array([row[f"m{j}"] for j in range(size)], dtype=float)
    std = np.array([row[f"s{j}"] for j in range(size)], dtype=float)
    return row["n"], mean, std


def shift_scale(vec: Column, mean: np.ndarray, std: np.ndarray | None = None) -> Column:
    """``(vec - mean) / std`` element by element; a constant component divides by 1."""
    means = F.array(*[F.lit(float(m)) for m in mean])
    moved = F.zip_with(vec, means, lambda x, m: x.cast("double") - m)
    if std is None:
        return moved
    stds = F.array(*[F.lit(float(s) if s > 0 else 1.0) for s in std])
    return F.zip_with(moved, stds, lambda x, s: x / s)


def zscore_vectors(df: DataFrame, vec: str, size: int) -> DataFrame:
    _, mean, std = column_stats(df, vec, size)
    return df.withColumn(vec, shift_scale(F.col(vec), mean, std))


def fix_signs(components: np.ndarray) -> np.ndarray:
    """Columns turned so that the largest loading is positive; directions have no sign of their own."""
    largest = np.argmax(np.abs(components), axis=0)
    signs = np.sign(components[largest, np.arange(components.shape[1])])
    return components * np.where(signs == 0, 1.0, signs)


def eigen(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in descending order, never negative, and sign-fixed eigenvectors as columns."""
    values, vectors = np.linalg.eigh(moments)
    order = np.argsort(values)[::-1]
    return np.maximum(values[order], 0.0), fix_signs(vectors[:, order])


def svd_spectrum(df: DataFrame, vec: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(singular values, right singular vectors)`` of the rows, through the p x p Gram matrix."""
    values, vectors = eigen(gram(df, vec, size))
    return np.sqrt(values), vectors


def spectrum_table(spark: SparkSession, sigma: np.ndarray) -> DataFrame:
    """``(k, sigma, energy)`` with one row per singular value."""
    rows = [(k + 1, float(s), float(s * s)) for k, s in enumerate(sigma)]
    return spark.createDataFrame(rows, "k int, sigma double, energy double")


def cumulative_variance(spectrum: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds the explained and the running share of ``energy``; a spectrum has one row per component."""
    order = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("energy").over(Window.partitionBy(*keys))
    return spectrum.withColumns({"explained": F.col("energy") / total, "cumulative": F.sum("energy").over(order) / total})


def components_needed(cumulative: DataFrame, threshold: float) -> DataFrame:
    """Smallest k whose running share reaches ``threshold``; NULL when the spectrum never does."""
    return cumulative.agg(F.min(F.when(F.col("cumulative") >= threshold, F.col("k"))).alias("k"))


def svd_reconstruct(df: DataFrame, vec: str, vectors: np.ndarray, k: int) -> DataFrame:
    """Rows projected on the first k right singular vectors and back; the same for train and test."""
    return df.withColumn(vec, apply_matrix(F.col(vec), vectors[:, :k] @ vectors[:, :k].T))


def pca_fit(df: DataFrame, vec: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(mean, explained variance, components as columns)`` of the centred rows."""
    n, mean, _ = column_stats(df, vec, size)
    centred = df.select(shift_scale(F.col(vec), mean).alias("vec"))
    values, vectors = eigen(gram(centred, "vec", size) / max(n - 1, 1))
    return mean, values, vectors


def pca_transform(df: DataFrame, vec: str, mean: np.ndarray, components: np.ndarray) -> DataFrame:
    """Scores on the given components; rows are centred first."""
    return df.withColumn(vec, apply_matrix(shift_scale(F.col(vec), mean), components))


def loadings_table(spark: SparkSession, vectors: np.ndarray, features: Sequence[str]) -> DataFrame:
    """Long ``(k, feature, loading)`` of a p x p loading matrix."""
    rows = [(k + 1, f, float(vectors[i, k])) for k in range(vectors.shape[1]) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "k int, feature string, loading double")


def dominant_feature(loadings: DataFrame) -> DataFrame:
    """``(k, feature)`` with the largest absolute loading (ties: alphabetical)."""
    return loadings.groupBy("k").agg(
        F.min_by("feature", F.struct(-F.abs("loading"), F.col("feature"))).alias("feature"))


def top_loadings(loadings: DataFrame, n: int = 3) -> DataFrame:
    order = Window.partitionBy("k").orderBy(F.desc(F.abs("loading")), "feature")
    return loadings.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def low_rank_ridge(df: DataFrame, size: int, ranks: Sequence[int], alpha: float = 1.0) -> tuple[DataFrame, np.ndarray]:
    """Ridge on rank-k versions of the features for every k, from one pass over the training rows.

    ``df`` has ``vec`` and ``y`` (both centred on the training rows) and ``is_test``. Projecting the
    features and then fitting only needs the Gram matrix of ``[vec, y]``; the rank-k coefficients
    are V_k (L_k + alpha)^-1 V_k' X'y, for reconstructed features and for component scores alike.
    Returns the test rows with one ``pred_<k>`` column per rank, and the singular values.
    """
    joined = df.filter(~F.col("is_test")).select(F.concat("vec", F.array("y")).alias("vec"))
    moments = gram(joined, "vec", size + 1)
    values, vectors = eigen(moments[:size, :size])
    target = moments[:size, size]
    out = df.filter("is_test")
    for k in ranks:
        v = vectors[:, :k]
        w = v @ ((v.T @ target) / (values[:k] + alpha))
        product = sum((F.col("vec")[j] * float(w[j]) for j in range(1, size)), F.col("vec")[0] * float(w[0]))
        out = out.withColumn(f"pred_{k}", product)
    return out, np.sqrt(values)


def _seeded_vector(key: str, size: int, seed: int) -> Column:
    """Pseudo-random start in [-1, 1) that depends on the row's id only, not on its partition."""
    scale = float(2 ** 63)
    return F.array(*[F.xxhash64(F.col(key), F.lit(seed * 10_007 + j)) / scale for j in range(size)])


def _orthonormal(df: DataFrame, vec: str, size: int) -> DataFrame:
    """Columns of the id x size table made orthonormal through their Gram matrix."""
    values, vectors = np.linalg.eigh(gram(df, vec, size))
    keep = values > max(values.max(), 1e-300) * 1e-14
    inverse = np.where(keep, 1.0 / np.sqrt(np.where(keep, values, 1.0)), 0.0)
    return df.withColumn(vec, apply_matrix(F.col(vec), vectors * inverse))


def truncated_svd_factors(train: DataFrame, items: DataFrame, k: int = 50, seed: int = 42,
                          iterations: int = POWER_ITERATIONS, trip_cells: int = grid.TRIP_CELLS) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``(user factors, item factors, singular values)`` of the weight matrix given as triples.

    Randomised subspace iteration on the users' side. The cells are dealt once by item; a block takes the vectors of its users to its items
    and back, so no item vector travels between the iterations, and partial sums of users leave a block once. Vectors travel in single
    precision there; the last basis and its image are in double precision. An item too long for a block is cut, and
    then every product goes from table to table. Only the small Gram matrices reach the driver. Both factor tables absorb the
    square root of the singular values. Items without training rows get zero factors.
    """
    size = k + OVERSAMPLE
    triples = materialise(train.select("user_id", "item_id", "weight"), "triples")
    total = triples.count()
    by_item = grid.deal(triples, "item_id", "user_id", total, trip_cells, max(1, trip_cells // 2), max(1, trip_cells // 50))
    places = materialise(by_item.rows.select("block", "id"), "svd_places")
    start = places.withColumn("vec", _seeded_vector("id", size, seed))
    if by_item.has_split:
        by_user = grid.deal(triples, "user_id", "item_id", total)
        image = grid.product(by_user, start.select("id", "vec").distinct(), size)
    else:
        image = grid.product_back(by_item, start.withColumn("vec", F.col("vec").cast("array<float>")), size, "float")
    for _ in range(iterations - 1):
        basis = _orthonormal(materialise(image, "svd_image"), "vec", size)
        if by_item.has_split:
            image = grid.product(by_user, grid.product(by_item, basis, size), size)
        else:
            image = grid.round_trip(by_item, basis, size)
    basis = _orthonormal(materialise(image, "svd_image"), "vec", size)
    sent = basis if by_item.has_split else basis.withColumn("vec", F.col("vec").cast("array<float>"))
    basis = _orthonormal(grid.product(by_item, sent, size), "vec", size)
    # one more pass: the Gram route loses half of the digits where columns are nearly parallel
    basis = materialise(_orthonormal(basis, "vec", size), "svd_basis")
    if by_item.has_split:
        image = grid.product(by_user, basis, size)
    else:
        image = grid.product_back(by_item, places.join(basis, "id"), size)
    image, basis = materialise(image, "svd_image").withColumnRenamed("id", "user_id"), basis.withColumnRenamed("id", "item_id")
    values, rotation = eigen(gram(image, "vec", size))
    sigma = np.sqrt(values[:k])
    rotation = rotation[:, :k]
    root = np.sqrt(np.where(sigma > 0, sigma, 1.0))
    users = image.withColumn("vec", apply_matrix(F.col("vec"), rotation / root))
    known = basis.withColumn("vec", apply_matrix(F.col("vec"), rotation * np.where(sigma > 0, root, 0.0)))
    zeros = F.array_repeat(F.lit(0.0), k)
    every = items.select("item_id").distinct().join(known, "item_id", "left").withColumn("vec", F.coalesce("vec", zeros))
    return materialise(users, "svd_users"), materialise(every, "svd_items"), sigma
