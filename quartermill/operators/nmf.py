"""Non-negative factorisation of a sparse table ``(row, col, x)`` with a bounded set of columns.

Columns are topics' vocabulary or industries: their number is a parameter of the method, so the
k x columns matrix H fits anywhere. Rows are unbounded and stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermill.session import materialise

MAX_COLUMNS = 5000
INNER_SWEEPS = 50
OVERSAMPLE, POWER_PASSES = 5, 4
TINY = 1e-12


@dataclass
class Topics:
    names: list[str]
    h: np.ndarray
    errors: list[float]
    rows: DataFrame
    converged: bool = True  # whether the error stopped falling before the iterations ended


def sparse_rows(df: DataFrame, row: str, col: str, value: str, max_columns: int = MAX_COLUMNS) -> tuple[DataFrame, list[str]]:
    """``(row, idx, val)`` with column positions, and the column names in order.

    The number of distinct columns is checked before they are listed: the method keeps topics x columns
    numbers on the driver, and ``max_columns`` says how many columns that may be.
    """
    names = [r[0] for r in df.select(col).distinct().orderBy(col).limit(max_columns + 1).collect()]
    if len(names) > max_columns:
        raise ValueError(f"more than {max_columns} columns; raise max_columns if topics x columns fit the driver")
    spark = df.sparkSession
    index = spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{col} string, _idx int")
    placed = df.filter(F.col(value) > 0).join(F.broadcast(index), col)
    pairs = F.array_sort(F.collect_list(F.struct("_idx", F.col(value).alias("_x"))))
    rows = placed.groupBy(row).agg(pairs.alias("_p"))
    return rows.select(row, F.transform("_p", lambda p: p["_idx"]).alias("idx"),
                       F.transform("_p", lambda p: p["_x"]).alias("val")), names


def _flat(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, column and value of every cell of a batch."""
    sizes = [len(i) for i in batch["idx"]]
    place = np.repeat(np.arange(len(batch)), sizes)
    return place, np.concatenate(list(batch["idx"])).astype(int), np.concatenate(list(batch["val"])).astype(float)


def _row_weights(batch: pd.DataFrame, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best non-negative topic weights of each row for fixed H, and the rows' products with H."""
    place, idx, val = _flat(batch)
    products = np.stack([np.bincount(place, h[t, idx] * val, len(batch)) for t in range(len(h))], axis=1)
    square = h @ h.T
    w = np.zeros_like(products)
    for _ in range(INNER_SWEEPS):
        before = w.copy()
        for j in range(h.shape[0]):
            gradient = products[:, j] - w @ square[:, j] + w[:, j] * square[j, j]
            w[:, j] = np.maximum(gradient, 0.0) / max(square[j, j], TINY)
        if np.max(np.abs(w - before), initial=0.0) <= 1e-8 * max(np.max(w, initial=0.0), TINY):
            break
    return w, products


def _pass(rows: DataFrame, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass over the rows: W'X (k x columns), W'W (k x k) and the squared error for the given H.

    Each partition sends its partial sums as cells, which Spark adds up by cell, map side first.
    """
    k, width = h.shape

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wx, ww, error = np.zeros((k, width)), np.zeros((k, k)), 0.0
        square = h @ h.T
        for batch in batches:
            if batch.empty:
                continue
            w, products = _row_weights(batch, h)
            ww += w.T @ w
            place, idx, val = _flat(batch)
            for t in range(k):
                wx[t] += np.bincount(idx, w[place, t] * val, width)
            norms = float(np.dot(val, val))
            error += norms - 2 * float((w * products).sum()) + float(np.einsum("ij,jk,ik->", w, square, w))
        cells = np.concatenate([wx, ww, np.full((k, 1), error / k)], axis=1)
        topic, column = np.nonzero(cells)
        yield pd.DataFrame({"topic": topic, "cell": column, "x": cells[topic, column]})

    parts = rows.select("idx", "val").mapInPandas(partial, "topic int, cell int, x double")
    total = np.zeros((k, width + k + 1))
    for r in parts.groupBy("topic", "cell").agg(F.sum("x").alias("x")).collect():  # topics x columns cells
        total[r["topic"], r["cell"]] = r["x"]
    return total[:, :width], total[:, width:width + k], max(float(total[:, -1].sum()), 0.0)


def _improve(h: np.ndarray, wx: np.ndarray, ww: np.ndarray) -> np.ndarray:
    """Coordinate updates of H for fixed W; needs only W'X and W'W."""
    h = h.copy()
    for _ in range(INNER_SWEEPS):
        before = h.copy()
        for j in range(h.shape[0]):
            if ww[j, j] > TINY:
                h[j] = np.maximum(h[j] + (wx[j] - ww[j] @ h) / ww[j, j], 0.0)
        if np.max(np.abs(h - before)) <= 1e-8 * max(np.max(h), TINY):
            break
    return h


def _summed(rows: DataFrame, shape: tuple[int, int], partial) -> np.ndarray:
    """Sum over the partitions of a small table that ``partial`` makes of the cells of a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for batch in batches:
            if not batch.empty:
                total += partial(*_flat(batch), len(batch))
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": i, "j": j, "x": total[i, j]})

    out = np.zeros(shape)
    for r in rows.select("idx", "val").mapInPandas(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():  # the cells of the table
        out[r["i"], r["j"]] = r["x"]
    return out


def singular_start(rows: DataFrame, width: int, topics: int, seed: int = 42) -> np.ndarray:
    """Start of H from the leading singular pairs: of each, the positive or the negative part of both vectors, whichever weighs more.

    The pairs come from a few passes of subspace iteration, of which the driver holds columns x topics numbers as it does of H;
    of the rows' vectors only the lengths of both parts are summed. A pair that the matrix lacks gives its topic the mean.
    """
    size = min(width, topics + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]

    def images(place: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(place, matrix[idx, t] * val, n) for t in range(matrix.shape[1])], axis=1)

    for _ in range(POWER_PASSES):
        def onwards(place, idx, val, n, basis=basis):
            image = images(place, idx, val, n, basis)
            return np.stack([np.bincount(idx, image[place, t] * val, width) for t in range(size)], axis=1)

        basis = np.linalg.qr(_summed(rows, (width, size), onwards))[0]

    def squares(place, idx, val, n):
        image = images(place, idx, val, n, basis)
        return image.T @ image

    values, rotation = np.linalg.eigh(_summed(rows, (size, size), squares))
    order = np.argsort(values)[::-1][:topics]
    sigma, v = np.sqrt(np.maximum(values[order], 0.0)), basis @ rotation[:, order]

    def parts(place, idx, val, n):
        image = images(place, idx, val, n, v)
        return np.stack([(np.maximum(image, 0.0) ** 2).sum(axis=0), (np.maximum(-image, 0.0) ** 2).sum(axis=0)])

    lengths = np.sqrt(_summed(rows, (2, len(order)), parts)) / np.where(sigma > 0, sigma, 1.0)
    h = np.zeros((topics, width))
    for j in range(len(order)):
        if sigma[j] > 1e-9 * sigma[0]:
            own = max(((lengths[side, j], np.maximum(sign * v[:, j], 0.0)) for side, sign in ((0, 1.0), (1, -1.0))), key=lambda p: p[0] * np.linalg.norm(p[1]))
            norm = np.linalg.norm(own[1])
            h[j] = np.sqrt(sigma[j] * own[0] * norm) * own[1] / max(norm, TINY)
    mean = max(float(h.mean()), TINY)
    h[h.sum(axis=1) <= TINY] = mean
    return h + 1e-6 * mean


def fit_topics(df: DataFrame, row: str, col: str, value: str, topics: int, max_iter: int = 500,
               tolerance: float = 1e-4, seed: int = 42, max_columns: int = MAX_COLUMNS) -> Topics:
    """Alternating non-negative least squares from :func:`singular_start` until the error falls by at most ``tolerance`` of the first.

    Every iteration is one job over the rows. Row weights depend on H alone, so nothing but H is
    carried from one iteration to the next, and a lost executor only repeats its part of one pass.
    """
    rows, names = sparse_rows(df, row, col, value, max_columns)
    rows = materialise(rows, "nmf_rows")
    if rows.isEmpty():
        raise ValueError("no positive cells to factorise")
    h = singular_start(rows, len(names), topics, seed)
    errors, converged = [], False
    for _ in range(max_iter):
        wx, ww, error = _pass(rows, h)
        errors.append(error)
        converged = len(errors) > 1 and errors[-2] - error <= tolerance * errors[0]
        if converged:
            break
        h = _improve(h, wx, ww)

    def weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                yield pd.DataFrame({row: batch[row], "vec": list(_row_weights(batch, h)[0])})

    row_type = df.schema[row].dataType.simpleString()
    fitted = rows.mapInPandas(weights, f"{row} {row_type}, vec array<double>")
    # rows without a positive cell have no weights; they come back as zero vectors
    zeros = F.array_repeat(F.lit(0.0), topics)
    every = df.select(row).distinct().join(fitted, row, "left").withColumn("vec", F.coalesce("vec", zeros))
    return Topics(names, h, errors, materialise(every, "nmf_weights"), converged)


def topic_table(spark: SparkSession, topics: Topics) -> DataFrame:
    """Long ``(topic, term, weight)`` of H, whose size is bounded by topics x columns."""
    rows = [(f"topic_{j + 1}", name, float(topics.h[j, i]))
            for j in range(topics.h.shape[0]) for i, name in enumerate(topics.names)]
    return spark.createDataFrame(rows, "topic string, term string, weight double")


def top_terms(table: DataFrame, n: int) -> DataFrame:
    """The n strongest terms per topic (ties: alphabetical)."""
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return table.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def topic_labels(table: DataFrame) -> DataFrame:
    """``(topic, label)``: the topic's name with its strongest term."""
    best = F.min_by("term", F.struct(-F.col("weight"), F.col("term")))
    return table.groupBy("topic").agg(F.concat(F.col("topic"), F.lit(" ("), best, F.lit(")")).alias("label"))


def lagged_topics(weights: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(date, <name>_lag1...)``: topic weights of the previous period, safe to use as features."""
    order = Window.orderBy("date")
    return weights.select("date", *[F.lag(F.col(n)).over(order).alias(f"{n}_lag1") for n in names])


def join_lagged_topics(df: DataFrame, weights: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join of the lagged topic weights by date; one row per calendar period on the right."""
    return df.join(lagged_topics(weights, names), "date", "left")


def topic_coverage(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(is_test, coverage)``: smallest non-missing share over the lagged columns, per split."""
    shares = [F.avg(F.col(f"{n}_lag1").isNotNull().cast("double")) for n in names]
    return df.groupBy("is_test").agg((F.least(*shares) if len(shares) > 1 else shares[0]).alias("coverage"))
