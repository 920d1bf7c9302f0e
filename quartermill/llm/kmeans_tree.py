"""Nearest neighbours with a tree of k-means clusters, searched best bin first.

The tree is grown on a bounded sample; every vector is then led to a leaf. A query keeps the branches it
has not taken in a priority queue and goes on with the nearest, so leaves come in the order of their
promise. How many it visits is found by widening until the recall on known neighbours is reached, and
a query goes on beyond that until its leaves hold enough candidates.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import column_type
from quartermill.session import materialise


@dataclass(frozen=True)
class TreeSettings:
    branches: int = 8
    leaf_rows: int = 128  # sampled vectors in a leaf
    sample_rows: int = 20_000  # vectors the tree is grown on: those with the smallest hash of their id
    rounds: int = 8  # of k-means at a node
    calibration_queries: int = 300
    recall: float = 0.96  # of the true neighbours in the sample, at which widening stops
    block_rows: int = 4096  # vectors of a leaf in one group
    block_queries: int = 2048  # queries in one group
    seed: int = 5


class Tree:
    """Centres of all nodes; ``children[n]`` lists the nodes below ``n``, ``leaf[n]`` is its number or -1."""

    def __init__(self, dim: int):
        self.centres: list[np.ndarray] = [np.zeros(dim)]
        self.children: list[np.ndarray] = [np.zeros(0, int)]
        self.leaf: list[int] = [-1]
        self.leaves = 0

    def grow(self, x: np.ndarray, s: TreeSettings) -> Tree:
        rng = np.random.default_rng(s.seed)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            parts = _clusters(x[rows], s, rng) if len(rows) > s.leaf_rows else []
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            below = []
            for centre, members in parts:
                below.append(len(self.centres))
                self.centres.append(centre)
                self.children.append(np.zeros(0, int))
                self.leaf.append(-1)
                todo.append((below[-1], rows[members]))
            self.children[node] = np.array(below)
        self.table = np.stack(self.centres)
        return self

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every node."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = self.children[node]
            nearest = _squares(x[rows], self.table[below]).argmin(axis=1)
            todo += [(int(below[k]), rows[nearest == k]) for k in range(len(below)) if (nearest == k).any()]
        return out

    def visit(self, query: np.ndarray, least: int, candidates: np.ndarray | None = None, wanted: int = 0) -> list[int]:
        """The first ``least`` leaves, nearest branch first, and more until they hold ``wanted`` of the ``candidates`` per leaf."""
        distance = ((self.table - query) ** 2).sum(axis=1)
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < least or held < wanted):
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                below = self.children[node]
                order = below[np.argsort(distance[below], kind="stable")]
                for other in order[1:]:
                    heapq.heappush(queue, (float(distance[other]), int(other)))
                node = int(order[0])
            found.append(self.leaf[node])
            held += 0 if candidates is None else int(candidates[self.leaf[node]])
        return found


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1), 0)


def _clusters(x: np.ndarray, s: TreeSettings, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Centres and members of the clusters of a node; fewer than two if its vectors are all alike."""
    distinct = np.unique(x, axis=0)
    k = min(s.branches, len(distinct))
    if k < 2:
        return []
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(s.rounds):
        nearest = _squares(x, centres).argmin(axis=1)
        centres = np.stack([x[nearest == i].mean(axis=0) if (nearest == i).any() else centres[i] for i in range(k)])
    nearest = _squares(x, centres).argmin(axis=1)
    return [(centres[i], np.flatnonzero(nearest == i)) for i in range(k) if (nearest == i).any()]


def calibrate(tree: Tree, sample: np.ndarray, neighbours: int, s: TreeSettings) -> int:
    """Leaves to visit so that the sample's own nearest neighbours are found with the recall asked for.

    The sample is thinner than the whole, so its neighbours lie farther off and are harder to find. Copies
    of a vector, which have their neighbours in one leaf, are one query.
    """
    if len(sample) < 2:
        return max(1, tree.leaves)
    leaf = tree.assign(sample)
    distinct = np.sort(np.unique(sample, axis=0, return_index=True)[1])
    queries = distinct[np.linspace(0, len(distinct) - 1, min(s.calibration_queries, len(distinct))).astype(int)]
    place = np.empty((len(queries), tree.leaves), int)
    needed = []
    for row, q in enumerate(queries):
        order = tree.visit(sample[q], tree.leaves)
        place[row, order] = np.arange(len(order))
        distance = ((sample - sample[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        nearest = np.argsort(distance, kind="stable")[: min(neighbours, len(sample) - 1)]
        needed.append(place[row, leaf[nearest]])
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed) - 1, int(np.ceil(s.recall * len(needed))) - 1)]) + 1


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vector)`` of vectors that take part: of the commonest dimension, finite, not all zero, with an id."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(F.col(vec_id).alias("vec_id"), x.cast("array<double>").alias("vector"), bad.alias("bad")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.col("bad") & F.exists("vector", lambda v: v != 0)).drop("bad")
    size = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return rows.filter(F.size("vector") == (size["dim"] if size else 0))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(list(column)).astype(float) if len(column) else np.zeros((0, dim))


def nearest_neighbours(df: DataFrame, is_query, neighbours: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
                       s: TreeSettings = TreeSettings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found rows of every row for which ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``; every usable row is indexed and a candidate for every query but
    those of its own id. Score is the Euclidean distance of the original vectors in double precision;
    ties go to the smaller id, exact repeats of a row count once, and a query with fewer candidates
    returns them all. Vectors that are null, all zero, of another dimension than most, or hold null or
    non-finite components take no part, nor do rows with a null id. An empty table gives no rows;
    other columns are not read.

    Only the sample and sizes per leaf come to the driver; leaves are cut into blocks, so neither a
    large cluster nor a leaf that many queries visit meets in one task.
    """
    spark = df.sparkSession
    id_type = column_type(df, vec_id)
    rows = materialise(usable(df, vec_id, vector), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(s.sample_rows).select("vector").collect()
    dim = len(sample[0]["vector"]) if sample else 0
    known = np.array([r["vector"] for r in sample], float).reshape(len(sample), dim)
    tree = Tree(dim).grow(known, s)
    visits = calibrate(tree, known, neighbours, s)
    shared = spark.sparkContext.broadcast(tree)

    def lead(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=shared.value.assign(_matrix(batch["vector"], dim)))

    index = materialise(rows.mapInPandas(lead, f"vec_id {id_type}, vector array<double>, leaf int"), "leaves")
    # A row for each leaf of the tree. One id of a leaf may be the query's own, wherever its rows lie.
    others = np.zeros(tree.leaves, int)
    for r in index.groupBy("leaf").agg(F.countDistinct("vec_id").alias("n")).collect():
        others[r["leaf"]] = r["n"] - 1
    candidates = spark.sparkContext.broadcast(others)

    def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = [shared.value.visit(np.asarray(v, float), visits, candidates.value, neighbours) for v in batch["vector"]]
            yield batch.assign(leaves=seen)

    queries = index.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")).distinct()
    asked = queries.select("query_id", F.col("query").alias("vector")).mapInPandas(
        search, f"query_id {id_type}, vector array<double>, leaves array<int>")
    asked = materialise(asked.select("query_id", F.col("vector").alias("query"), F.explode("leaves").alias("leaf")), "visits")
    # A row for each leaf of the tree, whose size the settings bound.
    sizes = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).join(
        asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("q")), "leaf")
    sizes = F.broadcast(sizes.select("leaf", F.ceil(F.col("n") / s.block_rows).cast("int").alias("blocks"),
                                     F.ceil(F.col("q") / s.block_queries).cast("int").alias("parts")))
    left = index.join(sizes, "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "vector")
    right = asked.join(sizes, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"), "query_id", "query")

    def compare(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(wanted):
            vectors = vectors if vectors["vec_id"].is_unique else _without_repeats(vectors)
            ids, x = vectors["vec_id"].to_numpy(), _matrix(vectors["vector"], dim)
            q = _matrix(wanted["query"], dim)
            # More than what rounding can change in a rough distance, which grows with the norms.
            margin = 64 * np.finfo(float).eps * dim * ((q * q).sum(axis=1) + (x * x).sum(axis=1).max())
            for at in range(0, len(q), 256):
                rough = _squares(q[at:at + 256], x)
                for k, query_id in enumerate(wanted["query_id"].iloc[at:at + 256]):
                    near = rough[k]
                    near[ids == query_id] = np.inf
                    most = min(neighbours, len(near)) - 1
                    edge = np.partition(near, most)[most]
                    picked = np.flatnonzero(near <= edge + margin[at + k]) if np.isfinite(edge) else np.flatnonzero(np.isfinite(near))
                    score = np.sqrt(((x[picked] - q[at + k]) ** 2).sum(axis=1))
                    order = np.lexsort((ids[picked], score))[:neighbours]
                    out += zip([query_id] * len(order), ids[picked][order], score[order])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["leaf", "block", "part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"query_id {id_type}, vec_id {id_type}, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def _without_repeats(vectors: pd.DataFrame) -> pd.DataFrame:
    named = vectors.assign(_v=[np.asarray(v, float).tobytes() for v in vectors["vector"]])
    return named.drop_duplicates(["vec_id", "_v"]).drop(columns="_v")
