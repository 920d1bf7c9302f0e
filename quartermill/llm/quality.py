"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics come from the whole text. Trees are grown on binned values, from sums of gradients per
bin, and then flattened into arrays, so that a batch of documents walks all trees at once in numpy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import column_type, map_texts, text_or_empty
from quartermill.llm.line_rules import SEPARATORS, SYMBOLS, repeated_words

STATISTICS = (
    "log_words", "log_lines", "mean_word", "longest_word", "distinct_words", "top_word", "repeated_words",
    "repeated_lines", "symbols", "separators", "exclamations", "upper_case", "digits", "marks", "ended_lines",
    "words_per_line", "blank_share", "beyond_ascii", "capitalised",
)


def statistics(text: str) -> list[float]:
    """The values named in ``STATISTICS``; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(STATISTICS)
    lines = [line for line in text.split("\n") if line.strip()]
    chars = len(text)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    in_words = sum(map(len, words))
    upper = sum(map(str.isupper, words))
    marks = sum(map(text.count, ".,;:?"))
    ended = sum(line.rstrip()[-1] in ".!?…" for line in lines)
    return [
        np.log1p(n), np.log1p(len(lines)), in_words / n, float(np.log1p(max(map(len, words)))), len(counts) / n,
        max(counts.values()) / n, repeated_words(words) / n, 1 - len(set(lines)) / len(lines),
        sum(map(text.count, SYMBOLS)) / n, sum(map(text.count, SEPARATORS)) / n, text.count("!") / n, upper / n,
        sum(map(text.count, "0123456789")) / chars, marks / n, ended / len(lines), np.log1p(n / len(lines)),
        1 - in_words / chars, (len(text.encode()) - chars) / chars, sum(map(str.istitle, words)) / n,
    ]


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 80
    depth: int = 4
    bins: int = 64
    learning_rate: float = 0.15
    l2: float = 1.0
    min_rows: int = 10
    min_gain: float = 1e-6
    #: Labelled rows used for fitting: the ones with the smallest hash of their id. More change little here.
    max_rows: int = 20_000


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays: nodes of one tree follow each other, leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(below, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


class _Grower:
    """Grows one tree after the other on binned values."""

    def __init__(self, x: np.ndarray, settings: BoostingSettings):
        self.settings = settings
        self.edges = []
        for column in x.T:
            values = np.unique(column)
            if len(values) > settings.bins:
                values = np.unique(np.quantile(column, np.linspace(0, 1, settings.bins + 1)[1:], method="lower"))
            self.edges.append((values[1:] + values[:-1]) / 2)
        self.binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1) if len(x) else x.astype(int)
        self.nodes: list[list] = []  # feature, threshold, left, right, value

    def grow(self, gradient: np.ndarray, hessian: np.ndarray) -> tuple[int, np.ndarray]:
        """Adds a tree and returns its root and what it adds to each row."""
        added = np.zeros(len(gradient))
        root = len(self.nodes)
        self.nodes.append([])
        todo = [(root, np.arange(len(gradient)), 0)]
        while todo:
            at, rows, depth = todo.pop()
            g, h = gradient[rows], hessian[rows]
            split = self._split(rows, g, h) if depth < self.settings.depth else None
            if split is None:
                value = -self.settings.learning_rate * g.sum() / (h.sum() + self.settings.l2)
                self.nodes[at] = [0, np.inf, at, at, value]
                added[rows] = value
                continue
            feature, edge = split
            below = self.binned[rows, feature] <= edge
            left, right = len(self.nodes), len(self.nodes) + 1
            self.nodes += [[], []]
            self.nodes[at] = [feature, self.edges[feature][edge], left, right, 0.0]
            todo += [(left, rows[below], depth + 1), (right, rows[~below], depth + 1)]
        return root, added

    def _split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
        s, best, found = self.settings, self.settings.min_gain, None
        whole = g.sum() ** 2 / (h.sum() + s.l2)
        for feature, edges in enumerate(self.edges):
            if not len(edges):
                continue
            bins = self.binned[rows, feature]
            size = len(edges) + 1
            gl = np.cumsum(np.bincount(bins, g, size))[:-1]
            hl = np.cumsum(np.bincount(bins, h, size))[:-1]
            nl = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            gain = gl**2 / (hl + s.l2) + (g.sum() - gl) ** 2 / (h.sum() - hl + s.l2) - whole
            gain[(nl < s.min_rows) | (len(rows) - nl < s.min_rows)] = -np.inf
            edge = int(np.argmax(gain))
            if gain[edge] > best:
                best, found = gain[edge], (feature, edge)
        return found


def fit(x: np.ndarray, y: np.ndarray, settings: BoostingSettings = BoostingSettings()) -> Trees:
    """Boosted trees for labels 0 and 1; without rows of both labels, a constant."""
    positive = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(positive / (1 - positive)))
    grower, roots = _Grower(x, settings), []
    margin = np.full(len(y), base)
    if 0 < y.sum() < len(y):
        for _ in range(settings.rounds):
            score = 1 / (1 + np.exp(-margin))
            root, added = grower.grow(score - y, score * (1 - score))
            roots.append(root)
            margin += added
    nodes = grower.nodes or [[0, np.inf, 0, 0, 0.0]]
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
    return Trees(feature.astype(np.int32), threshold.astype(float), left.astype(np.int32), right.astype(np.int32),
                 value.astype(float), np.array(roots or [0], np.int32), base, settings.depth)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_statistics(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    schema = ", ".join([f"`{c}` {column_type(df, c)}" for c in keep] + ["_x array<double>"])

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        return batch[list(keep)].assign(_x=[statistics(t) for t in batch["_text"]])

    return map_texts(df.select(*keep, text_or_empty(text).alias("_text")), schema, rows)


def train(documents: DataFrame, labels: DataFrame, settings: BoostingSettings = BoostingSettings(), text: str = "text",
          doc_id: str = "doc_id", label: str = "quality") -> Trees:
    """Fit on a bounded sample of the labelled rows that are not held out.

    The sample are the ``max_rows`` labelled ids with the smallest hash; only their statistics, a few
    numbers a row, come to the driver. Labels other than 0 and 1 and null ids are left out, of several
    labels or texts of one id the largest label and the smallest statistics count.
    """
    sample = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
        .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(settings.max_rows)
    )
    texts = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
    found = texts.join(F.broadcast(sample), "_id")  # at most max_rows rows of two numbers
    rows = (
        with_statistics(found, "_t", ["_id", "_y"])
        .groupBy("_id", "_y").agg(F.min("_x").alias("_x")).orderBy("_id").collect()
    )
    x = np.array([r["_x"] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r["_y"] for r in rows], float), settings)


def score(documents: DataFrame, trees: Trees, text: str = "text", keep: Sequence[str] = ("doc_id",),
          threshold: float = 0.7) -> DataFrame:
    """Columns ``keep`` with ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from ``threshold`` on).

    Every whole text gets a score: a null or empty one that of a document whose statistics are all
    zero. Repeated rows get equal scores; an empty table gives no rows. Labels, language, source and id
    are not read for it.
    """
    clash = set(keep) & {"score", "predicted", "_x"}
    if clash:
        raise ValueError(f"output names in keep: {sorted(clash)}")
    keep = list(keep)
    shared = documents.sparkSession.sparkContext.broadcast(trees)
    schema = ", ".join([f"`{c}` {column_type(documents, c)}" for c in keep] + ["score double", "predicted int"])

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        x = np.array([statistics(t) for t in batch["_text"]], float).reshape(len(batch), len(STATISTICS))
        scores = np.concatenate([shared.value.score(x[i:i + 4096]) for i in range(0, len(x), 4096)] or [np.zeros(0)])
        return batch[keep].assign(score=scores, predicted=(scores >= threshold).astype(np.int32))

    return map_texts(documents.select(*keep, text_or_empty(text).alias("_text")), schema, rows)


def good_ones(documents: DataFrame, trees: Trees, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``documents`` with a score of at least ``threshold``, as ``score`` gives it.

    Only the texts go to Python and only their scores come back. Nulls, repeats and empty tables as in ``score``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))
        return pd.Series(np.concatenate([shared.value.score(x[i:i + 4096]) for i in range(0, len(x), 4096)] or [np.zeros(0)]))

    return documents.filter(scored(text_or_empty(text)) >= threshold)
