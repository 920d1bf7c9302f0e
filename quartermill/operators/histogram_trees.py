"""Gradient-boosted trees on histograms, pooled over the panel, grown leaf by leaf.

Values are cut into bins at quantiles once. For each level, every partition adds up the residuals of its
rows by (leaf, feature, bin); the sums meet map-side and only they come to the driver, which picks the splits. A missing
value is a bin of its own that goes where the gain is larger. Several jobs, such as the folds of a walk-forward
split, grow their trees in the same passes.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.operators.scaling import SERIES, inverse_zscore, zscore, zscore_stats
from quartermill.operators.trees import last_block
from quartermill.session import materialise

#: Rounds after which the trees so far are added to the rows for good.
SETTLE = 10


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    rate: float = 0.1
    leaves: int = 31
    bins: int = 64
    min_rows: int = 20
    l1: float = 0.0
    l2: float = 0.1
    min_gain: float = 1e-9
    feature_share: float = 0.8
    patience: int = 15  # rounds without a smaller error of the stopping rows, after which a job ends
    seed: int = 42


@dataclass
class Tree:
    """Nodes in lists; a node without a left child is a leaf."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0) -> int:
        for column, start in ((self.feature, 0), (self.bin, 0), (self.missing_left, True), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(start)
        return len(self.value) - 1

    def split(self, node: int, feature: int, bin_: int, missing_left: bool) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.missing_left[node] = feature, bin_, missing_left
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]


def leaf_of(tree: Tree, bins: np.ndarray, missing: int) -> np.ndarray:
    """The leaf of every row of binned values, where the bin ``missing`` stands for no value."""
    feature, cut, to_left = np.array(tree.feature), np.array(tree.bin), np.array(tree.missing_left)
    left, right = np.array(tree.left), np.array(tree.right)
    node = np.zeros(len(bins), np.int64)
    moving = np.flatnonzero(left[node] >= 0)
    while len(moving):
        at = node[moving]
        own = bins[moving, feature[at]]
        node[moving] = np.where(np.where(own == missing, to_left[at], own <= cut[at]), left[at], right[at])
        moving = moving[left[node[moving]] >= 0]
    return node


def best_split(g: np.ndarray, n: np.ndarray, features: Sequence[int], s: Settings) -> tuple[float, int, int, bool] | None:
    """``(gain, feature, bin, missing left)`` of a node from its sums by (feature, bin), the last bin for missing values.

    Of equal gains the first feature, then the lowest cut, then missing values on the left count.
    """
    score = lambda g, n: np.maximum(np.abs(g) - s.l1, 0.0) ** 2 / (n + s.l2)
    whole_g, whole_n = g[features[0]].sum(), n[features[0]].sum()
    best = None
    for f in features:
        gl, nl = np.cumsum(g[f, :-1]), np.cumsum(n[f, :-1])
        for missing_left in (True, False):
            a, m = (gl + g[f, -1], nl + n[f, -1]) if missing_left else (gl, nl)
            gain = score(a, m) + score(whole_g - a, whole_n - m) - score(whole_g, whole_n)
            gain = np.where((m >= s.min_rows) & (whole_n - m >= s.min_rows), gain, -np.inf)
            cut = int(np.argmax(gain))
            if gain[cut] > s.min_gain and (best is None or gain[cut] > best[0] * (1 + 1e-12)):
                best = float(gain[cut]), f, cut, missing_left
    return best


def leaf_value(g: float, n: float, s: Settings) -> float:
    return float(-s.rate * np.sign(g) * max(abs(g) - s.l1, 0.0) / (n + s.l2))


class _Growth:
    """One tree on its way: sums of the nodes known so far, and the nodes whose sums the next pass has to bring."""

    def __init__(self, features: Sequence[int], s: Settings):
        self.tree, self.features, self.s = Tree(), features, s
        self.sums: dict[int, tuple[float, float]] = {}
        self.splits: dict[int, tuple[float, int, int, bool] | None] = {}
        self.wanted = [self.tree.add()]

    def learn(self, node: int, g: np.ndarray, n: np.ndarray) -> None:
        self.sums[node] = float(g[0].sum()), float(n[0].sum())
        self.splits[node] = best_split(g, n, self.features, self.s) if self.sums[node][1] else None

    def plan(self) -> list[int]:
        """Follows the order of gains as far as sums are known; splits the nodes that may come next and gives the new ones."""
        chosen, at = self._order()
        self.wanted = []
        if at is None:
            return []
        room = self.s.leaves - 1 - len(chosen)
        for node in sorted((n for n in self._open(chosen) if self.tree.left[n] < 0), key=lambda n: (-self.splits[n][0], n))[:room]:
            self.wanted += self.tree.split(node, *self.splits[node][1:])
        return self.wanted

    def _open(self, chosen: set[int]) -> list[int]:
        leaves = [0] if not chosen else [c for n in chosen for c in (self.tree.left[n], self.tree.right[n]) if c not in chosen]
        return [n for n in leaves if self.splits.get(n)]

    def _order(self) -> tuple[set[int], int | None]:
        """The nodes split in the order of gains, and the first of them whose children are not known yet."""
        chosen: set[int] = set()
        while len(chosen) < self.s.leaves - 1:
            leaves = self._open(chosen)
            if not leaves:
                return chosen, None
            node = max(leaves, key=lambda n: (self.splits[n][0], -n))
            if self.tree.left[node] < 0 or self.tree.left[node] not in self.splits:
                return chosen, node
            chosen.add(node)
        return chosen, None

    def finish(self) -> Tree:
        chosen, _ = self._order()
        out = Tree()

        def copy(node: int) -> int:
            new = out.add(leaf_value(*self.sums[node], self.s))
            if node in chosen:
                out.feature[new], out.bin[new], out.missing_left[new] = self.tree.feature[node], self.tree.bin[node], self.tree.missing_left[node]
                out.left[new] = copy(self.tree.left[node])
                out.right[new] = copy(self.tree.right[node])
            return new

        copy(0)
        return out


@dataclass(frozen=True)
class Forest:
    """Trees as arrays over raw values: nodes of one tree follow each other, leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    gains: np.ndarray  # how often each feature splits

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of raw values, not a number where one is missing."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while len(self.roots):
            own = x[rows, self.feature[node]]
            after = np.where(np.where(np.isnan(own), self.missing_left[node], own <= self.threshold[node]), self.left[node], self.right[node])
            if (after == node).all():
                break
            node = after
        return self.base + self.value[node].sum(axis=1)


def _flat(trees: Sequence[Tree], edges: Sequence[np.ndarray], base: float) -> Forest:
    feature, threshold, missing, left, right, value, roots = [], [], [], [], [], [], []
    for tree in trees:
        at = len(value)
        roots.append(at)
        for k in range(len(tree.value)):
            leaf = tree.left[k] < 0
            own = edges[tree.feature[k]]
            feature.append(tree.feature[k])
            threshold.append(np.inf if leaf or tree.bin[k] >= len(own) else own[tree.bin[k]])
            missing.append(tree.missing_left[k])
            left.append(at + (k if leaf else tree.left[k]))
            right.append(at + (k if leaf else tree.right[k]))
            value.append(tree.value[k] if leaf else 0.0)
    counts = np.bincount([f for t in trees for f, l in zip(t.feature, t.left) if l >= 0] or [0], minlength=len(edges)) if trees else np.zeros(len(edges))
    return Forest(np.array(feature, int), np.array(threshold, float), np.array(missing, bool), np.array(left, int), np.array(right, int), np.array(value, float),
                  np.array(roots, int), base, counts)


def grow(rows: DataFrame, features: Sequence[str], s: Settings = Settings()) -> dict[int, Forest]:
    """A forest for each ``job`` of ``rows``: ``(job, y, stop, <features>)``; rows to stop by only measure the error.

    A job without stopping rows takes all rounds, one with them keeps the rounds up to the smallest error. Nulls
    and not-a-numbers are missing; rows without a target are left out.
    """
    p, features = len(features), list(features)
    clean = rows.filter("y IS NOT NULL").select(F.col("job").cast("int").alias("job"), F.col("y").cast("double").alias("y"), F.col("stop").cast("boolean").alias("stop"),
                                                *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f"f{k}") for k, f in enumerate(features)])
    points = [k / s.bins for k in range(1, s.bins)]
    quantiles = [F.percentile_approx(f"f{k}", points, 10_000).alias(f"f{k}") for k in range(p)]
    found = clean.filter("NOT stop").groupBy("job").agg(F.avg("y").alias("base"), *[F.min(f"f{k}").alias(f"least{k}") for k in range(p)], *quantiles).collect()  # a row for each job
    edges = {r["job"]: [np.unique(np.array([*(r[f"f{k}"] or []), *([r[f"least{k}"]] if r[f"least{k}"] is not None else [])], float)) for k in range(p)] for r in found}
    base = {r["job"]: float(r["base"]) for r in found}
    missing = max((len(e) for own in edges.values() for e in own), default=0) + 1
    width = missing + 1  # bins of values, one above the last cut, one for missing ones

    def bin_rows(batches):
        for batch in batches:
            known = batch["job"].isin(list(edges)).to_numpy()
            batch = batch[known]
            values, jobs = batch[[f"f{k}" for k in range(p)]].to_numpy(float), batch["job"].to_numpy()
            bins = np.full(values.shape, missing, "<u2")
            for job in np.unique(jobs):
                own = np.flatnonzero(jobs == job)
                for k, cuts in enumerate(edges[job]):
                    there = own[~np.isnan(values[own, k])]
                    bins[there, k] = np.searchsorted(cuts, values[there, k], side="left")
            margin = np.array([base[j] for j in jobs], float)
            yield pd.DataFrame({"job": jobs, "y": batch["y"].to_numpy(), "stop": batch["stop"].to_numpy(), "bins": [b.tobytes() for b in bins], "margin": margin})

    schema = "job int, y double, stop boolean, bins binary, margin double"
    data = materialise(clean.mapInPandas(bin_rows, schema), "binned")
    draw = random.Random(s.seed)
    trees: dict[int, list[Tree]] = {job: [] for job in edges}
    errors: dict[int, list[float]] = {job: [] for job in edges}
    open_jobs, settled = sorted(edges), 0
    for round_ in range(s.rounds + 1):
        some = max(1, round(s.feature_share * p))
        growth = {job: _Growth(sorted(draw.sample(range(p), some)) if some < p else list(range(p)), s) for job in open_jobs}
        wanted = {job: g.wanted for job, g in growth.items()}
        first = True
        while any(wanted.values()):
            lately = {job: trees[job][settled:] for job in wanted}
            sums = _pass(data, {job: (growth[job].tree, nodes, lately[job]) for job, nodes in wanted.items() if nodes}, p, width, first)
            for job, nodes in wanted.items():
                if first and (job, -1) in sums:
                    total, rows_ = sums[job, -1]
                    errors[job].append(float(total[0, 0] / rows_[0, 0]))
                for node in nodes:
                    growth[job].learn(node, *sums.get((job, node), (np.zeros((p, width)), np.zeros((p, width)))))
            first = False
            ended = {job for job in open_jobs if errors[job] and len(errors[job]) - 1 - int(np.argmin(errors[job])) >= s.patience}
            open_jobs = [job for job in open_jobs if job not in ended]
            if round_ == s.rounds:  # the last pass only measures
                open_jobs = []
            wanted = {job: growth[job].plan() for job in open_jobs}
        if not open_jobs:
            break
        for job in open_jobs:
            trees[job].append(growth[job].finish())
        if (round_ + 1) % SETTLE == 0:
            data, settled = _settled(data, {job: trees[job][settled:] for job in edges}, p, missing), settled + SETTLE
    kept = {job: trees[job][:int(np.argmin(errors[job]))] if errors[job] else trees[job] for job in edges}
    return {job: _flat(kept[job], edges[job], base[job]) for job in edges}


def _binned(batch: pd.DataFrame, p: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["bins"]), "<u2").reshape(-1, p)


def _margins(margin: np.ndarray, bins: np.ndarray, trees: Sequence[Tree], missing: int) -> np.ndarray:
    for tree in trees:
        margin = margin + np.array(tree.value)[leaf_of(tree, bins, missing)]
    return margin


def _pass(data: DataFrame, jobs: Mapping[int, tuple[Tree, list[int], list[Tree]]], p: int, width: int, measure: bool) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Sums of residuals and counts by (feature, bin) of the wanted nodes; at node -1 the squared errors of the stopping rows."""
    missing = width - 1

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for job, own in batch.groupby("job"):
                if job not in jobs:
                    continue
                tree, nodes, lately = jobs[job]
                bins = _binned(own, p)
                residual = _margins(own["margin"].to_numpy(), bins, lately, missing) - own["y"].to_numpy()
                stop = own["stop"].to_numpy()
                if measure and stop.any():
                    total = sums.setdefault((job, -1), np.zeros((2, p * width)))
                    total[:, 0] += (residual[stop] ** 2).sum(), stop.sum()
                bins, residual = bins[~stop], residual[~stop]
                leaf = leaf_of(tree, bins, missing)
                for node in nodes:
                    inside = leaf == node
                    keys = (bins[inside] + np.arange(p, dtype=np.int64) * width).ravel()
                    total = sums.setdefault((job, node), np.zeros((2, p * width)))
                    total[0] += np.bincount(keys, np.repeat(residual[inside], p), p * width)
                    total[1] += np.bincount(keys, minlength=p * width)
        for (job, node), total in sums.items():
            there = np.flatnonzero(total[1])
            yield pd.DataFrame({"job": np.int32(job), "node": np.int32(node), "place": there.astype(np.int32), "g": total[0, there], "n": total[1, there]})

    parts = data.select("job", "y", "stop", "bins", "margin").mapInPandas(add, "job int, node int, place int, g double, n double")
    out: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    # jobs x nodes x features x bins sums, whatever the rows are
    for (job, node), own in parts.groupBy("job", "node", "place").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas().groupby(["job", "node"]):
        g, n = np.zeros(p * width), np.zeros(p * width)
        g[own["place"]], n[own["place"]] = own["g"], own["n"]
        out[job, node] = g.reshape(p, width), n.reshape(p, width)
    return out


def _settled(data: DataFrame, trees: Mapping[int, list[Tree]], p: int, missing: int) -> DataFrame:
    def move(batches):
        for batch in batches:
            margin = batch["margin"].to_numpy().copy()
            for job, place in batch.groupby("job").indices.items():
                own = batch.iloc[place]
                margin[place] = _margins(margin[place], _binned(own, p), trees[job], missing)
            yield batch.assign(margin=margin)

    return materialise(data.mapInPandas(move, data.schema), "binned")


# The panel


def prepare(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES) -> tuple[DataFrame, DataFrame]:
    """``(rows, target statistics)``: scaled by series so that one forest serves series of any level; missing values stay missing."""
    train = ~F.col("is_test")
    scaled = zscore(zscore(df.withColumn("actual", F.col("y")), list(features), train, keys), ["y"], train, keys)
    job = F.col("fold") if "fold" in keys else F.lit(0)
    return materialise(last_block(scaled, keys).withColumn("job", job.cast("int")).withColumn("stop", F.col("_stop")), "boosting"), zscore_stats(df, ["y"], train, keys)


def predict_rows(rows: DataFrame, forests: Mapping[int, Forest], features: Sequence[str]) -> DataFrame:
    """Adds ``y_hat``, what the forest of its job says to each row; null for a job without one."""

    @F.pandas_udf("double")
    def walk(job: pd.Series, x: pd.Series) -> pd.Series:
        values = np.array([[np.nan if v is None else v for v in row] for row in x], float).reshape(len(job), len(features))
        out = np.full(len(job), np.nan)
        for key in job.unique():
            if key in forests:
                own = (job == key).to_numpy()
                out[own] = forests[key].predict(values[own])
        return pd.Series(out)

    x = F.array(*[F.col(f).cast("double") for f in features])
    return rows.withColumn("y_hat", F.nanvl(walk("job", x), F.lit(None).cast("double")))


def fit_predict(df: DataFrame, features: Sequence[str], keys: Sequence[str] = SERIES, s: Settings = Settings(), early_stopping: bool = True) -> DataFrame:
    """``(keys, date, y, y_hat)`` of the test rows in the units of y; the folds of ``keys`` are jobs of one run.

    With ``early_stopping`` the last walk-forward block of the training rows decides when boosting ends.
    """
    rows, target = prepare(df, features, keys)
    train = rows.filter(~F.col("is_test"))
    forests = grow(train if early_stopping else train.withColumn("stop", F.lit(False)), features, s)
    predicted = predict_rows(rows.filter("is_test"), forests, features).select(*keys, "date", F.col("actual").alias("y"), "y_hat")
    return inverse_zscore(predicted, target, {"y_hat": "y"}, keys)


def fit(df: DataFrame, features: Sequence[str], s: Settings = Settings(), early_stopping: bool = True) -> tuple[Forest, DataFrame]:
    """``(forest, scales)`` of a panel: the forest is for scaled values, ``scales`` has ``_mean_`` and ``_std_`` of the features and y by series."""
    rows, _ = prepare(df, features)
    train = rows.filter(~F.col("is_test"))
    forest = grow(train if early_stopping else train.withColumn("stop", F.lit(False)), features, s)[0]
    return forest, materialise(zscore_stats(df, [*features, "y"], ~F.col("is_test")), "scales")
