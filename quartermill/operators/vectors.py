"""Distributed products with tables of short vectors ``(id, vec ARRAY<DOUBLE>)``.

The vector length is a model parameter (topics, factors, features), so k x k matrices may live on
the driver; tables of vectors never do.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import global_rank
from quartermill.session import materialise, release

# Items of a block, and users that are scored against so many at a time: their scores in single precision (4 MB) stay near the core.
ITEM_BLOCK = 4_096
USER_BLOCK = 256
# Numbers in the vectors that a task holds and that pass through the driver at a time (12 MB), and in those of a round, which the
# driver and the executors store (96 MB). What users have is written once a round, so rounds are few.
PART_NUMBERS = 1_500_000
ROUND_NUMBERS = 12_000_000
# Scores that are worked out in double precision at a time.
EXACT_AT_ONCE = 32_768
SCORE_DIGITS = 9
#: What rounding to so many digits may add to a score.
ROUNDING = 1e-9


def stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column])


def gram(df: DataFrame, vec: str, size: int) -> np.ndarray:
    """Sum of v v^T over all rows: one partial matrix per partition, then a keyed sum."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                x = stack(batch[vec])
                total += x.T @ x
        yield pd.DataFrame({"cell": np.arange(size * size), "x": total.ravel()})

    parts = df.select(vec).mapInPandas(partial, "cell int, x double")
    sums = parts.groupBy("cell").agg(F.sum("x").alias("x")).toPandas()  # size x size cells
    out = np.zeros(size * size)
    out[sums["cell"].to_numpy()] = sums["x"].to_numpy()
    return out.reshape(size, size)


def apply_matrix(column: Column, matrix: np.ndarray) -> Column:
    """``vec @ matrix`` for every row, in Arrow batches."""

    @F.pandas_udf("array<double>")
    def product(vecs: pd.Series) -> pd.Series:
        if len(vecs) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(stack(vecs) @ matrix))

    return product(column)


def weighted_sum(df: DataFrame, key: str, weight: str, vec: str, size: int) -> DataFrame:
    """``(key, vec)``: sum of weight * vec per key with map-side combine, all inside the JVM."""
    sums = df.groupBy(key).agg(*[F.sum(F.col(weight) * F.col(vec)[j]).alias(f"_v{j}") for j in range(size)])
    return sums.select(key, F.array(*[F.col(f"_v{j}") for j in range(size)]).alias(vec))


def l2_norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))


def normalise(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Unit length; a zero vector stays zero."""
    norm = l2_norm(F.col(vec))
    return df.withColumn("_norm", F.when(norm == 0, F.lit(1.0)).otherwise(norm)).withColumn(
        vec, F.transform(vec, lambda x: x / F.col("_norm"))).drop("_norm")


# Scoring of all users against all items


def _contenders(items: DataFrame, k: int, seen: DataFrame | None) -> DataFrame:
    """Items that can enter a list: of those with equal vectors the first by id, as many as any user asks for and has seen among them.

    Items with equal vectors have equal scores, so larger ids come first, and a user passes over none but its own seen ones.
    """
    marked = items.select("item_id", "vec", F.xxhash64("vec").alias("_hash"))
    most = marked.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if most <= k:
        return items
    keep = k
    if seen is not None:
        own = seen.select("user_id", F.col("item_id").cast(items.schema["item_id"].dataType)).join(marked.select("item_id", "_hash"), "item_id")
        keep += own.groupBy("user_id", "_hash").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy("_hash", "vec").orderBy(F.desc("item_id")))
    return marked.withColumn("_nth", nth).filter(F.col("_nth") <= keep).select("item_id", "vec")


def _blocks(items: DataFrame, item_block: int) -> tuple[DataFrame, list[float], int]:
    """Items with the number of their block, in falling order of length, the greatest length in each block, and the blocks of a round.

    Equal vectors come one after the other, so a class lies in one block, or in few.
    """
    sized = items.select("item_id", "vec", l2_norm(F.col("vec")).alias("norm"))
    placed = global_rank(sized, [F.desc("norm"), F.xxhash64("vec").desc(), F.desc("item_id")], "_place")
    stored = materialise(placed.withColumn("block", F.floor((F.col("_place") - 1) / item_block).cast("int")).drop("_place"), "item_blocks")
    release(placed)
    lengths = stored.groupBy("block").agg(F.max("norm").alias("norm"), F.max(F.size("vec")).alias("size")).orderBy("block").collect()  # a row for each block
    size = max([r["size"] for r in lengths], default=1)
    return stored, [r["norm"] for r in lengths], max(1, ROUND_NUMBERS // (item_block * max(1, size)))


def _block(own: pd.DataFrame, length: float) -> SimpleNamespace:
    """Items of a block in falling order of id, put into classes of equal vectors; ``matrix`` has a column for each class.

    A plain namespace, because broadcasts are pickled by reference and executors have no copy of this package.
    """
    own = own.sort_values("item_id", ascending=False)
    matrix = stack(own["vec"])
    distinct, group, count = np.unique(matrix, axis=0, return_inverse=True, return_counts=True)
    group = group.ravel()
    return SimpleNamespace(
        ids=own["item_id"].to_numpy(),
        group=group,  # class of each item
        member=np.argsort(group, kind="stable"),  # items class by class, in falling order of id
        start=np.cumsum(count) - count, count=count, matrix=distinct.T, length=length)


def _best(row: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k entries of each row with the highest scores (ties: the larger id), row by row. Ids are compared where scores tie only."""
    order = np.lexsort((-score, row))
    row, score, name = row[order], score[order], name[order]
    tie = (row[1:] == row[:-1]) & (score[1:] == score[:-1])
    if tie.any():
        tied = np.concatenate([tie, [False]]) | np.concatenate([[False], tie])
        place = np.zeros(len(row), int)
        place[tied] = -np.unique(name[tied], return_inverse=True)[1]
        order = np.lexsort((place, -score, row))
        row, score, name = row[order], score[order], name[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], score[keep], name[keep]


def _opened(shared) -> list[SimpleNamespace]:
    """Blocks of a part, with their unit vectors in single precision; a task holds one part at a time."""
    blocks = [pickle.loads(b) for b in shared.value]
    shared.__dict__.pop("_value", None)
    for block in blocks:
        block.vecs = np.ascontiguousarray(block.matrix.T)
        block.unit = (block.vecs / (block.length or 1.0)).astype("float32").T
    return blocks


def _units(vecs: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (vecs / np.where(norm > 0, norm, 1.0)[:, None]).astype("float32")


def _slack(size: int) -> float:
    """More than a product of two unit vectors can be wrong by in single precision."""
    return (size + 8) * 2.0**-22


def _where(mask: np.ndarray) -> np.ndarray:
    """Places of the few that are true, found eight at a time."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    near = (np.flatnonzero(flat[:whole].view("uint64"))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([near[flat[near]], whole + np.flatnonzero(flat[whole:])])


def _exact(vecs: np.ndarray, block: SimpleNamespace, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(r))
    for at in range(0, len(r), EXACT_AT_ONCE):
        some = slice(at, at + EXACT_AT_ONCE)
        out[some] = np.einsum("ij,ij->i", vecs[r[some]], block.vecs[c[some]])
    return out


def _rounds(users: DataFrame, items: DataFrame, item_block: int, update, reaches) -> tuple[DataFrame, int]:
    """``(state, blocks)``: users after all blocks that can still change what they have.

    A round sends blocks of items, together of bounded size, to all tasks, and the users stream past them. The blocks are packed on the
    executors; the driver passes them on in parts and keeps none. ``update`` is given these parts, each with the greatest length in it,
    and maps batches of users; ``reaches`` is a condition, given the greatest length in the next
    block, whether that block can change anything for a user. Blocks are in falling order of length, so a user that one can't
    reach is done. No side is copied for blocks of the other, so what moves grows with users + items. What a round leaves is
    removed when the next one has been written.
    """
    def pack(own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": own["block"].iloc[:1].to_numpy(), "data": [pickle.dumps(_block(own, float(own["norm"].max())), 5)]})

    spark = users.sparkSession
    stored, lengths, together = _blocks(items, item_block)
    packed = materialise(stored.groupBy("block").applyInPandas(pack, "block int, data binary"), "packed_blocks")
    release(stored)
    width = max(1, min(together, together * PART_NUMBERS // ROUND_NUMBERS))
    active, done, before = users, None, None
    for first in range(0, len(lengths), together):
        after = min(first + together, len(lengths))
        parts = []
        for low in range(first, after, width):
            rows = packed.filter(F.col("block").between(low, min(low + width, after) - 1)).orderBy("block").collect()
            parts.append((lengths[low], spark.sparkContext.broadcast([bytes(r["data"]) for r in rows])))
        del rows
        state = materialise(active.mapInPandas(update(parts), users.schema), "scoring")
        for _, shared in parts:
            shared.destroy()
        if before is not None:
            release(before)
        if after == len(lengths):
            done = state if done is None else done.unionByName(state)
            break
        going = F.coalesce(reaches(F.lit(lengths[after])), F.lit(True))
        ended, active, before = state.filter(~going), state.filter(going), state
        if not ended.isEmpty():
            ended = materialise(ended, "scored")
            done = ended if done is None else done.unionByName(ended)
        if active.isEmpty():
            release(state)
            break
    release(packed)
    return (users if done is None else done), len(lengths)


def _candidates(block: SimpleNamespace, vecs: np.ndarray, unit: np.ndarray, norm: np.ndarray, floor: np.ndarray, k: int, seen_row: np.ndarray, seen_item: np.ndarray):
    """``(row, item, score)`` of the unseen items of a block that can be among the k best with at least the score ``floor``.

    Classes of equal vectors are scored, and only those are opened that hold a row's k best unseen items, with all that tie. All are scored
    in single precision, by unit vectors, and those that come near enough in double precision.
    """
    raw = unit @ block.unit
    width, slack = raw.shape[1], _slack(len(block.unit))
    cells, passed = np.unique(seen_row * width + block.group[seen_item], return_counts=True)
    gone = cells[passed >= block.count[cells % width]]
    raw[gone // width, gone % width] = -np.inf
    most = norm * block.length
    scale = np.where(most > 0, most, 1.0)
    low = np.where(most > 0, (floor - 2 * ROUNDING - 1e-15 * np.abs(floor)) / scale - slack, -np.inf)  # no score below rounds to as much
    fresh = np.flatnonzero(np.isneginf(floor))
    if width > k and len(fresh):
        low[fresh] = np.partition(raw[fresh], width - k, axis=1)[:, width - k] - 2 * slack - 2 * ROUNDING / scale[fresh]
    near = _where(raw >= np.clip(low, -3.0, 3.0).astype("float32")[:, None])
    r = near // width
    c = near - r * width
    score = np.round(_exact(vecs, block, r, c), SCORE_DIGITS)
    order = np.lexsort((-score, r))
    order = order[score[order] >= floor[r[order]]]
    r, c, score = r[order], c[order], score[order]
    if not len(r):
        return r, c, score
    at = np.searchsorted(cells, r * width + c)
    known = cells[np.minimum(at, len(cells) - 1)] == r * width + c if len(cells) else np.zeros(len(r), bool)
    skipped = np.zeros(len(r), int)
    skipped[known] = passed[at[known]]
    above = np.cumsum(block.count[c] - skipped) - (block.count[c] - skipped)  # unseen items of classes before this one
    head = np.concatenate([[True], (r[1:] != r[:-1]) | (score[1:] != score[:-1])])
    above = np.maximum.accumulate(np.where(head, above, 0))  # classes that tie are opened together
    row_start = np.concatenate([[True], r[1:] != r[:-1]])
    wanted = above - np.maximum.accumulate(np.where(row_start, above, 0)) < k
    r, c, score, skipped = r[wanted], c[wanted], score[wanted], skipped[wanted]
    take = np.minimum(block.count[c], k + skipped)
    which = np.repeat(np.arange(len(r)), take)
    item = block.member[block.start[c[which]] + np.arange(len(which)) - np.repeat(np.cumsum(take) - take, take)]
    size = len(block.ids)
    free = ~np.isin(r[which] * size + item, seen_row * size + seen_item)
    return r[which][free], item[free], score[which][free]


def top_k_state(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
                user_block: int = USER_BLOCK, item_block: int = ITEM_BLOCK) -> tuple[DataFrame, int]:
    """``(state, blocks)`` with ``(user_id, vec, norm, seen, best, scores, visited)``: lists so far and the blocks looked at by each user."""
    user_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((users, "user_id"), (items, "item_id")))
    none = F.array().cast(f"array<{item_type}>")
    start = users.select("user_id", "vec", l2_norm(F.col("vec")).alias("norm"))
    if seen is not None:
        # A user has at most one cell for each item of the catalogue.
        own = seen.groupBy("user_id").agg(F.collect_list(F.col("item_id").cast(item_type)).alias("seen"))
        start = start.join(own, "user_id", "left").withColumn("seen", F.coalesce("seen", none))
    else:
        start = start.withColumn("seen", none)
    start = start.withColumns({"best": none, "scores": F.array().cast("array<double>"), "visited": F.lit(0)})
    start = start.select("user_id", "vec", "norm", "seen", "best", "scores", "visited")
    at_once = user_block * max(1, ITEM_BLOCK // item_block)

    def begun(some: pd.DataFrame) -> SimpleNamespace:
        vecs, norm = stack(some["vec"]), some["norm"].to_numpy(float)
        flat = lambda c, kind: np.concatenate([np.asarray(x, dtype=kind) for x in some[c]])
        return SimpleNamespace(
            some=some, vecs=vecs, norm=norm, unit=_units(vecs, norm), visited=some["visited"].to_numpy(int).copy(),
            floor=np.array([s[k - 1] if len(s) >= k else -np.inf for s in some["scores"]], float),
            row=np.repeat(np.arange(len(some)), some["best"].map(len)), score=flat("scores", float), name=flat("best", object),
            own_row=np.repeat(np.arange(len(some)), some["seen"].map(len)), own=flat("seen", object), found=[], n_found=0)

    def merge(users: SimpleNamespace) -> None:
        users.row, users.score, users.name = _best(*(np.concatenate(x) for x in zip((users.row, users.score, users.name), *users.found)), k)
        users.found, users.n_found = [], 0
        rows = np.arange(len(users.some))
        last = np.searchsorted(users.row, rows) + k - 1  # of a full list
        full = np.flatnonzero(last < np.searchsorted(users.row, rows, side="right"))
        users.floor[full] = users.score[last[full]]

    def visit(users: SimpleNamespace, blocks: list[SimpleNamespace], index: pd.Index) -> None:
        places = index.get_indexer(users.own) if len(users.own) else np.zeros(0, int)
        order = np.argsort(places, kind="stable")
        rows, places, end = users.own_row[order], places[order], 0
        for block in blocks:
            end += len(block.ids)
            going = np.flatnonzero(users.norm * block.length * (1 + 1e-12) + ROUNDING >= users.floor)
            if not len(going):
                break
            users.visited[going] += 1
            cut = slice(*np.searchsorted(places, [end - len(block.ids), end]))
            mine, seen_item = rows[cut], places[cut] - (end - len(block.ids))
            if len(going) == len(users.some):
                r, c, score = _candidates(block, users.vecs, users.unit, users.norm, users.floor, k, mine, seen_item)
            else:
                local = np.full(len(users.some), -1)
                local[going] = np.arange(len(going))
                mine = local[mine]
                r, c, score = _candidates(block, users.vecs[going], users.unit[going], users.norm[going], users.floor[going], k, mine[mine >= 0], seen_item[mine >= 0])
            if len(r):
                users.found.append((going[r], score, block.ids[c].astype(object)))
                users.n_found += len(r)
                if users.n_found > len(users.row) // 4:  # floors rise by merging only
                    merge(users)
        if users.found:
            merge(users)

    def ended(users: SimpleNamespace) -> pd.DataFrame:
        cuts = np.searchsorted(users.row, np.arange(1, len(users.some)))
        return users.some.assign(best=[b.tolist() for b in np.split(users.name, cuts)], scores=[x.tolist() for x in np.split(users.score, cuts)], visited=users.visited)

    def update(parts):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                users = [begun(batch.iloc[at:at + at_once].reset_index(drop=True)) for at in range(0, len(batch), at_once)]
                for length, shared in parts:
                    going = [u for u in users if (u.norm * length * (1 + 1e-12) + ROUNDING >= u.floor).any()]
                    if not going:
                        break
                    blocks = _opened(shared)
                    index = pd.Index(np.concatenate([b.ids for b in blocks]))
                    for some in going:
                        visit(some, blocks, index)
                yield from map(ended, users)

        return run

    def reaches(length: Column) -> Column:
        return (F.size("scores") < k) | (F.col("norm") * length * (1 + 1e-12) + ROUNDING >= F.get("scores", F.lit(k - 1)))

    return _rounds(start, _contenders(items, k, seen), item_block, update, reaches)


def top_k_scores(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
                 user_block: int = USER_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """``(user_id, item_id, score, rank)``: the k best unseen items of each user by dot product.

    Items with equal vectors are scored once. They come in blocks of falling length; a user is done with its k-th score above what its own length and the next
    block's can give, so most of the products with short vectors are never made. Nothing is left out: the bound is
    that of Cauchy and Schwarz. Scores are compared to nine decimals, then by item id descending, so neither blocks nor
    the order of addition can change a ranking.
    """
    state, _ = top_k_state(users, items, k, seen, user_block, item_block)
    rows = state.select("user_id", F.posexplode(F.arrays_zip("best", "scores")).alias("_i", "_m"))
    return rows.select("user_id", F.col("_m.best").alias("item_id"), F.col("_m.scores").alias("score"), (F.col("_i") + 1).alias("rank"))


def score_range(users: DataFrame, items: DataFrame, user_block: int = USER_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """``(user_id, lo, hi)``: smallest and largest score of each user over all items, from the blocks that can widen it."""
    items = items.groupBy("vec").agg(F.max("item_id").alias("item_id")).select("item_id", "vec")  # equal vectors have equal scores
    nothing = F.lit(None).cast("double")
    start = users.select("user_id", "vec", l2_norm(F.col("vec")).alias("norm"), nothing.alias("lo"), nothing.alias("hi"))
    at_once = user_block * max(1, ITEM_BLOCK // item_block)

    def widened(block: SimpleNamespace, raw: np.ndarray, vecs: np.ndarray, norm: np.ndarray, bounds: np.ndarray, sign: int) -> None:
        """Raises the greatest score of each row so far, or with ``sign`` -1 lowers the smallest, to that of this block."""
        top, slack, scale = raw.max(axis=1) if sign > 0 else -raw.min(axis=1), _slack(len(block.unit)), norm * block.length
        rows = np.flatnonzero(~np.isnan(top) & ~((top + slack) * scale < sign * bounds))  # also those without bounds
        if not len(rows):
            return
        least = top[rows] - 2 * slack
        near = _where(raw[rows] >= least[:, None] if sign > 0 else raw[rows] <= -least[:, None])
        r, c = near // raw.shape[1], near % raw.shape[1]
        best = np.maximum.reduceat(sign * _exact(vecs, block, rows[r], c), np.searchsorted(r, np.arange(len(rows))))
        bounds[rows] = sign * np.fmax(sign * bounds[rows], best)

    def update(parts):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                vecs, norm = (stack(batch["vec"]) if len(batch) else np.zeros((0, 1))), batch["norm"].to_numpy(float)
                unit, lo, hi = _units(vecs, norm), batch["lo"].to_numpy(float, copy=True), batch["hi"].to_numpy(float, copy=True)
                for _, shared in parts:
                    for block in _opened(shared):
                        for at in range(0, len(batch), at_once):
                            cut = slice(at, at + at_once)
                            raw = unit[cut] @ block.unit
                            widened(block, raw, vecs[cut], norm[cut], hi[cut], 1)
                            widened(block, raw, vecs[cut], norm[cut], lo[cut], -1)
                yield batch.assign(lo=lo, hi=hi)

        return run

    def reaches(length: Column) -> Column:
        most = F.col("norm") * length * (1 + 1e-12)
        return (most > F.col("hi")) | (-most < F.col("lo"))

    state, _ = _rounds(start, items, item_block, update, reaches)
    return state.select("user_id", "lo", "hi")
