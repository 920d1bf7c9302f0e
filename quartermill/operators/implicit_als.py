"""Implicit alternating least squares over a grid of blocks.

The loss counts every cell: an observed one has confidence equal to its weight and target 1, any other confidence 1
and target 0, and the penalty is the same for every row. With one side fixed, a row solves
``(G + reg + sum (c - 1) v v') x = sum c v`` over its observed cells, where G is the Gram matrix of the fixed side.

The cells are dealt once by row and once by column, as :mod:`quartermill.operators.grid` says; the sums of the pieces of a
very long row meet before they are solved. A solved vector carries the blocks of the other side that need it, and a block gives the Gram
matrix of what it solved, so a half-step is one job besides the sum of these matrices. Vectors travel as the bytes of their numbers,
and a half-step's table is removed when the vectors it held have been solved anew.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.operators.grid import BLOCK_CELLS, PIECE_CELLS, Grid, deal, flat
from quartermill.operators.vectors import gram
from quartermill.session import materialise, release


SOLVED_AT_ONCE = 2_000_000  # numbers of the vectors gathered for rows that are solved together
WHOLE, PIECE, SUMS = 0, 1, 2  # what a block gives: solved rows, sums of pieces, the Gram matrix of its solved rows


def solve_rows(base: np.ndarray, matrix: np.ndarray, places: np.ndarray, weights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Solutions of ``(base + sum (c - 1) v v') x = sum c v`` for rows of cells, those of equal length together.

    With V the vectors of a row, W = V base^-1 and D the confidences less one, x is ``W' (I + D W V')^-1 c``: a row of m cells
    takes a system of m instead of one of the vectors' size. Rows longer than that are solved as they stand.
    """
    size = len(base)
    out, shifted = np.empty((len(lengths), size)), matrix @ np.linalg.inv(base)
    for m in np.unique(lengths):
        rows = np.flatnonzero(lengths == m)
        step = max(1, SOLVED_AT_ONCE // int(m * size))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            cells = starts[some][:, None] + np.arange(m)
            v, c = matrix[places[cells]], weights[cells]
            if m < size:
                w = shifted[places[cells]]
                small = np.eye(m) + (c - 1)[:, :, None] * (w @ v.transpose(0, 2, 1))
                out[some] = (w.transpose(0, 2, 1) @ np.linalg.solve(small, c[:, :, None]))[:, :, 0]
            else:
                whole = base + (v * (c - 1)[:, :, None]).transpose(0, 2, 1) @ v
                out[some] = np.linalg.solve(whole, (c[:, None, :] @ v).transpose(0, 2, 1))[:, :, 0]
    return out


def _addressed(grid: Grid, other: Grid) -> Grid:
    """``grid`` with the blocks of ``other`` that need a row's vector in ``to``, so that solved vectors find their way without a join."""
    to = other.links.groupBy("id").agg(F.collect_list("block").alias("to"))
    rows = materialise(grid.rows.join(to, "id"), "als_rows")
    release(grid.rows)
    return replace(grid, rows=rows)


def _packed(vec: Column) -> Column:
    @F.pandas_udf("binary")
    def pack(vecs: pd.Series) -> pd.Series:
        return vecs.map(lambda v: np.asarray(v, float).tobytes())

    return pack(vec)


def _unpacked(vec: Column) -> Column:
    @F.pandas_udf("array<double>")
    def unpack(vecs: pd.Series) -> pd.Series:
        return vecs.map(np.frombuffer)

    return unpack(vec)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """Vectors of a column of packed ones."""
    whole = column.combine_chunks()
    if not len(whole):
        return np.empty((0, size))
    low = np.frombuffer(whole.buffers()[1], "int32")[whole.offset]
    return np.frombuffer(whole.buffers()[2], count=len(whole) * size, offset=low).reshape(-1, size)


def _half_step(grid: Grid, fixed: DataFrame, moments: np.ndarray, reg: float) -> tuple[DataFrame, np.ndarray]:
    """``(id, to, vec)`` of one side, solved against the vectors ``fixed`` of the other with the Gram matrix ``moments``, and their own Gram matrix."""
    size = len(moments)
    base = moments + reg * np.eye(size)
    kind = grid.id_type

    def named(own: pa.Table) -> pa.Schema:
        return pa.schema([("what", pa.int32()), own.schema.field("id"), ("to", pa.list_(pa.int32())), ("vec", pa.binary()), ("part", pa.binary())])

    def rows_of(what: int, own: pa.Table, vecs: np.ndarray | None = None, parts: list | None = None) -> pa.Table:
        to, n_to = flat(own["to"])
        to = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_to)]).astype("int32"), pa.array(to, pa.int32()))
        ends = np.arange(len(own) + 1, dtype="int32") * (8 * size)
        vec = pa.nulls(len(own), pa.binary()) if vecs is None else pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(vecs))])
        return pa.table([pa.array([what] * len(own), pa.int32()), own["id"].combine_chunks(), to, vec, pa.array(parts or [None] * len(own), pa.binary())], schema=named(own))

    def solve(own: pa.Table, vecs: pa.Table) -> pa.Table:
        if not len(own):
            return named(own).empty_table()
        (ids, lengths), weights = flat(own["ids"]), flat(own["weights"])[0]
        matrix = _matrix(vecs["vec"], size)
        places = pd.Index(vecs["id"].to_pandas()).get_indexer(ids)
        starts, split = np.cumsum(lengths) - lengths, own["split"].to_numpy().astype(bool)
        solved = solve_rows(base, matrix, places, weights, starts[~split], lengths[~split])
        sums = pa.Table.from_pylist([{"what": SUMS, "part": (solved.T @ solved).tobytes()}], named(own))
        pieces = []
        for low, n in zip(starts[split], lengths[split]):
            v, c = matrix[places[low:low + n]], weights[low:low + n]
            pieces.append(np.concatenate([((v * (c - 1)[:, None]).T @ v).ravel(), c @ v]).tobytes())
        out = [rows_of(WHOLE, own.filter(pa.array(~split)), solved), sums]
        return pa.concat_tables(out + ([rows_of(PIECE, own.filter(pa.array(split)), None, pieces)] if pieces else []))

    def join(own: pd.DataFrame) -> pd.DataFrame:  # the pieces of a row
        total = sum(np.frombuffer(p) for p in own["part"])
        a, b = total[:size * size].reshape(size, size), total[size * size:]
        return pd.DataFrame({"id": [own["id"].iloc[0]], "to": [own["to"].iloc[0]], "vec": [np.linalg.solve(base + a, b).tobytes()]})

    vecs = fixed.select(F.explode("to").alias("block"), "id", "vec")
    solved = materialise(grid.beside(vecs).applyInArrow(solve, f"what int, id {kind}, to array<int>, vec binary, part binary"), "als_half")
    parts = solved.filter(F.col("what") == SUMS).select("part").collect()  # a size x size matrix for each block
    own = sum((np.frombuffer(r["part"]).reshape(size, size) for r in parts), np.zeros((size, size)))
    whole = solved.filter(F.col("what") == WHOLE).select("id", "to", "vec")
    if not grid.has_split:
        whole.tables = [solved]
        return whole, own
    pieces = materialise(solved.filter(F.col("what") == PIECE).select("id", "to", "part").groupBy("id").applyInPandas(join, f"id {kind}, to array<int>, vec binary"), "als_pieces")
    both = whole.unionByName(pieces)
    both.tables = [solved, pieces]
    return both, own + gram(pieces.select(_unpacked(F.col("vec")).alias("vec")), "vec", size)


def als(cells: DataFrame, rank: int = 64, iterations: int = 30, reg: float = 0.1, seed: int = 42,
        block_cells: int = BLOCK_CELLS, piece_cells: int = PIECE_CELLS) -> tuple[DataFrame, DataFrame]:
    """``(user factors, item factors)`` of ``(user_id, item_id, weight)``, one row for each pair and a weight above zero.

    The start depends on the ids only. Users and items without cells have no factors; without cells both tables are empty.
    """
    cells = materialise(cells.select("user_id", "item_id", F.col("weight").cast("double").alias("weight")), "als_cells")
    total = cells.count()
    by_user = deal(cells, "user_id", "item_id", total, block_cells, piece_cells)
    by_item = deal(cells, "item_id", "user_id", total, block_cells, piece_cells)
    start = F.array(*[F.xxhash64("id", F.lit(seed * 10_007 + j)) / float(2**63) * 0.01 for j in range(rank)])
    release(cells)
    by_user, by_item = _addressed(by_user, by_item), _addressed(by_item, by_user)

    def begun(grid: Grid) -> DataFrame:
        return grid.rows.dropDuplicates(["id"]).select("id", "to", start.alias("vec"))

    items = materialise(begun(by_item), "als_start")
    moments = gram(items, "vec", rank)
    packed = materialise(items.withColumn("vec", _packed(F.col("vec"))), "als_start")
    packed.tables = [items, packed]
    users, items = None, packed
    for _ in range(iterations):
        before, (users, moments) = users, _half_step(by_user, items, moments, reg)
        release(*(before.tables if before is not None else ()))
        before, (items, moments) = items, _half_step(by_item, users, moments, reg)
        release(*before.tables)
    if users is None:
        users, items = begun(by_user), begun(by_item)
    else:
        users, items = (materialise(side.select("id", _unpacked(F.col("vec")).alias("vec")), "als_factors") for side in (users, items))
    return users.select(F.col("id").alias("user_id"), "vec"), items.select(F.col("id").alias("item_id"), "vec")
