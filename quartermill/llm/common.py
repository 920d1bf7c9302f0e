"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words, as every word-based operator of this package counts them: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_for_worker(key: object, build: Callable[[], object]) -> object:
    """An object built once per Python worker process and shared by all of its later tasks.

    Functions of this package travel to the workers by value, so their module globals are new in each
    task; what is costly to build (a parsed vocabulary with its memo) is kept in a module of its own.
    Only the newest object stays, so that a worker's memory does not grow from stage to stage.
    """
    store = sys.modules.setdefault("_quartermill_worker", types.ModuleType("_quartermill_worker"))
    kept = vars(store).setdefault("kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]


class Memo(dict):
    """``make(key)`` remembered for the newest keys: at most ``size`` of them and as many older ones."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def map_texts(df: DataFrame, schema: str, work: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Apply ``work`` to every Arrow batch of ``df``, in slices, so that results stay small; nothing is held across batches."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                yield work(batch.iloc[start:start + SLICE_ROWS].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal keys from sorted batches; only the group that a batch breaks off is carried over."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(batch)]
        if held and (held[-1][keys].to_numpy()[-1] != values[0]).any():
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for start, end in zip(edges[:-1], edges[1:]):
            part = batch.iloc[start:end]
            if end < len(batch):
                yield pd.concat([*held, part]) if held else part
                held = []
            else:
                held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
