"""Time splits of a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def holdout_split(df: DataFrame, horizon: int = 8) -> DataFrame:
    """Adds ``is_test``: true for the last ``horizon`` rows of each series."""
    last = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("date")))
    return df.withColumn("is_test", last <= horizon)


def walk_forward_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """One copy of a row per fold it belongs to, with ``fold`` and ``role`` (train or val).

    Fold k trains on everything before its validation block of n // (folds + 1) rows; the blocks
    end at the last row, and the first chunk is never validated. A row enters a fold only as
    train or val, so later rows are not copied into earlier folds.
    """
    series = Window.partitionBy("series_id")
    position = F.row_number().over(series.orderBy("date")) - 1
    rows = df.withColumn("_i", position).withColumn("_n", F.count(F.lit(1)).over(series))
    size = F.floor(F.col("_n") / (folds + 1)).cast("int")
    start = F.col("_n") - (folds - F.col("fold") + 1) * F.col("_size")
    return (
        rows.withColumn("_size", size)
        .filter(F.col("_size") >= 1)
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("_start", start)
        .filter(F.col("_i") < F.col("_start") + F.col("_size"))
        .withColumn("role", F.when(F.col("_i") < F.col("_start"), "train").otherwise("val"))
        .drop("_i", "_n", "_size", "_start")
    )
