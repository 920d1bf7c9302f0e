"""Scalers and imputers fitted on the training rows of each group and applied to all rows.

A group is one series (or one series and fold), bounded by the calendar, so statistics are window
functions over the group: imputing and scaling share one shuffle and read their input once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("series_id",)


def zscore_stats(df: DataFrame, columns: Sequence[str], train: Column, keys: Sequence[str] = SERIES) -> DataFrame:
    """Training mean and population deviation per column; a constant column divides by 1."""
    stats = []
    for c in columns:
        value = F.when(train, F.col(c))
        spread = F.stddev_pop(value)
        stats += [F.avg(value).alias(f"_mean_{c}"), F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias(f"_std_{c}")]
    return df.groupBy(*keys).agg(*stats)


def apply_zscore(df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    scaled = {c: (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}") for c in columns}
    return df.join(stats, list(keys)).withColumns(scaled).select(*df.columns)


def zscore(df: DataFrame, columns: Sequence[str], train: Column, keys: Sequence[str] = SERIES) -> DataFrame:
    """Training z-scores of every row; the statistics themselves come from :func:`zscore_stats`."""
    group = Window.partitionBy(*keys)
    scaled = {}
    for c in columns:
        value = F.when(train, F.col(c))
        spread = F.stddev_pop(value).over(group)
        scaled[c] = (F.col(c) - F.avg(value).over(group)) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    return df.withColumns(scaled)


def inverse_zscore(df: DataFrame, stats: DataFrame, columns: Mapping[str, str],
                   keys: Sequence[str] = SERIES) -> DataFrame:
    """Undo the scaling; ``columns`` maps a scaled column to the column whose statistics it uses."""
    back = {c: F.col(c) * F.col(f"_std_{s}") + F.col(f"_mean_{s}") for c, s in columns.items()}
    return df.join(stats, list(keys)).withColumns(back).select(*df.columns)


def minmax(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Scale to [0, 1] within each group; a constant column becomes 0."""
    limits = F.struct(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    if keys:
        joined = df.join(df.groupBy(*keys).agg(limits.alias("_limits")), list(keys))
    else:
        joined = df.withColumn("_limits", df.agg(limits).scalar())
    scaled = {}
    for c in columns:
        low, width = F.col(f"_limits.min_{c}"), F.col(f"_limits.max_{c}") - F.col(f"_limits.min_{c}")
        scaled[c] = F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - low, width), F.lit(0.0)))
    return joined.withColumns(scaled).select(*df.columns)


def impute_median(df: DataFrame, columns: Sequence[str], train: Column, keys: Sequence[str] = SERIES) -> DataFrame:
    """Exact training median for missing cells; a column without any training value is dropped.

    The median is exact because a group is one series, bounded by the calendar. Whether a column is
    empty depends on the data, so one small aggregate runs first.
    """
    known = df.filter(train).agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    kept = [c for c in columns if known[c]]
    group = Window.partitionBy(*keys)
    out = df.withColumns({c: F.coalesce(F.col(c), F.median(F.when(train, F.col(c))).over(group)) for c in kept})
    return out.select(*[c for c in df.columns if c not in columns or c in kept])
