"""Summary tables behind the exploratory plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame, value: str, keys: Sequence[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per group (one series each)."""
    def quantile(share: float, name: str):
        return F.round(F.percentile(value, F.lit(share)), digits).alias(name)

    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("std"), F.min(value).alias("min"),
        quantile(0.25, "q25"), quantile(0.5, "q50"), quantile(0.75, "q75"), F.max(value).alias("max"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlations as ``(a, b, corr)``, all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    rows = []
    for a in columns:
        for b in columns:
            name = f"{a}~{b}" if (a, b) in pairs else f"{b}~{a}"
            rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{name}`").alias("corr")))
    return one.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``(bin, n)`` over equal-width bins; the top edge belongs to the last bin."""
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    place = F.floor(F.try_divide(F.col(value) - bounds["lo"], bounds["hi"] - bounds["lo"]) * bins)
    return (
        df.select(value).dropna()
        .groupBy((F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)) + 1).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
