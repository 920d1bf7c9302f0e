"""Align series to quarters and merge them onto the anchor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.periods import quarter_label

QUARTER_END_MONTHS = (3, 6, 9, 12)


def filter_start_date(df: DataFrame, start: str) -> DataFrame:
    """Rows dated on or after ``start``; on a Parquet source the filter reaches the scan."""
    return df.filter(F.col("date") >= F.lit(start).cast("date"))


def quarter_end_rows(df: DataFrame) -> DataFrame:
    """Monthly to quarterly by keeping the quarters' last months, not by averaging."""
    return df.filter(F.month("date").isin(*QUARTER_END_MONTHS))


def mean_by_date(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy("date").agg(F.avg(value).alias(value))


def resample_quarter_mean(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the months present in each quarter, dated at the quarter's last month."""
    return (
        df.groupBy(*keys, quarter_label(F.col("date")).alias("date"))
        .agg(F.avg(value).alias(value))
        .dropna(subset=[value])
    )


def monthly_grid(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sparse anchors to one row per month, linear between anchors, nothing beyond the last one.

    Missing years are bridged. Each anchor expands only into the months up to the next one.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    anchors = (
        df.dropna(subset=[value])
        .withColumn("_next_date", F.lead("date").over(order))
        .withColumn("_next", F.lead(value).over(order))
        .withColumn("_gap", F.coalesce(F.months_between("_next_date", "date").cast("int"), F.lit(1)))
    )
    steps = F.sequence(F.lit(0), F.col("_gap") - 1)
    slope = (F.coalesce("_next", value) - F.col(value)) / F.col("_gap")
    return (
        anchors.withColumn("_step", F.explode(steps))
        .select(*keys, F.add_months("date", F.col("_step")).alias("date"),
                (F.col(value) + slope * F.col("_step")).alias(value))
    )


def interpolate_annual(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Annual mid-year anchors to quarterly means of the interpolated months."""
    return resample_quarter_mean(monthly_grid(df, value, keys), value, keys)


def assert_unique(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, value)``, one row per key; the job fails when ``keys`` repeat.

    A repeated key on the right side of a join would multiply anchor rows. The check is part of the
    plan, so it costs no job of its own.
    """
    problem = F.raise_error(F.lit(f"{value}: more than one row per {', '.join(keys)}"))
    one = F.when(F.count(F.lit(1)) == 1, F.first(value)).otherwise(problem.cast(df.schema[value].dataType))
    return df.groupBy(*keys).agg(one.alias(value))


def merge_exog(anchor: DataFrame, exog: Mapping[str, DataFrame | None], on: Sequence[str] = ("date",)) -> DataFrame:
    """Left-join each exogenous series by key; a missing source becomes an all-NULL column."""
    merged = anchor
    for name, source in exog.items():
        if source is None:
            merged = merged.withColumn(name, F.lit(None).cast("double"))
            continue
        right = assert_unique(source.select(*on, name), on, name)
        merged = merged.join(right, list(on), "left")
    return merged


def pivot_matrix(df: DataFrame, columns: Sequence[str], value: str = "value",
                 label: str = "industry", min_columns: int = 5) -> DataFrame:
    """Wide ``date x label`` table with a given column list; fewer than ``min_columns`` is refused.

    The first value per cell is the smallest one, so repeated cells give the same answer every run.
    """
    if len(columns) < min_columns:
        raise ValueError(f"need at least {min_columns} columns, got {len(columns)}")
    return df.groupBy("date").pivot(label, list(columns)).agg(F.min(value))
