"""Leakage-free features of a panel ``(series_id, date, y)``.

All windows share one partitioning and order, so Spark sorts the panel once. A series has one row
per period, which bounds the rows of a window partition by the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAGS = (1, 2, 4, 8)
WINDOWS = (2, 4, 8)
EXOG_LAGS = {
    "unemployment_rate": (1, 4),
    "interest_rate_90d": (1, 4),
    "employment_count": (1,),
}
MIN_COVERAGE = 0.20
ENGINEERED_PREFIXES = ("y_lag_", "y_roll_", "y_yoy_", "month_sin", "month_cos")
NOT_FEATURES = ("series_id", "date", "y", "is_test", "fold", "role")


def _series():
    return Window.partitionBy("series_id").orderBy("date")


def validate_input(df: DataFrame) -> DataFrame:
    """Required columns and types; looks only at the schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in ("y", "date"):
        if name not in types:
            raise ValueError(f"input must contain the column '{name}'")
    if not isinstance(types["date"], (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError("'date' must be a date or timestamp column")
    return df


def lag_features(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Row-based lags: a calendar gap counts as one step."""
    return df.withColumns({f"y_lag_{k}": F.lag("y", k).over(_series()) for k in lags})


def rolling_features(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Mean and sample deviation of the previous w rows; NULL unless all w are known."""
    out: dict[str, Column] = {}
    for w in windows:
        frame = _series().rowsBetween(-w, -1)
        full = F.count("y").over(frame) == w
        out[f"y_roll_mean_{w}"] = F.when(full, F.avg("y").over(frame))
        out[f"y_roll_std_{w}"] = F.when(full, F.stddev_samp("y").over(frame))
    return df.withColumns(out)


def yoy_pct(df: DataFrame) -> DataFrame:
    """Growth from t-5 to t-1, the most recent completed year; NULL when y[t-5] is zero."""
    before, now = F.lag("y", 5).over(_series()), F.lag("y", 1).over(_series())
    return df.withColumn("y_yoy_pct", F.try_divide(now - before, before) * 100)


def pct_change_12(df: DataFrame) -> DataFrame:
    """Change on the same month of the previous year, the current row included."""
    before = F.lag("y", 12).over(_series())
    return df.withColumn("pct_change_12", (F.try_divide(F.col("y"), before) - 1) * 100)


def cyclical_month(df: DataFrame) -> DataFrame:
    angle = F.lit(2 * math.pi) * F.month("date") / 12
    return df.withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle)})


def cpi_adjust(df: DataFrame) -> DataFrame:
    """``y[t-1]`` deflated by ``cpi[t]`` relative to the first known cpi; base 1 if none is known."""
    whole = _series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.coalesce(F.first("cpi", ignorenulls=True).over(whole), F.lit(1.0))
    return df.withColumn("y_real", F.try_divide(F.lag("y", 1).over(_series()), F.col("cpi") / base))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column, n_rows, n_valid, share)`` per column, in one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot("_n", list(columns), "column", "n_valid").select(
        "column", F.col("_n").alias("n_rows"), "n_valid",
        (F.col("n_valid") / F.col("_n")).alias("share"),
    )


def exog_lags(df: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Lags of the exogenous columns known in at least ``min_coverage`` of the rows.

    The feature list depends on the data, so this runs one small aggregate before planning the rest.
    """
    present = [c for c in EXOG_LAGS if c in df.columns]
    if not present:
        return df
    shares = {r["column"]: r["share"] for r in coverage(df, present).collect()}
    out = {
        f"{c}_lag{k}": F.lag(c, k).over(_series())
        for c in present if (shares[c] or 0.0) >= min_coverage for k in EXOG_LAGS[c]
    }
    return df.withColumns(out) if out else df


def engineered_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(ENGINEERED_PREFIXES)]


def feature_columns(df: DataFrame, subset: str = "all") -> list[str]:
    """Names of the features: ``all``, ``own`` history (with the deflated lag), ``exog`` or
    ``engineered`` (own history without the deflated lag, which needs the cpi)."""
    features = [c for c in df.columns if c not in NOT_FEATURES]
    own = [c for c in features if c.startswith(("y_", "month_"))]
    chosen = {
        "all": features,
        "own": own,
        "exog": [c for c in features if c not in own],
        "engineered": [c for c in features if c.startswith(ENGINEERED_PREFIXES)],
    }
    return chosen[subset]


def nan_policy(df: DataFrame, policy: str = "drop") -> DataFrame:
    """Drop or zero-fill missing engineered features; exogenous gaps stay for the imputer."""
    columns = engineered_columns(df)
    if policy == "drop":
        return df.dropna(subset=columns)
    if policy == "fill_zero":
        return df.fillna(0, subset=columns)
    raise ValueError(f"unknown policy '{policy}', expected 'drop' or 'fill_zero'")


def build_features(df: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
                   policy: str = "drop") -> DataFrame:
    """The whole feature step, usable as ``panel.transform(build_features)``."""
    out = cyclical_month(yoy_pct(rolling_features(lag_features(validate_input(df), lags), windows)))
    if "cpi" in df.columns:
        out = cpi_adjust(out)
    return nan_policy(exog_lags(out), policy)


def seasonal_decompose(df: DataFrame, period: int = 12) -> DataFrame:
    """Additive split into trend (centred 2 x period average), seasonal part and residual."""
    half = period // 2
    inner = F.sum("y").over(_series().rowsBetween(-half + 1, half - 1))
    ends = F.lag("y", half).over(_series()) + F.lead("y", half).over(_series())
    trended = df.withColumn("trend", (inner + ends * 0.5) / period)
    phase = Window.partitionBy("series_id", F.month("date"))
    detrended = trended.withColumn("_month_mean", F.avg(F.col("y") - F.col("trend")).over(phase))
    # every calendar month weighs the same in the grand mean, however many rows it has
    weight = F.when(F.col("_month_mean").isNotNull(), 1 / F.count(F.lit(1)).over(phase))
    whole = Window.partitionBy("series_id")
    grand = F.sum(F.col("_month_mean") * F.col("_weight")).over(whole) / F.sum("_weight").over(whole)
    return (
        detrended.withColumn("_weight", weight)
        .withColumn("seasonal", F.col("_month_mean") - grand)
        .withColumn("resid", F.col("y") - F.col("trend") - F.col("seasonal"))
        .drop("_month_mean", "_weight")
    )


def make_sequences(df: DataFrame, features: Sequence[str], length: int) -> DataFrame:
    """``(series_id, date, sequence, target)``: the last ``length`` feature rows, oldest first.

    The target is y of the sequence's last row; rows without a full history give no sequence.
    """
    frame = _series().rowsBetween(-(length - 1), 0)
    row = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.withColumn("_row", row).withColumn("sequence", F.collect_list("_row").over(frame))
    return rows.filter(F.size("sequence") == length).select(
        "series_id", "date", "sequence", F.col("y").alias("target")
    )


def sequence_context(df: DataFrame, features: Sequence[str], length: int) -> DataFrame:
    """Sequences of the test rows, each prefixed by the rows before it (training rows included)."""
    test = df.filter(F.col("is_test")).select("series_id", "date")
    return make_sequences(df, features, length).join(test, ["series_id", "date"], "left_semi")
