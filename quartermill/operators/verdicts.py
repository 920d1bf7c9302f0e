"""Sanity gates on reported errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published error before and after a leaking feature was removed, and the margins.
LEAKED_MAPE = 0.95
EXPECTED_BASELINE_MAPE = 2.58
LEAK_MARGIN = 0.3
DRIFT_MARGIN = 0.5


def leakage_verdict(sweep: DataFrame, baseline: DataFrame, keys: Sequence[str] = (), leaked: float = LEAKED_MAPE,
                    expected: float = EXPECTED_BASELINE_MAPE) -> DataFrame:
    """``(keys, best_mape, baseline_mape, leak_check, drift_check)``.

    A best reduced-rank error close to the leaked one, or a baseline far from its expected value, is
    a warning.
    """
    best = sweep.groupBy(*keys).agg(F.min("mape").alias("best_mape"))
    if keys:
        both = best.join(baseline.select(*keys, F.col("mape").alias("baseline_mape")), list(keys))
    else:
        both = best.withColumn("baseline_mape", baseline.select("mape").scalar())
    leak = F.when(F.abs(F.col("best_mape") - leaked) < LEAK_MARGIN, "warning").otherwise("confirmed")
    drift = F.when(F.abs(F.col("baseline_mape") - expected) > DRIFT_MARGIN, "warning").otherwise("ok")
    return both.withColumns({"leak_check": leak, "drift_check": drift})
