"""Declarative row checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, Column]

MAX_VALUE = 1e9


def retail_rules(as_of: str | None = None) -> dict[str, Column]:
    """Anchor rules: a known date that is not in the future, and a positive plausible value."""
    now = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    date, y = F.col("date").try_cast("date"), F.col("y").try_cast("double")
    return {
        "date_known": date.isNotNull(),
        "date_not_future": date.isNull() | (date <= now),
        "y_known": y.isNotNull(),
        "y_positive": y.isNull() | (y > 0),
        "y_plausible": y.isNull() | (y < MAX_VALUE),
    }


def merged_rules() -> dict[str, Column]:
    """Merged-table rules; the exogenous columns may be missing but not out of range."""
    def optional(name: str, low: float, high: float | None = None, closed: bool = False) -> Column:
        c = F.col(name)
        ok = (c >= low) if closed else (c > low)
        return c.isNull() | (ok if high is None else ok & (c < high))

    return {
        "y_positive": F.col("y").isNotNull() & (F.col("y") > 0),
        "cpi_positive": optional("cpi", 0),
        "unemployment_in_range": optional("unemployment_rate", 0, 30, closed=True),
        "interest_in_range": optional("interest_rate_90d", 0, 50, closed=True),
        "employment_positive": optional("employment_count", 0),
    }


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """``(rule, n_violations)`` for every rule, in one pass over the data."""
    counts = df.agg(F.lit(1).alias("_one"), *[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    return counts.unpivot("_one", list(rules), "rule", "n_violations").drop("_one")


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """Returns ``df`` or raises with the broken rules and their counts."""
    broken = violations(df, rules).filter(F.col("n_violations") > 0).collect()
    if broken:
        raise ValueError("; ".join(f"{r['rule']}: {r['n_violations']} rows" for r in broken))
    return df


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``broken_rules``, the list of rules a row breaks (empty for good rows)."""
    named = [F.when(~ok, F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("broken_rules", F.array_compact(F.array(*named)))


def coerce_panel(df: DataFrame) -> DataFrame:
    """Text dates and values to their types; unreadable cells become NULL for the rules to find."""
    return df.withColumns({"date": F.col("date").try_cast("date"), "y": F.col("y").try_cast("double")})
