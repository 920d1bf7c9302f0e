"""Leave-one-out ranking metrics over any table ``(model, user_id, rank, item_id)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K_VALUES = (10, 20, 50)
TIE_MARGIN = 0.005


def gains(k: int) -> dict[str, Column]:
    """Per-row gain of a recommendation; ``_hit`` marks the held-out item."""
    inside = F.col("_hit") & (F.col("rank") <= k)
    return {
        f"recall_{k}": F.when(inside, F.lit(1.0)),
        f"ndcg_{k}": F.when(inside, 1 / F.log2(F.col("rank") + 1)),
        f"map_{k}": F.when(inside, 1 / F.col("rank")),
    }


def evaluate_all(recs: DataFrame, test: DataFrame, k_values: Sequence[int] = K_VALUES) -> DataFrame:
    """Recall, NDCG and MAP at every k per model, in one pass over lists ranked once.

    The lists are read once and need not be stored: a row that is no hit adds nothing, so a model without any hit still gets
    its row. The denominator is the number of test users, so a user without recommendations counts as 0.
    """
    truth = test.select("user_id", "item_id", F.lit(True).alias("_hit"))
    marked = recs.select("model", "user_id", "item_id", "rank").join(truth, ["user_id", "item_id"], "left")
    n_users = test.agg(F.count(F.lit(1))).scalar()
    columns = {name: gain for k in k_values for name, gain in gains(k).items()}
    sums = marked.groupBy("model").agg(*[F.sum(gain).alias(name) for name, gain in columns.items()])
    shares = [(F.coalesce(F.col(name), F.lit(0.0)) / F.col("n_users")).alias(name) for name in columns]
    return sums.withColumn("n_users", n_users).select("model", *shares, "n_users")


def beat_popularity(scores: DataFrame, baseline: str = "Popularity", metric: str = "recall_10") -> DataFrame:
    """``(model, delta, verdict)``: beats, ties (within 0.005) or loses against the baseline."""
    base = scores.filter(F.col("model") == baseline).select(metric).scalar()
    delta = F.col(metric) - base
    verdict = F.when(F.col("delta") > TIE_MARGIN, "beats").when(F.abs("delta") <= TIE_MARGIN, "ties").otherwise("loses")
    return scores.withColumn("delta", delta).withColumn("verdict", verdict).select("model", "delta", "verdict")


def metric_name(label: Column) -> Column:
    """Model label to metric prefix: lower case, blanks and slashes to underscores, marks removed."""
    return F.translate(F.lower(label), " /()=", "__")
