"""From purchase lines to implicit user-item weights and the leave-one-out split.

Lines are combined into (user, item) cells before anything else moves. Every later step works on
cells, so a user or item with a large share of the raw lines is already small: a user has at most
one row per item of the catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.session import materialise

MIN_ROWS = 5
MAX_ROUNDS = 5

# Prices are summed in decimals: the order of addition must not decide the last digits of a mean.
EXACT_PRICE = "decimal(28,9)"


def clean_transactions(df: DataFrame, country: str) -> DataFrame:
    """Known customers buying something at a price, in one country, without cancelled invoices.

    A missing description is a real NULL here and removes the line.
    """
    kept = df.filter(F.col("user_id").isNotNull())
    if "description" in df.columns:
        kept = kept.filter(F.col("description").isNotNull())
    return kept.filter(
        (F.col("quantity") > 0) & (F.col("price") > 0)
        & ~F.col("invoice").startswith("C") & (F.col("country") == country)
    )


def cells(lines: DataFrame) -> DataFrame:
    """``(user_id, item_id, n_rows, quantity, last_at)``, combined map-side before the shuffle."""
    return lines.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity"),
        F.max(F.struct("invoice_date", "invoice", "line_no")).alias("last_at"),
    )


def semi_join_active(df: DataFrame, key: str, minimum: int = MIN_ROWS, rows: str = "n_rows") -> DataFrame:
    """Rows whose ``key`` has at least ``minimum`` purchase lines."""
    active = df.groupBy(key).agg(F.sum(rows).alias("_n")).filter(F.col("_n") >= minimum).select(key)
    return df.join(active, key, "left_semi")


def frequency_filter(df: DataFrame, minimum: int = MIN_ROWS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Drop sparse users, then sparse items, until nothing changes (at most ``rounds`` times).

    Whether a line survives depends only on its user and item, so filtering cells by their line
    counts equals filtering the lines. Each round is written to the shared folder: the plan stays
    short and a lost executor costs at most one round.
    """
    # both branches of every semi-join read the cells: build them once, not once per branch
    kept = materialise(df, "cells")
    before = None
    for _ in range(rounds):
        kept = semi_join_active(kept, "user_id", minimum)
        kept = materialise(semi_join_active(kept, "item_id", minimum), "frequency")
        after = kept.agg(F.sum("n_rows")).first()[0]
        if after == before or not after:
            break
        before = after
    return kept


def interaction_weights(df: DataFrame) -> DataFrame:
    """Adds the implicit weight ln(1 + quantity) to the cells."""
    return df.withColumn("weight", F.log1p("quantity"))


def item_meta(lines: DataFrame, kept: DataFrame) -> DataFrame:
    """``(item_id, description, price)``: most frequent description (ties: smallest), mean price."""
    items = kept.select("user_id", "item_id")
    counted = lines.join(items, ["user_id", "item_id"], "left_semi").groupBy("item_id", "description").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("price").cast(EXACT_PRICE)).alias("_price"))
    return counted.groupBy("item_id").agg(
        F.min_by("description", F.struct(-F.col("_n"), F.col("description"))).alias("description"),
        (F.sum("_price").cast("double") / F.sum("_n")).alias("price"),
    )


def last_purchase(df: DataFrame) -> DataFrame:
    """Each user's last item under a total order; an aggregate, so no user is sorted in one task."""
    last = F.max(F.struct("last_at", "item_id"))
    return df.groupBy("user_id").agg(last.alias("_last"), F.count(F.lit(1)).alias("n_items")).select(
        "user_id", F.col("_last.item_id").alias("item_id"), "n_items"
    )


def loo_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: the last item of every user with two or more items is held out.

    The whole (user, item) cell leaves the training data, even when the item was also bought before.
    """
    test = last_purchase(df).filter(F.col("n_items") >= 2).select("user_id", "item_id")
    return df.join(test, ["user_id", "item_id"], "left_anti"), test


def density_stats(df: DataFrame) -> DataFrame:
    """One row: users, items, cells, density in percent, median and 90th percentile of both sides."""
    def side(key: str, own: str, other: str):
        per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per.agg(F.struct(
            F.count(F.lit(1)).alias(f"n_{own}s"), F.sum("_n").alias("n_cells"),
            F.percentile("_n", F.lit(0.5)).alias(f"median_{other}s_per_{own}"),
            F.percentile("_n", F.lit(0.9)).alias(f"p90_{other}s_per_{own}"),
        ).alias(f"_{own}"))

    items = side("item_id", "item", "user").scalar()
    both = side("user_id", "user", "item").withColumn("_item", items).select(
        "_user.*", "_item.n_items", "_item.median_users_per_item", "_item.p90_users_per_item")
    return both.withColumn("density_pct", F.col("n_cells") * 100.0 / (F.col("n_users") * F.col("n_items")))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Lines, users and items; each side is counted by its own aggregate instead of expanding rows."""
    users = df.select("user_id").distinct().agg(F.count(F.lit(1))).scalar()
    items = df.select("item_id").distinct().agg(F.count(F.lit(1))).scalar()
    lines = df.agg(F.sum("n_rows").alias("n_rows"))
    return lines.withColumns({"n_users": users, "n_items": items})


def bm25_weights(train: DataFrame, users: DataFrame, k1: float = 100.0, b: float = 0.8) -> DataFrame:
    """Saturated weights, damped for users with many items; no document-frequency part.

    The mean length runs over all ``users``, including those left without training items.
    """
    lengths = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_len"))
    n_users = users.select("user_id").distinct().agg(F.count(F.lit(1))).scalar()
    mean = lengths.agg(F.sum("_len")).scalar() / n_users
    damp = k1 * (1 - b + b * F.col("_len") / mean)
    saturated = F.col("weight") * (k1 + 1) / (F.col("weight") + damp)
    return train.join(lengths, "user_id").withColumn("bm25", saturated).drop("_len")


def leakage_audit(full: DataFrame, train: DataFrame, test: DataFrame, recs: DataFrame,
                  popularity: DataFrame | None = None) -> DataFrame:
    """``(check, n_violations)``; every count has to be zero.

    With ``popularity`` (``item_id, popularity``), its numbers must be those of the training rows alone.
    """
    key = ["user_id", "item_id"]
    sizes = full.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.max("last_at").alias("_last"))
    latest = full.join(test, key, "left_semi").join(sizes, "user_id")
    checks = {
        "held_out_in_train": train.join(test, key, "left_semi"),
        "test_user_with_one_item": test.join(sizes.filter("_n < 2"), "user_id", "left_semi"),
        "held_out_not_latest": latest.filter(F.col("last_at") < F.col("_last")),
        "seen_recommended": recs.join(train, key, "left_semi"),
        "recommended_outside_catalogue": recs.join(full.select("item_id").distinct(), "item_id", "left_anti"),
    }
    if popularity is not None:
        own = train.groupBy("item_id").agg(F.sum(F.col("weight").cast("decimal(20,9)")).cast("double").alias("_own"))
        apart = F.abs(F.col("popularity") - F.coalesce("_own", F.lit(0.0))) > 1e-6
        checks["popularity_beyond_train"] = popularity.join(own, "item_id", "left").filter(apart)
    rows = None
    for name, bad in checks.items():
        one = bad.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check"), "n_violations")
        rows = one if rows is None else rows.unionByName(one)
    return rows
