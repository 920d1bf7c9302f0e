"""Recommenders. Each returns rows ``(user_id, rank, item_id, score)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import global_rank
from quartermill.operators.implicit_als import als
from quartermill.operators.interactions import bm25_weights
from quartermill.operators.vectors import l2_norm, normalise, score_range, top_k_scores, weighted_sum
from quartermill.session import materialise

# Popularity sums run in decimals: the order of addition must not decide between equal items.
EXACT_WEIGHT = "decimal(20,9)"
SVD_WEIGHT = 0.6


def popular_items(train: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """``(item_id, popularity)``: training weight of each item, 0 for items without training rows."""
    sums = train.groupBy("item_id").agg(
        F.sum(F.col("weight").cast(EXACT_WEIGHT)).cast("double").alias("popularity"))
    if catalogue is None:
        return sums
    return catalogue.select("item_id").join(sums, "item_id", "left").fillna(0.0, subset=["popularity"])


def popular_order(train: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """Items with their position in the popularity order (ties: larger item id first)."""
    return global_rank(popular_items(train, catalogue), [F.desc("popularity"), F.desc("item_id")], "position")


def anti_join_seen(scores: DataFrame, train: DataFrame) -> DataFrame:
    """Remove the items a user already has."""
    return scores.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def topk_items(scores: DataFrame, k: int) -> DataFrame:
    """The k best rows per user of a long score table (ties: larger item id first)."""
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), F.desc("item_id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rec_popularity(train: DataFrame, users: DataFrame, k: int, order: DataFrame | None = None) -> DataFrame:
    """The k most popular items each user has not seen.

    The j-th seen item of a user, by popularity, lies before the k-th unseen one exactly when fewer
    than k unseen items precede it (position - j < k). So k + m positions are enough, with m counted
    per user: nothing is capped, and no user is paired with the whole catalogue. The first 2 k positions
    are asked for by nearly every user and are so few that they are sent to the users; only users who have seen
    more than k of the first travel to later ones.
    """
    order = materialise(popular_order(train), "popular") if order is None else order
    users = users.select("user_id").distinct()
    total = order.agg(F.count(F.lit(1))).scalar()
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("position"))
    passed = (
        train.select("user_id", "item_id").join(users, "user_id", "left_semi")
        .join(order.select("item_id", "position"), "item_id")
        .withColumn("_nth", nth).filter(F.col("position") - F.col("_nth") < k)
        .groupBy("user_id").agg(F.collect_list("position").alias("_passed"))
    )
    none = F.array().cast("array<bigint>")
    wanted = users.join(passed, "user_id", "left").withColumn("_passed", F.coalesce("_passed", none)).withColumn(
        "_total", total)
    last = F.least(F.col("_total"), F.size("_passed") + F.lit(k).cast("bigint"))
    unseen = F.array_except(F.sequence(F.lit(1).cast("bigint"), last), F.col("_passed"))
    places = wanted.filter("_total > 0").select("user_id", F.posexplode(unseen).alias("_i", "position"))
    named = order.select("position", "item_id", F.col("popularity").alias("score"))
    first = places.filter(F.col("position") <= 2 * k).join(F.broadcast(named.filter(F.col("position") <= 2 * k)), "position")
    later = places.filter(F.col("position") > 2 * k).join(named, "position")
    named = first.unionByName(later)
    return named.select("user_id", (F.col("_i") + 1).alias("rank"), "item_id", "score")


def rec_factors(user_factors: DataFrame, item_factors: DataFrame, train: DataFrame, users: DataFrame,
                k: int) -> DataFrame:
    """Recommendations from any pair of factor tables (matrix factorisation, implicit ALS)."""
    asked = user_factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return top_k_scores(asked, item_factors, k, train)


def content_profiles(train: DataFrame, topics: DataFrame, users: DataFrame, size: int) -> DataFrame:
    """Unit-length sum of weight * topic vector over a user's items; zero profiles are left out."""
    bought = train.join(users.select("user_id").distinct(), "user_id", "left_semi").join(topics, "item_id")
    profiles = weighted_sum(bought, "user_id", "weight", "vec", size)
    return normalise(profiles.filter(l2_norm(F.col("vec")) > 0))


def rec_content(train: DataFrame, topics: DataFrame, users: DataFrame, size: int, k: int) -> DataFrame:
    """Items closest to the user's profile; ``topics`` holds unit vectors ``(item_id, vec)``."""
    profiles = materialise(content_profiles(train, topics, users, size), "profiles")
    return top_k_scores(profiles, topics, k, train)


def cold_start_fallback(recs: DataFrame, train: DataFrame, users: DataFrame, k: int,
                        order: DataFrame | None = None) -> DataFrame:
    """Users without training history get the popularity list."""
    cold = users.select("user_id").distinct().join(train, "user_id", "left_anti")
    columns = ["user_id", "rank", "item_id", "score"]
    return recs.select(*columns).unionByName(rec_popularity(train, cold, k, order).select(*columns))


def minmax_per_user(scores: DataFrame) -> DataFrame:
    """Scores scaled to [0, 1] within each user, over all of the user's rows; zero range gives 0."""
    bounds = scores.groupBy("user_id").agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    scaled = F.try_divide(F.col("score") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return scores.join(bounds, "user_id").withColumn("score", F.coalesce(scaled, F.lit(0.0))).drop("_lo", "_hi")


def hybrid_vectors(svd_users: DataFrame, svd_items: DataFrame, profiles: DataFrame, topics: DataFrame,
                   svd_size: int, topic_size: int, svd_weight: float = SVD_WEIGHT) -> tuple[DataFrame, DataFrame]:
    """One vector pair whose dot product is the blended, per-user min-max scaled score.

    Scaling is affine per user, so it folds into the user vector: both parts are divided by their
    range and the two minima become one constant against an extra component of 1 in the item
    vector. A user without a content profile gets zero content scores.
    """
    svd_part = svd_users.join(score_range(svd_users, svd_items), "user_id").withColumnsRenamed(
        {"vec": "_s", "lo": "_slo", "hi": "_shi"})
    content_part = profiles.join(score_range(profiles, topics), "user_id").withColumnsRenamed(
        {"vec": "_c", "lo": "_clo", "hi": "_chi"})
    both = svd_part.join(content_part, "user_id", "left")

    def gain(weight: float, lo: str, hi: str):
        width = F.col(hi) - F.col(lo)
        return F.coalesce(F.when(width > 0, F.lit(weight) / width).otherwise(F.lit(weight)), F.lit(0.0))

    both = both.withColumns({"_gs": gain(svd_weight, "_slo", "_shi"),
                             "_gc": F.when(F.col("_c").isNull(), F.lit(0.0)).otherwise(
                                 gain(1 - svd_weight, "_clo", "_chi"))})
    zeros = F.array_repeat(F.lit(0.0), topic_size)
    shift = -(F.col("_gs") * F.col("_slo") + F.col("_gc") * F.coalesce("_clo", F.lit(0.0)))
    vec = F.concat(F.transform("_s", lambda x: x * F.col("_gs")),
                   F.transform(F.coalesce("_c", zeros), lambda x: x * F.col("_gc")), F.array(shift))
    items = svd_items.withColumnRenamed("vec", "_s").join(
        topics.withColumnRenamed("vec", "_c"), "item_id", "left")
    item_vec = F.concat("_s", F.coalesce("_c", zeros), F.array(F.lit(1.0)))
    return both.select("user_id", vec.alias("vec")), items.select("item_id", item_vec.alias("vec"))


def rec_hybrid(svd_users: DataFrame, svd_items: DataFrame, topics: DataFrame, train: DataFrame, users: DataFrame,
               svd_size: int, topic_size: int, k: int, svd_weight: float = SVD_WEIGHT) -> DataFrame:
    """Weighted blend of scaled factor and content scores; users without history get popularity."""
    warm = users.select("user_id").distinct().join(train, "user_id", "left_semi")
    asked = svd_users.join(warm, "user_id", "left_semi")
    profiles = materialise(content_profiles(train, topics, warm, topic_size), "profiles")
    u, i = hybrid_vectors(asked, svd_items, profiles, topics, svd_size, topic_size, svd_weight)
    recs = top_k_scores(materialise(u, "hybrid_users"), materialise(i, "hybrid_items"), k, train)
    return cold_start_fallback(recs, train, users, k)


def als_factors(train: DataFrame, users: DataFrame, rank: int = 64, iterations: int = 30, reg: float = 0.1,
                seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(user_factors, item_factors)`` of implicit ALS with BM25 weights as confidences."""
    return als(bm25_weights(train, users).select("user_id", "item_id", F.col("bm25").alias("weight")), rank, iterations, reg, seed)
