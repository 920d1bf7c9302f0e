"""Joins and ranks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.session import materialise

# A key is hot with this share of the rows, or with this many rows, whatever share they are.
HOT_SHARE, HOT_ROWS = 0.01, 1_000_000
SALTS = 64


def spread(df: DataFrame, *keys: str | Column, partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``keys`` into a fixed number of tasks.

    Grouped Python work costs far more per row than its bytes suggest, so the partitions must not be
    merged by size; a partition count given explicitly is left alone by adaptive execution.
    """
    spark = df.sparkSession
    wanted = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(wanted, *keys)


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread an input of fewer partitions than cores; a large scan already has more and stays as is.

    Meant for row-local work that is heavy per row, such as tokenising the texts of one small file.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hot_keys(df: DataFrame, key: str, weight: Column | None = None, share: float = HOT_SHARE, rows: int = HOT_ROWS) -> DataFrame:
    """Keys holding ``share`` of the rows (or of ``weight``) or ``rows`` of them: at most 1/share or total/rows keys."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(key).agg(size.alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") >= F.least(share * total, F.lit(rows))).select(key)


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
                hot: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """Equi-join where rows of hot ``key`` values on the left are spread over ``salts`` partitions.

    The right side must be unique on ``key``; only its hot rows are copied, ``salts`` times each.
    Works for inner, left, left_semi and left_anti, and loses or repeats no row. A given ``hot`` list
    saves counting the left side; ``hot_keys`` has one row for each million rows, which bounds its broadcast.
    """
    hot = hot_keys(left, key) if hot is None else hot
    marked = F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0))
    lhs = left.join(marked, key, "left").withColumn("_salt", spread.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    rhs = right.join(marked, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return lhs.join(rhs, [key, "_salt"], how).drop("_salt")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Dense 1..n position under a total order, without sending all rows to one task.

    Rows are range-partitioned and sorted; each partition numbers its own rows and adds the number
    of rows in earlier partitions (one count per partition).
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = materialise(parts, "ranked")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(name, (local + F.col("_offset")).cast("bigint"))
        .drop("_part", "_offset")
    )
    ranked.scratch_path = parts.scratch_path  # so that the sorted rows can be released
    return ranked
