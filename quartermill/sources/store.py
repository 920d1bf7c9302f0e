"""Parquet caches, result sinks and the run table."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

RUN_SCHEMA = "experiment string, run_id string, start_time timestamp, model string, metric string, value double"


class ParquetCache:
    """Tables kept by key under one folder; a miss or an unreadable table means fetch again."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder.rstrip("/")

    def path(self, key: str) -> str:
        return f"{self._folder}/{key}"

    def load(self, key: str) -> DataFrame | None:
        try:
            stored = self._spark.read.parquet(self.path(key))
            stored.write.format("noop").mode("overwrite").save()  # a damaged file shows only when it is read
            return stored
        except (PySparkException, Py4JJavaError) as exc:
            logger.info("cache miss for %s: %s", key, type(exc).__name__)
            return None

    def save(self, key: str, df: DataFrame) -> bool:
        try:
            df.write.mode("overwrite").parquet(self.path(key))
            return True
        except (PySparkException, Py4JJavaError) as exc:
            logger.warning("cache write failed for %s: %s", key, type(exc).__name__)
            return False

    def get(self, key: str, fetch: Callable[[], DataFrame]) -> DataFrame:
        """The cached table, or the fetched one after storing all of it."""
        cached = self.load(key)
        if cached is not None:
            return cached
        fresh = fetch()
        if self.save(key, fresh):
            stored = self.load(key)
            if stored is not None:
                return stored
        return fresh


def write_merged(df: DataFrame, path: str, buckets: int = 16) -> None:
    """Merged table in a bounded number of folders, so a reader of one series skips the others."""
    bucket = F.pmod(F.xxhash64("series_id"), F.lit(buckets)).cast("int")
    (
        df.withColumn("series_bucket", bucket)
        .repartition("series_bucket", "series_id")
        .sortWithinPartitions("series_id", "date")
        .write.mode("overwrite").partitionBy("series_bucket").parquet(path)
    )


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("series_bucket")


def write_results_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def with_summary(results: DataFrame, columns: list[str], label: str = "mean", name: str = "model") -> DataFrame:
    """The rows per model and one more with the mean of each column over them."""
    mean = results.agg(*[F.avg(c).alias(c) for c in columns]).withColumn(name, F.lit(label))
    rest = [F.lit(None).cast(results.schema[c].dataType).alias(c) for c in results.columns if c not in (*columns, name)]
    return results.unionByName(mean.select(name, *columns, *rest))


def append_run(df: DataFrame, path: str) -> None:
    """Append metric rows of one or more runs; columns as in ``RUN_SCHEMA``."""
    df.select(*[c.split()[0] for c in RUN_SCHEMA.split(", ")]).write.mode("append").parquet(path)


def with_parameters(runs: DataFrame, parameters: dict[str, float]) -> DataFrame:
    """Metric rows of runs and, for each run and model, a row per parameter, named ``param:<name>``."""
    named = [F.struct(F.lit(f"param:{k}").alias("metric"), F.lit(float(v)).alias("value")) for k, v in parameters.items()]
    one = runs.select("experiment", "run_id", "start_time", "model").distinct().withColumn("_p", F.explode(F.array(*named)))
    return runs.unionByName(one.select("experiment", "run_id", "start_time", "model", "_p.metric", "_p.value"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of each experiment's most recent run (ties: larger run id).

    An aggregate finds the run, so a long history of one experiment is combined before it moves.
    """
    last = runs.groupBy("experiment").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id")
    )
    return runs.join(last, ["experiment", "run_id"], "left_semi")
