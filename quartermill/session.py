"""Session helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether shuffle files go when their query ends, instead of when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "quartermill", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark, with scratch space that ends with it; clusters bring their own."""
    scratch = tempfile.mkdtemp(prefix="quartermill-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application that every executor can reach, below ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse, which the executors share as well; never in a
    temporary folder of one machine.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    root = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/quartermill-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything this application has written to its scratch folder, wherever that lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative jobs and of inputs used by several branches. The table outlives
    lost executors, and its known size lets the optimizer decide broadcasts on facts.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the written table takes their place, and iterations would fill the disks with them
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove what ``materialise`` wrote for ``tables``, when nothing will read them again."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
