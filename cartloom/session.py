"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan in this package relies on.
RUNTIME_CONF = {
    # Bad text and overflowing numbers raise instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks. Forced, because the aggregates that follow
    # the joins here would otherwise make Spark keep the unsplit partition to save a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session the caller owns and return it.

    Adaptive execution merges small shuffle partitions but never makes more than it starts
    with. They start at ``initial_partitions`` (for large inputs, shuffled bytes / 128 MB), else
    at what the session already names, else at three per core or ``spark.sql.shuffle.partitions``, whichever is more.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if initial_partitions is not None:
        spark.conf.set(INITIAL_PARTITIONS, str(initial_partitions))
    elif spark.conf.get(INITIAL_PARTITIONS, None) is None:
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        cores = spark.sparkContext.defaultParallelism
        if 3 * cores > shuffle:
            spark.conf.set(INITIAL_PARTITIONS, str(3 * cores))
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """An empty folder below the one the cluster names in ``spark.checkpoint.dir``.

    Without that setting, below the warehouse, which is a shared path on a cluster. ``name`` makes it one folder of
    the application for that name, emptied now; without, each call gives another. All go when the session's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/cartloom-{spark.sparkContext.applicationId}/{name or uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path, True)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a working folder and read back: computed once, the same rows for every later step."""
    folder = shared_dir(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def setting(spark: SparkSession, name: str, default: str | None = None) -> str | None:
    """Configuration by name: Spark conf ``cartloom.<name>``, then the environment, then the default."""
    value = spark.conf.get(f"cartloom.{name}", None)
    if value is None:
        value = os.environ.get(f"CARTLOOM_{name.upper()}", default)
    return value
