"""What the operators share: Arrow batch limits and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from functools import lru_cache
from pathlib import Path

import cartloom

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.session import configure

# Texts can be long: a batch for Python holds so many rows and bytes at most.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


@lru_cache(maxsize=None)
def ship_package(application: str) -> None:
    """Send this package's modules to the executors, once per application: their Python imports the functions."""
    root = Path(cartloom.__file__).parent
    file = Path(tempfile.mkdtemp(prefix="cartloom-"), "cartloom.zip")  # on the driver, which serves it
    with zipfile.ZipFile(file, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    SparkSession.active().sparkContext.addPyFile(str(file))


def prepared(spark: SparkSession) -> SparkSession:
    """The library's session settings and the batch limits; the executors get the package."""
    configure(spark)
    ship_package(spark.sparkContext.applicationId)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that every node sees, removed when the session's JVM ends.

    Below ``spark.checkpoint.dir``; only where that is unset, as in tests, below the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/cartloom-llm/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that no later step computes it again
    and a lost executor costs no more than the files' rereading."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only ``names`` of ``df``: whatever else it has can't clash with columns made later."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
