"""The shared folder for written tables, checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one: it gets a fresh temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        base = context.getCheckpointDir()
        if not base:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="gearlog-"))
            base = context.getCheckpointDir()
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared base, different on every call."""
    return f"{shared_base(spark)}/gearlog/{name}-{uuid.uuid4().hex}"


def _on_disk(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, where = _on_disk(spark, path)
    fs.delete(where, True)


def read_or_empty(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """A Parquet table, without rows if nothing has been written yet."""
    fs, where = _on_disk(spark, path)
    if not fs.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)
