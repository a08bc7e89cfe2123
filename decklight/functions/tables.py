"""Tables between two parts of a job, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``; a local one is made and set only where that is unset on a local master, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """``df`` written as Parquet and read again: later parts do not run it again, nor do they differ in its order.

    Where rows hold long arrays, ``group_bytes`` bounds a row group, and so the batch of 4,096 rows that a reader would hold.
    """
    path = shared_folder(df.sparkSession)
    (df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
