"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Words are separated by these six ASCII characters and nothing else.
WORD_GAP = r"[ \x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors can reach.

    It lies in ``spark.checkpoint.dir``. Only where that is unset on a local master,
    as in tests, a local temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    This cuts the lineage: a lost executor costs a task, not the whole history.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


#: Rows of a table that may be broadcast after they are counted.
BROADCAST_ROWS = 200_000


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row a ``key``; no key gathers its rows in one task.

    A key is hot if it holds over 1 in 4 * partitions of the rows, so there are at most
    4 * partitions hot keys; their rows are joined where they are, with a broadcast of the
    hot keys' part of ``table``. The others meet by a shuffle. Both inputs should be written ones.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(8, rows.count() // (4 * parts))
    hot = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(key))
    cold = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    return cold.unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key, how))


def least_ids(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct doc_ids, those of the least hash; ids far above are left out before any are gathered."""
    distinct = rows.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    share = min(1.0, 2 * most / max(1, distinct))
    least = F.xxhash64("doc_id")
    low = min(int(-(1 << 63) + share * ((1 << 64) - 1)), (1 << 63) - 1)
    return rows.where(least <= low).select("doc_id").distinct().orderBy(least, "doc_id").limit(most)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mixed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers with their bits spread."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
