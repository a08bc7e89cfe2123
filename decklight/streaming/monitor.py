"""Live monitoring of runs and incremental tasks with Structured Streaming.

Both sinks write a folder a batch, with ``overwrite``, so a batch that runs again after a
failure replaces what it had written. A batch counts once its stream has committed it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from decklight.functions.columns import parse_run_log

#: What names a window's row.
WINDOW_KEYS = ["window_start", "child", "event", "reason"]
#: Keys of tasks are dealt to this many folders; a batch reads those that it has keys of.
KEY_FOLDERS = 64


def live_run_monitor(stream: DataFrame, window: str = "10 minutes", late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Events of each child in tumbling windows, by event and failure reason, of log lines (ts, line).

    In ``update`` mode a batch gives the windows that it changed, and state holds the windows that
    are not older than the latest event less ``late``; an event of an older one is left out.
    """
    timed = parse_run_log(stream).withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    counted = timed.groupBy(F.window("__ts", window).alias("w"), "child", "event", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds"))
    return counted.select(F.col("w.start").alias("window_start"), "child", "event", "reason", "n", "seconds")


def upsert_windows(windows: DataFrame, path: str, checkpoint: str) -> list:
    """Processes what is there in update mode, writes the changed windows of each batch under ``path`` and stops; gives the batches' progress."""
    return _run(windows, checkpoint, "update", _put(path))


def current_windows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Each window as the last batch that changed it has it; ``schema`` is that of the rows of ``live_run_monitor``."""
    rows = spark.read.schema(StructType([*schema.fields]).add("batch", "long")).option("basePath", path).parquet(path)
    rest = [c for c in schema.names if c not in (*WINDOW_KEYS, "batch")]
    latest = rows.groupBy(*WINDOW_KEYS).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return latest.select(*WINDOW_KEYS, *(f"r.{c}" for c in rest))


def incremental_tasks(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "7 days") -> DataFrame:
    """Each key once within the watermark, so that state does not grow for ever; ``write_new_tasks`` leaves out those of before."""
    timed = stream.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.dropDuplicatesWithinWatermark(keys).drop("__ts")


def write_new_tasks(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> list:
    """Writes the rows whose key no earlier batch has written, one a key, and stops: each task once, for ever.

    What was written is the memory, not the stream's state, so a task that comes back after any
    time is left out. Rows lie in folders by a hash of their key, and a batch is compared with the
    folders that its own keys fall into; a batch that runs again does not see its first try.
    """
    spark, schema = stream.sparkSession, _task_schema(stream.schema)

    def put(batch: DataFrame, number: int) -> None:
        folder = F.pmod(F.xxhash64(*keys), F.lit(KEY_FOLDERS)).cast("int")
        new = rows = batch.dropDuplicates(keys).withColumn("task_keys", folder).persist()
        if number:
            folders = [r.task_keys for r in rows.select("task_keys").distinct().collect()]  # KEY_FOLDERS at most
            before = spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col("task_keys").isin(folders) & (F.col("task_batch") < number))
            seen = before.select(F.col("task_keys").alias("__f"), *(F.col(k).alias(f"__{i}") for i, k in enumerate(keys)))
            same = F.col("task_keys") == F.col("__f")
            for i, k in enumerate(keys):
                same &= F.col(k).eqNullSafe(F.col(f"__{i}"))
            new = rows.join(seen, same, "left_anti")
        new.write.mode("overwrite").partitionBy("task_keys").parquet(f"{path}/task_batch={number}")
        rows.unpersist()

    return _run(stream, checkpoint, "append", put)


def _task_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("task_batch", "long").add("task_keys", "integer")


def written_tasks(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The tasks written so far; ``schema`` is that of the stream's rows."""
    return spark.read.schema(_task_schema(schema)).option("basePath", path).parquet(path).select(*schema.names)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> list:
    """Processes what is there, exactly once across restarts with one checkpoint, and stops."""
    return _run(stream, checkpoint, mode, _put(path))


def _put(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def _run(stream: DataFrame, checkpoint: str, mode: str, put: Callable[[DataFrame, int], None]) -> list:
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return query.recentProgress
