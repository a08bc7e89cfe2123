"""Streams over files: each file once across restarts, late keys once."""

from pyspark.sql import functions as F

from decklight.streaming import monitor

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def put(spark, path, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "event_id long").select(
        "event_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, event_id)").alias("ts"),
        (F.col("event_id") % 3).alias("user_id"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("event_type"),
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def test_restart_reads_new_files_only(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    put(spark, source, range(10))
    read = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    monitor.run_once(monitor.incremental_tasks(read(), ["user_id"]).select("user_id"), out, state)
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    monitor.run_once(monitor.incremental_tasks(read(), ["user_id"]).select("user_id"), out, state)
    put(spark, source, range(10, 20))
    monitor.run_once(monitor.incremental_tasks(read(), ["user_id"]).select("user_id"), out, state)
    assert sorted(r.user_id for r in spark.read.parquet(out).select("user_id").collect()) == [0, 1, 2]


LINES = "ts timestamp, line string"


def put_lines(spark, path, rows):
    """Rows of (minutes, child, event text)."""
    df = spark.createDataFrame([(m, f"[Child {c}] [bridge=b{m}] {e}") for m, c, e in rows], "m int, line string")
    df.select(F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m)").alias("ts"), "line").coalesce(1).write.mode("append").parquet(path)


def test_windows_are_upserted_and_state_is_bounded(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    windows = lambda: monitor.live_run_monitor(spark.readStream.schema(LINES).parquet(source))
    ok, bad = "INFER_OK bridge_seconds=2.50s", "INFER_FAILED reason=timeout"

    def current():
        rows = monitor.current_windows(spark, out, windows().schema).collect()
        assert len(rows) == len({(r.window_start, r.child, r.event, r.reason) for r in rows})
        return {(r.window_start.hour * 60 + r.window_start.minute, r.child, r.event, r.reason): (r.n, r.seconds) for r in rows}

    put_lines(spark, source, [(m, m % 2, ok) for m in range(20)] + [(3, 0, bad)])
    monitor.upsert_windows(windows(), out, state)
    first = {(w, c, "INFER_OK", None): (5, 12.5) for w in (0, 10) for c in (0, 1)} | {(0, 0, "INFER_FAILED", "timeout"): (1, None)}
    assert current() == first
    # late, but within an hour of the latest event: the window is counted on, and not twice
    put_lines(spark, source, [(4, 0, ok), (12, 1, ok), (70, 0, ok)])
    monitor.upsert_windows(windows(), out, state)
    second = first | {(0, 0, "INFER_OK", None): (6, 15.0), (10, 1, "INFER_OK", None): (6, 15.0), (70, 0, "INFER_OK", None): (1, 2.5)}
    assert current() == second
    # a jump in time: the old windows leave the state, and an event of theirs is left out
    put_lines(spark, source, [(m, 0, ok) for m in range(1_000, 1_400, 10)])
    monitor.upsert_windows(windows(), out, state)
    put_lines(spark, source, [(5, 0, ok), (1_395, 0, ok)])
    progress = monitor.upsert_windows(windows(), out, state)
    held = [p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators]
    assert held[-1] <= 8  # windows of the last hour
    wanted = second | {(m, 0, "INFER_OK", None): (1, 2.5) for m in range(1_000, 1_400, 10)} | {(1_390, 0, "INFER_OK", None): (2, 5.0)}
    assert current() == wanted


def test_a_task_comes_once_for_ever(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))

    def put_tasks(rows):
        df = spark.createDataFrame(rows, "day int, huc string, osmid string, task_batch string")
        df.select(F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, day)").alias("ts"), "huc", "osmid").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("ts timestamp, huc string, osmid string").parquet(source)
        tasks = monitor.incremental_tasks(stream, ["huc", "osmid"], late="2 days").select("huc", "osmid")
        monitor.write_new_tasks(tasks, ["huc", "osmid"], out, state)
        return sorted(((r.huc, r.osmid) for r in monitor.written_tasks(spark, out, tasks.schema).collect()), key=str)

    put_tasks([(0, "h", "1", ""), (0, "h", "1", ""), (0, "h", None, ""), (1, "g", "2", "")])
    assert run() == [("g", "2"), ("h", "1"), ("h", None)]
    put_tasks([(30, "x", "9", "")])
    assert run() == [("g", "2"), ("h", "1"), ("h", None), ("x", "9")]
    # long after the watermark has let go of them
    put_tasks([(60, "h", "1", ""), (60, "h", None, ""), (60, "y", "3", ""), (61, "y", "3", "")])
    assert run() == [("g", "2"), ("h", "1"), ("h", None), ("x", "9"), ("y", "3")] == run()
