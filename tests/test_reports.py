"""Run reports, comparisons and augmentation on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from decklight.functions import columns as C
from decklight.operators import metrics as M, runs as R, voxels as V

LOGS = [
    "[Child 0] [bridge=bridge_1_a] INFER_OK bridge_seconds=2.50s",
    "[Child 0] [bridge=bridge_2_a] INFER_FAILED reason=timeout reason=later",
    "[Child 0] SUMMARY succeeded=1 failed=1 skipped_exists=0 skipped_too_few_points=0 download_failed=2 total=4 wall_clock_seconds=100 wall_clock_hours=0.0278 gpu_seconds=7.5 note=fine",
    "[Child 2] SUMMARY succeeded=5 failed=0 skipped_exists=1 skipped_too_few_points=0 download_failed=0 total=6 wall_clock_seconds=50 wall_clock_hours=0.0139",
    "[Child 2] [bridge=bridge_3_a] SKIP_SMALL_FILE points<100",
    "[Child 2] [bridge=bridge_2_a] INFER_FAILED reason=inference_error",
    "no line of a child", None,
]


@pytest.fixture
def logs(spark):
    return spark.createDataFrame(list(enumerate(LOGS)), "line_no int, line string")


def test_pairs_and_counters(spark, logs):
    parsed = {r.line_no: r for r in C.parse_run_log(logs).collect()}
    assert parsed[0].pairs == {"bridge_seconds": "2.50s"} and parsed[1].pairs == {"reason": "timeout"} and parsed[4].pairs == {} == parsed[6].pairs
    assert parsed[2].pairs["gpu_seconds"] == "7.5" and parsed[2].event == "SUMMARY" and parsed[2].bridge is None
    totals = {r.counter: (r.total, r.lines) for r in R.summary_totals(logs).collect()}
    assert totals["succeeded"] == (6.0, 2) and totals["gpu_seconds"] == (7.5, 1) and "note" not in totals
    reports = {r.child: r for r in R.child_reports(logs, 4).collect()}
    assert sorted(reports) == [0, 1, 2, 3] and reports[1].lines == 0 and reports[1].total is None and reports[0].download_failed == 2.0
    assert {c for c, r in R.child_reports(logs, 1).toPandas().set_index("child")["expected"].items() if not r} == {2}
    timing = R.child_timing(logs, 4).first()
    assert (timing.children_reported, timing.children_expected, timing.min_seconds, timing.max_seconds, timing.avg_seconds, timing.total_child_hours) == (2, 4, 50.0, 100.0, 75.0, 0.0417)
    assert R.child_timing(logs.limit(0), 4).first().children_reported == 0


def test_report_of_missing_lines(spark, logs):
    lines = spark.createDataFrame([(i, f"h/bridge_{i}_a{e}") for i, e in enumerate(["", ".laz", "", ""])], "line_no int, line string")
    listing = spark.createDataFrame([("out/h/bridge_0_a_predicted.laz",)], "key string")
    report = R.postrun_report(lines, listing, logs, "out", "raw", expected_children=4, most=2)
    r = report.first()
    assert (r.audit.total, r.audit.found, r.audit.missing) == (4, 1, 3) and r.aggregated_results["download_failed"] == 2 and "wall_clock_hours" not in r.aggregated_results
    assert r.missing_entries == ["h/bridge_1_a.laz", "h/bridge_2_a"] and r.missing_entries_truncated and r.total_missing == 3
    assert r.missing_reasons == {"h/bridge_2_a": "inference_error"} and r.counts_by_reason == {"inference_error": 1, "too_few_points": 1, "unknown": 1}
    assert r.cost_estimate.estimated_compute_usd == 0.01 and r.bridge_timing["count"] == 1
    assert json.loads(R.report_json(report).first().report)["child_timing"]["children_expected"] == 4
    whole = R.postrun_report(lines, listing, logs.limit(0), "out", "raw", expected_children=0).first()
    assert not whole.missing_entries_truncated and whole.total_missing is None and len(whole.missing_entries) == 3 and whole.missing_reasons == {} == whole.aggregated_results


def test_messages_and_totals(spark):
    full = spark.createDataFrame([("a", "1", "Y"), ("a", "2", "Y"), ("b", "3", "Y"), ("b", "4", "N"), ("c", "5", "Y"), ("d", "6", "N")], "huc_id string, osmid string, has_lidar_tif string")
    subset = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "4"), ("c", "5"), ("c", "7")], "huc_id string, osmid string")
    got = {r.huc_id: (r.verdict, r.message) for r in R.subset_verify(full, subset).collect()}
    assert got == {"a": ("PASS", "OK"), "b": ("FAIL", "osmid set mismatch (counts equal)"), "c": ("FAIL", "count mismatch: expected 1, got 2")}
    asked = spark.createDataFrame([("a",), ("d",), ("x",), ("x",)], "huc_id string")
    assert R.huc_totals(full, asked).first().asDict() == {"processed": 2, "skipped_missing": 1, "total_bridges": 3, "lidar_bridges": 2, "hucs_with_lidar": 1, "not_lidar_bridges": 1, "hucs_with_not_lidar": 1}
    assert R.id_lists(full).first().asDict() == {"hucs": "a b c d", "osm_ids": "1 2 3 4 5 6"}
    clouds = spark.createDataFrame([(3,), (10,), (5,), (8,)], "n_points int")
    assert tuple(R.point_count_stats(clouds).select("clouds", "median", "mean", "min", "max").first()) == (4, 6.5, 6.5, 3, 10)


def test_comparison_of_two_matrices(spark):
    cells = lambda n: spark.createDataFrame([(g, p, n.get((g, p), 0)) for g in range(4) for p in range(4)], "gold int, pred int, n long")
    model, baseline = cells({(2, 2): 8, (2, 1): 2, (1, 1): 10}), cells({(2, 2): 5, (2, 1): 5, (1, 2): 5, (1, 1): 5})
    got = {r.metric: (round(r.model, 3), round(r.baseline, 3)) for r in M.overall_vs_baseline(model, baseline).collect()}
    assert got == {"overall_accuracy": (90.0, 50.0), "mean_iou": (81.667, 33.333), "deck_iou": (80.0, 33.333), "rest_iou": (83.333, 33.333), "binary_accuracy": (90.0, 50.0)}
    binary = {(r.gold_deck, r.pred_deck): (r.n, r.percent) for r in M.binary_confusion(model).collect()}
    assert binary == {(True, True): (8, 80.0), (True, False): (2, 20.0), (False, False): (10, 100.0), (False, True): (0, 0.0)}
    empty = {(r.gold_deck, r.pred_deck): r.percent for r in M.binary_confusion(cells({(2, 2): 1})).collect()}
    assert empty[False, True] == empty[False, False] == 0.0
    batches = spark.createDataFrame([(1.0, 0.5, 0.5, 0.9, 3), (0.0, 0.0, 0.0, 0.5, 1)], "recall double, precision double, iou double, accuracy double, n int")
    mean = M.epoch_deck_metrics(batches).first()
    assert (mean.batches, mean.recall, mean.iou) == (2, 0.75, 0.375)


def test_extra_augmentation_keeps_small_clouds(spark):
    rows = [("h", b, i, float(i % 9), float(i // 9), 1.0 + i / 50, 0.5, i % 4) for b, n in (("small", 10), ("large", 900)) for i in range(n)]
    cloud = spark.createDataFrame(rows, "huc_id string, bridge_id string, point_idx long, x double, y double, z double, intensity double, gold int")
    out = V.augment_points(cloud, extra=True)
    assert out.columns == cloud.columns
    got = out.toPandas()
    sizes = got.groupby("bridge_id").size()
    assert sizes["small"] == 10 and 0.88 * 900 < sizes["large"] < 0.97 * 900
    assert got.groupby("bridge_id")[["x", "y", "z"]].min().abs().to_numpy().max() == 0 and got["intensity"].between(0, 1).all() and got["intensity"].nunique() > 800
    span = got[got.bridge_id == "large"][["x", "y"]].max()
    assert 0.85 * 99 < max(span) < 1.15 * 101
    again = V.augment_points(cloud.repartition(7), extra=True).toPandas().sort_values(["bridge_id", "point_idx"]).reset_index(drop=True)
    assert again.round(9).equals(got.sort_values(["bridge_id", "point_idx"]).reset_index(drop=True).round(9))
