"""Small fixtures for the rules that the tables do not reach."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from decklight.functions import columns as C
from decklight.operators import hulls, metrics as M, planes as P, runs as R, spatial, splits as E, training as T, voxels as V
from decklight.sources import tables as A

POINT = "huc_id string, bridge_id string, point_idx long, x double, y double, z double, intensity double, classification int, gold int, pred int"


def points(spark, rows):
    return spark.createDataFrame([("h", "b", i, *map(float, r[:4]), *r[4:]) for i, r in enumerate(rows)], POINT)


def test_two_voxels(spark):
    cloud = points(spark, [(0.1, 0.1, 0.1, 0.2, 2, 1, 1), (0.2, 0.3, 0.4, 0.4, 2, 1, 1), (0.9, 0.5, 0.1, 0.6, 2, 3, 1), (2.1, 0.0, 0.0, 0.3, 1, 2, 2)])
    got = {r.vx: (round(r.intensity, 6), r.n_points) for r in V.voxelize(cloud, 1.0).collect()}
    assert got == {0: (0.4, 3), 2: (0.3, 1)}
    assert {r.vx: r.label for r in V.voxel_majority_label(cloud, 1.0).collect()} == {0: 1, 2: 2}
    tie = points(spark, [(0, 0, 0, 1, 1, 3, 1), (0, 0, 0, 1, 1, 2, 1)])
    assert V.voxel_majority_label(tie, 1.0).first().label == 2


def test_names_and_stems(spark):
    df = spark.createDataFrame([("bridge_12_a_b",), ("bridge_12_",), ("bridge__x",), ("other_1_x",), (None,)], "s string")
    got = [tuple(r.p) if r.p else None for r in df.select(C.parse_bridge_stem("s").alias("p")).collect()]
    assert got == [("12", "a_b"), ("12", ""), None, None, None]
    with pytest.raises(ValueError):
        C.classified_output(df, "other")


def test_split_ratios():
    assert E.split_ratios() == (0.70, 0.15, 0.15)
    assert E.split_ratios(train=0.8) == pytest.approx((0.8, 0.1, 0.1))
    assert E.split_ratios(val=0.2, test=0.2) == pytest.approx((0.6, 0.2, 0.2))
    for bad in ((0.9, 0.3, None), (0.5, 0.2, 0.2), (1.2, None, None)):
        with pytest.raises(ValueError):
            E.split_ratios(*bad)


@pytest.mark.parametrize("n", [1, 60, 61, 700])
def test_every_line_in_one_chunk(spark, n):
    lines = spark.range(n).select(F.col("id").alias("line_no")).repartition(7)
    rows = E.manifest_chunks(lines).collect()
    size = 1 if n <= 60 else -(-n // 60)
    assert len(rows) == n and {r.array_size for r in rows} == {size} and max(r.child for r in rows) < size


def test_weights_and_gates(spark):
    totals = spark.createDataFrame([(0, 1000), (1, 100), (2, 0)], "class int, total long")
    got = {r["class"]: r.weight for r in V.class_weights(totals).collect()}
    assert got == {0: pytest.approx(1100 / 3000), 1: pytest.approx(1100 / 300), 2: 0.0}
    ratio = V.imbalance_ratio(totals).first()
    assert ratio.ratio is None and not ratio.warn


def test_plane_of_a_noisy_deck(spark):
    import random

    random.seed(1)
    rows = []
    for i in range(400):
        x, y = random.uniform(0, 20), random.uniform(0, 6)
        off = random.choice([3.0, -4.0]) if i % 4 == 0 else random.gauss(0, 0.04)
        rows.append((x, y, 0.05 * x + 0.02 * y + 10 + off, 1.0, 1, 2, 2))
    cloud = points(spark, rows)
    plane = P.plane_consensus(cloud).first()
    assert abs(plane.a - 0.05) < 0.01 and abs(plane.b - 0.02) < 0.02 and plane.n_inliers >= 295
    assert P.quality_gate(cloud).first().status == "success"
    few = points(spark, rows[:12])
    assert P.quality_gate(few).first().status == "ransac_insufficient"
    arched = points(spark, [(i / 10, (i % 7) / 10, 10 - 0.1 * (i / 10 - 10) ** 2, 1.0, 1, 2, 2) for i in range(200)])
    assert P.linearity_check(arched).first().curved
    again = P.plane_consensus(cloud.repartition(5)).first()
    assert (round(again.a, 9), again.n_inliers) == (round(plane.a, 9), plane.n_inliers)


def test_metrics_on_empty_classes(spark):
    cloud = points(spark, [(0, 0, 0, 1, 1, 2, 2), (0, 0, 0, 1, 1, 2, 1)])
    cm = M.confusion_matrix(cloud)
    assert cm.count() == 16
    got = {r["class"]: (r.precision, r.recall, r.support) for r in M.class_metrics(cm).collect()}
    assert got[2] == (1.0, 0.5, 2) and got[3] == (0.0, 0.0, 0)
    assert M.overall_metrics(cm).first().mean_iou == 50.0


def test_lines_and_pairs(spark, tmp_path):
    (tmp_path / "m.txt").write_text(" a/b \n\nc/d\n")
    assert [tuple(r) for r in A.scan_manifest(spark, f"file://{tmp_path}/m.txt").orderBy("line_no").collect()] == [(1, "a/b"), (2, "c/d")]
    (tmp_path / "p.tsv").write_text("in\tout\nin2\tout2\n")
    assert {tuple(r) for r in A.scan_pairs(spark, f"file://{tmp_path}/p.tsv").collect()} == {("in", "out"), ("in2", "out2")}
    (tmp_path / "q.tsv").write_text("only\n")
    with pytest.raises(Exception, match="expected two fields"):
        A.scan_pairs(spark, f"file://{tmp_path}/q.tsv").collect()
    with pytest.raises(Exception, match="no slash"):
        A.split_ids(spark.createDataFrame([("x", 1)], "value string, line_no long")).collect()
    (tmp_path / "s.json").write_text('{"features": [{"url": "u"}, {"name": "n", "properties": {"url": "v"}}, {"name": "x"}]}')
    assert [(r.url, r.name) for r in A.scan_sources(spark, f"file://{tmp_path}/s.json").collect()] == [("u", "source_0"), ("v", "n")]


def test_sinks_and_registry(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "huc_id string, osmid string")
    A.write_by_huc(df, "huc_id", f"file://{tmp_path}/h")
    assert spark.read.parquet(f"file://{tmp_path}/h").groupBy("huc_id").count().count() == 2
    text = '{"models": {"a": {"checkpoint": "ca", "evaluation": {"test": {"iou": 0.5}}}, "b": {"parent": "a", "checkpoint": "cb", "evaluation": {"test": {"iou": 0.7}}}, "c": {"parent": "z"}}}'
    rows = A.registry_rows(spark.createDataFrame([(text,)], "value string"))
    assert [r.model for r in A.model_leaderboard(rows, "test", "iou").collect()] == ["b", "a"]
    assert {r.model: r.parent_checkpoint for r in A.model_lineage(rows).collect()} == {"a": "unknown", "b": "ca", "c": "unknown"}
    files = spark.createDataFrame([("m_iou=0.71.pt",), ("m_iou=0.8.pt",), ("m_loss=0.3.pt",), ("m_loss=0.2.pt",)], "path string")
    assert {r.metric: r.path for r in A.best_checkpoint(files).collect()} == {"iou": "m_iou=0.8.pt", "loss": "m_loss=0.2.pt"}


def test_curves(spark):
    assert T.metric_pairs(["epoch", "train_iou_epoch", "val_iou", "train_loss_epoch", "val_loss", "train_x", "val_x"]) == [
        ("loss", "train_loss_epoch", "val_loss"),
        ("iou", "train_iou_epoch", "val_iou"),
    ]
    epochs = spark.createDataFrame([(i, float(i % 7)) for i in range(12)], "epoch int, m double")
    assert [r.epoch for r in T.epoch_progression(epochs).collect()] == [0, 3, 6, 8, 11]
    assert T.best_epoch(epochs, "m").first().epoch == 6
    assert R.filter_by_ids(epochs, "epoch", []).count() == 0


def test_predict_points_labels_every_point(spark):
    from decklight.plans import catalogue

    sf = "/root/testdata/sf0.001"
    out = catalogue.QUERIES["m2_predict_points"](spark, sf)
    bridges = {r.bridge_id for r in out.select("bridge_id").distinct().collect()}
    assert any(int(b) % 5 for b in bridges) and any(int(b) % 5 == 0 for b in bridges)


def plain_hull(points):
    """Corners: points that see all others within less than half a turn."""
    own, out = sorted(set(points)), set()
    for p in own:
        turns = sorted(math.atan2(q[1] - p[1], q[0] - p[0]) for q in own if q != p)
        gaps = [b - a for a, b in zip(turns, turns[1:] + [turns[0] + 2 * math.pi])] if turns else []
        if gaps and max(gaps) > math.pi + 1e-9:
            out.add(p)
    return out


def test_hulls_of_parts(spark):
    random.seed(4)
    clouds = {
        "many": [(random.randint(0, 60), random.randint(0, 30)) for _ in range(300)], "square": [(x, y) for x in range(6) for y in range(6)],
        "line": [(x, 2 * x) for x in range(9)], "one": [(3, 4)] * 3, "two": [(0, 0), (1, 1)],
    }
    rows = [("h", name, float(x), float(y)) for name, own in clouds.items() for x, y in own]
    points = spark.createDataFrame(rows, "huc_id string, bridge_id string, x double, y double")
    for part_points in (20_000, 16):
        got = {r.bridge_id: r for r in hulls.convex_hull(points, part_points).collect()}
        for name in ("many", "square"):
            assert {(p.x, p.y) for p in got[name].hull} == plain_hull(clouds[name]) and got[name].n_corners == len(got[name].hull)
        assert all(got[name].hull is None and got[name].n_corners < 3 for name in ("line", "one", "two"))


def test_points_in_hulls(spark):
    random.seed(12)
    clouds = {"tilted": [(0, 0), (9, 3), (5, 8)], "box": [(0, 0), (0, 6), (8, 0), (8, 6)], "flat left": [(0, 0), (0, 5), (7, 2)], "flat right": [(0, 2), (7, 0), (7, 5)]}
    clouds["round"] = [(round(50 + 50 * math.cos(k / 9)), round(50 + 50 * math.sin(k / 9))) for k in range(57)]
    cloud = "huc_id string, bridge_id string, x double, y double"
    found = hulls.convex_hull(spark.createDataFrame([("h", n, float(x), float(y)) for n, own in clouds.items() for x, y in own], cloud))
    asked = [("h", n, float(x), float(y)) for n, own in clouds.items() for x, y in [*own, *((random.randint(-2, 11), random.randint(-2, 10)) for _ in range(300)), *((random.randint(0, 100), random.randint(0, 100)) for _ in range(60))]]
    got = [(r.bridge_id, r.x, r.y, r.inside) for r in hulls.points_in_hull(spark.createDataFrame(asked, cloud), found).collect()]
    corners = {r.bridge_id: [(p.x, p.y) for p in r.hull] for r in found.collect()}
    assert len(got) == len(asked)
    for n, x, y, inside in got:
        own = corners[n]
        assert inside == all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0 for (ax, ay), (bx, by) in zip(own, own[1:] + own[:1])), (n, x, y)


def _near_polygon(path, ring, steps=400):
    """The least distance of a path to a polygon, by points along the path; 0 where one is inside."""
    least = math.inf
    sides = list(zip(ring, ring[1:] + ring[:1]))
    for (ax, ay), (bx, by) in zip(path, path[1:]):
        for k in range(steps + 1):
            px, py = ax + (bx - ax) * k / steps, ay + (by - ay) * k / steps
            turn = 0.0
            for (cx, cy), (dx, dy) in sides:
                turn += math.remainder(math.atan2(dy - py, dx - px) - math.atan2(cy - py, cx - px), 2 * math.pi)
                t = max(0.0, min(1.0, ((px - cx) * (dx - cx) + (py - cy) * (dy - cy)) / ((dx - cx) ** 2 + (dy - cy) ** 2)))
                least = min(least, math.hypot(px - cx - t * (dx - cx), py - cy - t * (dy - cy)))
            if abs(turn) > math.pi:
                return 0.0
    return least


def test_paths_and_slanted_footprints(spark):
    random.seed(6)
    paths = {str(i): [(x := random.uniform(0, 900), y := random.uniform(0, 900)), (x + random.uniform(-90, 90), y + 40), (x + 60, y - 30)] for i in range(25)}
    rings = {}
    for i in range(12):
        x, y, r = random.uniform(0, 900), random.uniform(0, 900), random.choice([30, 150, 400])
        rings[f"s{i}"] = [(x, y + r), (x - r, y), (x, y - r / 3), (x + r / 2, y)]
    bridges = spark.createDataFrame([("h", i, p) for i, p in paths.items()], "huc_id string, osmid string, path array<struct<x:double,y:double>>")
    sources = spark.createDataFrame([(n, "u" + n, r) for n, r in rings.items()], "name string, url string, ring array<struct<x:double,y:double>>")
    got = [(r.osmid, r.source_name) for r in spatial.bridge_source_join(bridges, sources, 10.0, 50.0).collect()]
    assert len(got) == len(set(got)) > 10
    for i, p in paths.items():
        for n, ring in rings.items():
            far = _near_polygon(p, ring)
            if abs(far - 10) > 0.2:
                assert ((i, n) in got) == (far < 10), (i, n, far)


def test_footprints_with_holes_and_parts(spark, tmp_path):
    square = lambda x, y, r: [[x - r, y - r], [x + r, y - r], [x + r, y + r], [x - r, y + r], [x - r, y - r]]
    features = [
        {"url": "hole", "geometry": {"type": "Polygon", "coordinates": [square(0, 0, 1000), square(0, 0, 500)]}},
        {"url": "parts", "geometry": {"type": "MultiPolygon", "coordinates": [[square(-5000, 0, 400), square(-5000, 0, 200)], [square(5000, 0, 400)]]}},
        {"url": "point", "geometry": {"type": "Point", "coordinates": [0, 0]}}, {"url": "none"},
    ]
    (tmp_path / "s.json").write_text(json.dumps({"features": features}))
    sources = A.scan_sources(spark, f"file://{tmp_path}/s.json")
    assert {r.url: len(r.rings) for r in sources.collect()} == {"hole": 2, "parts": 3, "point": 0, "none": 0}
    ends = {"in hole": (0, 0), "near hole": (-515, 0), "ring": (750, 0), "out": (1100, 0), "near": (1005, 0), "left part": (-5300, 0), "left hole": (-5000, 0), "right part": (5000, 0)}
    bridges = spark.createDataFrame([("h", n, float(x), float(y), x + 8.0, float(y)) for n, (x, y) in ends.items()], "huc_id string, osmid string, x0 double, y0 double, x1 double, y1 double")
    got = {(r.osmid, r.source_url) for r in spatial.bridge_source_join(bridges, sources.unionByName(sources)).collect()}
    assert got == {("near hole", "hole"), ("ring", "hole"), ("near", "hole"), ("left part", "parts"), ("right part", "parts")}
    degrees = [{"url": "u", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [180, 0], [180, 45], [0, 0]]]}}]
    (tmp_path / "d.json").write_text(json.dumps({"features": degrees}))
    ring = A.scan_sources(spark, f"file://{tmp_path}/d.json", lon_lat=True).first().rings[0]
    assert math.isclose(ring[1].x, math.pi * 6378137) and math.isclose(ring[2].y, 5621521.486, abs_tol=0.01)


def test_a_footprint_of_many_corners(spark):
    n, radius = 10_000, 4_000.0
    ring = [(radius * math.cos(2 * math.pi * k / n), radius * math.sin(2 * math.pi * k / n)) for k in range(n)]
    sources = spark.createDataFrame([("s", "u", ring)], "name string, url string, ring array<struct<x:double,y:double>>")
    random.seed(8)
    rows = []
    for i in range(400):
        x, y = random.uniform(-4_500, 4_500), random.uniform(-4_500, 4_500)
        rows.append(("h", str(i), x, y, x + 12.0, y + 3.0))
    bridges = spark.createDataFrame(rows, "huc_id string, osmid string, x0 double, y0 double, x1 double, y1 double")
    got = {r.osmid for r in spatial.bridge_source_join(bridges, sources, 10.0, 100.0).collect()}
    for _, i, x0, y0, x1, y1 in rows:
        nearest = min(math.hypot(x0 + (x1 - x0) * k / 50, y0 + (y1 - y0) * k / 50) for k in range(51))
        if abs(nearest - radius - 10) > 0.1:
            assert (i in got) == (nearest <= radius + 10), (i, nearest)


def test_gate_of_a_bridge_without_points_and_bounds(spark):
    rows = [("h", "b", i, float(i % 7), float(i // 7), 5.0 + 0.1 * (i % 7)) for i in range(84)]
    points = spark.createDataFrame(rows, "huc_id string, bridge_id string, point_idx long, x double, y double, z double").withColumn("classification", F.lit(1))
    asked = spark.createDataFrame([("h", "b"), ("h", "none")], "huc_id string, bridge_id string")
    assert {r.bridge_id: r.status for r in P.quality_gate(points, asked).collect()} == {"b": "success", "none": "no_points"}
    random.seed(3)
    boxes = [tuple(random.uniform(0, 100) for _ in range(4)) for _ in range(137)]
    got = R.robust_bounds(spark.createDataFrame(boxes, "minx double, miny double, maxx double, maxy double")).first()
    wanted = [float(np.quantile([b[k] for b in boxes], q)) for k, q in ((0, 0.01), (1, 0.01), (2, 0.99), (3, 0.99))]
    assert np.allclose([got.minx, got.miny, got.maxx, got.maxy], wanted) and math.isclose(got.aspect, (wanted[2] - wanted[0]) / (wanted[3] - wanted[1]))


def test_a_large_region_has_many_files(spark, tmp_path):
    rows = [("big", i) for i in range(900)] + [("small", 1), (None, 2)]
    A.write_by_huc(spark.createDataFrame(rows, "huc_id string, n long"), "huc_id", f"file://{tmp_path}/out", 100)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "out").iterdir() if d.is_dir()}
    assert files["huc_id=big"] >= 4 and files["huc_id=small"] == 1
    assert sorted(r.n for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == sorted(n for _, n in rows)


def test_gate_of_a_narrow_strip_and_of_few_places(spark):
    """A strip whose spread the SQL takes for a line has no hull, though it has corners; equal places count once."""
    random.seed(4)
    strip = [("h", "strip", i, i * 0.1, random.choice([-3.5e-6, 3.5e-6]), 10 + 0.005 * i) for i in range(100)]
    few = [("h", "few", i, float(i % 9), float(i % 3), 10.0) for i in range(90)]
    ten = [("h", "ten", i, float(i % 10), float(i % 3 % 2), 10.0) for i in range(90)]
    cloud = spark.createDataFrame(strip + few + ten, "huc_id string, bridge_id string, point_idx long, x double, y double, z double")
    got = {r.bridge_id: r.status for r in P.quality_gate(cloud).collect()}
    assert got == {"strip": "hull_failed", "few": "ransac_insufficient", "ten": "success"}


def test_packed_rows_give_all_points(spark, monkeypatch):
    random.seed(9)
    rows = [("h", b, i, random.uniform(0, 20), random.uniform(0, 6), random.uniform(9, 10.5)) for b, n in (("large", 700), ("small", 40)) for i in range(n)]
    cloud = spark.createDataFrame(rows, "huc_id string, bridge_id string, point_idx long, x double, y double, z double")
    whole = sorted((r.bridge_id, r.n_points, r.n_inliers, round(r.rmse, 9), round(r.deviation, 9), r.status) for r in P.quality_gate(cloud).collect())
    monkeypatch.setattr(P, "PACKED", 30)
    monkeypatch.setattr(P, "MOST_BROADCAST", 0)
    parts = sorted((r.bridge_id, r.n_points, r.n_inliers, round(r.rmse, 9), round(r.deviation, 9), r.status) for r in P.quality_gate(cloud).collect())
    assert whole == parts and [r[:2] for r in whole] == [("large", 700), ("small", 40)]
    _, packed = P._packed(cloud, 250)
    assert packed.count() == 26 and sorted((r.bridge_id, r.point_idx, r.x, r.z) for r in P._unpacked(packed).collect()) == sorted((b, i, x, z) for _, b, i, x, _, z in rows)
