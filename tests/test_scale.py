"""Steps that split large groups, against plain ones."""

import math
import os
import random
import statistics
from collections import defaultdict

from pyspark.sql import Window, functions as F

from decklight.functions.columns import hash_order
from decklight.operators import ground, planes as P, selection, splits as E


def order():
    return [hash_order(3, "g", "k"), F.col("k")]


def groups(spark):
    rows = [("hot", i) for i in range(900)] + [("cold", i) for i in range(40)] + [(None, i) for i in range(30)] + [("one", 1)] + [("hot", 7)] * 5
    return spark.createDataFrame(rows, "g string, k int").repartition(5)


def test_numbers_in_groups(spark):
    df = groups(spark)
    got = [(r.g, r.k, r.place, r.size) for r in E.numbered(df, order(), "place", ["g"], "size").collect()]
    plain = df.select("*", F.row_number().over(Window.partitionBy("g").orderBy(*order())).alias("place"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("size"))
    assert sorted(got, key=str) == sorted(((r.g, r.k, r.place, r.size) for r in plain.collect()), key=str)


def test_first_of_groups(spark, monkeypatch):
    df = groups(spark)
    for most in (1, 7, 35, 2_000):
        for limit in (1_000, 5):
            monkeypatch.setattr(E, "MOST_RANKED", limit)
            got = sorted(((r.g, r.k, r.place) for r in E.least_of_each(df, most, ["g"], order(), "place").collect()), key=str)
            ranked = df.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy(*order()))).where(F.col("place") <= most)
            assert got == sorted(((r.g, r.k, r.place) for r in ranked.collect()), key=str)


def test_medians_of_large_groups(spark, monkeypatch):
    random.seed(5)
    values = {
        "even": [random.gauss(0, 1) for _ in range(400)], "odd": [random.uniform(-5, 5) for _ in range(301)], "ties": [float(random.randint(0, 2)) for _ in range(500)], "same": [4.0] * 90,
        "far": [random.random() for _ in range(200)] + [1e300, -1e300], "tiny": [1.0 + k * 2.0**-52 for k in range(120)], "small": [3.0, 1.0], "one": [2.5],
    }
    rows = [(g, v) for g, own in values.items() for v in own] + [("one", None)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    for small, ranges in ((10_000, 1_024), (50, 8), (50, 1_024)):
        monkeypatch.setattr(selection, "RANGES", ranges)
        got = {r.g: (r.n, r.median) for r in selection.grouped_median(df, ["g"], "v", small).collect()}
        assert got == {g: (len(own), statistics.median(own)) for g, own in values.items()}, (small, ranges)


def test_ground_in_blocks(spark):
    random.seed(6)
    rows = []
    for i in range(2_500):
        x, y = random.uniform(-20, 60), random.uniform(-15, 40)
        if (x - 10) ** 2 + (y - 5) ** 2 < 60:
            continue  # a gap
        z = 0.03 * x + random.random() * 0.1 + (4 if 20 < x < 26 and 3 < y < 22 else 0) + (2 if random.random() < 0.1 else 0)
        rows.append(("h", "b", i, x, y, z, 7 if i % 50 == 0 else 1))
    rows += [("h", "far", 0, 0.0, 0.0, 1.0, 1), ("h", "far", 1, 9_000_000.0, 4_000_000.0, 2.0, 1)]
    cloud = spark.createDataFrame(rows, "huc_id string, bridge_id string, point_idx long, x double, y double, z double, classification int")
    labels = []
    for block in (1_000, 16, 5):
        done = ground.ground_filter(cloud, window=4, block=block)
        labels.append({(r.bridge_id, r.point_idx): r.ground for r in done.collect()})
        assert len(labels[-1]) == len(rows)
    assert labels[0] == labels[1] == labels[2] and {1, 2, 7} == set(labels[0].values())
    # an opening lowers the raised part, which is wider than no window
    assert labels[0]["far", 0] == labels[0]["far", 1] == 2


def test_one_bridge_with_most_points(spark):
    random.seed(2)
    rows = []
    for bridge, n in (("hot", 3_000), ("a", 150), ("b", 150)):
        for i in range(n):
            x, y = random.uniform(0, 20), random.uniform(0, 6)
            rows.append(("h", bridge, i, x, y, 0.1 * x - 0.05 * y + (random.choice([2.0, -3.0]) if i % 5 == 0 else random.gauss(0, 0.03))))
    cloud = spark.createDataFrame(rows, "huc_id string, bridge_id string, point_idx long, x double, y double, z double")
    got = {r.bridge_id: r for r in P.plane_consensus(cloud).collect()}
    counts = defaultdict(int)
    for r in rows:
        counts[r[1]] += 1
    for bridge, r in got.items():
        assert r.n_points == counts[bridge] and abs(r.a - 0.1) < 0.01 and abs(r.b + 0.05) < 0.02 and r.n_inliers >= 0.79 * r.n_points


def test_ends_of_an_axis_whatever_the_order(spark):
    """Rows come in another order at each reading: the farthest point is in no bin, the nearest in the first."""
    random.seed(8)
    rows, wanted = [], {}
    for i in range(200):
        own = [(k + random.uniform(0.05, 0.95), random.uniform(0, 1.5), random.uniform(9, 11)) for k in range(10) for _ in range(6)]
        rows += [("h", str(i), *p) for p in own]
        n = len(own)
        mx, my = (math.fsum(p[j] for p in own) / n for j in (0, 1))
        vx, vy = (math.fsum((p[j] - m) ** 2 for p in own) / n for j, m in ((0, mx), (1, my)))
        t = 0.5 * math.atan2(2 * math.fsum((p[0] - mx) * (p[1] - my) for p in own) / n, vx - vy)
        placed = sorted(((p[0] - mx) * math.cos(t) + (p[1] - my) * math.sin(t), p[2]) for p in own)
        lo, width = placed[0][0], (placed[-1][0] - placed[0][0]) / 10
        bins = defaultdict(list)
        for a, z in placed[:-1]:
            bins[min(int((a - lo) / width), 9)].append(z)
        line = [(lo + (b + 0.5) * width, statistics.median(zs)) for b, zs in bins.items() if len(zs) >= 5]
        k, m = statistics.linear_regression(*zip(*line))
        wanted[str(i)] = max(abs(z - k * at - m) for at, z in line)
    schema = "huc_id string, bridge_id string, x double, y double, z double"
    cloud = spark.createDataFrame(rows, schema).repartition(4).mapInPandas(lambda parts: (p.sample(frac=1, random_state=int.from_bytes(os.urandom(4))) for p in parts), schema)
    got = {r.bridge_id: r.deviation for r in P.linearity_check(cloud).collect()}
    assert got.keys() == wanted.keys()
    assert not [i for i in wanted if abs(got[i] - wanted[i]) > 1e-9]
