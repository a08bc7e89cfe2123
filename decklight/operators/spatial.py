"""Spatial joins over tiles: candidates by an equi-join on tile keys, then the exact test.

A path or a ring is an array of structs (x, y); a ring closes itself. ``rings`` are an array
of rings: a point is inside if it is inside an odd number of them, so holes and parts of a
footprint are rings like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The side of the smallest tiles; each level of boxes doubles it.
TILE = 1000.0


def path(*ends: tuple[Column, Column]) -> Column:
    return F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ends))


def segments(points: Column, closed: bool) -> Column:
    """The segments (a, b) between points that follow each other; a single point is one from itself to itself."""
    n = F.size(points)
    last = n if closed else F.greatest(n - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.struct(F.get(points, i).alias("a"), F.get(points, (i + 1) % n).alias("b")))


def bounds(points: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def point_segment_distance(px, py, x0, y0, x1, y1) -> Column:
    dx, dy = x1 - x0, y1 - y0
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x0) * dx + (py - y0) * dy) / length))).otherwise(0.0)
    ex, ey = px - (x0 + t * dx), py - (y0 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def _side(a: Column, b: Column, p: Column) -> Column:
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def _distance(p: Column, s: Column) -> Column:
    return point_segment_distance(p["x"], p["y"], s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])


def segments_within(s: Column, t: Column, radius: float) -> Column:
    """Whether two segments cross or come as near as ``radius``."""
    cross = (_side(s["a"], s["b"], t["a"]) * _side(s["a"], s["b"], t["b"]) < 0) & (_side(t["a"], t["b"], s["a"]) * _side(t["a"], t["b"], s["b"]) < 0)
    return cross | (F.least(_distance(s["a"], t), _distance(s["b"], t), _distance(t["a"], s), _distance(t["b"], s)) <= radius)


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point to greater x crosses an edge."""
    a, b = e["a"], e["b"]
    return ((a["y"] > y) != (b["y"] > y)) & (x < F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"])


def inside_ring(x: Column, y: Column, edges: Column) -> Column:
    """Whether a ray from the point crosses the ring an odd number of times."""
    return F.size(F.filter(edges, lambda e: _crosses(e, x, y))) % 2 == 1


def _tiles(df: DataFrame, box: tuple[Column, Column, Column, Column], side: Column) -> DataFrame:
    """Each row once for every tile that its box touches."""
    x0, y0, x1, y1 = (F.floor(c / side) for c in box)
    return df.withColumn("__tx", F.explode(F.sequence(x0, x1))).withColumn("__ty", F.explode(F.sequence(y0, y1)))


def _footprints(sources: DataFrame) -> DataFrame:
    """(sid, source_name, source_url, rings) of different footprints; a ring or a box is one ring."""
    if "rings" in sources.columns:
        rings = F.col("rings")
    elif "ring" in sources.columns:
        rings = F.array("ring")
    else:
        xmin, ymin, xmax, ymax = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
        rings = F.array(path((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)))
    named = sources.select(F.col("name").alias("source_name"), F.col("url").alias("source_url"), F.filter(rings, lambda ring: F.size(ring) > 0).alias("rings"))
    return named.where(F.size("rings") > 0).withColumn("sid", F.xxhash64("source_name", "source_url", "rings")).dropDuplicates(["sid"])


def _edges(footprints: DataFrame) -> DataFrame:
    """(sid, e): one row an edge, of all rings."""
    edges = F.flatten(F.transform("rings", lambda ring: segments(ring, True)))
    return footprints.select("sid", F.explode(edges).alias("e"))


def _pieces(s: Column, tile: float) -> Column:
    """A segment cut into pieces no longer than a tile in x or y, so that each touches four tiles at most."""
    dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
    n = F.greatest(F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / tile), F.lit(1))
    at = lambda k: F.struct((s["a"]["x"] + dx * k / n).alias("x"), (s["a"]["y"] + dy * k / n).alias("y"))
    return F.transform(F.sequence(F.lit(1).cast("long"), n), lambda k: F.struct(at(k - 1).alias("a"), at(k).alias("b")))


def _piece_tiles(df: DataFrame, segment: str, pad: float, tile: float) -> DataFrame:
    """Each row for every tile near a piece of its segment, more than once where two pieces are near it."""
    cut = df.withColumn("__p", F.explode(_pieces(F.col(segment), tile)))
    low = lambda c: F.least(f"__p.a.{c}", f"__p.b.{c}") - pad
    high = lambda c: F.greatest(f"__p.a.{c}", f"__p.b.{c}") + pad
    return _tiles(cut, (low("x"), low("y"), high("x"), high("y")), F.lit(tile)).drop("__p")


def _near_pairs(lines: DataFrame, edges: DataFrame, buffer: float, tile: float) -> DataFrame:
    """(bid, sid), perhaps repeated, where a segment of the path comes as near as ``buffer`` to an edge: a join of segments with edges by tile."""
    parts = lines.select("bid", F.explode(segments(F.col("line"), False)).alias("s"))
    # both are padded by more than half of the buffer, so that rounding of the pieces loses no pair
    pad = 0.51 * buffer + 1e-6 * tile
    met = _piece_tiles(parts, "s", pad, tile).join(_piece_tiles(edges, "e", pad, tile), ["__tx", "__ty"])
    s, e = F.col("s"), F.col("e")
    apart = lambda c: (F.least(s["a"][c], s["b"][c]) - buffer > F.greatest(e["a"][c], e["b"][c])) | (F.least(e["a"][c], e["b"][c]) - buffer > F.greatest(s["a"][c], s["b"][c]))
    return met.where(~apart("x") & ~apart("y")).where(segments_within(s, e, buffer)).select("bid", "sid")


def _inside_pairs(lines: DataFrame, footprints: DataFrame, edges: DataFrame, tile: float) -> DataFrame:
    """(bid, sid) where the path begins inside a footprint: crossings of a ray, counted over the edges of its band of y.

    The boxes of footprints lie in the tiles of the level that fits their size, a few rows each,
    and a path's first point looks into each level that is there.
    """
    boxes = footprints.select("sid", *(c.alias(n) for c, n in zip(bounds(F.flatten("rings")), ("x0", "y0", "x1", "y1"))))
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(tile))
    boxes = boxes.withColumn("__level", F.ceil(F.log2(extent / tile)).cast("int"))
    levels = boxes.select("__level").distinct()  # as many as doublings between the least and the largest footprint
    side = tile * F.pow(F.lit(2.0), F.col("__level"))
    first = lines.select("bid", F.get("line", 0)["x"].alias("px"), F.get("line", 0)["y"].alias("py")).crossJoin(F.broadcast(levels))
    first = first.withColumns({"__tx": F.floor(F.col("px") / side), "__ty": F.floor(F.col("py") / side)})
    held = first.join(_tiles(boxes, tuple(F.col(c) for c in ("x0", "y0", "x1", "y1")), side), ["__level", "__tx", "__ty"])
    held = held.where("px >= x0 AND px <= x1 AND py >= y0 AND py <= y1").select("bid", "sid", "px", "py", F.floor(F.col("py") / tile).alias("band"))
    a, b = F.col("e")["a"], F.col("e")["b"]
    bands = F.sequence(F.floor(F.least(a["y"], b["y"]) / tile), F.floor(F.greatest(a["y"], b["y"]) / tile))
    banded = edges.where(a["y"] != b["y"]).select("sid", "e", F.explode(bands).alias("band"))
    crossed = held.join(banded, ["sid", "band"]).where(_crosses(F.col("e"), F.col("px"), F.col("py")))
    return crossed.groupBy("bid", "sid").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("bid", "sid")


def bridge_source_join(bridges: DataFrame, sources: DataFrame, buffer: float = 10.0, tile: float = TILE) -> DataFrame:
    """(huc_id, osmid, source_name, source_url) of footprints that a bridge, buffered, meets, once each.

    ``bridges`` have a ``path`` or the ends x0, y0, x1, y1; ``sources`` have ``rings``, a ``ring`` or a
    box. A bridge meets a footprint if a segment comes near an edge, or else if it begins inside: with
    no edge near, all of it is on one side. Both parts are joins of single segments and edges, so a
    footprint of many corners is as many rows, and no task walks around a whole ring.
    """
    line = F.col("path") if "path" in bridges.columns else path((F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")))
    named = bridges.select("huc_id", "osmid", line.alias("line")).where(F.size("line") > 0).withColumn("bid", F.xxhash64("huc_id", "osmid", "line"))
    parts = int(bridges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = named.select("bid", "line").repartition(parts, "bid").dropDuplicates(["bid"])  # spread, for an inventory is often one small file
    footprints = _footprints(sources)
    edges = _edges(footprints)
    pairs = _near_pairs(lines, edges, buffer, tile).unionByName(_inside_pairs(lines, footprints, edges, tile))
    found = pairs.join(named.select("bid", "huc_id", "osmid"), "bid").join(footprints.select("sid", "source_name", "source_url"), "sid")
    return found.select("huc_id", "osmid", "source_name", "source_url").distinct()


def clip_points_to_bridge(points: DataFrame, outlines: DataFrame, buffer: float) -> DataFrame:
    """The points in their bridge's outline or within ``buffer`` of it.

    ``outlines`` have one row a (huc_id, bridge_id), with a ``ring``, a ``path`` or the ends x0, y0, x1, y1.
    """
    at = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    closed = "ring" in outlines.columns
    line = F.col("ring") if closed else F.col("path") if "path" in outlines.columns else path((F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")))
    edges = outlines.select("huc_id", "bridge_id", segments(line, closed).alias("__edges"))
    joined = points.withColumn("__at", at).join(edges, ["huc_id", "bridge_id"])
    near = F.exists("__edges", lambda e: _distance(F.col("__at"), e) <= buffer)
    inside = inside_ring(F.col("x"), F.col("y"), F.col("__edges")) | near if closed else near
    return joined.where(inside).select(*points.columns)


def generate_tasks(bridges: DataFrame, sources: DataFrame, huc_ids: list[str] | None = None, osm_ids: list[str] | None = None, buffer: float = 10.0) -> DataFrame:
    """One task a (bridge, source); id filters go before the join."""
    from .runs import filter_by_ids

    kept = filter_by_ids(filter_by_ids(bridges, "huc_id", huc_ids), "osmid", osm_ids)
    return bridge_source_join(kept, sources, buffer)


def source_pair_stats(bridges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per lidar flag: bridges with and without a source, and pairs."""
    n = pairs.groupBy("huc_id", "osmid").agg(F.count(F.lit(1)).alias("n"))
    joined = bridges.join(n, ["huc_id", "osmid"], "left")
    return joined.groupBy("has_lidar_tif").agg(
        F.count("n").alias("with_source"), F.count_if(F.col("n").isNull()).alias("without_source"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs")
    )
