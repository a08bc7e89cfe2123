"""Deck planes: a robust fit per bridge, residuals, gates and labels.

The fit scores hypotheses in parallel: in each of a few rounds, a bridge's points are
ranked by a hash and every run of ``min_samples`` ranks gives one least-squares plane.
All planes of a bridge are scored against its points in one grouped count; the best is
fitted again on its inliers. Nothing depends on partitioning or arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from decklight.functions.tables import written
from .selection import grouped_median
from .splits import least_of_each
from .voxels import BRIDGE


def _plane(sums: dict[str, Column]) -> list[Column]:
    """(a, b, c) of z = a x + b y + c from sums, x and y centred; null where it is degenerate."""
    n, x, y, z, xx, yy, xy, xz, yz = (sums[k] for k in ("n", "x", "y", "z", "xx", "yy", "xy", "xz", "yz"))
    sxx, syy, sxy, sxz, syz = xx - x * x / n, yy - y * y / n, xy - x * y / n, xz - x * z / n, yz - y * z / n
    det = sxx * syy - sxy * sxy
    good = F.abs(det) >= 1e-9
    a, b = F.when(good, (sxz * syy - syz * sxy) / det), F.when(good, (syz * sxx - sxz * sxy) / det)
    return [a.alias("a"), b.alias("b"), ((z - a * x - b * y) / n).alias("c")]


def _sums() -> list[Column]:
    x, y, z = F.col("cx"), F.col("cy"), F.col("z")
    made = {"n": F.count(F.lit(1)).cast("double"), "x": F.sum(x), "y": F.sum(y), "z": F.sum(z), "xx": F.sum(x * x), "yy": F.sum(y * y), "xy": F.sum(x * y), "xz": F.sum(x * z), "yz": F.sum(y * z)}
    return [c.alias(f"s_{k}") for k, c in made.items()]


def _fit(df: DataFrame, keys: list[str]) -> DataFrame:
    summed = df.groupBy(*keys).agg(*_sums())
    named = {k: F.col(f"s_{k}") for k in ("n", "x", "y", "z", "xx", "yy", "xy", "xz", "yz")}
    return summed.select(*keys, F.col("s_n").alias("n"), *_plane(named))


#: Up to this many bridges their planes, a hundred each, are sent to all tasks; beyond it points and planes meet by a shuffle.
MOST_BROADCAST = 2_000
#: Points of a row of a packed cloud, and bytes of a row group of one.
PACKED = 2_000
GROUP_BYTES = 4_000_000


def _near(centers: DataFrame) -> Callable[[DataFrame], DataFrame]:
    return F.broadcast if centers.count() <= MOST_BROADCAST else (lambda df: df)


def _packed(points: DataFrame, wanted: int) -> tuple[DataFrame, DataFrame]:
    """A row a bridge (center, points, the places its (x, y) hash to), and its points in arrays of ``PACKED``, with their center.

    Tables of bridges then meet rows of many points, which a shuffle moves and sorts as one. ``bound`` is the hash under
    which six deviations more points lie than are ``wanted``; ``number`` is another name of a bridge, quicker to sort by.
    """
    rows = written(points.select(*BRIDGE, "point_idx", "x", "y", "z"))
    place = F.expr("CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN shiftleft(1L, CAST(pmod(xxhash64(x, y), 64) AS INT)) END")
    centers = rows.groupBy(*BRIDGE).agg(F.avg("x").alias("x_center"), F.avg("y").alias("y_center"), F.count(F.lit(1)).alias("n_points"), F.bit_count(F.bit_or(place)).alias("places"))
    rest = F.greatest(1 - wanted / F.col("n_points"), F.lit(0.0))
    share = (wanted + 6 * F.sqrt(wanted * rest) + 16) / F.col("n_points")
    bound = F.when(share >= 1, "g").otherwise(F.lower(F.lpad(F.hex(F.floor(share * 4294967296.0)), 8, "0")))  # "g" is over all hashes
    centers = written(centers.withColumns({"bound": bound, "number": F.monotonically_increasing_id()}))
    large = written(centers.where(F.col("n_points") > PACKED).select(*BRIDGE, F.ceil(F.col("n_points") / PACKED).alias("parts")))  # at most a row for each ``PACKED`` points
    dealt = rows.withColumn("__id", F.monotonically_increasing_id()).join(large, BRIDGE, "left").withColumn("part", F.pmod("__id", F.coalesce("parts", F.lit(1))))
    packed = dealt.groupBy(*BRIDGE, "part").agg(F.collect_list(F.struct("point_idx", "x", "y", "z")).alias("points"))
    cloud = packed.join(_near(centers)(centers), BRIDGE).select(*BRIDGE, "x_center", "y_center", "bound", "number", "points")
    return centers, written(cloud, GROUP_BYTES)


def _unpacked(cloud: DataFrame, *names: str) -> DataFrame:
    """A row a point of a packed cloud, (cx, cy) from the center, with the named columns of its row."""
    each = cloud.select(*BRIDGE, "x_center", "y_center", *names, F.inline("points"))
    return each.select(*BRIDGE, *names, "point_idx", "x", "y", "z", (F.col("x") - F.col("x_center")).alias("cx"), (F.col("y") - F.col("y_center")).alias("cy"))


def _sampled_planes(centred: DataFrame, most: int, min_samples: int, rounds: int, seed: int, bounded: bool) -> DataFrame:
    """(bridge, round, block, n, a, b, c): a plane for every run of ``min_samples`` of the first ``most`` points in each round's hash order.

    Hashes are spread evenly, so if ``bounded`` only rows under a hash that follows from the number of
    points are ranked: a few hundred a bridge and round, whatever its size.
    """
    each = centred.select("*", F.explode(F.array(*map(F.lit, range(rounds)))).alias("round"))
    each = each.withColumn("h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("round").cast("string"), *BRIDGE, F.col("point_idx").cast("string"))))
    each = each.select(*BRIDGE, (F.col("number") * rounds + F.col("round")).alias("group"), "round", "h", "bound", "point_idx", "z", "cx", "cy")
    rows = (each.where(F.col("h") < F.col("bound")) if bounded else each).drop("bound")
    ranked = least_of_each(rows, most, ["group"], [F.col("h"), F.col("point_idx")], "rank", salted=not bounded)
    block = ranked.withColumn("block", F.floor((F.col("rank") - 1) / min_samples).cast("int"))
    return written(_fit(block, ["group", *BRIDGE, "round", "block"]).where(F.col("n") == min_samples).drop("group"))


def plane_consensus(points: DataFrame, min_samples: int = 10, threshold: float = 0.20, trials: int = 100, seed: int = 27, rounds: int = 4) -> DataFrame:
    """(bridge, x_center, y_center, a, b, c, n_inliers, n_points): z = a (x - x_center) + b (y - y_center) + c."""
    centers, cloud = _packed(points, _most(min_samples, trials, rounds))
    return _consensus(centers, cloud, min_samples, threshold, trials, seed, rounds)


def _most(min_samples: int, trials: int, rounds: int) -> int:
    return max(1, trials // rounds) * min_samples


def _consensus(centers: DataFrame, cloud: DataFrame, min_samples: int = 10, threshold: float = 0.20, trials: int = 100, seed: int = 27, rounds: int = 4) -> DataFrame:
    most, near = _most(min_samples, trials, rounds), _near(centers)
    tried = _sampled_planes(_unpacked(cloud, "bound", "number"), most, min_samples, rounds, seed, True)
    # a bridge whose hashes are not spread, as one of repeated keys, may have too few under its bound: it is ranked whole
    wanted = rounds * F.floor(F.least(F.col("n_points"), F.lit(most)) / min_samples)
    found = tried.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("found"))
    short = written(centers.join(found, BRIDGE, "left").where(F.coalesce("found", F.lit(0)) < wanted).select(*BRIDGE))
    if not short.isEmpty():
        again = _sampled_planes(_unpacked(cloud.join(short, BRIDGE, "left_semi"), "bound", "number"), most, min_samples, rounds, seed, False)
        tried = tried.join(short, BRIDGE, "left_anti").unionByName(again)
    # at most ``trials`` planes a bridge, in a stated order
    planes = tried.where("a IS NOT NULL").groupBy(*BRIDGE).agg(F.array_sort(F.collect_list(F.struct("round", "block", "a", "b", "c"))).alias("planes"))
    residual = lambda p: F.abs(F.col("z") - p["a"] * F.col("cx") - p["b"] * F.col("cy") - p["c"])
    # a vote is a row that the same stage counts at once: a loop over the planes in generated code, which so many aggregates are not
    each = _unpacked(cloud.join(near(planes), BRIDGE), "planes")
    voted = each.select(*BRIDGE, "z", "cx", "cy", F.posexplode("planes").alias("at", "p")).where(residual(F.col("p")) <= threshold)
    votes = voted.groupBy(*BRIDGE, "at").agg(F.count(F.lit(1)).alias("n")).groupBy(*BRIDGE).agg(F.max_by("at", F.struct("n", -F.col("at"))).alias("at"))
    best = written(votes.join(planes, BRIDGE).select(*BRIDGE, F.get("planes", F.col("at")).alias("p")))
    inliers = _unpacked(cloud.join(near(best), BRIDGE), "p").where(residual(F.col("p")) <= threshold)
    refit = written(_fit(inliers, BRIDGE).select(*BRIDGE, "a", "b", "c").where("a IS NOT NULL"))
    counted = _unpacked(cloud.join(near(refit), BRIDGE), "a", "b", "c").groupBy(*BRIDGE, "a", "b", "c").agg(
        F.count_if(F.abs(F.col("z") - F.col("a") * F.col("cx") - F.col("b") * F.col("cy") - F.col("c")) <= threshold).alias("n_inliers")
    )
    return centers.join(counted, BRIDGE).select(*BRIDGE, "x_center", "y_center", "a", "b", "c", "n_inliers", "n_points")


def plane_residuals(points: DataFrame, planes: DataFrame, threshold: float = 0.20) -> DataFrame:
    """``residual`` of each point above its bridge's plane, and whether it is an inlier."""
    d = F.col("z") - F.col("a") * (F.col("x") - F.col("x_center")) - F.col("b") * (F.col("y") - F.col("y_center")) - F.col("c")
    kept = planes.select(*BRIDGE, "x_center", "y_center", "a", "b", "c")
    return points.join(kept, BRIDGE).select(*points.columns, d.alias("residual"), (F.abs(d) <= threshold).alias("inlier"))


def inlier_rmse(residuals: DataFrame, most: float = 0.30) -> DataFrame:
    rmse = F.sqrt(F.avg(F.when(F.col("inlier"), F.col("residual") * F.col("residual"))))
    return residuals.groupBy(*BRIDGE).agg(F.count_if("inlier").alias("n_inliers"), rmse.alias("rmse")).withColumn("rejected", F.coalesce(F.col("rmse") > most, F.lit(False)))


def _shape() -> list[Column]:
    """Columns over a bridge's points: their mean, variances and covariance."""
    return [F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("vxy")]


def _axis() -> Column:
    """The place of a point of known shape along the first principal axis, from the mean."""
    angle = 0.5 * F.atan2(2 * F.col("vxy"), F.col("vx") - F.col("vy"))
    return (F.col("x") - F.col("mx")) * F.cos(angle) + (F.col("y") - F.col("my")) * F.sin(angle)


def principal_axis(points: DataFrame) -> DataFrame:
    """``axis``: the place of each point along its bridge's first principal axis, from the mean (its sign is free)."""
    return points.join(points.groupBy(*BRIDGE).agg(*_shape()), BRIDGE).select(*points.columns, _axis().alias("axis"))


def linearity_check(points: DataFrame, threshold: float = 0.35, bins: int = 10) -> DataFrame:
    """The largest deviation of the bins' median heights from a line along the axis, and whether it is over the threshold.

    Bins are half-open, so the farthest point is in none. 50 points, 5 metres, and 3 bins of 5 points are needed;
    else the deviation is 0.
    """
    shape = written(points.groupBy(*BRIDGE).agg(*_shape()))
    return _straightness(lambda spans: points.join(shape if spans is None else shape.join(spans, BRIDGE), BRIDGE), threshold, bins)


def _straightness(placed: Callable[[DataFrame | None], DataFrame], threshold: float, bins: int) -> DataFrame:
    """The linearity check of points that ``placed`` gives with their bridge's written shape, and with the columns of a table of bridges.

    Shapes and spans are written, for the ends and the bins must come from the same axis: sums made twice may differ.
    """
    axis = F.col("axis")
    span = written(placed(None).withColumn("axis", _axis()).groupBy(*BRIDGE).agg(F.min(axis).alias("lo"), F.max(axis).alias("hi"), F.count(F.lit(1)).alias("n_all")))
    width = (F.col("hi") - F.col("lo")) / bins
    long = span.where((F.col("n_all") >= 50) & (F.col("hi") - F.col("lo") >= 5.0))
    binned = placed(long).withColumn("axis", _axis()).where(axis < F.col("hi"))
    bin_ = F.least(F.floor((axis - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    binned = written(binned.select(*BRIDGE, bin_.alias("bin"), "z"))
    middle = grouped_median(binned, [*BRIDGE, "bin"], "z").withColumnRenamed("median", "mz")
    medians = middle.join(span, BRIDGE).select(*BRIDGE, "bin", "mz", "n", (F.col("lo") + (F.col("bin") + 0.5) * width).alias("at"))
    good = medians.where("n >= 5")
    line = good.groupBy(*BRIDGE).agg(F.regr_slope("mz", "at").alias("k"), F.regr_intercept("mz", "at").alias("m"), F.count(F.lit(1)).alias("n_bins"))
    off = good.join(line.where("n_bins >= 3"), BRIDGE).groupBy(*BRIDGE).agg(F.max(F.abs(F.col("mz") - F.col("k") * F.col("at") - F.col("m"))).alias("d"))
    deviation = F.coalesce("d", F.lit(0.0))
    return span.select(*BRIDGE).join(off, BRIDGE, "left").select(*BRIDGE, deviation.alias("deviation"), (deviation > threshold).alias("curved"))


def band_labels(residuals: DataFrame, inside: Column, below: float = -0.70, above: float = 0.20, high: float = 15.0) -> DataFrame:
    """17 on the deck, 18 above it, else the code that was there; ``inside`` says which points are over the deck."""
    d = F.col("residual")
    label = F.when(inside & (d > above) & (d < high), 18).when(inside & (d >= below) & (d <= above), 17).otherwise(F.col("classification"))
    return residuals.withColumn("label", label.cast("int"))


def quality_gate(points: DataFrame, bridges: DataFrame | None = None, max_rmse: float = 0.30, threshold: float = 0.35, min_points: int = 20, min_samples: int = 10) -> DataFrame:
    """The first failing reason of each bridge, or success; of ``bridges`` (huc_id, bridge_id) too, which may have no points."""
    centers, cloud = _packed(points, _most(min_samples, 100, 4))
    near = _near(centers)
    # as many places as are hashed to, or more, are there; only where these are too few are they counted
    counts = centers.select(*BRIDGE, "n_points", F.coalesce("places", F.lit(0)).cast("long").alias("n_xy"))
    few = written(counts.where((F.col("n_points") >= min_points) & (F.col("n_xy") < min_samples)).select(*BRIDGE))
    if not few.isEmpty():
        exact = _unpacked(cloud.join(few, BRIDGE, "left_semi")).groupBy(*BRIDGE).agg(F.countDistinct("x", "y").alias("exact"))
        counts = counts.join(exact, BRIDGE, "left").withColumn("n_xy", F.coalesce("exact", "n_xy")).drop("exact")
    if bridges is not None:
        counts = bridges.select(*BRIDGE).distinct().join(counts, BRIDGE, "left").fillna(0, ["n_points", "n_xy"])
    planes = written(_consensus(centers, cloud, min_samples).select(*BRIDGE, "a", "b", "c"))  # one row a bridge
    d = F.col("z") - F.col("a") * F.col("cx") - F.col("b") * F.col("cy") - F.col("c")

    def inliers(table: DataFrame, *names: str) -> DataFrame:
        each = _unpacked(cloud.join(near(table), BRIDGE), "a", "b", "c", *names)
        return each.withColumn("residual", d).where(F.abs("residual") <= 0.20)

    shape = written(inliers(planes).groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_inliers"), F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"), *_shape()))
    fitted = written(planes.join(shape, BRIDGE))
    means = ["mx", "my", "vx", "vy", "vxy"]
    straight = _straightness(lambda spans: inliers(fitted, *means) if spans is None else inliers(fitted.join(spans, BRIDGE), *means, "lo", "hi"), threshold, 10)
    spread = F.coalesce(F.col("vx") * F.col("vy") - F.col("vxy") * F.col("vxy") > 1e-9, F.lit(False))  # not all on a line, so that they have a hull
    reason = (
        F.when(F.col("n_points") == 0, "no_points")
        .when((F.col("n_points") < min_points) | (F.col("n_xy") < min_samples), "ransac_insufficient")
        .when(F.col("n_inliers").isNull(), "ransac_failed")
        .when(F.col("n_inliers") < min_points, "ransac_low_inliers")
        .when(~spread, "hull_failed")
        .when(F.col("rmse") > max_rmse, "high_rmse")
        .when(F.coalesce("curved", F.lit(False)), "curved")
        .otherwise("success")
    )
    joined = counts.join(shape, BRIDGE, "left").join(straight, BRIDGE, "left")
    return joined.select(*BRIDGE, "n_points", "n_inliers", "rmse", "deviation", reason.alias("status"))
