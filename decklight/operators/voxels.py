"""Voxel grids, per-cloud normalisation and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from decklight.functions.columns import asprs_to_model, hash_order

BRIDGE = ["huc_id", "bridge_id"]
CLASSES = (0, 1, 2, 3)


def voxel_keys(size: float) -> list[Column]:
    return [F.floor(F.col(c) / F.lit(size)).cast("int").alias(f"v{c}") for c in "xyz"]


def voxelize(points: DataFrame, size: float = 0.1) -> DataFrame:
    """One row a voxel: its mean intensity and its number of points."""
    keyed = points.select(*BRIDGE, *voxel_keys(size), "intensity")
    return keyed.groupBy(*BRIDGE, "vx", "vy", "vz").agg(F.avg("intensity").alias("intensity"), F.count(F.lit(1)).alias("n_points"))


def voxel_majority_label(points: DataFrame, size: float = 0.1, label: str = "gold") -> DataFrame:
    """The most frequent label of each voxel, the smallest of equal ones."""
    counts = points.select(*BRIDGE, *voxel_keys(size), F.col(label).alias("label")).groupBy(*BRIDGE, "vx", "vy", "vz", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("label", F.struct(F.col("n"), -F.col("label")))
    return counts.groupBy(*BRIDGE, "vx", "vy", "vz").agg(best.alias("label"), F.sum("n").alias("n_points"))


def voxel_to_points(points: DataFrame, voxels: DataFrame, size: float, label: str = "label") -> DataFrame:
    """Every point with the label of its voxel; points of a voxel without one are left out."""
    keyed = points.select("*", *voxel_keys(size))
    return keyed.join(voxels.select(*BRIDGE, "vx", "vy", "vz", F.col(label).alias("voxel_label")), [*BRIDGE, "vx", "vy", "vz"])


def voxel_compression(points: DataFrame, size: float) -> DataFrame:
    """Points, voxels and their ratio for each bridge, and the share of each class before and after."""
    before = points.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_points"), *(F.avg((F.col("gold") == c).cast("double")).alias(f"points_share_{c}") for c in CLASSES))
    after = voxel_majority_label(points, size).groupBy(*BRIDGE).agg(
        F.count(F.lit(1)).alias("n_voxels"), *(F.avg((F.col("label") == c).cast("double")).alias(f"voxels_share_{c}") for c in CLASSES)
    )
    return before.join(after, BRIDGE).withColumn("ratio", F.col("n_points") / F.col("n_voxels"))


def thin_by_resolution(points: DataFrame, resolution: float = 0.1, seed: int = 27) -> DataFrame:
    """One point of each resolution cell, the first in hash order."""
    kept = [c for c in points.columns if c not in BRIDGE]
    row = F.struct(*kept)
    order = F.struct(hash_order(seed, *BRIDGE, "point_idx"), F.col("point_idx"))
    return (
        points.select("*", *voxel_keys(resolution))
        .groupBy(*BRIDGE, "vx", "vy", "vz")
        .agg(F.min_by(row, order).alias("r"))
        .select(*BRIDGE, "r.*")
    )


def shift_to_min(points: DataFrame) -> DataFrame:
    """Coordinates from each cloud's least x, y and z."""
    low = points.groupBy(*BRIDGE).agg(*(F.min(c).alias(f"{c}_min") for c in "xyz"))
    return points.join(low, BRIDGE).select(*BRIDGE, "point_idx", *((F.col(c) - F.col(f"{c}_min")).alias(c) for c in "xyz"))


def cloud_offsets(points: DataFrame) -> DataFrame:
    return points.groupBy(*BRIDGE).agg(
        F.avg("x").alias("x_center"), F.avg("y").alias("y_center"), F.min("z").alias("z_min"), F.max("intensity").alias("intensity_max")
    )


def normalize_cloud(points: DataFrame) -> DataFrame:
    """x and y from their mean, z from its minimum, intensity over its maximum if that is positive, model labels."""
    joined = points.join(cloud_offsets(points), BRIDGE)
    intensity = F.when(F.col("intensity_max") > 0, F.col("intensity") / F.col("intensity_max")).otherwise(F.col("intensity"))
    return joined.select(
        *BRIDGE, "point_idx", (F.col("x") - F.col("x_center")).alias("x"), (F.col("y") - F.col("y_center")).alias("y"),
        (F.col("z") - F.col("z_min")).alias("z"), intensity.alias("intensity"), asprs_to_model("classification").alias("label"),
    )


def restore_absolute(points: DataFrame, offsets: DataFrame) -> DataFrame:
    joined = points.join(offsets, BRIDGE)
    return joined.select(
        *BRIDGE, "point_idx", (F.col("x") + F.col("x_center")).alias("x"), (F.col("y") + F.col("y_center")).alias("y"), (F.col("z") + F.col("z_min")).alias("z")
    )


def cloud_metadata(points: DataFrame, label: str = "gold") -> DataFrame:
    """Offsets, number of points and points of each class; all four classes are there."""
    counts = [F.count_if(F.col(label) == c).alias(f"class_{c}") for c in CLASSES]
    made = points.groupBy(*BRIDGE).agg(
        F.avg("x").alias("x_center"), F.avg("y").alias("y_center"), F.min("z").alias("z_min"), F.count(F.lit(1)).alias("n_points"), *counts
    )
    pairs = [x for c in CLASSES for x in (F.lit(str(c)), F.col(f"class_{c}"))]
    return made.withColumn("class_distribution", F.create_map(*pairs))


def class_totals(metadata: DataFrame) -> DataFrame:
    """(class, total) over all clouds' ``class_distribution`` maps; clouds without one add nothing."""
    pairs = metadata.select(F.explode("class_distribution").alias("class", "n"))
    return pairs.groupBy(F.col("class").cast("int").alias("class")).agg(F.sum("n").alias("total"))


def class_weights(totals: DataFrame) -> DataFrame:
    """total / (classes * count) for class 0 to the largest; 0 where the class is absent or empty."""
    all_ = totals.agg(F.sum("total").alias("everything"), F.count(F.lit(1)).alias("n_classes"), F.max("class").alias("last"))
    grid = all_.select("everything", "n_classes", F.explode(F.sequence(F.lit(0), "last")).alias("class"))
    joined = grid.join(totals, "class", "left")
    weight = F.when(F.col("total") > 0, F.col("everything") / (F.col("n_classes") * F.col("total"))).otherwise(0.0)
    return joined.select("class", F.coalesce("total", F.lit(0)).cast("long").alias("total"), weight.alias("weight"))


def class_distribution(totals: DataFrame) -> DataFrame:
    share = 100.0 * F.col("total") / F.sum("total").over(Window.partitionBy())
    return totals.select("class", "total", share.alias("percent"))


def imbalance_ratio(totals: DataFrame, ground: int = 1, deck: int = 2, warn_over: float = 100.0) -> DataFrame:
    of = lambda c: F.sum(F.when(F.col("class") == c, F.col("total")).otherwise(0))
    ratio = F.try_divide(of(ground), of(deck))
    return totals.agg(of(ground).alias("ground"), of(deck).alias("deck"), ratio.alias("ratio"), F.coalesce(ratio > warn_over, F.lit(False)).alias("warn"))


def min_points_gate(points: DataFrame, least: int = 100) -> DataFrame:
    counts = points.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_points"))
    return counts.withColumn("status", F.when(F.col("n_points") < least, "skipped").otherwise("ok"))


def augment_points(points: DataFrame, seed: int = 27, jitter: float = 0.01, extra: bool = False) -> DataFrame:
    """Each cloud turned about z by a hashed angle, each point moved by hashed normal noise, then shifted to its minimum.

    With ``extra`` a cloud may also be flipped in x and in y, is scaled by 0.9 to 1.1 and loses 5 to 10 % of
    its points, unless 10 or fewer would stay; ``intensity`` gets noise of 0.02 within 0 and 1. Other
    columns of the points are kept then.
    """

    def uniform(name: str, *keys: str) -> Column:
        digits = F.substring(hash_order(seed, F.lit(name), *keys), 1, 8)
        return (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0

    def normal(name: str) -> Column:
        return F.sqrt(-2 * F.ln(uniform(name + "a", *BRIDGE, "point_idx"))) * F.cos(2 * F.pi() * uniform(name + "b", *BRIDGE, "point_idx"))

    angle = 2 * F.pi() * uniform("angle", *BRIDGE)
    moved = {
        "x": F.col("x") * F.cos(angle) - F.col("y") * F.sin(angle) + jitter * normal("x"), "y": F.col("x") * F.sin(angle) + F.col("y") * F.cos(angle) + jitter * normal("y"),
        "z": F.col("z") + jitter * normal("z"),
    }
    if not extra:
        return shift_to_min(points.select(*BRIDGE, "point_idx", *(c.alias(k) for k, c in moved.items())))
    flip = lambda k: F.when(uniform("flip" + k, *BRIDGE) > 0.5, -1.0).otherwise(1.0) if k != "z" else F.lit(1.0)
    scale = 0.9 + 0.2 * uniform("scale", *BRIDGE)
    kept = uniform("drop", *BRIDGE, "point_idx") > 0.05 + 0.05 * uniform("rate", *BRIDGE)
    noisy = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("intensity") + 0.02 * normal("intensity")))
    changed = {k: c * flip(k) * scale for k, c in moved.items()} | {"intensity": noisy}
    rows = points.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in points.columns), kept.alias("__kept"))
    low = [F.min(F.when(F.col("__kept"), F.col(c))).alias(f"__{c}") for c in "xyz"] + [F.min(c).alias(f"__all_{c}") for c in "xyz"]
    clouds = rows.groupBy(*BRIDGE).agg(F.count_if("__kept").alias("__left"), *low)  # of what is left, and of all for the clouds under the guard
    guarded = F.col("__left") <= 10
    shifted = {c: F.col(c) - F.when(guarded, F.col(f"__all_{c}")).otherwise(F.col(f"__{c}")) for c in "xyz"}
    return rows.join(clouds, BRIDGE).where(F.col("__kept") | guarded).select(*(shifted[c].alias(c) if c in shifted else F.col(c) for c in points.columns))
