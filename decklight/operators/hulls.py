"""Convex hulls per bridge, and points inside them.

Only the least and the greatest y of an x can be corners, so a grouped aggregate thins
each cloud first. Large clouds are dealt into parts of bounded size; the corners of the
parts' hulls have the same hull as the cloud and meet in one array. The chain is
Andrew's, as an ``aggregate`` over a sorted array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from decklight.functions.tables import written

from .voxels import BRIDGE

_POINTS = "array<struct<x:double,y:double>>"


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def _chain(points: Column) -> Column:
    """The corners met going along the sorted points with the cloud on the left."""

    def add(held: Column, p: Column) -> Column:
        turns = F.filter(F.sequence(F.lit(1), F.size(held)), lambda k: (k == 1) | (_cross(F.get(held, k - 2), F.get(held, k - 1), p) > 0))
        kept = F.when(F.size(held) > 0, F.slice(held, 1, F.array_max(turns))).otherwise(held)
        return F.concat(kept, F.array(p))

    return F.aggregate(points, F.array().cast(_POINTS), add)


def _hulls(corners: DataFrame, keys: list) -> DataFrame:
    """(keys, hull) of rows (keys, p)."""
    sorted_ = corners.groupBy(*keys).agg(F.array_sort(F.collect_set("p")).alias("pts"))
    chains = sorted_.select(*keys, _chain(F.col("pts")).alias("low"), _chain(F.reverse("pts")).alias("high"))
    open_ = lambda c: F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))
    whole = F.when(F.size("low") == 1, F.col("low")).otherwise(F.concat(open_("low"), open_("high")))
    return chains.select(*keys, whole.alias("hull"))


def convex_hull(points: DataFrame, part_points: int = 20_000) -> DataFrame:
    """(bridge, hull, n_corners): the corners against the clock; ``hull`` is null under three corners."""
    ends = points.groupBy(*BRIDGE, "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    corner = lambda y: F.struct(F.col("x").cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    each = written(ends.select(*BRIDGE, F.explode(F.array(corner("lo"), corner("hi"))).alias("p")))
    large = each.groupBy(*BRIDGE).agg(F.ceil(F.count(F.lit(1)) / part_points).alias("parts")).where("parts > 1")
    dealt = each.join(large, BRIDGE, "left").select(*BRIDGE, "p", F.pmod(F.xxhash64("p"), F.coalesce("parts", F.lit(1))).alias("part"))
    first = _hulls(dealt, [*BRIDGE, "part"]).select(*BRIDGE, F.explode("hull").alias("p"))
    hulls = _hulls(first, BRIDGE)
    return hulls.select(*BRIDGE, F.when(F.size("hull") >= 3, F.col("hull")).alias("hull"), F.size("hull").alias("n_corners"))


def _chains(hulls: DataFrame) -> DataFrame:
    """(bridge, lower, upper): the corners along the bottom and along the top of each hull, by x."""
    n, at = F.size("hull"), lambda i: F.get("hull", i)  # noqa: E731  the first corner is the lowest of the least x
    right = F.array_max(F.transform("hull", lambda p: p["x"]))
    first = (F.array_position(F.transform("hull", lambda p: p["x"]), right) - 1).cast("int")  # the lowest of the greatest x
    last = F.when(at(first + 1)["x"] == right, first + 1).otherwise(first)  # the highest of it
    over = F.reverse(F.slice("hull", last + 1, n - last))
    upper = F.when(at(n - 1)["x"] > at(F.lit(0))["x"], F.concat(F.array(at(F.lit(0))), over)).otherwise(over)
    return hulls.where("hull IS NOT NULL").select(*BRIDGE, F.slice("hull", 1, first + 1).alias("lower"), upper.alias("upper"))


def _over_chain(chain: Column, p: Column) -> Column:
    """The turn from the chain's edge at the point's x to the point, found by halving the chain."""
    steps = F.ceil(F.log2(F.size(chain).cast("double"))).cast("int") + 1

    def halve(held: Column, _: Column) -> Column:
        middle = F.floor((held["a"] + held["b"]) / 2).cast("int")
        right = F.get(chain, middle)["x"] <= p["x"]
        narrow = F.struct(F.when(right, middle).otherwise(held["a"]).alias("a"), F.when(right, held["b"]).otherwise(middle).alias("b"))
        return F.when(held["b"] - held["a"] > 1, narrow).otherwise(held)

    found = F.aggregate(F.sequence(F.lit(1), steps), F.struct(F.lit(0).alias("a"), (F.size(chain) - 1).alias("b")), halve)
    return _cross(F.get(chain, found["a"]), F.get(chain, found["b"]), p)


def points_in_hull(points: DataFrame, hulls: DataFrame) -> DataFrame:
    """``inside`` of each point of a bridge with a hull; its edge belongs to it.

    A point is over the bottom chain and under the top one; in each only the edge at its x is
    looked at, which takes as many steps as the number of corners has binary digits.
    """
    at = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    p, lower, upper = F.col("__at"), F.col("lower"), F.col("upper")
    between = (p["x"] >= F.get(lower, 0)["x"]) & (p["x"] <= F.element_at(lower, -1)["x"])
    inside = F.when(between, (_over_chain(lower, p) >= 0) & (_over_chain(upper, p) <= 0)).otherwise(False)
    return points.withColumn("__at", at).join(_chains(hulls), BRIDGE).select(*points.columns, inside.alias("inside"))
