"""Exact medians of groups of any size, by counting in ranges of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from decklight.functions.tables import written

#: Groups up to this size are sorted in one task.
SMALL = 10_000
#: Ranges a pass cuts what is left of a group into, and passes.
RANGES = 1_024
PASSES = 4


def grouped_median(df: DataFrame, groups: list[str], value: str, small: int = SMALL) -> DataFrame:
    """(groups, n, median) of the non-null values of each group; the mean of the two middle values of an even number.

    A large group's middle is searched for: its values are counted in ranges between the least and
    the greatest, the range that holds the middle is cut again, and after ``PASSES`` passes what is
    left is counted by value. Only counts of ranges meet, so memory does not grow with a group.
    Group columns must not be null.
    """
    rows = df.select(*groups, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    direct = lambda part: part.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.expr("percentile(__v, 0.5)").alias("median"))
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    large = written(sizes.where(F.col("n") > small))  # at most a row for each ``small`` values
    if large.isEmpty():
        return direct(rows)
    return direct(rows.join(large, groups, "left_anti")).unionByName(_selected(written(rows.join(large, groups, "left_semi")), large, groups))


def _selected(rows: DataFrame, sizes: DataFrame, groups: list[str]) -> DataFrame:
    # two wanted places a group, the same one where the number is odd
    places = F.explode(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))).alias("rank")
    wanted = written(sizes.select(*groups, "n", "lo", "hi", places).distinct().withColumn("place", F.col("rank")))
    keys = [*groups, "place"]
    over = Window.partitionBy(*keys).orderBy("cell")
    inside = lambda: rows.join(wanted, groups).where("__v >= lo AND __v <= hi")
    for _ in range(PASSES):
        # what a cell holds is between its least and its greatest value, for the cell grows with the value
        cell = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("__v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * RANGES), F.lit(RANGES - 1))).otherwise(0)
        counted = inside().groupBy(*keys, "n", "rank", cell.alias("cell")).agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        before = counted.withColumn("before", F.sum("c").over(over) - F.col("c"))
        wanted = written(before.where("rank >= before AND rank < before + c").select(*keys, "n", "lo", "hi", (F.col("rank") - F.col("before")).alias("rank")))
    values = inside().groupBy(*keys, "n", "rank", F.col("__v").alias("cell")).agg(F.count(F.lit(1)).alias("c"))
    found = values.withColumn("before", F.sum("c").over(over) - F.col("c")).where("rank >= before AND rank < before + c")
    return found.groupBy(*groups, "n").agg(F.avg("cell").alias("median"))
