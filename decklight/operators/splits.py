"""Splits, samples and orders. Seeded shuffles are orders by a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from decklight.functions.columns import hash_order
from decklight.functions.tables import written
from .voxels import BRIDGE

SEED = 27


def _ranked(df: DataFrame, groups: list[str], order: list[Column], name: str = "__r") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))


def numbered(df: DataFrame, order: list[Column], name: str, groups: list[str] = (), total: str | None = None) -> DataFrame:
    """Row numbers from 1 over the whole table, or in each group, and the rows there are as ``total``, in two steps:
    within ranges of the order, then over the ranges' sizes.

    The ranges are written, for they come from a sample and would differ from one reading to the
    next. A large group lies in many ranges, so no task holds it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select("*", *(c.alias(f"__k{i}") for i, c in enumerate(order)))
    keys, own = [f"__k{i}" for i in range(len(order))], [f"__g{i}" for i in range(len(groups))]
    ranged = written(dealt.repartitionByRange(parts, *groups, *keys).withColumn("__p", F.spark_partition_id()))
    named = [F.col(c).alias(g) for c, g in zip(groups, own)]
    sizes = ranged.groupBy(*named, F.col("__p").alias("__q")).agg(F.count(F.lit(1)).alias("__n"))  # a row a group and range
    before = (F.sum("__n").over(Window.partitionBy(*own).orderBy("__q")) - F.col("__n")).alias("__before")
    before = sizes.select(*own, "__q", before, *([F.sum("__n").over(Window.partitionBy(*own)).alias(total)] if total else []))
    within = F.row_number().over(Window.partitionBy(*groups, "__p").orderBy(*keys))
    same = F.col("__p") == F.col("__q")
    for c, g in zip(groups, own):
        same &= F.col(c).eqNullSafe(F.col(g))
    joined = ranged.withColumn("__w", within).join(before, same)
    return joined.withColumn(name, (F.col("__w") + F.col("__before")).cast("long")).drop("__p", "__q", "__w", "__before", *keys, *own)


#: Parts of a group of which the first rows are taken apart.
SALTS = 32
#: Up to this many rows of a group are ranked in one task.
MOST_RANKED = 1_000


def least_of_each(df: DataFrame, most: int, groups: list[str], order: list[Column], name: str = "__r", salted: bool = True) -> DataFrame:
    """The first ``most`` rows of each group in an order, with their place in it, from 1.

    The first rows of salted parts of each group come first, and then the first of these, so one task
    ranks ``SALTS * most`` rows of a group at most. Where that is much, all rows are numbered instead.
    ``salted`` may be off where the groups are known to be small.
    """
    if not salted:
        # most rows of small groups are kept: said so that Spark does not rank them before the shuffle as well
        return _ranked(df, groups, order, name).where(F.col(name) - most <= 0)
    if most > MOST_RANKED:
        return numbered(df, order, name, groups).where(F.col(name) <= most)
    first = _ranked(df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(SALTS))), [*groups, "__salt"], order).where(F.col("__r") <= most)
    return _ranked(first.drop("__r", "__salt"), groups, order, name).where(F.col(name) <= most)


def deterministic_order(points: DataFrame, seed: int = SEED) -> DataFrame:
    """``shuffled_idx``: each point's place in its bridge's hash order, from 0."""
    ranked = numbered(points, [hash_order(seed, *BRIDGE, "point_idx"), F.col("point_idx")], "__r", BRIDGE)
    return ranked.withColumn("shuffled_idx", F.col("__r") - 1).drop("__r")


def split_ratios(train: float | None = None, val: float | None = None, test: float | None = None) -> tuple[float, float, float]:
    """Three ratios that sum to one, from none to three given ones."""
    given = [r for r in (train, val, test) if r is not None]
    if any(not 0 <= r <= 1 for r in given) or sum(given) > 1 + 1e-9:
        raise ValueError("ratios must be between 0 and 1 and sum to 1 at most")
    if not given:
        return 0.70, 0.15, 0.15
    if len(given) == 3:
        if abs(sum(given) - 1) > 1e-6:
            raise ValueError("three ratios must sum to 1")
        return train, val, test
    rest = (1 - sum(given)) / (3 - len(given))
    return tuple(rest if r is None else r for r in (train, val, test))


def stratified_split(bridges: DataFrame, train: float, val: float, test: float, seed: int = SEED, group: str = "huc_id", key: str = "osmid") -> DataFrame:
    """``split`` of each row: in each group the first int(train * n) in hash order, then int(val * n), then the rest.

    The rest is test, or val where the test ratio is 0.
    """
    ranked = numbered(bridges, [hash_order(seed, group, key), F.col(key)], "__r", [group], "__n")
    n_train, n_val = F.floor(F.lit(train) * F.col("__n")), F.floor(F.lit(val) * F.col("__n"))
    rest = "test" if test > 0 else "val"
    split = F.when(F.col("__r") <= n_train, "train").when(F.col("__r") <= n_train + n_val, "val").otherwise(rest)
    return ranked.withColumn("split", split).drop("__r", "__n")


def round_robin_sample(df: DataFrame, size: int, cap: int | None = None, seed: int = SEED, group: str = "huc_id", key: str = "osmid") -> DataFrame:
    """The k-th row of every group before any group's next, up to ``size`` rows and ``cap`` a group."""
    once = df.dropDuplicates([group, key])
    ranked = least_of_each(once, size if cap is None else min(cap, size), [group], [hash_order(seed, group, key), F.col(key)])
    return ranked.orderBy("__r", hash_order(seed, group), group).limit(size).drop("__r")


def sample_groups(df: DataFrame, n: int, seed: int = SEED, group: str = "huc_id") -> DataFrame:
    """The rows of n groups, or of all if there are fewer."""
    chosen = df.select(group).distinct().orderBy(hash_order(seed, group), group).limit(n)
    return df.join(F.broadcast(chosen), group, "left_semi")  # n rows


def two_stage_sample(df: DataFrame, groups: int, rows: int, seed: int = SEED, group: str = "huc_id", key: str = "osmid") -> DataFrame:
    return least_of_each(sample_groups(df, groups, seed, group), rows, [group], [hash_order(seed, group, key), F.col(key)]).drop("__r")


def dedupe_max(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The row of the largest value for each key, the first in ``order`` of equal ones."""
    return _best(df, keys, F.max_by, F.struct(F.col(value), -F.col(order)))


def dedupe_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return _best(df, keys, F.min_by, F.col(order))


def _best(df: DataFrame, keys: list[str], pick, by: Column) -> DataFrame:
    """A grouped pick, which combines before it shuffles as a window would not."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("__b")).select(*keys, "__b.*")


def cap_per_group(df: DataFrame, cap: int, groups: list[str], keys: list[str], seed: int = SEED) -> DataFrame:
    """At most ``cap`` rows of each group, the first in hash order (voxel cap and point downsampling)."""
    return least_of_each(df, cap, groups, [hash_order(seed, *groups, *keys), *map(F.col, keys)]).drop("__r")


def at_places(df: DataFrame, places: dict[str, tuple[Column, list[float]]]) -> DataFrame:
    """One row: for each name the value of its column at the places (from 0) of its order, interpolated between two places.

    The order is made by ranges (``numbered``), so no task holds a column.
    """
    out = None
    for name, (column, wanted) in places.items():
        ranks = sorted({int(p) + k for p in wanted for k in (1, 2)})
        values = numbered(df.select(column.cast("double").alias("__v")).where("__v IS NOT NULL"), [F.col("__v")], "__i").where(F.col("__i").isin(ranks))
        value = lambda p: F.max(F.when(F.col("__i") == int(p) + 1, F.col("__v")))
        between = [value(p) + (F.coalesce(value(p + 1), value(p)) - value(p)) * (p - int(p)) for p in wanted]
        one = values.agg(F.array(*between).alias(name))
        out = one if out is None else out.crossJoin(one)  # a row each
    return out


def manifest_chunks(lines: DataFrame, target: int = 60, most: int = 10_000, order: str = "line_no") -> DataFrame:
    """``child`` of each line: an array of 1 child up to ``target`` lines, else of min(ceil(n / target), most)."""
    total = lines.agg(F.count(F.lit(1)).alias("n"))
    size = F.when(F.col("n") <= target, 1).otherwise(F.least(F.ceil(F.col("n") / target), F.lit(most)))
    plan = total.select(size.cast("long").alias("array_size"), F.ceil(F.col("n") / size).cast("long").alias("chunk"))
    rows = numbered(lines, [F.col(order)], "__i").crossJoin(F.broadcast(plan))  # one row
    return rows.withColumn("child", F.floor((F.col("__i") - 1) / F.col("chunk")).cast("long")).drop("__i")


def random_val_split(files: DataFrame, ratio: float, key: str, seed: int = SEED) -> DataFrame:
    """int(ratio * n) rows, the first in hash order, to val and the others to train."""
    total = files.agg(F.count(F.lit(1)).alias("__n"))
    rows = numbered(files, [hash_order(seed, key), F.col(key)], "__i").crossJoin(F.broadcast(total))  # one row
    return rows.withColumn("split", F.when(F.col("__i") <= F.floor(F.lit(ratio) * F.col("__n")), "val").otherwise("train")).drop("__i", "__n")


def assemble_batches(voxels: DataFrame, size: int) -> DataFrame:
    """``batch_no`` and ``batch_slot`` of every voxel, bridges in order, and the voxels of its bridge."""
    bridges = voxels.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_voxels"))
    placed = numbered(bridges, [F.col(c) for c in BRIDGE], "__i")
    batch = placed.select(*BRIDGE, "n_voxels", F.floor((F.col("__i") - 1) / size).cast("int").alias("batch_no"), ((F.col("__i") - 1) % size).cast("int").alias("batch_slot"))
    return voxels.join(batch, BRIDGE)


def apply_holdout(bridges: DataFrame, holdout: DataFrame, key: str = "osmid") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pool without the fixed test ids, rows of these ids, ids that are not there)."""
    return bridges.join(holdout, key, "left_anti"), bridges.join(holdout, key, "left_semi"), holdout.join(bridges, key, "left_anti")


def split_stats(splits: DataFrame) -> DataFrame:
    """Rows and distinct regions of each split and of all."""
    return splits.rollup("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("huc_id").alias("n_hucs")).withColumn("split", F.coalesce("split", F.lit("all")))


def used_ids(splits: DataFrame) -> DataFrame:
    """Distinct stems and osm ids of the splits."""
    return splits.select("bridge_stem", F.regexp_extract("bridge_stem", "^bridge_([^_]+)", 1).alias("osm_id")).distinct()


def id_set_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids that are on one side only."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
