"""Training curves: epochs, best rows, resumed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def epoch_metrics(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row an epoch: the largest value of each sparse column, NaN as null."""
    return metrics.groupBy("epoch").agg(*(F.max(F.nanvl(F.col(c), F.lit(None).cast("double"))).alias(c) for c in names))


def best_epoch(epochs: DataFrame, metric: str) -> DataFrame:
    """The epoch of the largest metric, the first of equal ones."""
    rest = [c for c in epochs.columns if c != "epoch"]
    rows = epochs.where(F.col(metric).isNotNull())
    return rows.agg(F.max_by(F.struct("epoch", *rest), F.struct(F.col(metric), -F.col("epoch"))).alias("b")).where("b IS NOT NULL").select("b.*")


def epoch_progression(epochs: DataFrame, n: int = 5) -> DataFrame:
    """At most ``n`` epochs spread evenly, places rounded half to even. A row an epoch: the window is small."""
    w = Window.orderBy("epoch")
    ranked = epochs.select("*", (F.row_number().over(w) - 1).alias("__i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("__n"))
    places = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * (F.col("__n") - 1) / (n - 1), 0).cast("int"))
    keep = F.when(F.col("__n") <= n, F.lit(True)).otherwise(F.array_contains(places, F.col("__i").cast("int")))
    return ranked.where(keep).drop("__i", "__n")


def merge_resumed_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """All epochs of the first run, and those of the second after its last."""
    last = first.agg(F.max("epoch").alias("__last"))
    later = second.crossJoin(F.broadcast(last)).where(F.col("__last").isNull() | (F.col("epoch") > F.col("__last"))).drop("__last")  # one row
    return first.unionByName(later)


def metric_pairs(columns: list[str]) -> list[tuple[str, str, str]]:
    """(title, train column, validation column), loss first, then by name."""
    names = {c.removeprefix("train_").removesuffix("_epoch"): c for c in columns if c.startswith("train_") and c.endswith("_epoch")}
    found = [(n, c, f"val_{n}") for n, c in names.items() if f"val_{n}" in columns]
    return sorted(found, key=lambda p: (p[0] != "loss", p[0]))


def metric_curves(epochs: DataFrame) -> DataFrame:
    """Long rows (epoch, metric, train, val) of every pair of columns."""
    pairs = metric_pairs(epochs.columns)
    if not pairs:
        return epochs.select("epoch", F.lit("").alias("metric"), F.lit(0.0).alias("train"), F.lit(0.0).alias("val")).limit(0)
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("metric"), F.col(a).alias("train"), F.col(b).alias("val")) for t, a, b in pairs)))
    return epochs.select("epoch", each.alias("p")).select("epoch", "p.*")
