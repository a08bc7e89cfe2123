"""Ground classification by progressive opening of a lowest-point grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .voxels import BRIDGE

#: The side of a block of cells that one call opens.
BLOCK = 256


def _opener(cell: float, slope: float, window: int, block: int):
    """The function that opens one block; it is made here, so that tasks need nothing of this module."""
    keys, rim = list(BRIDGE), window * (window + 1)

    def running(grid: np.ndarray, reach: int, axis: int, pick) -> np.ndarray:
        """The least or greatest of each cell and those up to ``reach`` away along an axis, by doubling the window."""
        empty = np.inf if pick is np.minimum else -np.inf
        pad = [(0, 0), (0, 0)]
        pad[axis] = (reach, reach)
        held = np.moveaxis(np.pad(grid, pad, constant_values=empty), axis, 0)
        size, width = 1, 2 * reach + 1
        while 2 * size <= width:
            held, size = pick(held[:-size], held[size:]), 2 * size
        if size < width:
            held = pick(held[: len(held) - (width - size)], held[width - size :])
        return np.moveaxis(held, 0, axis)

    def opened(grid: np.ndarray, reach: int) -> np.ndarray:
        """Least, then greatest, of the squares around each cell; NaN has no height, and stays only where no square has one."""
        low = np.where(np.isnan(grid), np.inf, grid)
        for axis in (0, 1):
            low = running(low, reach, axis, np.minimum)
        high = np.where(np.isinf(low), -np.inf, low)
        for axis in (0, 1):
            high = running(high, reach, axis, np.maximum)
        return np.where(np.isinf(high), np.nan, high)

    def run(table: pa.Table) -> pa.Table:
        col = lambda c: table[c].to_numpy()
        x, y, bx, by = col("gx").astype(np.int64), col("gy").astype(np.int64), int(col("bx")[0]) * block, int(col("by")[0]) * block
        own = (x >= bx) & (x < bx + block) & (y >= by) & (y < by + block)
        low_x, low_y = max(bx - rim, int(col("x0")[0])), max(by - rim, int(col("y0")[0]))
        high_x, high_y = min(bx + block - 1 + rim, int(col("x1")[0])), min(by + block - 1 + rim, int(col("y1")[0]))
        surface, is_object = np.zeros(0), np.zeros(0, bool)
        if own.any():
            heights = np.full((high_x - low_x + 1, high_y - low_y + 1), np.nan)
            heights[x - low_x, y - low_y] = col("s")
            objects = np.zeros(heights.shape, bool)
            for w in range(1, window + 1):
                lower = opened(heights, w)
                objects |= heights - lower > slope * w * cell  # never where a height is missing
                heights = lower
            surface, is_object = heights[x[own] - low_x, y[own] - low_y], objects[x[own] - low_x, y[own] - low_y]
        kept = table.filter(pa.array(own)).select([*keys, "gx", "gy"])
        return kept.append_column("surface", pa.array(surface, pa.float64())).append_column("object", pa.array(is_object, pa.bool_()))

    return run


def ground_filter(
    points: DataFrame, cell: float = 1.0, slope: float = 0.05, window: int = 10, threshold: float = 0.5, scalar: float = 1.25, block: int = BLOCK
) -> DataFrame:
    """``ground`` of each point: 2 for ground, 7 kept, else 1.

    Each cell's lowest height is opened (running least, then greatest, along x and y) with
    windows from 1 to ``window``; a cell that an opening lowers by more than slope * window * cell
    is an object. Points within threshold + scalar * slope of the last surface of a cell that is no
    object are ground. A cell without points is filled with the surface of the first opening that
    reaches it, so that gaps do not cut the windows; there are no cells beyond the outermost points.

    Cells are dealt to blocks with a rim as wide as all windows reach together, and a block is opened
    in one call, whatever the number of windows. Only blocks that hold points are made, so one far
    point costs one block, and a large cloud is many blocks.
    """
    gx, gy = F.floor(F.col("x") / cell).cast("int"), F.floor(F.col("y") / cell).cast("int")
    grid = points.where("classification <> 7").groupBy(*BRIDGE, gx.alias("gx"), gy.alias("gy")).agg(F.min("z").alias("s"))
    ends = grid.groupBy(*BRIDGE).agg(F.min("gx").alias("x0"), F.max("gx").alias("x1"), F.min("gy").alias("y0"), F.max("gy").alias("y1"))
    rim = window * (window + 1)  # an opening reaches its window twice
    blocks = lambda c: F.sequence(F.floor((F.col(c) - rim) / block), F.floor((F.col(c) + rim) / block))
    dealt = grid.withColumn("bx", F.explode(blocks("gx"))).withColumn("by", F.explode(blocks("gy"))).join(ends, BRIDGE)

    kinds = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in BRIDGE)
    cells = dealt.groupBy(*BRIDGE, "bx", "by").applyInArrow(_opener(cell, slope, window, block), f"{kinds}, gx int, gy int, surface double, object boolean")
    cells = cells.withColumnsRenamed({"gx": "__gx", "gy": "__gy", "surface": "__s", "object": "__o"})
    placed = points.withColumn("__gx", gx).withColumn("__gy", gy).join(cells, [*BRIDGE, "__gx", "__gy"], "left")
    low = ~F.col("__o") & (F.col("z") - F.col("__s") <= threshold + scalar * slope)
    ground = F.when(F.col("classification") == 7, 7).when(F.coalesce(low, F.lit(False)), 2).otherwise(1)
    return placed.select(*points.columns, ground.alias("ground"))
