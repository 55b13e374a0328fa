"""Adaptive tiles: leaves of a quadtree grown from counts, and points dealt to them with halos.

A block is a power of two of base cells on each side; halving it along x and y in
turn gives the next smaller ones. A leaf is the largest block whose load, its own
points and those of the cells around it, is not above a cap; where even a base
cell's is, that cell is the leaf. Loads are partial sums over cells, so no task
and no driver sees an area's points, and heavy areas get small leaves wherever
they lie. Base cells are at least as wide as the halo, so a point belongs to at
most nine leaves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut

CELL = ["ix", "iy"]
LEAF = ["level", "bx", "by"]
AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def base_cells(side: float) -> list[Column]:
    """ix, iy, counted from absolute zero."""
    return [F.floor(F.col(c) / side).alias(f"i{c}") for c in "xy"]


def _block(ix: Column, iy: Column, level: Column) -> Column:
    """The block of a cell: each even level doubles along y, each odd one along x."""
    shift = lambda v, by: F.call_function("shiftright", v, by.cast("int"))
    return F.struct(level.alias("level"), shift(ix, F.floor((level + 1) / 2)).alias("bx"), shift(iy, F.floor(level / 2)).alias("by"))


def leaves(cells: DataFrame, cap: int) -> DataFrame:
    """ix, iy, level, bx, by, load for each row of a table (ix, iy, n) of distinct cells: the leaf that the cell lies in."""
    wide = cells.agg(*[(F.max(c) - F.min(c)).alias(c) for c in CELL]).first()
    levels = 2 * math.ceil(math.log2(max(wide.ix or 0, wide.iy or 0, 1) + 1)) + 1
    rank = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    spread = cells.select(*CELL, "n", rank)
    # a cell counts once for each block that it or a cell next to it lies in
    near = F.array_distinct(F.array(*[_block(F.col("ix") + i, F.col("iy") + j, F.col("level")) for i, j in AROUND]))
    loads = spread.select("n", F.explode(near).alias("b")).groupBy("b.level", "b.bx", "b.by").agg(F.sum("n").alias("load"))
    own = spread.select(*CELL, _block(F.col("ix"), F.col("iy"), F.col("level")).alias("b")).select(*CELL, "b.*")
    fits = own.join(loads, LEAF).where((F.col("load") <= cap) | (F.col("level") == 0))
    best = fits.groupBy(*CELL).agg(F.max(F.struct(*LEAF, "load")).alias("leaf"))
    return best.select(*CELL, "leaf.*")


def dealt(points: DataFrame, side: float, cap: int, halo: float) -> DataFrame:
    """Each point once for every leaf whose block or halo holds it: level, bx, by, is_core. halo must not exceed side; points should be cheap to read twice."""
    if halo > side:
        raise ValueError("base cells must be at least as wide as the halo")
    p = points.select("*", *base_cells(side))
    tree = cut(leaves(cut(p.groupBy(*CELL).agg(F.count("*").alias("n"))), cap))
    beside = F.explode(F.array(*[F.struct((F.col("ix") + i).alias("jx"), (F.col("iy") + j).alias("jy"), F.lit(-i).alias("dx"), F.lit(-j).alias("dy")) for i, j in AROUND])).alias("c")
    theirs = tree.select(*LEAF, beside).select(*LEAF, "c.*")
    # for each cell the leaves of the cells around it, each once, and on which side: a block with cells on both sides of the
    # middle, or in it and beside it, reaches over the middle, so that it is as near as its side there
    over = [F.when(F.min(d) == F.max(d), F.min(d)).otherwise(0).alias(d) for d in ("dx", "dy")]
    about = theirs.groupBy(F.col("jx").alias("ix"), F.col("jy").alias("iy"), *LEAF).agg(*over)

    def close(c: str) -> Column:
        low, d = F.col(f"i{c}") * side, F.col(f"d{c}")
        return (d == 0) | ((d < 0) & (F.col(c) - low <= halo)) | ((d > 0) & (low + side - F.col(c) <= halo))

    # plain columns and conditions only: this meets every point
    return p.join(about, CELL).where(close("x") & close("y")).select(*points.columns, *LEAF, ((F.col("dx") == 0) & (F.col("dy") == 0)).alias("is_core"))


def leaf_loads(points: DataFrame, side: float, cap: int) -> DataFrame:
    """level, bx, by, load, n_core of each leaf."""
    cells = cut(points.select(*base_cells(side)).groupBy(*CELL).agg(F.count("*").alias("n")))
    return leaves(cells, cap).join(cells, CELL).groupBy(*LEAF, "load").agg(F.sum("n").alias("n_core"))
