"""Cells, voxels, rasters and their morphology, as sparse cell tables (ix, iy) worked on in tiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.storage import cut
from .graph import connected_components, merged

CELL = ["ix", "iy"]


def with_cells(points: DataFrame, cell: float, among: Column | None = None, shift: float = 0.0) -> DataFrame:
    """Adds ix, iy. The grid begins `shift` before the least x and y of the points that `among` marks (of all without it)."""
    box = points if among is None else points.where(among)
    origin = box.agg(F.min("x").alias("__x0"), F.min("y").alias("__y0"))
    return (
        points.join(F.broadcast(origin))  # one row
        .withColumn("ix", F.floor((F.col("x") - (F.col("__x0") - shift)) / cell))
        .withColumn("iy", F.floor((F.col("y") - (F.col("__y0") - shift)) / cell))
        .drop("__x0", "__y0")
    )


def with_voxels(points: DataFrame, cell: float) -> DataFrame:
    """Adds vx, vy, vz, counted from absolute zero."""
    return points.select("*", *[F.floor(F.col(c) / cell).alias(f"v{c}") for c in "xyz"])


def mark(points: DataFrame, cells: DataFrame, name: str = "hit", keys: list[str] = CELL) -> DataFrame:
    """Adds a boolean: whether the point's cell is in the cell table."""
    return points.join(cells.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _framed(cells: DataFrame, tile: int, rim: int) -> DataFrame:
    """Each cell once for every tile that it lies in or within `rim` cells of: tx, ty."""
    span = lambda c: F.sequence(F.floor((F.col(c) - rim) / tile), F.floor((F.col(c) + rim) / tile))
    return cells.select("*", F.explode(span("ix")).alias("tx"), span("iy").alias("__ty")).select("*", F.explode("__ty").alias("ty")).drop("__ty")


def _running(a: np.ndarray, size: int, take) -> np.ndarray:
    """take over each size x size square that lies within an array."""
    for _ in (0, 1):
        out, width = a, 1
        while width < size:
            step = min(width, size - width)
            out = take(out[:-step], out[step:])
            width += step
        a = out.T
    return a


def morphed(cells: DataFrame, value: str, size: int, steps: tuple[str, ...], fill: float | None = None, tile: int = 64) -> DataFrame:
    """ix, iy, value and `new`: after running minima ("min") and maxima ("max") over size x size squares, one after the other.

    The raster is kept in tiles, only where cells are; a tile gets the cells around
    it that its steps reach and works on one array. Without `fill`, cells that are
    not there count for nothing. With it they hold that value, within the rectangle
    from (0, 0) to the greatest ix and iy, and those of tiles with cells are returned
    too. Squares are clipped at the rectangle's edge, which equals reflecting it.
    """
    half = size // 2
    rim = half * len(steps)
    nx, ny = (cells.agg(F.max("ix"), F.max("iy")).first() if fill is not None else (None, None))

    def work(key, table):
        tx, ty = key[0].as_py(), key[1].as_py()
        x, y = (table[c].combine_chunks().to_numpy() for c in CELL)
        x, y, side = x - tx * tile + rim, y - ty * tile + rim, tile + 2 * rim
        a = np.full((side, side), np.nan)
        if fill is not None:
            gx, gy = (np.arange(side) - rim + t * tile for t in (tx, ty))
            a[np.ix_((gx >= 0) & (gx <= nx), (gy >= 0) & (gy <= ny))] = fill
        a[x, y] = table[value].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
        new = a
        for step in steps:
            empty, take = (np.inf, np.minimum) if step == "min" else (-np.inf, np.maximum)
            gone = np.isnan(new)[half : new.shape[0] - half, half : new.shape[1] - half]
            new = _running(np.where(np.isnan(new), empty, new), 2 * half + 1, take)
            new = np.where(gone, np.nan, new)
        a = a[rim : rim + tile, rim : rim + tile]
        if fill is None or not ((x >= rim) & (x < rim + tile) & (y >= rim) & (y < rim + tile)).any():
            some = np.zeros_like(a, bool)
            own = (x >= rim) & (x < rim + tile) & (y >= rim) & (y < rim + tile)
            some[x[own] - rim, y[own] - rim] = True
        else:
            some = ~np.isnan(a)
        i, j = np.nonzero(some)
        return pa.table({"ix": i + tx * tile, "iy": j + ty * tile, value: a[i, j], "new": new[i, j]})

    framed = _framed(cells.select(*CELL, value), tile, rim)
    return framed.groupBy("tx", "ty").applyInArrow(work, f"ix bigint, iy bigint, {value} double, new double")


def middle(cells: DataFrame, value: str) -> float | None:
    """The median of a cell table's values."""
    return quantiles(cells, {"v": F.col(value)}, [0.5]).get(("v", 0.5, None))


def filled(cells: DataFrame, value: str, size: int, steps: tuple[str, ...], fill: float | None = None) -> DataFrame:
    """`morphed` with the median of the occupied cells (or another value) in the holes."""
    fill = middle(cells, value) if fill is None else fill
    return morphed(cells, value, size, steps, fill)


def erode(grid: DataFrame, value: str, size: int) -> DataFrame:
    """Least value of a size x size square, edges clipped (which equals reflecting them)."""
    return morphed(grid, value, size, ("min",)).select(*CELL, F.col("new").alias(value))


def opening(grid: DataFrame, value: str, size: int) -> DataFrame:
    """Grey opening of a grid by a size x size square."""
    return morphed(grid, value, size, ("min", "max")).select(*CELL, F.col("new").alias(value))


def _around(offsets: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct((F.col("ix") + i).alias("ix"), (F.col("iy") + j).alias("iy")) for i, j in offsets])).alias("c")


def dilate(cells: DataFrame, radius: int = 1, cross: bool = False, value: str | None = None) -> DataFrame:
    """Square (or cross-shaped) dilation of a sparse mask; with a value column, the greatest value around."""
    span = range(-radius, radius + 1)
    offsets = [(i, j) for i in span for j in span if not cross or abs(i) + abs(j) <= radius]
    spread = cells.select(_around(offsets), *([value] if value else [])).select("c.*", *([value] if value else []))
    return spread.groupBy(*CELL).agg(F.max(value).alias(value)) if value else spread.distinct()


def opened(cells: DataFrame, size: int) -> DataFrame:
    """Binary opening of a sparse mask: cells in some fully occupied size x size block."""
    offsets = [(-i, -j) for i in range(size) for j in range(size)]
    full = cells.select(*CELL).distinct().select(_around(offsets)).select("c.*").groupBy(*CELL).count().where(F.col("count") == size * size).drop("count")
    return full.select(_around([(-i, -j) for i, j in offsets])).select("c.*").distinct()


def components(cells: DataFrame, tile: int = 256) -> DataFrame:
    """ix, iy, component (the least (ix, iy) that 4-neighbour steps reach) of a sparse mask.

    Two levels: labels within tiles, each in one task, and then components of the
    labels that meet at the tiles' edges.
    """
    cells = cells.select(*CELL).distinct()

    def label(table: pa.Table) -> pa.Table:
        x, y = (table[c].combine_chunks().to_numpy() for c in CELL)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        key = (x - x[0]) * (2 * tile) + (y - y.min())
        pairs = []
        for step in (2 * tile, 1):
            at = np.minimum(np.searchsorted(key, key + step), len(key) - 1)
            hit = np.flatnonzero(key[at] == key + step)
            pairs.append((hit, at[hit]))
        found = merged(np.arange(len(x)), *(np.concatenate(c) for c in zip(*pairs, strict=True)))[0]
        return pa.table({"ix": x, "iy": y, "lx": x[found], "ly": y[found]})

    tiles = [F.floor(F.col(c) / tile).alias(f"t{c}") for c in CELL]
    local = cells.select(*CELL, *tiles).groupBy("tix", "tiy").applyInArrow(label, "ix bigint, iy bigint, lx bigint, ly bigint")
    local = cut(local.select(*CELL, F.struct(F.col("lx").alias("ix"), F.col("ly").alias("iy")).alias("own")))
    low = local.where(f"ix % {tile} = 0 OR iy % {tile} = 0").select(*CELL, F.col("own").alias("b"))
    edge = lambda c: F.pmod(F.col(c), F.lit(tile)) == tile - 1
    right = local.where(edge("ix")).select((F.col("ix") + 1).alias("ix"), "iy", F.col("own").alias("a"))
    over = local.where(edge("iy")).select("ix", (F.col("iy") + 1).alias("iy"), F.col("own").alias("a"))
    links = cut(right.union(over).join(low, CELL).select("a", "b").distinct())
    if links.isEmpty():
        return local.select(*CELL, F.col("own").alias("component"))
    found = connected_components(links)
    return local.join(found, F.col("own") == found["id"], "left").select(*CELL, F.coalesce("component", "own").alias("component"))


def box_raster(boxes: DataFrame, points: DataFrame, cell: float, pad: float, radius: int) -> DataFrame:
    """ix, iy, top: cells under padded boxes (on the points' grid), greatest zmax, dilated."""
    origin = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    at = lambda c, o, f, p: f((F.col(c) + p - F.col(o)) / cell).cast("long")
    under = (
        boxes.join(F.broadcast(origin))
        .select(
            F.sequence(at("xmin", "x0", F.floor, -pad), at("xmax", "x0", F.ceil, pad) - 1).alias("xs"),
            F.sequence(at("ymin", "y0", F.floor, -pad), at("ymax", "y0", F.ceil, pad) - 1).alias("ys"),
            F.col("zmax").alias("top"),
        )
        .select(F.explode("xs").alias("ix"), "ys", "top")
        .select("ix", F.explode("ys").alias("iy"), "top")
        .groupBy(*CELL)
        .agg(F.max("top").alias("top"))
    )
    return dilate(under, radius, value="top")
