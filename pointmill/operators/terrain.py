"""Terrain surfaces and ground rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.storage import cut
from ..sources.points import DIRTY, GROUND, relabel
from . import grid


def cell_heights(points: DataFrame, cell: float, quantile: float | None = None) -> DataFrame:
    """ix, iy, low: least z of each cell, or its exact quantile."""
    low = F.min("z") if quantile is None else F.percentile("z", quantile)
    return grid.with_cells(points, cell).groupBy(*grid.CELL).agg(low.alias("low"))


def road_surface(points: DataFrame, cell: float = 1.0, size: int = 7) -> DataFrame:
    """ix, iy, gz: cell minima, holes filled by their median, opened by a square."""
    cells = cut(cell_heights(points, cell))
    return grid.filled(cells, "low", size, ("min", "max")).select(*grid.CELL, F.col("new").alias("gz"))


def low_surface(points: DataFrame, cell: float) -> DataFrame:
    """ix, iy, gz: the cell's 20 % height, but not above its opening by 3 x 3."""
    cells = cut(cell_heights(points, cell, 0.2))
    return grid.filled(cells, "low", 3, ("min", "max")).select(*grid.CELL, F.least("low", "new").alias("gz"))


def ground_surface(points: DataFrame, ground: Column, cell: float = 0.5) -> DataFrame:
    """ix, iy, gz: least ground z of a cell, else the least z of all its points."""
    cells = grid.with_cells(points, cell).groupBy(*grid.CELL)
    return cells.agg(F.coalesce(F.min(F.when(ground, F.col("z"))), F.min("z")).alias("gz"))


def refiner_surface(points: DataFrame, cell: float = 1.0, least: int = 100) -> DataFrame:
    """ix, iy, gz: ground minima, holes filled by the median ground z, 3 x 3 minimum; with few ground points one height everywhere."""
    ground = F.col("cls") == GROUND
    cells = cut(grid.with_cells(points, cell).groupBy(*grid.CELL).agg(F.min(F.when(ground, F.col("z"))).alias("gz"), F.count_if(ground).alias("n")))
    if (cells.agg(F.sum("n")).first()[0] or 0) < least:
        level = quantiles(points, {"z": F.col("z")}, [0.5]).get(("z", 0.5, None))
        cells = cells.withColumn("gz", F.lit(level))
    else:
        level = quantiles(points.where(ground), {"z": F.col("z")}, [0.5])["z", 0.5, None]
        cells = cells.fillna({"gz": level})
    return grid.filled(cells, "gz", 3, ("min",), level).select(*grid.CELL, F.col("new").alias("gz"))


def with_surface(points: DataFrame, surface: DataFrame, cell: float) -> DataFrame:
    """Points with gz taken from the surface's cell."""
    return grid.with_cells(points.drop("gz"), cell).join(surface, grid.CELL, "left").drop(*grid.CELL)


def radius_low_points(points: DataFrame, depth: float = 0.2, cell: float = 0.5) -> DataFrame:
    """Points more than `depth` below their cell's least z. As that least z is over the same points there are none for any depth of 0 or more: a stated no-op."""
    with_low = grid.with_cells(points, cell).join(cell_heights(points, cell), grid.CELL)
    return with_low.where(F.col("z") < F.col("low") - depth).select("point_id")


def split_ground(points: DataFrame, above: float = 0.06, below: float = 0.04) -> DataFrame:
    """Ground is what lies within the tolerances of gz."""
    return relabel(points, F.col("z").between(F.col("gz") - below, F.col("gz") + above), GROUND)


def peel_elevated(points: DataFrame, above: float = 0.12) -> DataFrame:
    return relabel(points, (F.col("cls") == GROUND) & (F.col("z") > F.col("gz") + above), DIRTY)
