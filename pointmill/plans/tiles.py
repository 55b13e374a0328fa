"""Tiles with halos, windows and crops."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles


def window(x0: float, x1: float, y0: float, y1: float, xmax: float, ymax: float) -> Column:
    """Half-open window; at the cloud's far edges the last points belong to it."""

    def side(c: str, a: float, b: float, top: float) -> Column:
        upper = F.col(c) <= top + 1e-9 if b >= top - 1e-6 else F.col(c) < b
        return (F.col(c) >= a) & upper

    return side("x", x0, x1, xmax) & side("y", y0, y1, ymax)


def tile_of(points: DataFrame, tile: float) -> DataFrame:
    """Adds tx, ty, the tile that owns each point, from the cloud's least corner."""
    box = points.agg(F.min("x").alias("__x0"), F.min("y").alias("__y0"))
    return points.join(F.broadcast(box)).select(*points.columns, F.floor((F.col("x") - F.col("__x0")) / tile).alias("tx"), F.floor((F.col("y") - F.col("__y0")) / tile).alias("ty"))


def with_halo(points: DataFrame, tile: float, overlap: float) -> DataFrame:
    """Each point in every tile whose core or halo holds it: tx, ty, is_core. overlap must not exceed the tile."""
    box = points.agg(F.min("x").alias("__x0"), F.min("y").alias("__y0"), F.max("x").alias("__x1"), F.max("y").alias("__y1"))
    p = points.join(F.broadcast(box))
    at = lambda c, o, d: F.floor((F.col(c) - F.col(o) + d) / tile)
    low = lambda c, o: F.greatest(at(c, o, -overlap), F.lit(0).cast("long"))
    high = lambda c, o, m: F.least(at(c, o, overlap), F.floor((F.col(m) - F.col(o)) / tile))
    spread = p.select(*points.columns, at("x", "__x0", 0.0).alias("__cx"), at("y", "__y0", 0.0).alias("__cy"), F.sequence(low("y", "__y0"), high("y", "__y0", "__y1")).alias("__ys"), F.explode(F.sequence(low("x", "__x0"), high("x", "__x0", "__x1"))).alias("tx"))
    spread = spread.select("*", F.explode("__ys").alias("ty"))
    return spread.select(*points.columns, "tx", "ty", ((F.col("tx") == F.col("__cx")) & (F.col("ty") == F.col("__cy"))).alias("is_core"))


def crop(points: DataFrame, half: float, among: tuple[int, ...] = (9, 6), least: int = 5000) -> DataFrame:
    """The square around the middle of the first class: its median if it has `least` points, else that of the second class if it has any, else that of all."""
    first, second = among
    n, others = points.agg(F.count_if(F.col("cls") == first), F.count_if(F.col("cls") == second)).first()
    chosen = points.where(F.col("cls") == first) if n >= least else points.where(F.col("cls") == second) if others else points
    at = quantiles(chosen, {c: F.col(c) for c in "xy"}, [0.5])
    if not at:
        return points
    return points.where((F.abs(F.col("x") - at["x", 0.5, None]) <= half) & (F.abs(F.col("y") - at["y", 0.5, None]) <= half))


def uncovered(points: DataFrame, judged: DataFrame) -> DataFrame:
    """point_id of points that no tile has judged, and of those that several have: empty if the cores cover the cloud once."""
    missing = points.select("point_id").join(judged.select("point_id"), "point_id", "left_anti")
    twice = judged.groupBy("point_id").agg(F.count("*").alias("n")).where("n > 1").select("point_id")
    return missing.union(twice)


def tile_counts(points: DataFrame, tile: float, overlap: float) -> DataFrame:
    return with_halo(points, tile, overlap).groupBy("tx", "ty").agg(F.count_if("is_core").alias("n_core"), F.count("*").alias("n_load"))


@dataclass(frozen=True)
class Rect:
    x0: float
    x1: float
    y0: float
    y1: float


def tile_grid(xmin: float, xmax: float, ymin: float, ymax: float, tile: float) -> list[Rect]:
    """Core rectangles row by row, the last ones ending at the maximum; a degenerate box is one padded tile."""
    if xmax - xmin <= 0 or ymax - ymin <= 0:
        return [Rect(xmin - 1e-3, xmax + 1e-3, ymin - 1e-3, ymax + 1e-3)]
    nx, ny = (max(1, math.ceil((b - a) / tile)) for a, b in ((xmin, xmax), (ymin, ymax)))
    return [Rect(xmin + i * tile, min(xmin + (i + 1) * tile, xmax), ymin + j * tile, min(ymin + (j + 1) * tile, ymax)) for i in range(nx) for j in range(ny)]
