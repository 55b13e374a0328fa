"""Ground by a falling cloth, relaxed on tiles that exchange their rims.

The cloud is turned upside down and a cloth of square cells falls on it: gravity
and inertia move cells that hang free, each is pulled towards its neighbours a
few times a step, and a cell that meets the lowest point of its column (the
highest, upside down) stays there. Ground is what lies close to the cloth. Cells
exist where points are and up to `margin` cells around. A round takes `steps`
steps: a tile holds the cells around it that these can reach, so tiles meet only
between rounds and their size changes nothing. Rounds go on until no free cell
moves much.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut, discard
from . import grid

#: Fixed values of the simulation: share of the speed that is lost, and the pull downwards.
DAMPING, GRAVITY = 0.01, 0.2


def fallen(z: np.ndarray, old: np.ndarray, floor: np.ndarray, steps: int, rigidness: int, time_step: float) -> tuple[np.ndarray, np.ndarray]:
    """(z, z a step before) after some steps; NaN where there is no cell, floor -inf where nothing is met."""
    there = ~np.isnan(z)
    near = [(slice(1, None), slice(None)), (slice(None, -1), slice(None)), (slice(None), slice(1, None)), (slice(None), slice(None, -1))]
    pairs = [(near[0], near[1]), (near[1], near[0]), (near[2], near[3]), (near[3], near[2])]
    count = np.zeros(z.shape)
    for to, of in pairs:
        count[to] += there[of]
    for _ in range(steps):
        free = there & (z > floor)
        new = np.where(free, z + (z - old) * (1 - DAMPING) - GRAVITY * time_step**2, z)
        for _ in range(rigidness):
            total = np.zeros(z.shape)
            for to, of in pairs:
                total[to] += np.where(there[of], new[of], 0.0)
            pull = np.where(count > 0, total / np.maximum(count, 1) - new, 0.0)
            new = np.where(free, new + 0.3 * pull, new)
        z, old = np.where(there, np.maximum(new, floor), np.nan), z
    return z, old


def _round(state: DataFrame, tile: int, steps: int, rigidness: int, time_step: float) -> DataFrame:
    rim = steps * rigidness

    def work(key, table):
        tx, ty = key[0].as_py(), key[1].as_py()
        get = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
        x, y = get("ix") - tx * tile + rim, get("iy") - ty * tile + rim
        side = tile + 2 * rim
        z, old, floor = np.full((side, side), np.nan), np.full((side, side), np.nan), np.full((side, side), -np.inf)
        z[x, y], old[x, y], floor[x, y] = get("z"), get("old"), get("floor")
        new, before = fallen(z, old, floor, steps, rigidness, time_step)
        own = (x >= rim) & (x < rim + tile) & (y >= rim) & (y < rim + tile)
        x, y = x[own], y[own]
        return pa.table({"ix": x + tx * tile - rim, "iy": y + ty * tile - rim, "z": new[x, y], "old": before[x, y], "floor": floor[x, y]})

    framed = grid._framed(state, tile, rim)
    return framed.groupBy("tx", "ty").applyInArrow(work, "ix bigint, iy bigint, z double, old double, floor double")


def cloth(points: DataFrame, cell: float = 0.8, rigidness: int = 3, time_step: float = 0.65, iterations: int = 500, still: float = 0.005, margin: int = 2, tile: int = 64, steps: int = 10) -> DataFrame:
    """ix, iy, gz: the height of the cloth when it lies still, or after so many steps."""
    lows = cut(grid.with_cells(points, cell).groupBy(*grid.CELL).agg((-F.min("z")).alias("floor")))
    top = lows.agg(F.max("floor")).first()[0]
    every = grid.dilate(lows.select(*grid.CELL), margin).join(lows, grid.CELL, "left")
    start = F.lit((top or 0.0) + 0.1)
    state = cut(every.select(*grid.CELL, start.alias("z"), start.alias("old"), F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))
    for _ in range(-(-iterations // steps)):
        before, state = state, cut(_round(state, tile, steps, rigidness, time_step))
        discard(before)
        moved = state.where(F.col("z") > F.col("floor")).agg(F.max(F.abs(F.col("z") - F.col("old")))).first()[0]
        if moved is None or moved < still:
            break
    return state.select(*grid.CELL, (-F.col("z")).alias("gz"))


def cloth_ground(points: DataFrame, threshold: float = 0.35, cell: float = 0.8, **options) -> DataFrame:
    """point_id of the points closer than threshold to the cloth of their cell."""
    placed = grid.with_cells(points.drop("gz"), cell).join(cloth(points, cell, **options), grid.CELL)
    return placed.where(F.abs(F.col("z") - F.col("gz")) < threshold).select("point_id")
