"""Spatial joins by buckets: within a radius, and nearest within a radius, in the plane."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.storage import cut
from .quadtree import LEAF, dealt
from .search import exposed, fitted, nearest_one

AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def bucket(size: float) -> list[Column]:
    return [F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by")]


def spread(targets: DataFrame, size: float, keep: list[str] = ()) -> DataFrame:
    """bx, by, tx, ty and t_* columns: each target in the nine buckets around its own."""
    own = targets.select(*bucket(size), F.col("x").alias("tx"), F.col("y").alias("ty"), *[F.col(k).alias(f"t_{k}") for k in keep])
    near = F.explode(F.array(*[F.struct((F.col("bx") + i).alias("bx"), (F.col("by") + j).alias("by")) for i, j in AROUND])).alias("b")
    return own.select(near, *own.columns[2:]).select("b.bx", "b.by", *own.columns[2:])


def _d2() -> Column:
    dx, dy = F.col("x") - F.col("tx"), F.col("y") - F.col("ty")
    return dx * dx + dy * dy


def near(points: DataFrame, source: Column, target: Column, radius: float, name: str = "near") -> DataFrame:
    """Adds a boolean: a source point has a target point closer than radius in the plane (strictly).

    A semi-join stops at a point's first target, so dense surroundings cost no
    more than thin ones; only the targets are spread over buckets.
    """
    p = points.where(source).select("point_id", "x", "y", *bucket(radius)).alias("p")
    t = spread(points.where(target), radius).alias("t")
    hit = p.join(t, F.expr("p.bx = t.bx AND p.by = t.by") & (_d2() < radius * radius), "left_semi")
    return points.join(hit.select("point_id", F.lit(True).alias(name)), "point_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))


def finite(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.abs(c) < float("inf") for c in columns])


def spacing(points: DataFrame, cell: float) -> tuple[int, float]:
    """(rows, mean distance between them in the plane): over the cells of this width that hold any."""
    n, cells = points.groupBy(*bucket(cell)).agg(F.count("*").alias("n")).agg(F.sum("n"), F.count("*")).first()
    return n or 0, cell * (cells / n) ** 0.5 if n else cell


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def plane(table: pa.Table, which: np.ndarray) -> np.ndarray:
    return np.column_stack([column(table, c)[which] for c in "xy"])


def searched(rows: DataFrame, keep: list[str], radius: float, side: float, cap: int) -> DataFrame:
    """point_id, x, y, d2 and columns n_* for each source of rows with is_source and is_target; null without a target closer than radius."""
    kinds = dict(rows.dtypes)
    schema = "point_id bigint, x double, y double, d2 double" + "".join(f", n_{k} {kinds[k]}" for k in keep)

    def search(table: pa.Table) -> pa.Table:
        own = np.flatnonzero(column(table, "is_source") & column(table, "is_core"))
        there = np.flatnonzero(column(table, "is_target").astype(bool))
        sources, targets, ids = plane(table, own), plane(table, there), column(table, "point_id")
        best, d2 = np.full(len(own), -1), np.full(len(own), np.inf)
        if len(own) and len(there):
            best, d2 = nearest_one(sources, targets, ids[there], radius, fitted(targets, 2))
        hit = best >= 0
        theirs = table.take(pa.array(there[best[hit]])) if hit.any() else table.slice(0, 0)
        place = pa.array(np.cumsum(hit) - 1, mask=~hit)
        found = {f"n_{k}": theirs[k].take(place) for k in keep}
        return pa.table({"point_id": ids[own], "x": sources[:, 0], "y": sources[:, 1], "d2": pa.array(d2, mask=~hit)} | found)

    placed = dealt(rows, side, cap, radius).where("is_target OR is_core")
    return placed.groupBy(*LEAF).applyInArrow(search, schema)


def outer(targets: DataFrame, reach: float, side: float, cap: int) -> DataFrame:
    """A written table of the targets (x, y and more) that may be nearest to a place at least `reach` away, among others that are not: few where they lie close."""

    names = targets.columns

    def search(table: pa.Table) -> pa.Table:
        core = column(table, "is_core").astype(bool)
        every = plane(table, slice(None))
        own = every[core]
        out = np.flatnonzero(core)
        if len(own):
            out = out[exposed(own, every, reach, fitted(every, 6))]
        return table.take(pa.array(out)).select(names)

    return cut(dealt(targets, max(side, reach), cap, reach).groupBy(*LEAF).applyInArrow(search, targets.schema))


def beside(rows: DataFrame, others: DataFrame, size: float) -> DataFrame:
    """The rows whose cell of this width, or one next to it, holds one of the others."""
    cells = others.select(*bucket(size)).distinct()
    near = F.explode(F.array(*[F.struct((F.col("bx") + i).alias("bx"), (F.col("by") + j).alias("by")) for i, j in AROUND])).alias("b")
    return rows.select("*", *bucket(size)).join(cut(cells.select(near).select("b.*").distinct()), ["bx", "by"], "left_semi").drop("bx", "by")


def nearest(points: DataFrame, source: Column, target: Column, radius: float, keep: list[str], first: float | None = None, cap: int = 200_000) -> DataFrame:
    """point_id, d2 and columns n_* of the nearest target closer than radius, ties to the smaller target id.

    Each leaf of a quadtree searches for its own points among the targets that it or
    its halo holds. Where targets lie close, the halo is a few times their distance;
    points that found nothing there are at least that far from all targets and go on
    with those that may be nearest from afar, the rims of where targets lie.
    """
    extra = [k for k in keep if k not in ("point_id", "x", "y")]
    rows = points.where((source | target) & finite("x", "y")).select("point_id", "x", "y", F.coalesce(source, F.lit(False)).alias("is_source"), F.coalesce(target, F.lit(False)).alias("is_target"), *extra)
    targets = rows.where("is_target")
    n, apart = spacing(targets, radius)
    reach = first or (6 * apart if apart * 100 < radius else radius)
    side = max(2 * min(reach, radius), min(1.0, apart * cap**0.5 / 4))
    if reach >= radius:
        return searched(rows, keep, radius, side, cap).where("d2 IS NOT NULL").drop("x", "y")
    near = cut(searched(rows, keep, reach, side, cap))
    left = near.where("d2 IS NULL").select("point_id", "x", "y")
    done = near.where("d2 IS NOT NULL").drop("x", "y")
    if left.isEmpty():
        return done
    rims = outer(beside(targets.drop("is_source"), left, radius), reach, side, cap)
    blank = [F.lit(None).cast(kind).alias(k) for k, kind in rows.select(*extra).dtypes]
    ends = rims.select("point_id", "x", "y", F.lit(False).alias("is_source"), F.lit(True).alias("is_target"), *extra)
    rest = left.select("point_id", "x", "y", F.lit(True).alias("is_source"), F.lit(False).alias("is_target"), *blank)
    far = searched(beside(rest, rims, radius).union(ends), keep, radius, 2 * radius, cap)
    return done.union(far.where("d2 IS NOT NULL").drop("x", "y"))


def nearest_distance(points: DataFrame, targets: DataFrame, limit: float, finest: float = 0.1) -> DataFrame:
    """point_id, distance to the nearest target in the plane, for points that have one closer than limit."""
    return distances(points, targets, limit, finest).where("distance IS NOT NULL")


def distances(points: DataFrame, targets: DataFrame, limit: float, finest: float = 0.1, cap: int = 200_000) -> DataFrame:
    """point_id of all points, distance to the nearest target in the plane or null if none is closer than limit.

    Points in or beside cells with targets search the leaf that they lie in. What is
    at least a 64th of the limit away from all targets needs their rims only, those
    that may be nearest from afar. Occupied cells of points and rims are compared
    first, from large cells to small ones: a pair of cells lives while its least
    possible distance is not above the least greatest possible one of its point cell;
    then the boxes of the targets in these cells. Of the targets left a point cell
    keeps those that no other one beats in the whole cell, a handful, and its points
    meet these where they are: most points are not shuffled.
    """
    levels = 0
    while limit / 2 ** (levels + 1) >= finest:
        levels += 1
    size = limit / 2**levels
    p = points.select("point_id", "x", "y", *bucket(size))
    reach = limit / 64
    targets = targets.where(finite("x", "y")).groupBy("x", "y").agg(F.min("point_id").alias("point_id")) if "point_id" in targets.columns else targets.where(finite("x", "y")).select("x", "y").distinct().withColumn("point_id", F.lit(0).cast("long"))
    targets = cut(targets)
    _, apart = spacing(targets, reach)
    side = max(2 * reach, min(1.0, apart * cap**0.5 / 4))
    cell = [F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy")]
    t = cut(outer(targets, reach, side, cap).select(*cell, F.col("x").alias("tx"), F.col("y").alias("ty")))
    sides = [f(c).alias(f"{c}{n}") for c in ("tx", "ty") for f, n in ((F.min, 0), (F.max, 1))]
    theirs, mine = cut(t.groupBy("cx", "cy").agg(*sides)), cut(p.where(finite("x", "y")).select("bx", "by").distinct())
    up = lambda c, n: F.floor(F.col(c) / 2**n)
    least = lambda a, b: F.greatest(F.abs(F.col(a) - F.col(b)) - 1, F.lit(0))
    most = lambda a, b: F.abs(F.col(a) - F.col(b)) + 1
    pairs = mine.select(up("bx", levels).alias("bx"), up("by", levels).alias("by")).distinct()
    top = theirs.select(up("cx", levels).alias("cx"), up("cy", levels).alias("cy")).distinct()
    beside = F.explode(F.array(*[F.struct((F.col("cx") + i).alias("bx"), (F.col("cy") + j).alias("by")) for i, j in AROUND])).alias("b")
    pairs = pairs.join(top.select("cx", "cy", beside).select("cx", "cy", "b.*"), ["bx", "by"])
    for level in range(levels - 1, -1, -1):
        child = lambda table, a, b: table.select(up(a, level).alias(f"n{a}"), up(b, level).alias(f"n{b}")).distinct().select(F.floor(F.col(f"n{a}") / 2).alias(a), F.floor(F.col(f"n{b}") / 2).alias(b), f"n{a}", f"n{b}")  # noqa: B023, E731
        down = pairs.join(child(mine, "bx", "by"), ["bx", "by"]).join(child(theirs, "cx", "cy"), ["cx", "cy"]).select(*[F.col(f"n{c}").alias(c) for c in ("bx", "by", "cx", "cy")])
        bounds = down.withColumn("low", least("bx", "cx") ** 2 + least("by", "cy") ** 2).withColumn("best", F.min(most("bx", "cx") ** 2 + most("by", "cy") ** 2).over(Window.partitionBy("bx", "by")))
        pairs = bounds.where((F.col("low") <= F.col("best")) & (F.col("low") * size * size * 4**level < limit * limit)).select("bx", "by", "cx", "cy")
    names = ["cx", "cy", "tx0", "tx1", "ty0", "ty1"]
    to = lambda c, v: F.greatest(c[f"t{v}0"] - F.col(v), F.col(v) - c[f"t{v}1"], F.lit(0.0))
    near_side = lambda c, v: F.least(F.abs(F.col(v) - c[f"t{v}0"]), F.abs(F.col(v) - c[f"t{v}1"]))
    far_side = lambda c, v: F.greatest(F.abs(F.col(v) - c[f"t{v}0"]), F.abs(F.col(v) - c[f"t{v}1"]))
    bound = lambda c: F.least(near_side(c, "x") ** 2 + far_side(c, "y") ** 2, far_side(c, "x") ** 2 + near_side(c, "y") ** 2)
    # the same of a whole point cell, from its middle: all its points are within half a diagonal of that
    middle = pairs.join(theirs, ["cx", "cy"]).select("bx", "by", F.struct(*names).alias("c"), ((F.col("bx") + 0.5) * size).alias("x"), ((F.col("by") + 0.5) * size).alias("y"))
    bounds = middle.withColumn("low", F.sqrt(to(F.col("c"), "x") ** 2 + to(F.col("c"), "y") ** 2)).withColumn("best", F.min(F.sqrt(bound(F.col("c")))).over(Window.partitionBy("bx", "by")))
    chosen = bounds.where(F.col("low") <= F.col("best") + 1.4143 * size).select("bx", "by", "c.cx", "c.cy")
    theirs = chosen.join(t, ["cx", "cy"]).groupBy("bx", "by").agg(F.collect_list(F.struct(F.col("tx").alias("x"), F.col("ty").alias("y"))).alias("ends"))

    def unbeaten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bx, by = (batch.column(k).to_numpy() for k in (0, 1))
            ends = batch.column(2)
            stop, xy = ends.offsets.to_numpy(), np.column_stack([ends.values.field(k).to_numpy() for k in (0, 1)])
            keep, count = [], [0]
            for i in range(len(bx)):
                own = xy[stop[i] : stop[i + 1]]
                far = np.stack([((own - (np.array([bx[i] + a, by[i] + b]) * size)) ** 2).sum(1) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1), (0.5, 0.5))])
                # one that is closer to all four corners of a cell is closer to all of it
                beaten = (far[:4, far.argmin(1), None] * (1 + 1e-9) + 1e-12 < far[:4, None, :]).all(0).any(0)
                keep.append(own[~beaten])
                count.append(len(keep[-1]))
            kept = np.concatenate(keep) if keep else np.zeros((0, 2))
            rows = pa.ListArray.from_arrays(pa.array(np.cumsum(count), pa.int32()), pa.StructArray.from_arrays([pa.array(kept[:, 0]), pa.array(kept[:, 1])], ["x", "y"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["bx", "by", "ends"])

    lists = cut(theirs.mapInArrow(unbeaten, theirs.schema))
    rows = points.select("point_id", "x", "y")
    by = [F.floor(F.col(c) / reach).alias(f"n{c}") for c in "xy"]
    around = F.explode(F.array(*[F.struct((F.col("nx") + i).alias("nx"), (F.col("ny") + j).alias("ny")) for i, j in AROUND])).alias("b")
    close = cut(targets.select(*by).distinct().select(around).select("b.*").distinct())
    placed = rows.select("*", *by)
    whole = finite("x", "y")
    beside_some = placed.where(whole).join(close, ["nx", "ny"], "left_semi").select(*rows.columns, F.lit(True).alias("is_source"), F.lit(False).alias("is_target"))
    rest = placed.where(whole).join(close, ["nx", "ny"], "left_anti").union(placed.where(F.coalesce(~whole, F.lit(True))).select("nx", "ny", *rows.columns)).select(*rows.columns, F.lit(None).cast("double").alias("d2"))
    ends = targets.select("point_id", "x", "y", F.lit(False).alias("is_source"), F.lit(True).alias("is_target"))
    every = searched(beside_some.union(ends), [], reach, side, cap).union(rest)
    afar = F.array_min(F.transform("ends", lambda e: (F.col("x") - e["x"]) * (F.col("x") - e["x"]) + (F.col("y") - e["y"]) * (F.col("y") - e["y"])))
    found = every.select("*", *bucket(size)).join(lists, ["bx", "by"], "left").select("point_id", F.coalesce("d2", afar).alias("d2"))
    return found.select("point_id", F.when(F.col("d2") < limit * limit, F.sqrt("d2")).alias("distance"))
