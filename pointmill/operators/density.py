"""Density groups of points, the object rules on them, and outliers, as joins.

Voxel centroids stand for their points. A centroid is dense if at least
`samples` points lie within `epsilon` of it, itself counted; dense centroids
closer than that are connected, and each component of at least `least` points
is a group. This is the density hierarchy cut at `epsilon`; `density_hierarchy`
keeps the most stable groups of all cuts up to a distance instead. Links are
found in the leaves of a quadtree and leave them contracted; what they connect is
joined across leaves, so no tile cuts a group however long it is.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from ..sources.points import CAR, GHOST, MED_VEG, PEDESTRIAN, VEHICLE, height
from . import grid
from .blobs import group_shapes, is_car, is_ghost, is_pedestrian
from .graph import connected_components
from .links import links
from .quadtree import LEAF, dealt
from .rules import is_class, peel_car_volume
from .search import closest, fitted
from .spatial import bucket, column, finite

VOXEL = ["vx", "vy", "vz"]
EDGES = ["xmin", "xmax", "ymin", "ymax", "zmax"]


def boxes(size: float) -> list[Column]:
    return [F.floor(F.col(c) / size).alias(f"b{c}") for c in "xyz"]


def _centroids(boxed: DataFrame) -> DataFrame:
    """id, vx, vy, vz, x, y, z, n: a written table of the voxels of a cloud."""
    means = boxed.groupBy(*VOXEL).agg(*[F.avg(c).alias(c) for c in "xyz"], F.count("*").alias("n"))
    return cut(means.withColumn("id", F.monotonically_increasing_id()))


def _joined(parts: DataFrame, between: DataFrame) -> DataFrame:
    """part, node: the least part that each one is connected with."""
    found = connected_components(between)
    return parts.select("part").distinct().join(found, F.col("part") == found["id"], "left").select("part", F.coalesce("component", "part").alias("node"))


def density_groups(points: DataFrame, least: int = 30, samples: int = 6, epsilon: float = 0.4, voxel: float = 0.08, cap: int = 100_000) -> DataFrame:
    """points with group_id (the least cell of the group; null for noise)."""
    boxed = grid.with_voxels(points, voxel)
    centroids = _centroids(boxed)
    parts, between = links(centroids, [epsilon], samples, cap)
    dense = parts.where("core = 0")
    nodes = _joined(dense, between)
    side = epsilon / 3**0.5
    cells = centroids.select("id", *VOXEL, "n", F.struct(*boxes(side)).alias("box"))
    own = cut(dense.join(nodes, "part").join(cells, "id").select(*VOXEL, "n", "node", "box"))
    many = own.groupBy("node").agg(F.sum("n").alias("n"), F.min("box").alias("group_id")).where(F.col("n") >= least)
    named = own.select(*VOXEL, "node").join(many.select("node", "group_id"), "node").drop("node")
    return boxed.join(named, VOXEL, "left").drop(*VOXEL)


def density_hierarchy(points: DataFrame, least: int = 30, samples: int = 6, epsilon: float = 0.2, reach: float = 1.0, steps: int = 12, voxel: float = 0.08, cap: int = 100_000) -> DataFrame:
    """points with group_id: the most stable groups of the density hierarchy, null for noise.

    Distances between centroids count as at least `epsilon` and are rounded up to
    rungs, `steps` of them up to `reach`, evenly on a logarithmic scale; links
    beyond are none, and all that is left is taken as joined one rung above. A
    point's core rung holds `samples` points around it, itself counted, and a link
    lies on the greatest of its ends' core rungs and its distance's. On each rung
    components of `least` points or more are groups; a group ends where it falls
    into several. It counts, for each of its points, 1 / distance where the point
    leaves less 1 / distance where the group begins. A group stays if that is at
    least the sum of the best of what it falls into; a point belongs to the topmost
    group that stays among those it is in.
    """
    rungs = [epsilon * (reach / epsilon) ** (k / steps) for k in range(steps + 2)]
    boxed = grid.with_voxels(points, voxel)
    centroids = _centroids(boxed)
    parts, between = links(centroids, rungs[:-1], samples, cap)
    between = cut(between)
    nodes = cut(_joined(parts, between.where("rung = 0").select("a", "b")))
    at = parts.select("id", "part").join(nodes, "part").select("id", "node")
    sizes = at.join(centroids.select("id", "n"), "id").groupBy("node").agg(F.sum("n").alias("n"))

    # the components of every rung at once, over nodes that the lowest rung has joined
    to = lambda c: nodes.select(F.col("part").alias(c), F.col("node").alias(f"n{c}"))
    upper = between.where("rung > 0").join(to("a"), "a").join(to("b"), "b").where("na <> nb")
    on = upper.select("na", "nb", F.explode(F.sequence(F.col("rung"), F.lit(steps))).alias("level"))
    found = connected_components(on.select(F.struct("level", F.col("na").alias("node")).alias("a"), F.struct("level", F.col("nb").alias("node")).alias("b")))
    found = found.select("id.level", "id.node", F.col("component.node").alias("comp"))
    every = sizes.select("node", "n", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("level"))
    paths = cut(every.join(found, ["level", "node"], "left").select("level", "node", "n", F.coalesce("comp", "node").alias("comp")))

    # components of enough points, and which of them begin: those on the top rung and those with brothers
    large = paths.groupBy("level", "comp").agg(F.sum("n").alias("size")).where(F.col("size") >= least)
    above = paths.select((F.col("level") - 1).alias("level"), F.col("node").alias("comp"), F.col("comp").alias("parent"))
    large = cut(large.join(above, ["level", "comp"], "left"))
    brothers = large.where("parent IS NOT NULL").groupBy("level", "parent").agg(F.count("*").alias("k"))
    begins = large.join(brothers, ["level", "parent"], "left").select("level", "comp", ((F.col("level") == steps) | (F.col("k") > 1)).alias("head"))

    # each node's groups from the lowest up, with the lowest rung that it is in each of them
    mine = paths.join(begins, ["level", "comp"]).groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("level", "comp", "head"))).alias("path"))
    heads = F.filter("path", lambda x: x["head"])
    low = lambda i: F.when(i == 0, F.col("path")[0]["level"]).otherwise(F.get("heads", i - 1)["level"] + 1)
    key = lambda x: F.when(x.isNotNull(), F.struct(x["level"].alias("level"), x["comp"].alias("comp")))
    turns = F.transform("heads", lambda x, i: F.struct(key(x).alias("g"), low(i).alias("low"), key(F.get("heads", i + 1)).alias("up")))
    turns = cut(mine.withColumn("heads", heads).select("node", "n", F.explode(turns).alias("t")).select("node", "n", "t.*"))
    inverse = F.array(*[F.lit(1 / r) for r in rungs])
    gain = F.col("n") * (F.get(inverse, F.col("low")) - F.get(inverse, F.col("g.level") + 1))
    groups = cut(turns.groupBy("g").agg(F.sum(gain).alias("own"), F.first("up").alias("up")))
    stays = _chosen(groups)
    best = turns.join(stays, "g", "left_semi").groupBy("node").agg(F.max("g").alias("group_id"))
    named = at.join(best, "node").join(centroids.select("id", *VOXEL), "id").select(*VOXEL, "group_id")
    return boxed.join(named, VOXEL, "left").drop(*VOXEL)


def _chosen(groups: DataFrame) -> DataFrame:
    """g of the groups (g, own, up) whose own gain is at least the best that the groups they fall into reach; a round for each storey."""
    parts = groups.where("up IS NOT NULL").groupBy(F.col("up").alias("g")).agg(F.count("*").alias("parts"))
    left = cut(groups.join(parts, "g", "left"))
    done = cut(left.where("parts IS NULL").select("g", "up", F.col("own").alias("best"), F.lit(True).alias("stays")))
    left = left.where("parts IS NOT NULL")
    while not left.isEmpty():
        below = done.where("up IS NOT NULL").groupBy(F.col("up").alias("g")).agg(F.sum("best").alias("sum"), F.count("*").alias("have"))
        ready = cut(left.join(below, "g").where("have = parts").select("g", "up", F.greatest("own", "sum").alias("best"), (F.col("own") >= F.col("sum")).alias("stays")))
        done, left = done.union(ready), cut(left.join(ready, "g", "left_anti"))
    return done.where("stays").select("g")


def object_groups(points: DataFrame, car: int = CAR, person: int = PEDESTRIAN, ghost: int = GHOST, peel: dict | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(points, boxes of the cars): groups of medium vegetation that look like a car, else a ghost, else a person; then what is left of medium vegetation (or of the classes that `peel` names) in the cars' boxes."""
    found = cut(density_groups(points.where(is_class(MED_VEG)), **options).where("group_id IS NOT NULL"))
    kind = F.when(is_car(), car).when(is_ghost(), ghost).when(is_pedestrian(), person)
    kinds = cut(group_shapes(found).select("group_id", kind.alias("kind"), is_car().alias("car"), *EDGES).where("kind IS NOT NULL"))
    new = found.join(kinds.select("group_id", "kind"), "group_id").select("point_id", "kind")
    named = points.join(new, "point_id", "left").withColumn("cls", F.coalesce("kind", "cls").cast("int")).drop("kind")
    boxes = kinds.where("car").select(*EDGES)
    return peel_car_volume(named, boxes, target=car, **({"sources": (MED_VEG,)} | (peel or {}))), boxes


def object_classes(points: DataFrame, **options) -> DataFrame:
    return object_groups(points, **options)[0]


def car_groups(points: DataFrame, sources, target: int = VEHICLE, min_h: float = 0.10, max_h: float | None = None, strict: bool = False, least: int = 25, samples: int = 6, epsilon: float = 0.45, **options) -> tuple[DataFrame, DataFrame]:
    """(points, boxes): groups of source points in a height band that look like cars."""
    h = height()
    band = is_class(*sources) & (h > min_h) if max_h is None else is_class(*sources) & (h > min_h) & (h <= max_h)
    found = cut(density_groups(points.where(band), least, samples, epsilon, **options).where("group_id IS NOT NULL"))
    cars = cut(group_shapes(found).where(is_car(strict)).select("group_id", *EDGES))
    hit = found.join(cars, "group_id", "left_semi").select("point_id").withColumn("hit", F.lit(True))
    named = points.join(hit, "point_id", "left").withColumn("cls", F.when(F.col("hit"), target).otherwise(F.col("cls")).cast("int")).drop("hit")
    return named, cars.select(*EDGES)


def extract_cars(points: DataFrame, sources, target: int = VEHICLE, *args, **options) -> DataFrame:
    return car_groups(points, sources, target, *args, **options)[0]


def last_cars(points: DataFrame, target: int = VEHICLE, **options) -> DataFrame:
    """The final sweep over vegetation: cars among its groups, then what is left of it in their boxes."""
    swept, boxes = car_groups(points, (3, 4, 5), target, **options)
    return peel_car_volume(swept, boxes, target=target, sources=(3, 4, 5), pad=0.60, min_h=0.05, dilate=2)


def outliers(points: DataFrame, neighbours: int = 20, ratio: float = 2.0, radius: float | None = None, cap: int = 200_000) -> DataFrame:
    """point_id of points whose mean distance to their nearest neighbours is over the mean plus ratio deviations.

    Neighbours are sought in leaves of a quadtree, with a halo of eight times
    `radius` (by default the radius that holds twice as many in the plane at the
    cloud's mean density); each point leaves its leaf as one row. Points that have too
    few there go on, with the points around them only and a halo four times as wide,
    until they have all, so no distance is cut. Points without finite coordinates
    are neither judged nor neighbours.
    """
    p = points.select("point_id", "x", "y", "z").where(finite("x", "y", "z"))
    coarse = p.groupBy(*bucket(0.5)).agg(F.count("*").alias("n"), *[f(c).alias(f"{s}{c}") for c in "xyz" for f, s in ((F.min, "l"), (F.max, "h"))])
    n, cells, *spans = coarse.agg(F.sum("n"), F.count("*"), *[F.max(f"h{c}") - F.min(f"l{c}") for c in "xyz"]).first()
    k = min(neighbours, (n or 0) - 1)
    if k < 1:
        return points.select("point_id").limit(0)
    area = min(0.25 * cells, max(spans[0], 1e-3) * max(spans[1], 1e-3))
    halo = 8 * (radius or max((2 * k * area / (3.14 * n)) ** 0.5, 1e-3))

    def judged(table: pa.Table) -> pa.Table:
        own = np.flatnonzero(column(table, "is_core"))
        if not len(own):
            return pa.table({c: table[c].slice(0, 0) for c in ("point_id", "x", "y", "z")} | {"m": pa.nulls(0, pa.float64())})
        xyz = np.column_stack([column(table, c) for c in "xyz"])
        d2 = closest(xyz[own], xyz, k + 1, halo, fitted(xyz, 8))  # a point itself is the first
        m = np.sqrt(d2).sum(1) / k
        return pa.table({"point_id": column(table, "point_id")[own], **{c: xyz[own, i] for i, c in enumerate("xyz")}, "m": pa.array(m, mask=~np.isfinite(m))})

    first = dealt(p, max(halo, 0.25 * (cap * area / n) ** 0.5), cap, halo).groupBy(*LEAF).applyInArrow(judged, "point_id bigint, x double, y double, z double, m double")
    found = cut(first)
    each, left, last = found.where("m IS NOT NULL").select("point_id", "m"), found.where("m IS NULL").drop("m"), False
    while not (last or left.isEmpty()):
        halo *= 4
        last = halo > sum(spans)
        found = cut(_closest_afar(p, left, k + 1, halo, max(1, round(min(2 * (10 * halo) ** 2 / area, 1) * n / (5 * cap)))))
        each = each.union(found.where(F.size("near") > k).select("point_id", (F.aggregate("near", F.lit(0.0), lambda a, d2: a + F.sqrt(d2)) / k).alias("m")))
        left = found.where(F.size("near") <= k).drop("near")
    limit = each.agg((F.avg("m") + ratio * F.stddev_pop("m")).alias("limit"))
    return each.join(F.broadcast(limit)).where("m > limit").select("point_id")


def _closest_afar(p: DataFrame, left: DataFrame, k: int, halo: float, parts: int) -> DataFrame:
    """left with near: the k least squared distances below halo squared, in order. What lies around a cell of them is searched in so many parts and merged, so no task holds it all."""
    side = 8 * halo
    own = left.select("*", *bucket(side))
    asking = own.select("bx", "by").distinct()
    steps = F.explode(F.array(*[F.struct((F.col("bx") + i).alias("ix"), (F.col("by") + j).alias("iy"), F.lit(-i).alias("dx"), F.lit(-j).alias("dy")) for i, j in product((-1, 0, 1), repeat=2)])).alias("c")
    about = cut(asking.select("bx", "by", steps).select("bx", "by", "c.*"))

    def close(c: str):
        low, d = F.col(f"i{c}") * side, F.col(f"d{c}")
        return (d == 0) | ((d < 0) & (F.col(c) - low <= halo)) | ((d > 0) & (low + side - F.col(c) <= halo))

    columns = ["point_id", "x", "y", "z", "bx", "by"]
    met = p.select("point_id", "x", "y", "z", F.floor(F.col("x") / side).alias("ix"), F.floor(F.col("y") / side).alias("iy")).join(about, ["ix", "iy"]).where(close("x") & close("y"))
    targets = met.select(*columns, F.pmod(F.xxhash64("point_id"), F.lit(parts)).alias("part"), F.lit(False).alias("asks"))
    queries = own.select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(True).alias("asks"))

    def search(table: pa.Table) -> pa.Table:
        asks = column(table, "asks").astype(bool)
        xyz = np.column_stack([column(table, c) for c in "xyz"])
        q, t = np.flatnonzero(asks), xyz[~asks]
        d2 = np.full((len(q), k), np.inf)
        if len(q) and len(t):
            d2 = closest(xyz[q], t, k, halo, fitted(t, 8))
        there = np.isfinite(d2)
        ends = pa.array(np.append(0, np.cumsum(there.sum(1))), pa.int32())
        rows = table.take(pa.array(q)).select(["point_id", "x", "y", "z"])
        return rows.append_column("near", pa.ListArray.from_arrays(ends, pa.array(d2[there])))

    found = targets.union(queries).groupBy("bx", "by", "part").applyInArrow(search, "point_id bigint, x double, y double, z double, near array<double>")
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k)
    return found.groupBy("point_id", "x", "y", "z").agg(merged.alias("near"))
