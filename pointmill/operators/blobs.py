"""Connected blobs of cells and group shapes, judged by their aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from ..sources.points import BUILDING, GROUND, LOW_VEG, NOISE, VEHICLE, height, relabel
from . import grid, terrain
from .rules import VEGETATION, is_class
from .spatial import near


def extents() -> list[Column]:
    return [F.count("*").alias("n"), *[(F.max(c) - F.min(c)).alias(f"d{c}") for c in "xyz"]]


def edges() -> list[Column]:
    return [*[f(c).alias(f"{c}{s}") for c in "xy" for f, s in ((F.min, "min"), (F.max, "max"))], F.max("z").alias("zmax")]


def blobs(points: DataFrame, among: Column, cell: float, prepare=None) -> DataFrame:
    """The points of `among` with ix, iy and the component of their cell; prepare may dilate or open the cells."""
    chosen = grid.with_cells(points, cell, among).where(among)
    cells = chosen.select(*grid.CELL).distinct()
    return chosen.join(grid.components(prepare(cells) if prepare else cells), grid.CELL)


def mark_blobs(points: DataFrame, members: DataFrame, keep: DataFrame, target: int, only: Column | None = None) -> DataFrame:
    hit = members.join(keep.select("component"), "component", "left_semi").select("point_id").distinct().withColumn("hit", F.lit(True))
    condition = F.coalesce("hit", F.lit(False))
    return relabel(points.join(hit, "point_id", "left"), condition if only is None else condition & only, target).drop("hit")


def car_blobs(points: DataFrame, sources=VEGETATION, band: tuple[float, float] = (0.35, 2.3), cell: float = 0.25, length: tuple[float, float] = (2.0, 8.0), width: tuple[float, float] = (1.15, 3.9), count: tuple[int, int] = (120, 120_000), p50: float = 0.40, p90: float = 2.35, under_tall: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(member points, box of each car-shaped blob); with under_tall, points under something that tall are left out."""
    h = height()
    chosen = is_class(*sources) & h.between(*band)
    if under_tall is not None:
        tall = grid.dilate(grid.with_cells(points, 0.40).where(h >= under_tall).select(*grid.CELL).distinct(), 1, cross=True)
        points = grid.mark(grid.with_cells(points, 0.40), tall, "tall").drop(*grid.CELL)
        chosen = chosen & ~F.col("tall")
    members = blobs(points, chosen, cell, lambda c: grid.opened(c, 2))
    stats = members.withColumn("h", height()).groupBy("component").agg(*extents(), F.percentile("h", 0.5).alias("p50"), F.percentile("h", 0.9).alias("p90"), *edges())
    long, wide = F.greatest("dx", "dy"), F.least("dx", "dy")
    fits = long.between(*length) & wide.between(*width) & (wide / long).between(0.28, 0.90) & F.col("n").between(*count)
    fits = fits & F.col("p50").between(p50, 1.9) & (F.col("p90") <= p90) & F.col("dz").between(0.45, 2.7) & (F.col("n") / (long * wide) >= 10)
    return members, stats.where(fits).select("component", "xmin", "xmax", "ymin", "ymax", "zmax")


def find_car_blobs(points: DataFrame, target: int = VEHICLE, **options) -> tuple[DataFrame, DataFrame]:
    """(points, boxes of the blobs that became target)."""
    members, boxes = car_blobs(points, **options)
    members, boxes = cut(members), cut(boxes)
    return mark_blobs(points, members, boxes, target), boxes.drop("component")


def extract_car_blobs(points: DataFrame, target: int = VEHICLE, **options) -> DataFrame:
    members, boxes = car_blobs(points, **options)
    return mark_blobs(points, members, boxes, target)


def restore_curbs(points: DataFrame, noise: int = NOISE, target: int = LOW_VEG, cell: float = 0.15, band: tuple[float, float] = (0.06, 0.50), least: int = 4, length: float = 0.7, width: float = 0.42) -> DataFrame:
    """Long thin blobs of low noise, measured over the cells of the dilated blob."""
    chosen = is_class(noise) & height().between(*band)
    own = grid.with_cells(points, cell, chosen).where(chosen)
    spread = grid.components(grid.dilate(own.select(*grid.CELL).distinct(), 1))
    members = own.join(spread, grid.CELL)
    span = lambda c: (F.max(c) - F.min(c)) * cell
    shapes = spread.groupBy("component").agg(span("ix").alias("dx"), span("iy").alias("dy"))
    long, wide = F.greatest("dx", "dy"), F.least("dx", "dy")
    thin = shapes.where((long >= length) & (wide <= width) & (long / F.greatest(wide, F.lit(cell / 2)) >= 3))
    many = members.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return mark_blobs(points, members, thin.join(many, "component", "left_semi"), target)


def demote_pedestrians(points: DataFrame, target: int = NOISE, cell: float = 0.22, band: tuple[float, float] = (0.85, 2.35), count: tuple[int, int] = (10, 2500), width: float = 0.55, length: float = 0.95, aspect: float = 2.4, span: float = 0.75) -> DataFrame:
    """Small upright blobs of building points."""
    members = blobs(points, is_class(BUILDING) & height().between(*band), cell)
    stats = members.withColumn("h", height()).groupBy("component").agg(*extents(), F.avg("h").alias("mean"))
    long, wide = F.greatest("dx", "dy"), F.least("dx", "dy")
    keep = stats.where(F.col("n").between(*count) & (wide <= width) & (long <= length) & (long / F.greatest(wide, F.lit(0.04)) <= aspect) & F.col("dz").between(span, 2.5) & F.col("mean").between(*band))
    return mark_blobs(points, members, keep, target)


def peel_islands(points: DataFrame, target: int = NOISE, cell: float = 0.18, band: tuple[float, float] = (0.025, 0.85), least: int = 12, length: float = 3.5, width: float = 1.4, surface_cell: float = 0.3, protect_m: float = 0.0, protect_h: float = 2.8) -> DataFrame:
    """Compact ground blobs raised over the local ground minimum."""
    local = terrain.with_surface(points.drop("gz"), terrain.ground_surface(points, is_class(GROUND), surface_cell), surface_cell)
    chosen = is_class(GROUND) & height().between(*band)
    members = blobs(local, chosen, cell, lambda c: grid.opened(c, 3))
    stats = members.groupBy("component").agg(*extents(), F.avg(height()).alias("mean"), F.max(height()).alias("top"))
    long, wide = F.greatest("dx", "dy"), F.least("dx", "dy")
    flat = (F.col("mean") < band[0] + 0.005) & (F.col("top") < band[0] + 0.025)
    keep = stats.where((F.col("n") >= least) & (long <= length) & (wide <= width) & ~flat & ~((F.col("n") > 30_000) & (long > 2.5)))
    if protect_m <= 0:
        return mark_blobs(points, members, keep, target)
    guarded = near(points, is_class(GROUND), is_class(BUILDING), protect_m)
    return mark_blobs(guarded, members, keep, target, ~(F.col("near") & (height() < protect_h))).drop("near")


def vehicle_boxes(points: DataFrame, vehicle: int = VEHICLE, cell: float = 0.5, least: int = 80) -> DataFrame:
    """Boxes of car-sized blobs of vehicle points."""
    members = blobs(points, is_class(vehicle), cell)
    stats = members.groupBy("component").agg(*extents(), *edges())
    long, wide = F.greatest("dx", "dy"), F.least("dx", "dy")
    return stats.where(long.between(1.2, 12) & wide.between(0.4, 5) & (wide / long <= 0.92) & (F.col("n") >= least)).select("xmin", "xmax", "ymin", "ymax", "zmax", "n")


def blob_sizes(points: DataFrame, vehicle: int = VEHICLE, cell: float = 0.25, least: int = 8) -> DataFrame:
    """n, n_cells, long, wide of each blob of vehicle points with at least so many cells."""
    members = blobs(points, is_class(vehicle), cell)
    sizes = members.groupBy("component").agg(*extents(), F.count_distinct(*grid.CELL).alias("n_cells")).where(F.col("n_cells") >= least)
    return sizes.select("component", "n", "n_cells", F.greatest("dx", "dy").alias("long"), F.least("dx", "dy").alias("wide"))


def group_shapes(points: DataFrame, key: str = "group_id") -> DataFrame:
    """Aggregates of each group that the shape rules need, and its box."""
    c = {a + b: (F.covar_pop(a, b) if a != b else F.var_pop(a)).alias(f"c{a}{b}") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    h = height()
    return (
        points.groupBy(key)
        .agg(*extents(), F.percentile(h, 0.5).alias("p50"), F.percentile(h, 0.9).alias("p90"), *c.values(), *edges())
        .withColumn("long", F.greatest("dx", "dy"))
        .withColumn("wide", F.least("dx", "dy"))
        .withColumn("density", F.col("n") / F.greatest(F.col("long") * F.col("wide"), F.lit(0.01)))
        .withColumn("flatness", _eigen_ratio())
    )


def _eigen_ratio() -> Column:
    """Least over greatest eigenvalue of the symmetric 3 x 3 covariance, in closed form."""
    xx, yy, zz, xy, xz, yz = (F.col(f"c{k}") for k in ("xx", "yy", "zz", "xy", "xz", "yz"))
    q = (xx + yy + zz) / 3
    p = F.sqrt(((xx - q) ** 2 + (yy - q) ** 2 + (zz - q) ** 2 + 2 * (xy**2 + xz**2 + yz**2)) / 6)
    a, b, d = (xx - q) / p, (yy - q) / p, (zz - q) / p
    e, f, g = xy / p, xz / p, yz / p
    r = (a * (b * d - g * g) - e * (e * d - g * f) + f * (e * g - b * f)) / 2
    phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))) / 3
    most, least = q + 2 * p * F.cos(phi), q + 2 * p * F.cos(phi + 2.0943951023931953)
    return F.when((p > 0) & (most > 0), least / most).otherwise(F.when(q > 0, 1.0).otherwise(0.0))


def is_car(strict: bool = False, max_upright: float = 2.2) -> Column:
    """A condition on group_shapes."""
    c = F.col
    aspect = c("wide") / F.greatest("long", F.lit(0.01))
    ok = c("dz") / F.greatest("wide", F.lit(0.05)) <= max_upright
    if not strict:
        return ok & c("long").between(1.2, 12) & c("wide").between(0.40, 5) & c("dz").between(0.20, 4) & c("p90").between(0.12, 2.5) & (c("n") >= 20) & (c("density") >= 6) & (aspect <= 0.92)
    shape = c("long").between(2, 8.5) & c("wide").between(1.1, 3.9) & c("dz").between(0.55, 2.6) & c("p90").between(0.45, 2.4) & c("p50").between(0.30, 1.8)
    solid = (c("n") / (c("long") * c("wide") * F.greatest("dz", F.lit(0.3))) >= 6) & (c("flatness") >= 0.035)
    return ok & shape & c("n").between(80, 120_000) & (c("density") >= 12) & aspect.between(0.28, 0.88) & solid


def is_ghost() -> Column:
    c = F.col
    small = (c("n") < 900) & (c("long") > 3.2) & (c("wide") < 1.8) & (c("dz") < 2.6) & (c("density") < 140)
    post = c("dz") / F.greatest("wide", F.lit(0.05)) > 2.2
    rail = (c("dz") >= 0.45) & (c("dz") / F.greatest("long", F.lit(0.01)) > 0.22)
    curb = (c("long") >= 1.2) & (c("wide") <= 0.42) & c("dz").between(0.06, 0.55)
    return small & ~post & ~rail & ~curb


def is_pedestrian(least: int = 22) -> Column:
    c = F.col
    return c("wide").between(0.25, 1.0) & c("long").between(0.20, 1.4) & (c("dz") <= 2.2) & c("p50").between(1.0, 2.1) & (c("n") >= least)
