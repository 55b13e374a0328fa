"""Rules that rewrite cls from heights, cells, voxels and neighbours.

Every rule takes points with cls, z and gz and returns the same points; it reads
the classes of its input only, so its result does not depend on row order or
partitioning. Cells are aggregated with partial aggregates and joined back as
small marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.points import BUILDING, GROUND, HIGH_VEG, LOW_VEG, MED_VEG, NOISE, VEHICLE, height, relabel
from . import grid
from .spatial import near, nearest

VEGETATION = (LOW_VEG, MED_VEG, HIGH_VEG)


def is_class(*classes: int) -> Column:
    return F.col("cls").isin(*classes)


# heights


def layers(points: DataFrame, low: float = 0.35, high: float = 2.2) -> DataFrame:
    """Height layers; points below the terrain keep their class."""
    h = height()
    return relabel(points, h >= 0, F.when(h < low, LOW_VEG).when(h < high, MED_VEG).otherwise(HIGH_VEG))


def ground_layers(points: DataFrame, among: Column, ground: float = 0.08, low: float = 0.30, high: float = 2.2) -> DataFrame:
    """Height layers with a ground band, over the points that `among` marks."""
    h = height()
    return relabel(points, among, F.when(h <= ground, GROUND).when(h < low, LOW_VEG).when(h < high, MED_VEG).otherwise(HIGH_VEG))


def relayer(points: DataFrame, sources=VEGETATION, low: float = 0.35, high: float = 2.2, ground: float = 0.08) -> DataFrame:
    return ground_layers(points, is_class(*sources), ground, low, high)


def below_surface(points: DataFrame, among: Column, depth: float = 0.12) -> DataFrame:
    return relabel(points, among & (F.col("z") < F.col("gz") - depth), NOISE)


def demote_false_vehicles(points: DataFrame, vehicle: int = VEHICLE, max_h: float = 0.18) -> DataFrame:
    return relabel(points, is_class(vehicle) & (height() < max_h), GROUND)


def peel_junk(points: DataFrame, target: int = NOISE, min_h: float = 0.35, max_h: float = 4.0, protect_m: float = 0.0, protect_h: float = 0.45) -> DataFrame:
    """Ground far above the terrain; with protect_m, not what lies near a building and below protect_h."""
    h = height()
    junk = is_class(GROUND) & (h > min_h) & (h < max_h)
    if protect_m <= 0:
        return relabel(points, junk, target)
    marked = near(points, junk, is_class(BUILDING), protect_m)
    return relabel(marked, junk & ~(F.col("near") & (h < protect_h)), target).drop("near")


def peel_ground_noise(points: DataFrame, target: int = NOISE, above: float = 0.08, below: float = 0.06, curb_max: float = 0.30, sparse_cell: float = 0.2, sparse_min: int = 4, sparse: bool = False, protect_m: float = 0.0, protect_h: float = 2.8) -> DataFrame:
    """Ground in the curb band becomes low vegetation, what still is too high or low becomes noise; optionally lonely voxels too."""
    h = height()
    points = relabel(points, is_class(GROUND) & h.between(0.08, curb_max + 0.06), LOW_VEG)
    off = is_class(GROUND) & ((h > above) | (h < -below))
    if protect_m > 0:
        points = near(points, off, is_class(BUILDING), protect_m)
        points = relabel(points, off & ~(F.col("near") & (h < protect_h)), target).drop("near")
    else:
        points = relabel(points, off, target)
    return sparse_voxels(points, (GROUND,), target, sparse_cell, sparse_min) if sparse else points


# cells and voxels


def sparse_voxels(points: DataFrame, sources=(*VEGETATION, BUILDING), target: int = NOISE, cell: float = 0.15, least: int = 6, among: Column | None = None) -> DataFrame:
    """Source points in voxels of fewer than `least` source points; nothing if there are fewer than that in all."""
    chosen = is_class(*sources) if among is None else is_class(*sources) & among
    keys = ["vx", "vy", "vz"]
    voxels = grid.with_voxels(points, cell)
    counts = voxels.where(chosen).groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    few = counts.join(F.broadcast(total)).where((F.col("total") >= least) & (F.col("n") < least))
    return relabel(grid.mark(voxels, few, keys=keys), chosen & F.col("hit"), target).drop("hit", *keys)


def hanging_wires(points: DataFrame, target: int = NOISE) -> DataFrame:
    return sparse_voxels(points, (MED_VEG, HIGH_VEG), target, 0.15, 5, height() > 2.5)


def recover_landscape(points: DataFrame, noise: int = NOISE, cell: float = 0.15, least: int = 8, min_h: float = 0.10, max_h: float = 2.5) -> DataFrame:
    """Noise in dense voxels goes back to vegetation by height, unless its 1 m cell is a flat sheet."""
    h = height()
    chosen = is_class(noise) & h.between(min_h, max_h)
    keys = ["vx", "vy", "vz"]
    marked = grid.with_cells(grid.with_voxels(points, cell), 1.0, chosen)
    full = marked.where(chosen).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    flat = marked.where(chosen).groupBy(*grid.CELL).agg(F.count("*").alias("n"), (F.max("z") - F.min("z")).alias("span"), F.avg(h).alias("mean")).where("n >= 15 AND span <= 0.14 AND mean <= 0.30")
    marked = grid.mark(grid.mark(marked, full, "full", keys), flat, "flat")
    back = F.when(h < 0.35, LOW_VEG).when(h < 2.2, MED_VEG).otherwise(HIGH_VEG)
    return relabel(marked, chosen & F.col("full") & ~F.col("flat"), back).drop("full", "flat", *keys, *grid.CELL)


def flat_cells(points: DataFrame, among: Column, cell: float, keep: str, update: Column, target: int, max_h: float) -> DataFrame:
    """Points of `update` become target in cells whose `among` points satisfy `keep`, a condition on n, span and share (of -0.05 <= h <= max_h)."""
    h = height()
    marked = grid.with_cells(points, cell, among)
    cells = marked.where(among).groupBy(*grid.CELL).agg(F.count("*").alias("n"), (F.max("z") - F.min("z")).alias("span"), F.avg(h.between(-0.05, max_h).cast("double")).alias("share")).where(keep)
    return relabel(grid.mark(marked, cells), update & F.col("hit"), target).drop("hit", *grid.CELL)


def restore_paving(points: DataFrame, sources=(LOW_VEG, MED_VEG), cell: float = 1.0, max_h: float = 0.38, max_span: float = 0.14, least: int = 20, min_share: float = 0.82) -> DataFrame:
    chosen = is_class(*sources)
    return flat_cells(points, chosen, cell, f"n >= {least} AND share >= {min_share} AND span <= {max_span}", chosen & (height() <= max_h + 0.05), GROUND, max_h)


def restore_near_terrain(points: DataFrame, sources=(LOW_VEG, MED_VEG), max_h: float = 0.14, flat_span: float = 0.08, cell: float = 0.5) -> DataFrame:
    chosen = is_class(*sources) & height().between(-0.04, max_h)
    return flat_cells(points, chosen, cell, f"n >= 8 AND span <= {flat_span}", chosen, GROUND, max_h)


def restore_low_band(points: DataFrame, sources=(LOW_VEG, MED_VEG, VEHICLE), max_h: float = 0.20, flat_span: float = 0.08, cell: float = 0.5) -> DataFrame:
    chosen = is_class(*sources) & height().between(-0.05, max_h)
    return flat_cells(points, chosen, cell, f"n >= 6 AND span <= {flat_span}", chosen, GROUND, max_h)


def demote_low_building(points: DataFrame, max_h: float = 0.28, flat_span: float = 0.12, cell: float = 0.75) -> DataFrame:
    chosen = is_class(BUILDING) & height().between(-0.08, max_h)
    return flat_cells(points, chosen, cell, f"n >= 10 AND span <= {flat_span}", chosen, GROUND, max_h)


def building_cells(points: DataFrame, cell: float = 1.25, top: float = 3.8, span: float = 2.8, least: int = 60, protect=(VEHICLE,), canopy_top: float = 4.0, roundness: float = 0.35, filled: float = 0.55) -> DataFrame:
    """ix, iy, canopy: tall cells; canopy ones are round in plan and filled in height."""
    h = height()
    chosen = ~is_class(GROUND, *protect) & (h >= 0.3)
    cells = grid.with_cells(points, cell).where(chosen).withColumn("h", h)
    stats = cells.groupBy(*grid.CELL).agg(
        F.count("*").alias("n"),
        F.percentile("h", 0.9).alias("top"),
        (F.percentile("z", 0.9) - F.percentile("z", 0.1)).alias("span"),
        F.var_pop("x").alias("vx"),
        F.var_pop("y").alias("vy"),
        F.covar_pop("x", "y").alias("vxy"),
        F.min("h").alias("lo"),
    )
    tall = stats.where((F.col("n") >= least) & (F.col("top") >= top) & (F.col("span") >= span))
    base = F.greatest("lo", F.lit(0.5))
    tall = tall.withColumn("base", base).withColumn("n_bins", F.greatest(F.ceil((F.col("top") - F.col("base")) / 0.5), F.lit(1)))
    bins = cells.select(*grid.CELL, "h").join(tall.select(*grid.CELL, "base", "n_bins"), grid.CELL).withColumn("bin", F.floor((F.col("h") - F.col("base")) / 0.5))
    bins = bins.where("bin >= 0 AND bin < n_bins").groupBy(*grid.CELL, "bin").agg(F.count("*").alias("k")).where("k >= 3").groupBy(*grid.CELL).agg(F.count("*").alias("bins"))
    half, det = (F.col("vx") + F.col("vy")) / 2, F.col("vx") * F.col("vy") - F.col("vxy") * F.col("vxy")
    root = F.sqrt(F.greatest(half * half - det, F.lit(0.0)))
    ratio = (half - root) / F.greatest(half + root, F.lit(1e-9))
    canopy = (F.col("top") >= canopy_top) & (ratio >= roundness) & (F.coalesce("bins", F.lit(0)) / F.col("n_bins") >= filled)
    return tall.join(bins, grid.CELL, "left").select(*grid.CELL, canopy.alias("canopy"))


def detect_buildings(points: DataFrame, assign_h: float = 1.5, dilate: int = 1, protect=(VEHICLE,), **options) -> DataFrame:
    """Points of canopy cells become high vegetation; points in columns of the other tall cells, dilated, become building."""
    found = building_cells(points, protect=protect, **options)
    canopy = found.where("canopy")
    columns = grid.dilate(found.where("NOT canopy").select(*grid.CELL), dilate).join(canopy.select(*grid.CELL), grid.CELL, "left_anti")
    free = ~is_class(GROUND, *protect)
    marked = grid.mark(grid.mark(grid.with_cells(points, options.get("cell", 1.25)), canopy, "canopy"), columns, "column")
    h = height()
    target = F.when(F.col("canopy") & (h >= 1.0), HIGH_VEG).when(F.col("column") & (h >= assign_h), BUILDING)
    return relabel(marked, free & target.isNotNull(), target).drop("canopy", "column", *grid.CELL)


def detect_walls(points: DataFrame, cell: float = 0.5, top: tuple[float, float] = (0.9, 3.4), span: float = 0.55, count: tuple[int, int] = (18, 220), assign_h: float = 0.2, protect=(VEHICLE,)) -> DataFrame:
    h = height()
    chosen = ~is_class(GROUND, BUILDING, *protect) & (h >= assign_h)
    marked = grid.with_cells(points, cell)
    cells = marked.where(chosen).groupBy(*grid.CELL).agg(F.count("*").alias("n"), F.percentile(h, 0.9).alias("top"), (F.max("z") - F.min("z")).alias("span"))
    walls = cells.where(F.col("n").between(*count) & F.col("top").between(*top) & (F.col("span") >= span))
    return relabel(grid.mark(marked, walls), chosen & F.col("hit"), BUILDING).drop("hit", *grid.CELL)


def restore_building_columns(points: DataFrame, noise: int = NOISE, cell: float = 0.75, min_h: float = 0.4, max_h: float = 25.0, dilate: int = 1, tall: float = 3.5, car_band: float = 2.8) -> DataFrame:
    """Noise in tall building cells, and above the car band in the ring around them, inside the buildings' extent."""
    h = height()
    marked = grid.with_cells(points, cell, is_class(BUILDING))
    cells = marked.where(is_class(BUILDING)).groupBy(*grid.CELL).agg(F.max(h).alias("top"))
    extent = cells.agg(F.max("ix").alias("nx"), F.max("iy").alias("ny"))
    core = cells.where(F.col("top") >= tall)
    ring = grid.dilate(core.select(*grid.CELL), dilate).join(F.broadcast(extent)).where("ix BETWEEN 0 AND nx AND iy BETWEEN 0 AND ny")
    marked = grid.mark(grid.mark(marked, core, "core"), ring, "ring")
    fits = is_class(noise) & h.between(min_h, max_h) & (F.col("core") | (F.col("ring") & (h >= car_band)))
    return relabel(marked, fits, BUILDING).drop("core", "ring", *grid.CELL)


def demote_orphans(points: DataFrame, target: int = NOISE, cell: float = 1.25, top: float = 3.2, span: float = 2.2, roof: float = 5.0, least: int = 25, dilate: int = 2, to_noise: bool = True) -> DataFrame:
    """Building points outside the dilated well-built cells: flat ones become ground, others target if to_noise."""
    h = height()
    marked = grid.with_cells(points, cell, is_class(BUILDING))
    cells = marked.where(is_class(BUILDING)).groupBy(*grid.CELL).agg(F.count("*").alias("n"), F.percentile(h, 0.9).alias("top"), (F.max("z") - F.min("z")).alias("span"))
    built = cells.where((F.col("n") >= least) & (F.col("top") >= top) & (F.col("span") >= span) | (F.col("top") >= roof))
    marked = grid.mark(marked, grid.dilate(built.select(*grid.CELL), dilate))
    new = F.when(h.between(-0.08, 0.28), GROUND).when(F.lit(to_noise), target)
    return relabel(marked, is_class(BUILDING) & ~F.col("hit") & new.isNotNull(), new).drop("hit", *grid.CELL)


# neighbours


def attach(points: DataFrame, source: Column, radius: float, target: int = BUILDING) -> DataFrame:
    """Source points closer than radius to a building."""
    return relabel(near(points, source, is_class(BUILDING), radius), source & F.col("near"), target).drop("near")


def attach_near_buildings(points: DataFrame, sources=(MED_VEG, LOW_VEG), radius: float = 0.40, curb_max: float = 0.40, obj_max: float = 2.2) -> DataFrame:
    h = height()
    return attach(points, is_class(*sources) & ~((h >= curb_max) & (h < obj_max)), radius)


def attach_facades(points: DataFrame, sources=(*VEGETATION, NOISE), band: tuple[float, float] = (0.35, 2.8), radius: float = 0.22) -> DataFrame:
    return attach(points, is_class(*sources) & height().between(*band), radius)


def restore_building_from_noise(points: DataFrame, noise: int = NOISE, radius: float = 0.35, min_h: float = 0.2, max_h: float = 8.0) -> DataFrame:
    return attach(points, is_class(noise) & height().between(min_h, max_h), radius)


def restore_building_skin(points: DataFrame, sources=(LOW_VEG, MED_VEG, NOISE), radius: float = 0.14, min_h: float = 0.18, max_h: float = 8.0) -> DataFrame:
    return attach(points, is_class(*sources) & height().between(min_h, max_h), radius)


def restore_asphalt(points: DataFrame, sources=(NOISE, LOW_VEG, MED_VEG), radius: float = 1.25, z_tol: float = 0.06, max_h: float | None = None) -> DataFrame:
    """Points as high as the nearest ground point."""
    chosen = is_class(*sources) if max_h is None else is_class(*sources) & (height() <= max_h)
    best = nearest(points, chosen, is_class(GROUND), radius, ["z"]).drop("d2")
    return relabel(points.join(best, "point_id", "left"), chosen & (F.abs(F.col("z") - F.col("n_z")) <= z_tol), GROUND).drop("n_z")


def peel_near_cars(points: DataFrame, vehicle: int = VEHICLE, sources=(GROUND, LOW_VEG), radius: float = 0.55, z_pad: float = 0.20, max_car_h: float = 0.55, max_h: float = 0.12) -> DataFrame:
    h = height()
    chosen = is_class(*sources) & (h <= max_h)
    best = nearest(points, chosen, is_class(vehicle) & (h <= max_car_h), radius, ["z"]).drop("d2")
    return relabel(points.join(best, "point_id", "left"), chosen & (F.col("z") <= F.col("n_z") + z_pad), vehicle).drop("n_z")


def peel_car_volume(points: DataFrame, boxes: DataFrame, target: int = VEHICLE, sources=(GROUND, *VEGETATION), pad: float = 0.45, min_h: float = 0.06, z_pad: float = 0.40, cell: float = 0.25, dilate: int = 1, away_m: float = 0.0) -> DataFrame:
    """Points in the raster of car boxes, up to z_pad over them; with away_m not near buildings."""
    raster = grid.box_raster(boxes, points, cell, pad, dilate)
    marked = grid.with_cells(points, cell).join(raster, grid.CELL, "left")
    fits = is_class(*sources) & (height() >= min_h) & (F.col("z") <= F.col("top") + z_pad)
    if away_m > 0:
        marked = near(marked, fits, is_class(BUILDING), away_m)
        fits = fits & ~F.col("near")
    return relabel(marked, fits, target).drop("top", "near", *grid.CELL)


def peel_footprint(points: DataFrame, boxes: DataFrame, target: int = VEHICLE, sources=(GROUND, LOW_VEG, MED_VEG), z_pad: float = 0.35, cell: float = 0.25, pad: float = 0.85, dilate: int = 2) -> DataFrame:
    marked = grid.with_cells(points, cell).join(grid.box_raster(boxes, points, cell, pad, dilate), grid.CELL, "left")
    return relabel(marked, is_class(*sources) & (F.col("z") <= F.col("top") + z_pad), target).drop("top", *grid.CELL)


def peel_box(points: DataFrame, box: tuple[float, float, float, float, float], target: int = VEHICLE, sources=(LOW_VEG, MED_VEG), pad: float = 0.40, z_pad: float = 0.25, band: tuple[float, float] = (0.05, 0.55)) -> DataFrame:
    x0, x1, y0, y1, top = box
    inside = F.col("x").between(x0 - pad, x1 + pad) & F.col("y").between(y0 - pad, y1 + pad) & (F.col("z") <= top + z_pad)
    return relabel(points, is_class(*sources) & height().between(*band) & inside, target)


def peel_car_residuals(points: DataFrame, seed: int = VEHICLE, target: int = VEHICLE, boxes: DataFrame | None = None, cell: float = 0.25, radius: float = 0.75, min_h: float = 0.04, max_h: float = 0.9, seed_h: tuple[float, float] = (0.10, 3.5)) -> DataFrame:
    """Low ground in the raster of car boxes, or, without boxes, in the dilated raster of seed points."""
    reach = max(1, round(radius / cell))
    chosen = is_class(GROUND) & height().between(min_h, max_h)
    if boxes is not None:
        return relabel(grid.mark(grid.with_cells(points, cell), grid.box_raster(boxes, points, cell, radius, reach)), chosen & F.col("hit"), target).drop("hit", *grid.CELL)
    seeds = is_class(seed) & height().between(*seed_h)
    marked = grid.with_cells(points, cell, seeds | chosen, radius)
    cells = grid.dilate(marked.where(seeds).select(*grid.CELL).distinct(), reach)
    return relabel(grid.mark(marked, cells), chosen & F.col("hit"), target).drop("hit", *grid.CELL)
