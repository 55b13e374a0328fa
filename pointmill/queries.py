"""Registered queries over the derived scene and queue tables, each with its SQL where SQL can state it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.quantiles import quantiles
from .functions.storage import cut, shared_dir
from .operators import blobs, cloth, density, grid, quadtree, refine, rules, spatial, terrain
from .plans import classify, evaluate, layout, tasks, tiles
from .sources.points import BUILDING, GROUND, NOISE, VEHICLE, height, scene, scene_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PTS = f"pts AS ({scene_sql()}), p AS (SELECT *, z - gz AS h FROM pts)"


def register(name: str, sql: str | None = None, bare: bool = False):
    """sql follows WITH p (the scene with h), unless bare."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql if bare else f"WITH RECURSIVE {PTS}{'' if sql.lstrip().upper().startswith('SELECT') else ','} {sql}"
        return f

    return add


def over_scene(name: str, sql: str | None, f: Callable[[DataFrame], DataFrame]) -> None:
    register(name, sql)(lambda spark, sf_dir: f(scene(spark, sf_dir)))


def rule(name: str, f: Callable[[DataFrame], DataFrame], new: str, tables: str = "", source: str = "p") -> None:
    """A rule on cls; `new` is SQL for the new class or null, over `source`."""
    sql = f"{tables} SELECT point_id, CAST(coalesce({new}, cls) AS INTEGER) AS cls FROM {source}"
    over_scene(name, sql, lambda p: f(p).select("point_id", "cls"))


def cells(cell: float, among: str = "true", name: str = "c", source: str = "p", shift: float = 0.0) -> str:
    """SQL of a table: all points with ix, iy of a grid that begins at the points that `among` marks."""
    return f"""o_{name} AS (SELECT min(x) - {shift} AS x0, min(y) - {shift} AS y0 FROM {source} WHERE {among}),
{name} AS (SELECT q.*, CAST(floor((x - x0) / {cell}) AS BIGINT) AS ix, CAST(floor((y - y0) / {cell}) AS BIGINT) AS iy FROM {source} q, o_{name})"""


def components(source: str, name: str = "comp") -> str:
    """SQL: least (ix, iy) of each 4-connected component, by keyed recursion."""
    return f"""{name}_r(ix, iy, lab) USING KEY (ix, iy) AS (SELECT ix, iy, ix * 1000000 + iy FROM {source}
  UNION SELECT s.ix, s.iy, min(w.lab) FROM {name}_r w JOIN recurring.{name}_r s ON (abs(s.ix - w.ix) + abs(s.iy - w.iy) = 1) WHERE w.lab < s.lab GROUP BY s.ix, s.iy),
{name} AS (SELECT ix, iy, lab FROM {name}_r)"""


def spread(source: str, radius: int, cross: bool = False, value: str = "") -> str:
    span = range(-radius, radius + 1)
    offsets = ", ".join(f"({i}, {j})" for i in span for j in span if not cross or abs(i) + abs(j) <= radius)
    if value:
        return f"SELECT s.ix + i AS ix, s.iy + j AS iy, max({value}) AS {value} FROM {source} s, (VALUES {offsets}) v(i, j) GROUP BY ALL"
    return f"SELECT DISTINCT s.ix + i AS ix, s.iy + j AS iy FROM {source} s, (VALUES {offsets}) v(i, j)"


def opened(source: str, size: int) -> str:
    off = ", ".join(f"({i}, {j})" for i in range(size) for j in range(size))
    return f"""SELECT DISTINCT a.ix + i AS ix, a.iy + j AS iy FROM (SELECT s.ix - i AS ix, s.iy - j AS iy FROM {source} s, (VALUES {off}) v(i, j)
  GROUP BY ALL HAVING count(*) = {size * size}) a, (VALUES {off}) w(i, j)"""


# scans and histograms

over_scene("class_histogram", "SELECT cls, count(*) AS n FROM p GROUP BY cls", lambda p: p.groupBy("cls").agg(F.count("*").alias("n")))
over_scene(
    "crop",
    "m AS (SELECT quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy FROM p WHERE cls = 9) SELECT point_id FROM p, m WHERE abs(x - cx) <= 3 AND abs(y - cy) <= 3",
    lambda p: tiles.crop(p, 3.0, least=1).select("point_id"),
)
over_scene(
    "crop_fallback",
    """c AS (SELECT count(*) FILTER (cls = 9) AS n FROM p), m AS (SELECT quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy FROM p, c WHERE CASE WHEN n >= 1000000000 THEN cls = 9 ELSE cls = 6 END)
SELECT point_id FROM p, m WHERE abs(x - cx) <= 2 AND abs(y - cy) <= 2""",
    lambda p: tiles.crop(p, 2.0, least=1_000_000_000).select("point_id"),
)
over_scene("intensity_norm", "s AS (SELECT quantile_cont(intensity, 0.95) AS p95 FROM p WHERE intensity > 0) SELECT point_id, round(least(greatest(intensity / greatest(p95, 1e-6), 0), 2), 6) AS inten FROM p, s", lambda p: refine.intensity_norm(p).select("point_id", F.round("inten", 6).alias("inten")))

# terrain

over_scene("cell_min_z", f"{cells(1.0)} SELECT ix, iy, min(z) AS low FROM c GROUP BY ix, iy", lambda p: terrain.cell_heights(p, 1.0))
over_scene("cell_p20_z", f"{cells(0.5)} SELECT ix, iy, round(quantile_cont(z, 0.2), 6) AS low FROM c GROUP BY ix, iy", lambda p: terrain.cell_heights(p, 0.5, 0.2).select("ix", "iy", F.round("low", 6).alias("low")))


def _dense(source: str, value: str) -> str:
    return f"""e AS (SELECT max(ix) AS nx, max(iy) AS ny, quantile_cont({value}, 0.5) AS mid FROM {source}),
d AS (SELECT a.ix, b.iy, coalesce(s.{value}, mid) AS {value} FROM e, unnest(range(0, nx + 1)) AS a(ix), unnest(range(0, ny + 1)) AS b(iy) LEFT JOIN {source} s ON s.ix = a.ix AND s.iy = b.iy)"""


def _slide(source: str, value: str, radius: int, take: str, name: str) -> str:
    w = f"RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING"
    return f"""{name}_x AS (SELECT ix, iy, {take}({value}) OVER (PARTITION BY iy ORDER BY ix {w}) AS {value} FROM {source}),
{name} AS (SELECT ix, iy, {take}({value}) OVER (PARTITION BY ix ORDER BY iy {w}) AS {value} FROM {name}_x)"""


_ROAD = f"""{cells(1.0)}, m AS (SELECT ix, iy, min(z) AS low FROM c GROUP BY ix, iy), {_dense('m', 'low')},
{_slide('d', 'low', 3, 'min', 'er')}, {_slide('er', 'low', 3, 'max', 'op')}"""
over_scene("road_surface", f"{_ROAD} SELECT ix, iy, low AS gz FROM op", terrain.road_surface)
over_scene(
    "low_surface",
    f"{cells(1.0)}, m AS (SELECT ix, iy, quantile_cont(z, 0.2) AS low FROM c GROUP BY ix, iy), {_dense('m', 'low')}, {_slide('d', 'low', 1, 'min', 'er')}, {_slide('er', 'low', 1, 'max', 'op')} SELECT d.ix, d.iy, round(least(d.low, op.low), 6) AS gz FROM d JOIN op USING (ix, iy)",
    lambda p: terrain.low_surface(p, 1.0).select("ix", "iy", F.round("gz", 6).alias("gz")),
)
_ON_ROAD = f"{_ROAD}, g AS (SELECT c.*, op.low AS rz FROM c LEFT JOIN op USING (ix, iy))"
on_road = lambda p: terrain.with_surface(p, terrain.road_surface(p), 1.0)
rule("ground_split", lambda p: terrain.split_ground(on_road(p)), "CASE WHEN z BETWEEN rz - 0.04 AND rz + 0.06 THEN 2 END", _ON_ROAD, "g")
rule("elevated_peel", lambda p: terrain.peel_elevated(on_road(p)), "CASE WHEN cls = 2 AND z > rz + 0.12 THEN 11 END", _ON_ROAD, "g")
over_scene("ground_surface", f"{cells(0.5)} SELECT ix, iy, coalesce(min(z) FILTER (cls = 2), min(z)) AS gz FROM c GROUP BY ix, iy", lambda p: terrain.ground_surface(p, rules.is_class(GROUND), 0.5))
over_scene(
    "refiner_surface",
    f"{cells(1.0)}, m AS (SELECT ix, iy, min(z) FILTER (cls = 2) AS low FROM c GROUP BY ix, iy), k AS (SELECT count(*) FILTER (cls = 2) AS n, quantile_cont(z, 0.5) AS a, quantile_cont(z, 0.5) FILTER (cls = 2) AS b FROM p), e AS (SELECT max(ix) AS nx, max(iy) AS ny FROM m),"
    f" d AS (SELECT a.ix, b.iy, CASE WHEN k.n < 100 THEN k.a ELSE coalesce(m.low, k.b) END AS low FROM e, k, unnest(range(0, nx + 1)) AS a(ix), unnest(range(0, ny + 1)) AS b(iy) LEFT JOIN m ON m.ix = a.ix AND m.iy = b.iy), {_slide('d', 'low', 1, 'min', 'er')} SELECT ix, iy, round(low, 6) AS gz FROM er",
    lambda p: terrain.refiner_surface(p).select("ix", "iy", F.round("gz", 6).alias("gz")),
)
over_scene("ground_residuals", f"{cells(0.5)}, m AS (SELECT *, z - min(z) OVER (PARTITION BY ix, iy) AS r FROM c WHERE cls = 2) SELECT count(*) AS n, round(quantile_cont(r, 0.5), 6) AS p50, round(quantile_cont(r, 0.9), 6) AS p90, round(max(r), 6) AS top, round(quantile_cont(r, 0.99), 6) AS p99, count(*) FILTER (r > 0.05) AS over5, count(*) FILTER (r > 0.1) AS over10, count(*) FILTER (r > 0.2) AS over20 FROM m",
           lambda p: residuals(p))


def residuals(p: DataFrame) -> DataFrame:
    """How far ground lies over the least ground of its 0.5 m cell."""
    ground = grid.with_cells(p, 0.5).where("cls = 2")
    lows = ground.groupBy(*grid.CELL).agg(F.min("z").alias("lo"))
    r = cut(ground.join(lows, grid.CELL).select((F.col("z") - F.col("lo")).alias("r")))
    at = quantiles(r, {"r": F.col("r")}, [0.5, 0.9, 0.99])
    shares = [F.round(F.lit(at.get(("r", q, None))), 6).alias(f"p{round(100 * q)}") for q in (0.5, 0.9, 0.99)]
    over = [F.count_if(F.col("r") > c / 100).alias(f"over{c}") for c in (5, 10, 20)]
    return r.agg(F.count("*").alias("n"), F.round(F.max("r"), 6).alias("top"), *over).select("n", "top", *shares, "over5", "over10", "over20")


# height rules

rule("height_layers", rules.layers, "CASE WHEN h < 0 THEN NULL WHEN h < 0.35 THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END")
_LAYERS = "CASE WHEN {} THEN CASE WHEN h <= 0.08 THEN 2 WHEN h < {} THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END END"
rule("ground_layers", lambda p: rules.ground_layers(p, rules.is_class(NOISE)), _LAYERS.format("cls = 7", 0.30))
rule("relayer", rules.relayer, _LAYERS.format("cls IN (3, 4, 5)", 0.35))
rule("class_reset", lambda p: p.withColumn("cls", F.lit(1)), "1")
rule("below_surface", lambda p: rules.below_surface(p, rules.is_class(GROUND, 3, 4)), "CASE WHEN cls IN (2, 3, 4) AND z < gz - 0.12 THEN 7 END")
rule("false_vehicles", lambda p: rules.demote_false_vehicles(p, max_h=0.5), "CASE WHEN cls = 9 AND h < 0.5 THEN 2 END")
_NEAR = "{name} AS (SELECT DISTINCT s.point_id FROM {source} s JOIN p b ON b.cls = {target} AND abs(b.x - s.x) < {r} AND abs(b.y - s.y) < {r} AND (s.x - b.x) * (s.x - b.x) + (s.y - b.y) * (s.y - b.y) < {r} * {r} WHERE {cond})"


def near_sql(cond: str, r: float, target: int = 6, name: str = "nb", source: str = "p") -> str:
    return _NEAR.format(name=name, source=source, target=target, r=r, cond=re.sub(r"\b(cls|h)\b", r"s.\1", cond))


_JUNK = "cls = 2 AND h > 0.01 AND h < 4.0"
rule("junk_peel", lambda p: rules.peel_junk(p, min_h=0.01, protect_m=0.45), f"CASE WHEN {_JUNK} AND NOT (point_id IN (SELECT point_id FROM nb) AND h < 0.45) THEN 7 END", near_sql(_JUNK, 0.45))
rule("ground_noise", lambda p: rules.peel_ground_noise(p, above=0.02, curb_max=0.03), "CASE WHEN cls = 2 AND h BETWEEN 0.08 AND 0.03 + 0.06 THEN 3 WHEN cls = 2 AND (h > 0.02 OR h < -0.06) THEN 7 END")
_OFF = "c1 = 2 AND (h > 0.02 OR h < -0.06)"
rule(
    "ground_noise_guarded",
    lambda p: rules.peel_ground_noise(p, above=0.02, curb_max=0.03, sparse=True, sparse_cell=0.5, protect_m=0.45),
    "CASE WHEN c2 = 2 AND EXISTS (SELECT 1 FROM few f WHERE f.vx = v.vx AND f.vy = v.vy AND f.vz = v.vz) THEN 7 ELSE c2 END",
    f"q1 AS (SELECT *, CASE WHEN cls = 2 AND h BETWEEN 0.08 AND 0.03 + 0.06 THEN 3 ELSE cls END AS c1 FROM p), {near_sql(_OFF, 0.45, source='q1').replace('c1 =', 's.c1 =')}, q2 AS (SELECT *, CASE WHEN {_OFF} AND NOT (point_id IN (SELECT point_id FROM nb) AND h < 2.8) THEN 7 ELSE c1 END AS c2 FROM q1), vox AS (SELECT *, floor(x / 0.5) AS vx, floor(y / 0.5) AS vy, floor(z / 0.5) AS vz FROM q2), few AS (SELECT vx, vy, vz FROM vox WHERE c2 = 2 GROUP BY ALL HAVING count(*) < 4)",
    "vox v",
)
rule("box_peel", lambda p: rules.peel_box(p, (1.0, 5.2, 1.5, 3.4, 1.6)), "CASE WHEN cls IN (3, 4) AND h BETWEEN 0.05 AND 0.55 AND x BETWEEN 1.0 - 0.4 AND 5.2 + 0.4 AND y BETWEEN 1.5 - 0.4 AND 3.4 + 0.4 AND z <= 1.6 + 0.25 THEN 9 END")

# voxels and cells

_VOX = "vox AS (SELECT *, floor(x / {c}) AS vx, floor(y / {c}) AS vy, floor(z / {c}) AS vz FROM {source})"
over_scene("voxel_centroids", f"{_VOX.format(c=1.0, source='p')} SELECT CAST(vx AS BIGINT) AS vx, CAST(vy AS BIGINT) AS vy, CAST(vz AS BIGINT) AS vz, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z FROM vox GROUP BY ALL",
           lambda p: grid.with_voxels(p, 1.0).groupBy("vx", "vy", "vz").agg(*[F.round(F.avg(c), 6).alias(c) for c in "xyz"]))


def _sparse(cond: str, cell: float, least: int, source: str = "p") -> str:
    return f"{_VOX.format(c=cell, source=source)}, few AS (SELECT vx, vy, vz FROM vox WHERE {cond} GROUP BY ALL HAVING count(*) < {least})"


_HIT = "CASE WHEN {} AND EXISTS (SELECT 1 FROM few f WHERE f.vx = v.vx AND f.vy = v.vy AND f.vz = v.vz) THEN 7 END"
rule("sparse_voxels", lambda p: rules.sparse_voxels(p, cell=0.5), _HIT.format("cls IN (3, 4, 5, 6)"), _sparse("cls IN (3, 4, 5, 6)", 0.5, 6), "vox v")
rule("hanging_wires", rules.hanging_wires, _HIT.format("cls IN (4, 5) AND h > 2.5"), _sparse("cls IN (4, 5) AND h > 2.5", 0.15, 5), "vox v")
_N = "cls = 7 AND h BETWEEN 0.10 AND 2.5"
rule("recover_landscape", lambda p: rules.recover_landscape(p, cell=0.5, least=4), f"CASE WHEN {_N} AND EXISTS (SELECT 1 FROM full_ f WHERE f.vx = v.vx AND f.vy = v.vy AND f.vz = v.vz) AND NOT EXISTS (SELECT 1 FROM flat f WHERE f.ix = v.ix AND f.iy = v.iy) THEN CASE WHEN h < 0.35 THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END END",
     f"{cells(1.0, _N)}, {_VOX.format(c=0.5, source='c')}, full_ AS (SELECT vx, vy, vz FROM vox WHERE {_N} GROUP BY ALL HAVING count(*) >= 4), flat AS (SELECT ix, iy FROM vox WHERE {_N} GROUP BY ALL HAVING count(*) >= 15 AND max(z) - min(z) <= 0.14 AND avg(h) <= 0.30)", "vox v")


def flat_rule(name: str, f, among: str, cell: float, having: str, update: str) -> None:
    rule(name, f, f"CASE WHEN {update} AND EXISTS (SELECT 1 FROM k WHERE k.ix = c.ix AND k.iy = c.iy) THEN 2 END", f"{cells(cell, among)}, k AS (SELECT ix, iy FROM c WHERE {among} GROUP BY ALL HAVING {having})", "c")


flat_rule("restore_paving", lambda p: rules.restore_paving(p, max_span=3.0, least=5, min_share=0.5), "cls IN (3, 4)", 1.0, "count(*) >= 5 AND avg(CASE WHEN h BETWEEN -0.05 AND 0.38 THEN 1.0 ELSE 0 END) >= 0.5 AND max(z) - min(z) <= 3.0", "cls IN (3, 4) AND h <= 0.38 + 0.05")
flat_rule("restore_near_terrain", rules.restore_near_terrain, "cls IN (3, 4) AND h BETWEEN -0.04 AND 0.14", 0.5, "count(*) >= 8 AND max(z) - min(z) <= 0.08", "cls IN (3, 4) AND h BETWEEN -0.04 AND 0.14")
flat_rule("restore_low_band", rules.restore_low_band, "cls IN (3, 4, 9) AND h BETWEEN -0.05 AND 0.20", 0.5, "count(*) >= 6 AND max(z) - min(z) <= 0.08", "cls IN (3, 4, 9) AND h BETWEEN -0.05 AND 0.20")
flat_rule("demote_low_building", lambda p: rules.demote_low_building(p, max_h=1.5, flat_span=1.3), "cls = 6 AND h BETWEEN -0.08 AND 1.5", 0.75, "count(*) >= 10 AND max(z) - min(z) <= 1.3", "cls = 6 AND h BETWEEN -0.08 AND 1.5")

_B = "cls NOT IN (2, 9) AND h >= 0.3"
_BUILD = f"""{cells(1.25)}, st AS (SELECT ix, iy, count(*) AS n, quantile_cont(h, 0.9) AS top, quantile_cont(z, 0.9) - quantile_cont(z, 0.1) AS span, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS vxy, greatest(min(h), 0.5) AS base FROM c WHERE {_B} GROUP BY ALL),
tall AS (SELECT *, greatest(ceil((top - base) / 0.5), 1) AS nb FROM st WHERE n >= 60 AND top >= 3.8 AND span >= 2.8),
bins AS (SELECT ix, iy, count(*) AS bins FROM (SELECT c.ix, c.iy, floor((h - base) / 0.5) AS bin FROM c JOIN tall t ON t.ix = c.ix AND t.iy = c.iy WHERE {_B} AND floor((h - base) / 0.5) >= 0 AND floor((h - base) / 0.5) < nb GROUP BY ALL HAVING count(*) >= 3) GROUP BY ALL),
bc AS (SELECT tall.ix, tall.iy, top >= 4.0 AND ((vx + vy) / 2 - sqrt(greatest((vx + vy) * (vx + vy) / 4 - (vx * vy - vxy * vxy), 0))) / greatest((vx + vy) / 2 + sqrt(greatest((vx + vy) * (vx + vy) / 4 - (vx * vy - vxy * vxy), 0)), 1e-9) >= 0.35 AND coalesce(bins, 0) / nb >= 0.55 AS canopy
  FROM tall LEFT JOIN bins USING (ix, iy))"""
over_scene("building_cells", f"{_BUILD} SELECT ix, iy, canopy FROM bc", rules.building_cells)
rule("detect_buildings", rules.detect_buildings, "CASE WHEN cls NOT IN (2, 9) THEN CASE WHEN h >= 1.0 AND (ix, iy) IN (SELECT (ix, iy) FROM bc WHERE canopy) THEN 5 WHEN h >= 1.5 AND (ix, iy) IN (SELECT (ix, iy) FROM col) THEN 6 END END",
     f"{_BUILD}, hard AS (SELECT ix, iy FROM bc WHERE NOT canopy), col AS ({spread('hard', 1)} EXCEPT SELECT ix, iy FROM bc WHERE canopy)", "c")
_W = "cls NOT IN (2, 6, 9) AND h >= 0.2"
rule("detect_walls", lambda p: rules.detect_walls(p, count=(5, 220)), f"CASE WHEN {_W} AND (ix, iy) IN (SELECT (ix, iy) FROM k) THEN 6 END", f"{cells(0.5)}, k AS (SELECT ix, iy FROM c WHERE {_W} GROUP BY ALL HAVING count(*) BETWEEN 5 AND 220 AND quantile_cont(h, 0.9) BETWEEN 0.9 AND 3.4 AND max(z) - min(z) >= 0.55)", "c")
rule("restore_columns", rules.restore_building_columns, "CASE WHEN cls = 7 AND h BETWEEN 0.4 AND 25 AND ((ix, iy) IN (SELECT (ix, iy) FROM core) OR h >= 2.8 AND (ix, iy) IN (SELECT (ix, iy) FROM ring)) THEN 6 END",
     f"{cells(0.75, 'cls = 6')}, k AS (SELECT ix, iy, max(h) AS top FROM c WHERE cls = 6 GROUP BY ALL), core AS (SELECT ix, iy FROM k WHERE top >= 3.5), ring AS (SELECT ix, iy FROM ({spread('core', 1)}), (SELECT max(ix) AS nx, max(iy) AS ny FROM k) WHERE ix BETWEEN 0 AND nx AND iy BETWEEN 0 AND ny)", "c")
rule("demote_orphans", lambda p: rules.demote_orphans(p, cell=0.5, top=10.5, span=10.0, roof=11.6, dilate=0), "CASE WHEN cls = 6 AND (ix, iy) NOT IN (SELECT (ix, iy) FROM keep) THEN CASE WHEN h BETWEEN -0.08 AND 0.28 THEN 2 ELSE 7 END END",
     f"{cells(0.5, 'cls = 6')}, keep AS (SELECT ix, iy FROM c WHERE cls = 6 GROUP BY ALL HAVING count(*) >= 25 AND quantile_cont(h, 0.9) >= 10.5 AND max(z) - min(z) >= 10.0 OR quantile_cont(h, 0.9) >= 11.6)", "c")
over_scene("dilate_cells", f"{cells(0.25)}, k AS (SELECT DISTINCT ix, iy FROM c WHERE cls = 9) {spread('k', 1)}", lambda p: grid.dilate(grid.with_cells(p, 0.25).where("cls = 9").select("ix", "iy").distinct()))
over_scene("dilate_cross", f"{cells(0.25)}, k AS (SELECT DISTINCT ix, iy FROM c WHERE cls = 9) {spread('k', 1, True)}", lambda p: grid.dilate(grid.with_cells(p, 0.25).where("cls = 9").select("ix", "iy").distinct(), cross=True))
for _n in (2, 3):
    over_scene(f"open_{_n}x{_n}", f"{cells(0.25)}, k AS (SELECT DISTINCT ix, iy FROM c WHERE cls = 9) {opened('k', _n)}", lambda p, n=_n: grid.opened(grid.with_cells(p, 0.25).where("cls = 9").select("ix", "iy").distinct(), n))
over_scene("components", f"{cells(0.5)}, k AS (SELECT DISTINCT ix, iy FROM c WHERE cls = 9), {components('k')} SELECT ix, iy, CAST(lab // 1000000 AS BIGINT) AS cx, CAST(lab % 1000000 AS BIGINT) AS cy FROM comp",
           lambda p: grid.components(grid.with_cells(p, 0.5).where("cls = 9")).select("ix", "iy", F.col("component.ix").alias("cx"), F.col("component.iy").alias("cy")))

# neighbours

_F = "CASE WHEN point_id IN (SELECT point_id FROM nb) THEN 6 END"
for _name, _rule, _cond, _r in (
    ("attach_near_buildings", lambda p: rules.attach_near_buildings(p), "cls IN (3, 4) AND NOT (h >= 0.4 AND h < 2.2)", 0.40),
    ("attach_facades", lambda p: rules.attach_facades(p), "cls IN (3, 4, 5, 7) AND h BETWEEN 0.35 AND 2.8", 0.22),
    ("building_from_noise", lambda p: rules.restore_building_from_noise(p), "cls = 7 AND h BETWEEN 0.2 AND 8.0", 0.35),
    ("building_skin", lambda p: rules.restore_building_skin(p), "cls IN (3, 4, 7) AND h BETWEEN 0.18 AND 8.0", 0.14),
):
    rule(_name, _rule, _F, near_sql(_cond, _r))
over_scene("near_building", f"{near_sql('cls <> 6', 0.45)} SELECT point_id FROM nb", lambda p: spatial.near(p, ~rules.is_class(BUILDING), rules.is_class(BUILDING), 0.45).where("near").select("point_id"))


def nearest_sql(cond: str, target: str, r: float) -> str:
    return f"""tb AS (SELECT b.*, CAST(floor(b.x / {r}) AS BIGINT) + i AS bx, CAST(floor(b.y / {r}) AS BIGINT) + j AS by FROM p b, (VALUES (-1), (0), (1)) v(i), (VALUES (-1), (0), (1)) w(j) WHERE {target}),
nn AS (SELECT s.point_id, min_by(b.z, ((s.x - b.x) * (s.x - b.x) + (s.y - b.y) * (s.y - b.y), b.point_id)) AS nz FROM p s JOIN tb b ON CAST(floor(s.x / {r}) AS BIGINT) = b.bx AND CAST(floor(s.y / {r}) AS BIGINT) = b.by
  WHERE (s.x - b.x) * (s.x - b.x) + (s.y - b.y) * (s.y - b.y) < {r} * {r} AND {cond} GROUP BY s.point_id),
j AS (SELECT p.*, nz FROM p LEFT JOIN nn USING (point_id))"""


rule("restore_asphalt", rules.restore_asphalt, "CASE WHEN cls IN (7, 3, 4) AND abs(z - nz) <= 0.06 THEN 2 END", nearest_sql("s.cls IN (7, 3, 4)", "b.cls = 2", 1.25), "j")
rule("peel_near_cars", rules.peel_near_cars, "CASE WHEN cls IN (2, 3) AND h <= 0.12 AND z <= nz + 0.2 THEN 9 END", nearest_sql("s.cls IN (2, 3) AND s.h <= 0.12", "b.cls = 9 AND b.h <= 0.55", 0.55), "j")

_BOXES = "bx AS (SELECT min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, max(z) AS zmax FROM p WHERE gt = 9 GROUP BY floor(x / 6.5), floor(y / 6.0))"


def boxes(p: DataFrame) -> DataFrame:
    """One box for each car of the scene's lattice."""
    return p.where("gt = 9").groupBy(F.floor(F.col("x") / 6.5), F.floor(F.col("y") / 6.0)).agg(*[f(c).alias(f"{c}{s}") for c in "xy" for f, s in ((F.min, "min"), (F.max, "max"))], F.max("z").alias("zmax")).select("xmin", "xmax", "ymin", "ymax", "zmax")


def raster_sql(pad: float, radius: int, cell: float = 0.25, boxes: str = _BOXES) -> str:
    edge = lambda c, f, s: f"CAST({f}(({c} {s} {pad} - {c[0]}0) / {cell}) AS BIGINT)"
    return f"""{boxes}, {cells(cell)}, rr AS (SELECT a.ix, b.iy, max(zmax) AS top FROM bx, o_c, unnest(range({edge('xmin', 'floor', '-')}, {edge('xmax', 'ceil', '+')})) AS a(ix), unnest(range({edge('ymin', 'floor', '-')}, {edge('ymax', 'ceil', '+')})) AS b(iy) GROUP BY ALL),
r AS ({spread('rr', radius, value='top')})"""


over_scene("box_raster", f"{raster_sql(0.85, 2)} SELECT ix, iy, top FROM r", lambda p: grid.box_raster(boxes(p), p, 0.25, 0.85, 2))
rule("peel_car_volume", lambda p: rules.peel_car_volume(p, boxes(p)), "CASE WHEN cls IN (2, 3, 4, 5) AND h >= 0.06 AND z <= top + 0.4 THEN 9 END", raster_sql(0.45, 1), "c LEFT JOIN r USING (ix, iy)")
rule("peel_car_volume_guarded", lambda p: rules.peel_car_volume(p, boxes(p), away_m=0.45), "CASE WHEN cls IN (2, 3, 4, 5) AND h >= 0.06 AND z <= top + 0.4 AND point_id NOT IN (SELECT point_id FROM nb) THEN 9 END", f"{raster_sql(0.45, 1)}, {near_sql('cls IN (2, 3, 4, 5) AND h >= 0.06', 0.45)}", "c LEFT JOIN r USING (ix, iy)")
rule("peel_footprint", lambda p: rules.peel_footprint(p, boxes(p)), "CASE WHEN cls IN (2, 3, 4) AND z <= top + 0.35 THEN 9 END", raster_sql(0.85, 2), "c LEFT JOIN r USING (ix, iy)")
rule("car_residuals_boxes", lambda p: rules.peel_car_residuals(p, boxes=boxes(p), min_h=0.01), "CASE WHEN cls = 2 AND h BETWEEN 0.01 AND 0.9 AND top IS NOT NULL THEN 9 END", raster_sql(0.75, 3), "c LEFT JOIN r USING (ix, iy)")
_SEED, _LOWG = "cls = 9 AND h BETWEEN 0.1 AND 3.5", "cls = 2 AND h BETWEEN 0.01 AND 0.9"
rule("car_residuals_seeds", lambda p: rules.peel_car_residuals(p, min_h=0.01), f"CASE WHEN {_LOWG} AND (ix, iy) IN (SELECT (ix, iy) FROM k) THEN 9 END", f"{cells(0.25, f'({_SEED}) OR ({_LOWG})', shift=0.75)}, s AS (SELECT DISTINCT ix, iy FROM c WHERE {_SEED}), k AS ({spread('s', 3)})", "c")
_D_BLDG = "t AS (SELECT x, y FROM p WHERE cls = 6 AND h >= 3.5), db AS (SELECT s.point_id, least(coalesce(min(sqrt((s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y))), 20), 20) AS d_bldg FROM p s LEFT JOIN t ON true GROUP BY s.point_id)"
over_scene("building_distance", f"{_D_BLDG} SELECT point_id, round(d_bldg, 6) AS d_bldg FROM db", lambda p: refine.building_distance(p).select("point_id", F.round("d_bldg", 6).alias("d_bldg")))
over_scene(
    "voxel_features",
    f"""{_D_BLDG}, o AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0 FROM p), v AS (SELECT p.*, floor((x - x0) / 0.35) AS vx, floor((y - y0) / 0.35) AS vy, floor((z - z0) / 0.35) AS vz FROM p, o),
a AS (SELECT vx, vy, vz, ln(1 + count(*)) AS log_n, max(z) - min(z) AS v_span, avg(h) AS v_hmean FROM v GROUP BY ALL), s AS (SELECT quantile_cont(intensity, 0.95) AS p95 FROM p WHERE intensity > 0)
SELECT point_id, round(h, 6) AS h, round(log_n, 6) AS log_n, round(v_span, 6) AS v_span, round(v_hmean + 1e-9, 6) AS v_hmean, round(least(greatest(intensity / greatest(p95, 1e-6), 0), 2), 6) AS inten, round(d_bldg, 6) AS d_bldg,
  CAST(cls AS DOUBLE) AS cls_f, CAST(h >= 0.3 AS DOUBLE) AS h030, CAST(h >= 2.2 AS DOUBLE) AS h220, CAST(h >= 4 AS DOUBLE) AS h400 FROM v JOIN a USING (vx, vy, vz) JOIN db USING (point_id), s""",
    lambda p: refine.features(p).select("point_id", *[F.round(c, 6).alias(c) for c in ("h", "log_n", "v_span", "inten", "d_bldg")], F.round(F.col("v_hmean") + 1e-9, 6).alias("v_hmean"), "cls_f", "h030", "h220", "h400"),
)

# blobs

_CAR = "cls IN (3, 4, 5, 9) AND h BETWEEN 0.35 AND 2.3"


def car_sql(cond: str, source: str = "p") -> str:
    return f"""{cells(0.25, cond, source=source)}, m0 AS (SELECT * FROM c WHERE {cond}), k AS (SELECT DISTINCT ix, iy FROM m0), ok AS ({opened('k', 2)}), {components('ok')},
m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)),
s AS (SELECT lab, count(*) AS n, greatest(max(x) - min(x), max(y) - min(y)) AS l, least(max(x) - min(x), max(y) - min(y)) AS w, max(z) - min(z) AS dz, quantile_cont(h, 0.5) AS p50, quantile_cont(h, 0.9) AS p90, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, max(z) AS zmax FROM m GROUP BY lab),
good AS (SELECT * FROM s WHERE l BETWEEN 2 AND 8 AND w BETWEEN 1.15 AND 3.9 AND w / l BETWEEN 0.28 AND 0.9 AND n BETWEEN 120 AND 120000 AND p50 BETWEEN 0.4 AND 1.9 AND p90 <= 2.35 AND dz BETWEEN 0.45 AND 2.7 AND n / (l * w) >= 10)"""


_BLOB = "CASE WHEN point_id IN (SELECT point_id FROM m WHERE lab IN (SELECT lab FROM good)) THEN {} END"
rule("car_blobs", lambda p: blobs.extract_car_blobs(p, target=66, sources=(3, 4, 5, 9)), _BLOB.format(66), car_sql(_CAR))
_OPEN = f"{cells(0.40, name='c4')}, tl0 AS (SELECT DISTINCT ix, iy FROM c4 WHERE h >= 1.4), tl AS ({spread('tl0', 1, True)}), q AS (SELECT c4.* EXCLUDE (ix, iy), (ix, iy) IN (SELECT (ix, iy) FROM tl) AS tall FROM c4)"
rule("car_blobs_in_the_open", lambda p: blobs.extract_car_blobs(p, target=66, sources=(3, 4, 5, 9), under_tall=1.4), _BLOB.format(66), f"{_OPEN}, {car_sql(_CAR + ' AND NOT tall', 'q')}")
_CURB = "cls = 7 AND h BETWEEN 0.06 AND 0.50"
rule("restore_curbs", lambda p: blobs.restore_curbs(p, cell=0.5, width=6.0), _BLOB.format(3),
     f"{cells(0.5, _CURB)}, m0 AS (SELECT * FROM c WHERE {_CURB}), k AS (SELECT DISTINCT ix, iy FROM m0), dl AS ({spread('k', 1)}), {components('dl')}, m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)), s AS (SELECT lab, (max(ix) - min(ix)) * 0.5 AS dx, (max(iy) - min(iy)) * 0.5 AS dy FROM comp GROUP BY lab), good AS (SELECT lab FROM s WHERE greatest(dx, dy) >= 0.7 AND least(dx, dy) <= 6.0 AND greatest(dx, dy) / greatest(least(dx, dy), 0.5 / 2) >= 3 AND lab IN (SELECT lab FROM m GROUP BY lab HAVING count(*) >= 4))")
_PED = "cls = 6 AND h BETWEEN 0.85 AND 2.35"
rule("demote_pedestrians", lambda p: blobs.demote_pedestrians(p, cell=0.12, count=(3, 2500), span=0.3, aspect=9.0), _BLOB.format(7),
     f"{cells(0.12, _PED)}, m0 AS (SELECT * FROM c WHERE {_PED}), k AS (SELECT DISTINCT ix, iy FROM m0), {components('k')}, m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)), s AS (SELECT lab, count(*) AS n, greatest(max(x) - min(x), max(y) - min(y)) AS l, least(max(x) - min(x), max(y) - min(y)) AS w, max(z) - min(z) AS dz, avg(h) AS mean FROM m GROUP BY lab), good AS (SELECT lab FROM s WHERE n BETWEEN 3 AND 2500 AND w <= 0.55 AND l <= 0.95 AND l / greatest(w, 0.04) <= 9.0 AND dz BETWEEN 0.3 AND 2.5 AND mean BETWEEN 0.85 AND 2.35)")
_ISL = "cls = 2 AND z - lz BETWEEN 0.025 AND 0.85"
rule("peel_islands", lambda p: blobs.peel_islands(p, least=6), _BLOB.format(7),
     f"{cells(0.3, name='c3')}, ls AS (SELECT ix, iy, coalesce(min(z) FILTER (cls = 2), min(z)) AS lz FROM c3 GROUP BY ALL), q AS (SELECT c3.* EXCLUDE (ix, iy), lz FROM c3 JOIN ls USING (ix, iy)), {cells(0.18, _ISL, source='q')}, m0 AS (SELECT * FROM c WHERE {_ISL}), k AS (SELECT DISTINCT ix, iy FROM m0), ok AS ({opened('k', 3)}), {components('ok')}, m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)), s AS (SELECT lab, count(*) AS n, greatest(max(x) - min(x), max(y) - min(y)) AS l, least(max(x) - min(x), max(y) - min(y)) AS w, avg(z - lz) AS mean, max(z - lz) AS top FROM m GROUP BY lab), good AS (SELECT lab FROM s WHERE n >= 6 AND l <= 3.5 AND w <= 1.4 AND NOT (mean < 0.025 + 0.005 AND top < 0.025 + 0.025) AND NOT (n > 30000 AND l > 2.5))")
over_scene("vehicle_boxes", f"{cells(0.5, 'cls = 9')}, m0 AS (SELECT * FROM c WHERE cls = 9), k AS (SELECT DISTINCT ix, iy FROM m0), {components('k')}, m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)) SELECT min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, max(z) AS zmax, count(*) AS n FROM m GROUP BY lab HAVING greatest(max(x) - min(x), max(y) - min(y)) BETWEEN 1.2 AND 12 AND least(max(x) - min(x), max(y) - min(y)) BETWEEN 0.4 AND 5 AND least(max(x) - min(x), max(y) - min(y)) / greatest(max(x) - min(x), max(y) - min(y)) <= 0.92 AND count(*) >= 80", blobs.vehicle_boxes)
lattice = lambda p: p.where("gt IN (8, 9)").withColumn("group_id", F.floor(F.col("x") / 6.5) * 100 + F.floor(F.col("y") / 6.0) * 10 + F.col("gt"))
over_scene("group_shapes", "k AS (SELECT *, CAST(floor(x / 6.5) * 100 + floor(y / 6.0) * 10 + gt AS BIGINT) AS group_id FROM p WHERE gt IN (8, 9)), s AS (SELECT group_id, count(*) AS n, greatest(max(x) - min(x), max(y) - min(y)) AS l, least(max(x) - min(x), max(y) - min(y)) AS w, max(z) - min(z) AS dz, quantile_cont(h, 0.5) AS p50, quantile_cont(h, 0.9) AS p90 FROM k GROUP BY ALL) SELECT group_id, n, round(l, 6) AS long, round(w, 6) AS wide, l BETWEEN 1.2 AND 12 AND w BETWEEN 0.4 AND 5 AND dz BETWEEN 0.2 AND 4 AND p90 BETWEEN 0.12 AND 2.5 AND n >= 20 AND n / greatest(l * w, 0.01) >= 6 AND w / greatest(l, 0.01) <= 0.92 AND dz / greatest(w, 0.05) <= 2.2 AS car, w BETWEEN 0.25 AND 1.0 AND l BETWEEN 0.2 AND 1.4 AND dz <= 2.2 AND p50 BETWEEN 1.0 AND 2.1 AND n >= 5 AS person FROM s",
           lambda p: blobs.group_shapes(lattice(p)).select("group_id", "n", F.round("long", 6).alias("long"), F.round("wide", 6).alias("wide"), blobs.is_car().alias("car"), blobs.is_pedestrian(5).alias("person")))

over_scene(
    "vehicle_blob_sizes",
    f"{cells(0.25, 'cls = 9')}, m0 AS (SELECT * FROM c WHERE cls = 9), k AS (SELECT DISTINCT ix, iy FROM m0), {components('k')}, m AS (SELECT m0.*, lab FROM m0 JOIN comp USING (ix, iy)) SELECT count(*) AS n, count(DISTINCT (ix, iy)) AS n_cells, round(greatest(max(x) - min(x), max(y) - min(y)), 6) AS long, round(least(max(x) - min(x), max(y) - min(y)), 6) AS wide FROM m GROUP BY lab HAVING count(DISTINCT (ix, iy)) >= 8",
    lambda p: blobs.blob_sizes(p).select("n", "n_cells", F.round("long", 6).alias("long"), F.round("wide", 6).alias("wide")),
)

# density groups

_SPAN = "greatest(max(x) - min(x), max(y) - min(y)) AS l, least(max(x) - min(x), max(y) - min(y)) AS w, max(z) - min(z) AS dz, quantile_cont(h, 0.5) AS p50, quantile_cont(h, 0.9) AS p90, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, max(z) AS zmax"
_IS_CAR = "l BETWEEN 1.2 AND 12 AND w BETWEEN 0.4 AND 5 AND dz BETWEEN 0.2 AND 4 AND p90 BETWEEN 0.12 AND 2.5 AND n >= 20 AND n / greatest(l * w, 0.01) >= 6 AND w / greatest(l, 0.01) <= 0.92 AND dz / greatest(w, 0.05) <= 2.2"
_IS_GHOST = "n < 900 AND l > 3.2 AND w < 1.8 AND dz < 2.6 AND n / greatest(l * w, 0.01) < 140 AND NOT dz / greatest(w, 0.05) > 2.2 AND NOT (dz >= 0.45 AND dz / greatest(l, 0.01) > 0.22) AND NOT (l >= 1.2 AND w <= 0.42 AND dz BETWEEN 0.06 AND 0.55)"
_IS_PERSON = "w BETWEEN 0.25 AND 1.0 AND l BETWEEN 0.2 AND 1.4 AND dz <= 2.2 AND p50 BETWEEN 1.0 AND 2.1 AND n >= 22"


def groups_sql(cond: str, least: int, samples: int, epsilon: float, voxel: float = 0.08, source: str = "p") -> str:
    """SQL of gm: the points of `cond` in density groups, with lab, the number of the group's least cell."""
    side, reach = f"{epsilon / 3**0.5:.17e}", f"{epsilon * epsilon:.17e}"
    d2 = "(s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) + (s.z - t.z) * (s.z - t.z)"
    at = lambda size: ", ".join(f"CAST(floor({c} / {size}) AS BIGINT) AS u{c}" for c in "xyz")
    about = lambda table, r: f"(SELECT t.* EXCLUDE (ux, uy, uz), ux + i AS ux, uy + j AS uy, uz + k AS uz FROM {table} t, range({-r}, {r + 1}) a(i), range({-r}, {r + 1}) b(j), range({-r}, {r + 1}) c(k))"
    return f"""gv AS (SELECT *, floor(x / {voxel}) AS vx, floor(y / {voxel}) AS vy, floor(z / {voxel}) AS vz FROM {source} WHERE {cond}),
gc AS (SELECT vx, vy, vz, avg(x) AS x, avg(y) AS y, avg(z) AS z, count(*) AS n FROM gv GROUP BY ALL), gb AS (SELECT *, {at(epsilon)} FROM gc),
gd AS (SELECT s.vx, s.vy, s.vz, any_value(s.x) AS x, any_value(s.y) AS y, any_value(s.z) AS z FROM gb s JOIN {about('gb', 1)} t USING (ux, uy, uz) WHERE {d2} <= {reach} GROUP BY ALL HAVING sum(t.n) >= {samples}),
ge AS (SELECT *, ((ux + 100000) * 1000000 + uy + 100000) * 1000000 + uz + 100000 AS id FROM (SELECT *, {at(side)} FROM gd)),
gl AS (SELECT DISTINCT s.id AS a, t.id AS b FROM ge s JOIN {about('ge', 2)} t USING (ux, uy, uz) WHERE s.id <> t.id AND {d2} <= {reach}),
gr(id, lab) USING KEY (id) AS (SELECT DISTINCT id, id FROM ge UNION SELECT gl.b, min(w.lab) FROM gr w JOIN gl ON gl.a = w.id JOIN recurring.gr o ON o.id = gl.b WHERE w.lab < o.lab GROUP BY gl.b),
gm AS (SELECT gv.*, lab FROM gv JOIN ge USING (vx, vy, vz) JOIN gr ON gr.id = ge.id QUALIFY count(*) OVER (PARTITION BY lab) >= {least})"""


_BAND = "cls IN (3, 4, 5, 9) AND h > 0.08 AND h <= 2.5"
in_band = lambda p: p.where("cls IN (3, 4, 5, 9) AND z - gz > 0.08 AND z - gz <= 2.5")
over_scene(
    "density_groups",
    f"{groups_sql(_BAND, 25, 6, 0.45)} SELECT point_id, lab // 1000000000000 - 100000 AS gx, (lab // 1000000) % 1000000 - 100000 AS gy, lab % 1000000 - 100000 AS gz FROM gm",
    lambda p: density.density_groups(in_band(p), 25, 6, 0.45).where("group_id IS NOT NULL").select("point_id", F.col("group_id.bx").alias("gx"), F.col("group_id.by").alias("gy"), F.col("group_id.bz").alias("gz")),
)
rule("density_cars", lambda p: density.extract_cars(p, (3, 4, 5, 9), 66, 0.08, 2.5), "CASE WHEN point_id IN (SELECT point_id FROM gm WHERE lab IN (SELECT lab FROM cars)) THEN 66 END", f"{groups_sql(_BAND, 25, 6, 0.45)}, s AS (SELECT lab, count(*) AS n, {_SPAN} FROM gm GROUP BY lab), cars AS (SELECT lab FROM s WHERE {_IS_CAR})")
rule(
    "object_groups",
    lambda p: density.object_classes(rules.layers(p)),
    "CASE WHEN coalesce(kind, cls) = 4 AND h >= 0.06 AND z <= top + 0.4 THEN 66 ELSE kind END",
    f"q AS (SELECT * REPLACE (CAST({{new}} AS INTEGER) AS cls) FROM p), {groups_sql('cls = 4', 30, 6, 0.4, source='q')}, s AS (SELECT lab, count(*) AS n, {_SPAN} FROM gm GROUP BY lab), kinds AS (SELECT *, CASE WHEN {_IS_CAR} THEN 66 WHEN {_IS_GHOST} THEN 8 WHEN {_IS_PERSON} THEN 67 END AS kind FROM s), {{raster}}, kp AS (SELECT point_id, kind FROM gm JOIN kinds USING (lab)), z AS (SELECT q.*, kind, top FROM q LEFT JOIN kp USING (point_id) JOIN (SELECT point_id, top FROM c LEFT JOIN r USING (ix, iy)) USING (point_id))".format(
        new="CASE WHEN h < 0 THEN cls WHEN h < 0.35 THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END", raster=raster_sql(0.45, 1, boxes="bx AS (SELECT * FROM kinds WHERE kind = 66)")
    ),
    "z",
)
rule(
    "object_groups_wide",
    lambda p: density.object_classes(rules.layers(p), peel=classify.WIDE_PEEL),
    "CASE WHEN coalesce(kind, cls) IN (2, 3, 4, 5) AND h >= 0.05 AND z <= top + 0.4 THEN 66 ELSE kind END",
    f"q AS (SELECT * REPLACE (CAST({{new}} AS INTEGER) AS cls) FROM p), {groups_sql('cls = 4', 30, 6, 0.4, source='q')}, s AS (SELECT lab, count(*) AS n, {_SPAN} FROM gm GROUP BY lab), kinds AS (SELECT *, CASE WHEN {_IS_CAR} THEN 66 WHEN {_IS_GHOST} THEN 8 WHEN {_IS_PERSON} THEN 67 END AS kind FROM s), {{raster}}, kp AS (SELECT point_id, kind FROM gm JOIN kinds USING (lab)), z AS (SELECT q.*, kind, top FROM q LEFT JOIN kp USING (point_id) JOIN (SELECT point_id, top FROM c LEFT JOIN r USING (ix, iy)) USING (point_id))".format(
        new="CASE WHEN h < 0 THEN cls WHEN h < 0.35 THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END", raster=raster_sql(0.60, 1, boxes="bx AS (SELECT * FROM kinds WHERE kind = 66)")
    ),
    "z",
)
rule(
    "last_cars",
    density.last_cars,
    "CASE WHEN car OR cls IN (3, 4, 5) AND h >= 0.05 AND z <= top + 0.4 THEN 9 END",
    f"{groups_sql('cls IN (3, 4, 5) AND h > 0.10', 25, 6, 0.45)}, s AS (SELECT lab, count(*) AS n, {_SPAN} FROM gm GROUP BY lab), cars AS (SELECT * FROM s WHERE {_IS_CAR}), {raster_sql(0.60, 2, boxes='bx AS (SELECT * FROM cars)')}, hit AS (SELECT point_id FROM gm WHERE lab IN (SELECT lab FROM cars)), z AS (SELECT c.*, top, point_id IN (SELECT point_id FROM hit) AS car FROM c LEFT JOIN r USING (ix, iy))",
    "z",
)
_COVARIANCE = ", ".join(f"{'var_pop' if a == b else 'covar_pop'}({a if a == b else a + ', ' + b}) AS c{a}{b}" for a, b in ("xx", "yy", "zz", "xy", "xz", "yz"))
_FLATNESS = """e1 AS (SELECT *, (cxx + cyy + czz) / 3 AS q FROM s), e2 AS (SELECT *, sqrt(((cxx - q) ** 2 + (cyy - q) ** 2 + (czz - q) ** 2 + 2 * (cxy ** 2 + cxz ** 2 + cyz ** 2)) / 6) AS p FROM e1),
e3 AS (SELECT *, CASE WHEN p > 0 THEN ((cxx - q) * ((cyy - q) * (czz - q) - cyz * cyz) - cxy * (cxy * (czz - q) - cyz * cxz) + cxz * (cxy * cyz - (cyy - q) * cxz)) / (2 * p ** 3) ELSE 0 END AS r FROM e2),
e4 AS (SELECT *, acos(greatest(-1.0, least(1.0, r))) / 3 AS phi FROM e3), e5 AS (SELECT *, (q + 2 * p * cos(phi + 2 * pi() / 3)) / nullif(q + 2 * p * cos(phi), 0) AS flat FROM e4)"""
_IS_STRICT = "l BETWEEN 2 AND 8.5 AND w BETWEEN 1.1 AND 3.9 AND dz BETWEEN 0.55 AND 2.6 AND p90 BETWEEN 0.45 AND 2.4 AND p50 BETWEEN 0.30 AND 1.8 AND n BETWEEN 80 AND 120000 AND n / greatest(l * w, 0.01) >= 12 AND w / greatest(l, 0.01) BETWEEN 0.28 AND 0.88 AND n / (l * w * greatest(dz, 0.3)) >= 6 AND flat >= 0.035 AND dz / greatest(w, 0.05) <= 2.2"
rule(
    "density_cars_strict",
    lambda p: density.extract_cars(p, (3, 4, 5, 9), 66, 0.08, 2.5, strict=True),
    "CASE WHEN point_id IN (SELECT point_id FROM gm WHERE lab IN (SELECT lab FROM e5 WHERE " + _IS_STRICT + ")) THEN 66 END",
    f"{groups_sql(_BAND, 25, 6, 0.45)}, s AS (SELECT lab, count(*) AS n, {_SPAN}, {_COVARIANCE} FROM gm GROUP BY lab), {_FLATNESS}",
)
_NEAR_K = "SELECT a.point_id, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2 FROM"
over_scene(
    "outliers",
    f"""o AS (SELECT point_id, x, y, z, CAST(floor(x) AS BIGINT) AS ux, CAST(floor(y) AS BIGINT) AS uy, CAST(floor(z) AS BIGINT) AS uz FROM p), b3 AS (SELECT o.point_id, x, y, z, ux + i AS ux, uy + j AS uy, uz + k AS uz FROM o, range(-1, 2) a(i), range(-1, 2) b(j), range(-1, 2) c(k)),
n1 AS ({_NEAR_K} o a JOIN b3 b USING (ux, uy, uz) WHERE a.point_id <> b.point_id), w1 AS (SELECT * FROM n1 WHERE d2 < 1), ok AS (SELECT point_id FROM w1 GROUP BY ALL HAVING count(*) >= 20),
w2 AS ({_NEAR_K} (SELECT * FROM o WHERE point_id NOT IN (SELECT point_id FROM ok)) a JOIN o b ON a.point_id <> b.point_id), w AS (SELECT * FROM w1 WHERE point_id IN (SELECT point_id FROM ok) UNION ALL SELECT * FROM w2),
m AS (SELECT point_id, avg(sqrt(d2)) AS m FROM (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY d2) <= 20) GROUP BY point_id), l AS (SELECT avg(m) + 2.0 * stddev_pop(m) AS top FROM m) SELECT point_id FROM m, l WHERE m > top""",
    density.outliers,
)

# tiles

over_scene("tile_counts", """o AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM p),
h AS (SELECT a.tx, b.ty, a.tx = floor((x - x0) / 5) AND b.ty = floor((y - y0) / 5) AS core FROM p, o, unnest(range(greatest(CAST(floor((x - x0 - 1) / 5) AS BIGINT), 0), least(CAST(floor((x - x0 + 1) / 5) AS BIGINT), CAST(floor((x1 - x0) / 5) AS BIGINT)) + 1)) AS a(tx), unnest(range(greatest(CAST(floor((y - y0 - 1) / 5) AS BIGINT), 0), least(CAST(floor((y - y0 + 1) / 5) AS BIGINT), CAST(floor((y1 - y0) / 5) AS BIGINT)) + 1)) AS b(ty))
SELECT tx, ty, count(*) FILTER (core) AS n_core, count(*) AS n_load FROM h GROUP BY ALL""", lambda p: tiles.tile_counts(p, 5.0, 1.0))

# leaves of at most 2,000 points with their halos, from base cells of 0.5 m, and the loads that the rule asks for
_LEAVES = """b AS (SELECT point_id, CAST(floor(x / 0.5) AS BIGINT) AS ix, CAST(floor(y / 0.5) AS BIGINT) AS iy, x, y FROM p), cc AS (SELECT ix, iy, count(*) AS n FROM b GROUP BY ALL),
lv AS (SELECT CAST(k AS INTEGER) AS level, CAST(pow(2, (k + 1) // 2) AS BIGINT) AS w, CAST(pow(2, k // 2) AS BIGINT) AS t FROM range(0, 2 * (SELECT CAST(ceil(log2(greatest(max(ix) - min(ix), max(iy) - min(iy), 1) + 1)) AS BIGINT) FROM cc) + 1) r(k)),
ld AS (SELECT level, ux, uy, sum(n) AS load FROM (SELECT DISTINCT level, cc.ix, cc.iy, n, CAST(floor((cc.ix + i) / w) AS BIGINT) AS ux, CAST(floor((cc.iy + j) / t) AS BIGINT) AS uy FROM cc, lv, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) c(j)) GROUP BY ALL),
lf AS (SELECT cc.ix, cc.iy, cc.n, max({'a': level, 'b': ux, 'c': uy, 'd': load}) AS leaf FROM cc, lv JOIN ld USING (level) WHERE ux = CAST(floor(cc.ix / w) AS BIGINT) AND uy = CAST(floor(cc.iy / t) AS BIGINT) AND (load <= 2000 OR level = 0) GROUP BY ALL)"""
over_scene(
    "quadtree_leaves",
    f"{_LEAVES} SELECT leaf.a AS level, leaf.b AS bx, leaf.c AS \"by\", CAST(any_value(leaf.d) AS BIGINT) AS load, CAST(sum(n) AS BIGINT) AS n_core FROM lf GROUP BY leaf.a, leaf.b, leaf.c",
    lambda p: quadtree.leaf_loads(p, 0.5, 2000),
)



def window_scan(p: DataFrame) -> DataFrame:
    """A window of the cloud, laid out along the Morton curve first."""
    path = f"{shared_dir(p.sparkSession)}/layout-{uuid.uuid4().hex}"
    layout.write(p, path)
    return layout.read_window(p.sparkSession, path, 4.0, 9.0, 3.5, 8.0).select("point_id", "cls")


over_scene("window_scan", "SELECT point_id, cls FROM p WHERE x >= 4 AND x < 9 AND y >= 3.5 AND y < 8", window_scan)

# evaluation

_M = "cm AS (SELECT gt, cls AS pred, count(*) AS n FROM p GROUP BY ALL)"
over_scene("confusion", f"{_M} SELECT * FROM cm", evaluate.confusion)
_S = f"{_M}, cl AS (SELECT gt AS cls FROM cm UNION SELECT pred FROM cm), sc AS (SELECT cls, (SELECT coalesce(sum(n), 0) FROM cm WHERE pred = cls) AS pn, (SELECT coalesce(sum(n), 0) FROM cm WHERE gt = cls) AS tn, (SELECT coalesce(sum(n), 0) FROM cm WHERE gt = cls AND pred = cls) AS tp FROM cl)"
over_scene("precision_recall", f"{_S} SELECT cls, round(CASE WHEN pn > 0 THEN tp / pn ELSE 0 END, 9) AS precision, round(CASE WHEN tn > 0 THEN tp / tn END, 9) AS recall, round(CASE WHEN tn > 0 AND tp > 0 THEN 2.0 * tp / (pn + tn) ELSE 0 END, 9) AS f1 FROM sc",
           lambda p: evaluate.scores(evaluate.confusion(p)).select("cls", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]))
over_scene("retention", f"{_M} SELECT round(sum(CASE WHEN gt = pred THEN n ELSE 0 END) / sum(n), 9) AS accuracy, CAST(coalesce(sum(n) FILTER (gt = 2 AND pred IN (7, 9)), 0) AS BIGINT) AS ground_lost, CAST(coalesce(sum(n) FILTER (gt = 6 AND pred IN (7, 9)), 0) AS BIGINT) AS buildings_lost, CAST(coalesce(sum(n) FILTER (gt = 9 AND pred NOT IN (7, 9)), 0) AS BIGINT) AS vehicles_left, CAST(coalesce(sum(n) FILTER (gt = 7 AND pred NOT IN (7, 9)), 0) AS BIGINT) AS noise_left, CAST(coalesce(sum(n) FILTER (gt IN (7, 9) AND pred = 2), 0) AS BIGINT) AS in_ground FROM cm",
           lambda p: evaluate.retention(evaluate.confusion(p)).withColumn("accuracy", F.round("accuracy", 9)))
_NEWC = "CASE WHEN h < 0 THEN cls WHEN h < 0.35 THEN 3 WHEN h < 2.2 THEN 4 ELSE 5 END"
relayered = lambda p: rules.layers(p.withColumn("old", F.col("cls")))
over_scene("transitions", f"SELECT cls AS old, CAST({_NEWC} AS INTEGER) AS new, count(*) AS n FROM p GROUP BY ALL", lambda p: evaluate.transitions(relayered(p), "old", "cls"))
over_scene("outside_crop", "SELECT gt, cls AS pred, count(*) AS n FROM p WHERE abs(x - 10) > 5 OR abs(y - 10) > 5 GROUP BY ALL", lambda p: evaluate.confusion(p.where("abs(x - 10) > 5 OR abs(y - 10) > 5")))
over_scene("top_confusions", f"{_M} SELECT gt, pred, n, round(n / sum_n, 9) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY gt) AS sum_n FROM cm) WHERE gt <> pred ORDER BY n DESC, gt, pred LIMIT 25", lambda p: evaluate.top_confusions(evaluate.confusion(p)).withColumn("share", F.round("share", 9)))


def _gate_sql() -> str:
    def side(k: str, cls: str) -> str:
        n = lambda c: f"count(*) FILTER ({c})"
        return f"""{k} AS (SELECT {n(f'gt = {cls}')} / count(*) AS accuracy, coalesce({n(f'gt = 2 AND {cls} = 2')} / nullif({n(f'{cls} = 2')}, 0), 0) AS ground_precision, {n(f'gt = 2 AND {cls} = 2')} / {n('gt = 2')} AS ground_recall,
  2.0 * {n(f'gt = 6 AND {cls} = 6')} / nullif({n('gt = 6')} + {n(f'{cls} = 6')}, 0) AS building_f1, {n(f'gt = 2 AND {cls} IN (7, 9)')} AS ground_lost, {n(f'gt = 6 AND {cls} IN (7, 9)')} AS buildings_lost, {n(f'gt = 9 AND {cls} NOT IN (7, 9)')} AS vehicles_left, {n(f'gt = 7 AND {cls} NOT IN (7, 9)')} AS noise_left, {n(f'gt IN (7, 9) AND {cls} = 2')} AS in_ground FROM q)"""

    up, down = ("accuracy", "ground_precision", "ground_recall", "building_f1"), ("ground_lost", "buildings_lost", "vehicles_left", "noise_left", "in_ground")
    rows = " UNION ALL ".join([f"SELECT '{c}' AS \"check\", b.{c} >= a.{c} AS ok FROM a, b" for c in up] + [f"SELECT '{c}', b.{c} <= a.{c} FROM a, b" for c in down])
    return f"q AS (SELECT gt, cls, {_NEWC} AS new FROM p), {side('a', 'cls')}, {side('b', 'new')}, r AS ({rows}) SELECT * FROM r UNION ALL SELECT 'allowed', bool_and(ok) FROM r"


over_scene("release_gate", _gate_sql(), lambda p: evaluate.gate(evaluate.confusion(p), evaluate.confusion(rules.layers(p))))
over_scene("profile", "SELECT gt, count(*) AS n, round(avg(h), 6) AS mean, round(stddev_pop(h), 6) AS std, " + ", ".join(f"round(quantile_cont(h, {q / 100}), 6) AS p{q}" for q in (5, 25, 50, 75, 95)) + " FROM p GROUP BY gt",
           lambda p: evaluate.profile(p).select("gt", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], *[F.round(f"h_p{q}", 6).alias(f"p{q}") for q in (5, 25, 50, 75, 95)]))
over_scene(
    "intensity_profile",
    "SELECT gt, count(*) AS n, " + ", ".join(f"round(quantile_cont(intensity, {q / 100}), 6) AS p{q}" for q in (5, 25, 50, 75, 95)) + " FROM p GROUP BY gt",
    lambda p: evaluate.profile(p, True).select("gt", "n", *[F.round(f"intensity_p{q}", 6).alias(f"p{q}") for q in (5, 25, 50, 75, 95)]),
)
_EDGES = (-0.05, 0.05, 0.12, 0.35, 1.0, 2.2, 4.0)
over_scene("band_shares", f"b AS (SELECT gt, CASE {' '.join(f'WHEN h >= {e} THEN {e}' for e in reversed(_EDGES))} END AS band FROM p), k AS (SELECT gt, CAST(band AS DOUBLE) AS band, count(*) AS n FROM b GROUP BY ALL) SELECT gt, band, n, round(n / sum(n) OVER (PARTITION BY gt), 9) AS share FROM k",
           lambda p: evaluate.band_shares(p).withColumn("share", F.round("share", 9)))
over_scene("cell_spans", f"{cells(0.5)}, k AS (SELECT gt, ix, iy, max(z) - min(z) AS span, max(h) AS top FROM c GROUP BY ALL HAVING count(*) >= 8) SELECT gt, count(*) AS n_cells, {', '.join(f'round(quantile_cont({c}, {q / 100}), 6) AS {c}_p{q}' for c in ('span', 'top') for q in (50, 95))} FROM k GROUP BY gt",
           lambda p: evaluate.cell_spans(p).select("gt", "n_cells", *[F.round(f"{c}_p{q}", 6).alias(f"{c}_p{q}") for c in ("span", "top") for q in (50, 95)]))
over_scene("refiner_override", "s AS (SELECT point_id, cls, CASE WHEN gt = 8 THEN 4 ELSE gt END AS rf, 0.5 + (intensity % 100) / 200 AS conf FROM p) SELECT point_id, CAST(CASE WHEN (cls IN (3, 4, 5, 6, 7, 9) AND conf >= 0.6 OR cls = 2 AND rf <> 2 AND conf >= 0.75 AND rf IN (3, 9, 6)) AND rf <> cls THEN rf ELSE cls END AS INTEGER) AS cls FROM s",
           lambda p: p.withColumn("rf", F.when(F.col("gt") == 8, 4).otherwise(F.col("gt"))).withColumn("conf", 0.5 + F.pmod("intensity", F.lit(100)) / 200).select("point_id", refine.override().cast("int").alias("cls")))

# queue

_Q = """WITH sub AS (SELECT event_id AS id, event_id // 3 AS task_id, 'w' || user_id AS worker_id, CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'processing' WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'skipped' ELSE 'error' END AS status, ts AS started_at, '/out/f' || (event_id % 977) || '.las' AS output_file FROM events),
roll AS (SELECT task_id, count(*) AS total, count(*) FILTER (status NOT IN ('pending', 'processing')) AS done, CASE WHEN bool_or(status = 'processing') THEN 'processing' WHEN bool_or(status = 'pending') THEN 'pending' WHEN bool_or(status = 'error') THEN 'error' ELSE 'completed' END AS status FROM sub GROUP BY task_id),
wk AS (SELECT worker_id, max(started_at) AS last_heartbeat, max_by(id, (started_at, id)) AS current_subtask_id FROM sub GROUP BY worker_id), busy AS (SELECT DISTINCT output_file FROM sub WHERE status = 'processing')"""


def over_queue(name: str, sql: str, f) -> None:
    register(name, f"{_Q} {sql}", bare=True)(lambda spark, sf_dir: f(*tasks.from_events(spark, sf_dir)))


over_queue("task_rollup", "SELECT * FROM roll", lambda t, s, w: tasks.rolled_up(s))
over_queue("task_status_counts", "SELECT status, count(*) AS n FROM roll GROUP BY status", lambda t, s, w: tasks.status_counts(t))
over_queue("task_search", "SELECT task_id AS id, status FROM roll WHERE contains('/in/' || task_id, 't/3_') OR contains(lower('/Out/' || task_id % 7 || '_%'), 't/3_') OR contains('u' || task_id, 't/3_') ORDER BY id DESC LIMIT 20 OFFSET 20", lambda t, s, w: tasks.search(t, "T/3_", page=1).select("id", "status"))
over_queue("output_busy", "SELECT output_file FROM busy", lambda t, s, w: tasks.busy_outputs(s))
_CLAIM = "SELECT sub.task_id, id, output_file FROM sub JOIN roll USING (task_id) WHERE sub.status = 'pending' AND roll.status IN ('pending', 'processing') AND output_file NOT IN (SELECT output_file FROM busy)"
over_queue("claimable", _CLAIM, lambda t, s, w: tasks.claimable(t, s))
over_queue("claim_fifo", f"{_CLAIM} ORDER BY sub.task_id, id LIMIT 5", lambda t, s, w: tasks.claim(t, s, 5))
over_queue("stale_lease", "SELECT id, task_id, worker_id FROM sub JOIN wk USING (worker_id) WHERE status = 'processing' AND (last_heartbeat < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 30 MINUTE OR started_at < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 30 MINUTE AND current_subtask_id IS DISTINCT FROM id)", lambda t, s, w: tasks.stale(s, w, F.lit("2024-01-30 12:00:00").cast("timestamp")))
over_queue("heartbeats", "SELECT * FROM wk", lambda t, s, w: w)
over_queue(
    "claim_task",
    """, gone AS (SELECT id AS gid FROM sub JOIN wk USING (worker_id) WHERE status = 'processing' AND (last_heartbeat < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 30 MINUTE OR started_at < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 30 MINUTE AND current_subtask_id IS DISTINCT FROM id)),
re AS (SELECT id, task_id, output_file, CASE WHEN gid IS NOT NULL THEN 'pending' ELSE status END AS status, CASE WHEN gid IS NULL THEN worker_id END AS worker_id FROM sub LEFT JOIN gone ON gid = id),
can AS (SELECT re.task_id, re.id, output_file FROM re JOIN roll USING (task_id) WHERE re.status = 'pending' AND roll.status IN ('pending', 'processing') AND output_file NOT IN (SELECT output_file FROM re WHERE status = 'processing')),
got AS (SELECT id AS tid FROM can QUALIFY row_number() OVER (PARTITION BY output_file ORDER BY task_id, id) = 1 ORDER BY task_id, id LIMIT 50)
SELECT id, CASE WHEN tid IS NOT NULL THEN 'processing' ELSE status END AS status, CASE WHEN tid IS NOT NULL THEN 'w-new' ELSE worker_id END AS worker_id FROM re LEFT JOIN got ON tid = id""",
    lambda t, s, w: tasks.claimed(t, s, w, "w-new", F.lit("2024-01-30 12:00:00").cast("timestamp"), 50).select("id", "status", "worker_id"),
)
over_queue("task_rollup_sticky", "SELECT task_id, total, done, CASE WHEN task_id % 5 = 0 THEN 'cancelled' ELSE status END AS status FROM roll", lambda t, s, w: tasks.rolled_up(s, t.withColumn("status", F.when(F.col("id") % 5 == 0, "cancelled").otherwise(F.col("status")))))
over_queue("restart_task", "SELECT 1000000 AS task_id, output_file, 'pending' AS status FROM sub WHERE task_id = 7", lambda t, s, w: tasks.restarted(t, s, 7, 1_000_000)[1])
over_queue("cancel_task", "SELECT id, CASE WHEN task_id = 3 AND status = 'pending' THEN 'cancelled' ELSE status END AS status FROM sub", lambda t, s, w: tasks.cancelled(s, 3).select("id", "status"))

# beyond SQL: the forest and the stages; tests hold them against small fixtures

over_scene("stages_front", None, lambda p: classify.classify(p, ["ground", "building", "layers", "paving"]).select("point_id", "cls"))
over_scene("classify_scene", None, lambda p: classify.classify(p, reset=True).select("point_id", "cls"))
over_scene("cloth_ground", None, cloth.cloth_ground)
over_scene(
    "density_hierarchy",
    None,
    lambda p: density.density_hierarchy(in_band(p), 25, 6, 0.25, 1.0, 8).where("group_id IS NOT NULL").select("point_id", F.col("group_id.level").alias("rung"), F.col("group_id.comp").alias("part")),
)


@register("forest_refine")
def forest_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest learnt from a balanced part of the scene and applied to all of it."""
    table = cut(refine.features(scene(spark, sf_dir)).withColumn("gt", F.when(F.col("gt") == 8, 7).otherwise(F.col("gt"))))
    model = refine.train(cut(refine.balanced(table, 1000)))
    return refine.score(table, model).select("point_id", refine.override().cast("int").alias("cls"))
