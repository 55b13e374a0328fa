"""The library's own structures against brute force: links and density hierarchy, quadtree leaves, tiled rasters, components, quantiles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointmill.functions.quantiles import quantiles
from pointmill.operators import density, grid, links, quadtree
from pointmill.operators.graph import merged

SCHEMA = "point_id long, x double, y double, z double, cls int, gt int, intensity int, gz double"


def cloud(spark, xyz, cls=4):
    return spark.createDataFrame([(i, *map(float, p), cls, cls, 100, 0.0) for i, p in enumerate(xyz)], SCHEMA)


# quantiles


def test_quantiles_of_many_distinct_values(spark):
    df = spark.range(1_000_000).select((F.xxhash64("id") / 1e6).alias("a"), F.when(F.col("id") % 3 == 0, F.pow(F.lit(2.0), (F.col("id") % 2000 - 1000).cast("double"))).alias("b"))
    got = quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.0, 0.05, 0.5, 0.95, 1.0])
    want = df.select(*[F.percentile(c, q).alias(f"{c}{q}") for c in "ab" for q in (0.0, 0.05, 0.5, 0.95, 1.0)]).first()
    for (c, q, g), v in got.items():
        assert g is None and math.isclose(v, want[f"{c}{q}"], rel_tol=1e-12), (c, q)


def test_quantiles_by_group_with_nulls_ties_and_extremes(spark):
    rows = [(g, v) for g, values in {1: [3.0] * 9000 + [4.0], 2: [None], 3: [1.0], 4: [float("inf"), 1.0, 2.0], 5: [-1.7e308, 1.7e308] * 5000}.items() for v in values]
    got = quantiles(spark.createDataFrame(rows, "g int, v double"), {"v": F.col("v")}, [0.5, 1.0], F.col("g"))
    assert got == {("v", 0.5, 1): 3.0, ("v", 1.0, 1): 4.0, ("v", 0.5, 3): 1.0, ("v", 1.0, 3): 1.0, ("v", 0.5, 4): 2.0, ("v", 1.0, 4): math.inf, ("v", 0.5, 5): 0.0, ("v", 1.0, 5): 1.7e308}
    assert quantiles(spark.createDataFrame([], "v double"), {"v": F.col("v")}, [0.5]) == {}


# rasters and components


def plain_morph(a, inside, half, steps, fill):
    a = np.where(np.isnan(a) & inside, fill, a) if fill is not None else a
    for step in steps:
        take = np.nanmin if step == "min" else np.nanmax
        out = np.full_like(a, np.nan)
        for i, j in zip(*np.nonzero(~np.isnan(a)), strict=True):
            out[i, j] = take(a[max(0, i - half) : i + half + 1, max(0, j - half) : j + half + 1])
        a = out
    return a


@pytest.mark.parametrize("tile", [4, 64])
@pytest.mark.parametrize("fill", [None, 0.25])
def test_rasters_do_not_depend_on_tiles(spark, tile, fill):
    r = np.random.default_rng(tile)
    z = np.where(r.random((23, 17)) < 0.6, r.normal(size=(23, 17)), np.nan)
    z[22, 16] = z[0, 0] = 1.0
    table = spark.createDataFrame([(int(i), int(j), float(z[i, j])) for i, j in zip(*np.nonzero(~np.isnan(z)), strict=True)], "ix long, iy long, v double")
    for size, steps in ((3, ("min",)), (7, ("min", "max"))):
        got = {(x.ix, x.iy): x.new for x in grid.morphed(table, "v", size, steps, fill, tile).collect()}
        want = plain_morph(z, np.ones_like(z, bool), size // 2, steps, fill)
        assert set(got) == {(i, j) for i, j in zip(*np.nonzero(~np.isnan(want)), strict=True)}
        assert all(got[k] == want[k] for k in got)


@pytest.mark.parametrize("tile", [5, 256])
def test_components_do_not_depend_on_tiles(spark, tile):
    r = np.random.default_rng(9)
    mask = r.random((40, 30)) < 0.62
    cells = {(int(i) - 20, int(j) - 9) for i, j in zip(*np.nonzero(mask), strict=True)}
    want, left = {}, set(cells)
    while left:
        stack, part = [left.pop()], set()
        while stack:
            c = stack.pop()
            part.add(c)
            for d in ((1, 0), (-1, 0), (0, 1), (0, -1)):
                n = (c[0] + d[0], c[1] + d[1])
                if n in left:
                    left.remove(n)
                    stack.append(n)
        want |= {c: min(part) for c in part}
    got = {(x.ix, x.iy): tuple(x.component) for x in grid.components(spark.createDataFrame(sorted(cells), "ix long, iy long"), tile).collect()}
    assert got == want
    assert grid.components(spark.createDataFrame([], "ix long, iy long")).count() == 0


# leaves


def test_leaves_hold_no_more_than_the_cap(spark):
    r = np.random.default_rng(2)
    xyz = np.vstack([np.column_stack([r.uniform(0, 64, (3000, 2)), np.zeros(3000)]), np.column_stack([r.uniform(20, 21, (3000, 2)), np.zeros(3000)]), [[-40.0, 3.0, 0.0]]])
    p = cloud(spark, xyz)
    side, cap, halo = 0.1, 400, 0.1
    out = quadtree.dealt(p, side, cap, halo).cache()
    assert out.where("is_core").count() == len(xyz) and out.where("is_core").select("point_id").distinct().count() == len(xyz)
    counts = out.groupBy(*quadtree.LEAF).agg(F.count("*").alias("n_load"), F.count_if("is_core").alias("n_core")).collect()
    assert max(c.n_load for c in counts) <= cap and max(c.level for c in counts) > 4 > min(c.level for c in counts)
    # every pair within the halo meets in the leaf of each of its points
    held = {}
    for x in out.select("point_id", *quadtree.LEAF, "is_core").collect():
        held.setdefault((x.level, x.bx, x.by), ([], []))[0].append(x.point_id)
        if x.is_core:
            held[x.level, x.bx, x.by][1].append(x.point_id)
    for everyone, own in held.values():
        far = np.hypot(*(xyz[own][:, None, :2] - xyz[None, :, :2]).T)
        assert set(np.flatnonzero((far <= halo * 0.999).any(1))) <= set(everyone)
    out.unpersist()


def test_dense_spots_give_small_leaves_and_the_same_groups(spark):
    r = np.random.default_rng(3)
    spots = [r.normal(c, 0.15, (150, 3)) for c in ((2, 2, 1), (9.9, 5, 1), (30, 30, 1))] + [r.uniform(0, 40, (100, 3))]
    p = cloud(spark, np.vstack(spots))
    sets = []
    for cap in (50, 100_000):
        found = {}
        for x in density.density_groups(p, 30, 6, 0.4, 0.08, cap).where("group_id IS NOT NULL").collect():
            found.setdefault(x.group_id, set()).add(x.point_id)
        sets.append(found)
    assert sets[0] == sets[1] and len(sets[0]) == 3


# links and the hierarchy


def test_forest_connects_what_the_links_connect():
    r = np.random.default_rng(4)
    a, b, rung = r.integers(0, 200, 600), r.integers(0, 200, 600), r.integers(0, 5, 600)
    x, y, s = links.forest(a, b, rung, 200)
    for k in range(5):
        one, two = merged(np.arange(200), a[rung <= k], b[rung <= k])[0], merged(np.arange(200), x[s <= k], y[s <= k])[0]
        assert (one == two).all()
    assert len(x) == 200 - len(np.unique(two))


def slow_hierarchy(xyz, weight, least, samples, rungs):
    """Group of each centroid, by recursion over sets; rungs: one more than links have."""
    n, steps = len(xyz), len(rungs) - 2
    d2 = ((xyz[:, None] - xyz[None]) ** 2).sum(2)
    squares = np.array(rungs[:-1]) ** 2
    far = np.searchsorted(squares, d2)
    core = np.array([next((k for k in range(steps + 1) if weight[far[i] <= k].sum() >= samples), steps + 1) for i in range(n)])
    link = np.maximum(np.maximum(core[:, None], core[None]), far)

    def parts(members, k):
        left, out = set(members), []
        while left:
            stack, one = [left.pop()], set()
            while stack:
                i = stack.pop()
                one.add(i)
                near = {j for j in left if link[i, j] <= k}
                left -= near
                stack += near
            out.append(one)
        return out

    size = lambda s: weight[list(s)].sum()

    def grow(members, k):
        """(gain of the group that begins with these on rung k, its best choice as a list of (first rung, members), its best gain)."""
        gain, here, low, birth = 0.0, members, k, 1 / rungs[k + 1]
        while True:
            if low == 0:
                inner = []
                gain += size(here) * (1 / rungs[0] - birth)
                break
            inner = [s for s in parts(here, low - 1) if size(s) >= least]
            gone = here - set().union(*inner) if inner else here
            gain += size(gone) * (1 / rungs[low] - birth) if gone else 0.0
            if len(inner) != 1:
                gain += sum(size(s) for s in inner) * (1 / rungs[low] - birth)
                break
            here, low = inner[0], low - 1
        below = [grow(s, low - 1) for s in inner]
        best = sum(b for _, b in below)
        return ([(k, members)], gain) if gain >= best else ([c for chosen, _ in below for c in chosen], best)

    chosen = [c for s in parts(range(n), steps) if size(s) >= least for c in grow(s, steps)[0]]
    return {frozenset(members) for _, members in chosen}


def found_groups(df):
    out = {}
    for x in df.where("group_id IS NOT NULL").collect():
        out.setdefault(x.group_id, set()).add(x.point_id)
    return {frozenset(s) for s in out.values()}


@pytest.mark.parametrize("cap", [60, 100_000])
def test_hierarchy_matches_recursion(spark, cap):
    r = np.random.default_rng(6)
    blobs = [r.normal((x, y, 1), s, (k, 3)) for x, y, s, k in ((1, 1, 0.1, 90), (1.7, 1, 0.12, 80), (1.3, 1.9, 0.3, 60), (6, 6, 0.5, 120), (7.2, 6, 0.1, 50), (12, 3, 0.05, 20))]
    xyz = np.vstack([*blobs, r.uniform(0, 14, (120, 3)) * [1, 1, 0.2]])
    for least, samples, epsilon, reach, steps in ((20, 4, 0.1, 1.2, 8), (30, 6, 0.25, 0.8, 3))[: 1 if cap == 60 else 2]:
        rungs = [epsilon * (reach / epsilon) ** (k / steps) for k in range(steps + 2)]
        voxel = {}
        for i, p in enumerate(xyz):
            voxel.setdefault(tuple(np.floor(p / 0.08).astype(int)), []).append(i)
        own = list(voxel.values())
        centres, weight = np.array([xyz[o].mean(0) for o in own]), np.array([len(o) for o in own])
        want = {frozenset(i for v in g for i in own[v]) for g in slow_hierarchy(centres, weight, least, samples, rungs)}
        got = found_groups(density.density_hierarchy(cloud(spark, xyz), least, samples, epsilon, reach, steps, 0.08, cap))
        assert got == want and want


def test_hierarchy_tells_touching_cars_apart(spark):
    r = np.random.default_rng(7)
    car = lambda x: np.column_stack([r.uniform(x, x + 4, 4000), r.uniform(0, 1.8, 4000), r.uniform(1.0, 1.05, 4000)])
    p = cloud(spark, np.vstack([car(0.0), car(4.35), r.uniform(10, 14, (30, 3))]))
    assert len(found_groups(density.density_groups(p, 25, 6, 0.45))) == 1
    apart = found_groups(density.density_hierarchy(p, 25, 6, 0.12, 0.9, 8))
    assert len(apart) == 2 and all(max(g) < 4000 or 4000 <= min(g) and max(g) < 8000 for g in apart)


# the cloth


def slow_cloth(floor, start, steps, rigidness, dt):
    """One cell at a time, over {cell: floor}."""
    z, old = dict.fromkeys(floor, start), dict.fromkeys(floor, start)
    for _ in range(steps):
        free = {c for c in floor if z[c] > floor[c]}
        new = {c: z[c] + (z[c] - old[c]) * 0.99 - 0.2 * dt * dt if c in free else z[c] for c in floor}
        for _ in range(rigidness):
            near = {c: [new[n] for n in ((c[0] + 1, c[1]), (c[0] - 1, c[1]), (c[0], c[1] + 1), (c[0], c[1] - 1)) if n in new] for c in floor}
            new = {c: new[c] + 0.3 * (sum(near[c]) / len(near[c]) - new[c]) if c in free and near[c] else new[c] for c in floor}
        z, old = {c: max(new[c], floor[c]) for c in floor}, z
    return z


def test_cloth_does_not_depend_on_tiles(spark):
    from pointmill.operators import cloth

    r = np.random.default_rng(10)
    ground = np.column_stack([r.uniform(0, 12, (1500, 2)), r.uniform(0, 0.03, 1500)])
    roof = np.column_stack([r.uniform(3, 7, (900, 2)), r.uniform(3.0, 3.05, 900)])
    hole = ~((ground[:, 0] > 3) & (ground[:, 0] < 7) & (ground[:, 1] > 3) & (ground[:, 1] < 7))
    p = cloud(spark, np.vstack([ground[hole], roof]))
    options = {"cell": 1.0, "iterations": 12, "steps": 4, "still": 0.0, "margin": 1}
    got = [{(x.ix, x.iy): -x.gz for x in cloth.cloth(p, tile=tile, **options).collect()} for tile in (5, 64)]
    lows = {}
    for x, y, z in np.vstack([ground[hole], roof]):
        c = (int(x - ground[hole][:, 0].min()), int(y - ground[hole][:, 1].min()))
        lows[c] = max(lows.get(c, -math.inf), -z)
    floor = {(i + a, j + b): -math.inf for i, j in lows for a in (-1, 0, 1) for b in (-1, 0, 1)} | lows
    want = slow_cloth(floor, max(lows.values()) + 0.1, 12, 3, 0.65)
    assert set(got[0]) == set(got[1]) == set(want)
    assert all(abs(got[k][c] - want[c]) < 1e-9 for k in (0, 1) for c in want)
    found = {x.point_id for x in cloth.cloth_ground(p, cell=1.0).collect()}
    n = int(hole.sum())
    assert len(found & set(range(n))) > 0.95 * n and not found & set(range(n, n + 900))
