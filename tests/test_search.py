"""Searches inside leaves against brute force, and how much they look at."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointmill.operators import quadtree, search, spatial

SCHEMA = "point_id long, x double, y double, z double, cls int, gt int, intensity int, gz double"


def cloud(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y), float(z), c, c, 100 + i, 0.0) for i, (x, y, z, c) in enumerate(rows)], SCHEMA)


def test_the_nearest_and_the_closest_match_brute_force():
    r = np.random.default_rng(1)
    q, t, ids = r.integers(0, 300, (500, 2)) * 0.001, r.integers(0, 300, (700, 2)) * 0.001, r.permutation(700)
    best, d2 = search.nearest_one(q, t, ids, 0.02, search.fitted(t, 2))
    far = (q[:, None, 0] - t[None, :, 0]) ** 2 + (q[:, None, 1] - t[None, :, 1]) ** 2
    for i, row in enumerate(far):
        ties = np.flatnonzero(row == row.min())
        assert (best[i], d2[i]) == ((ties[ids[ties].argmin()], row.min()) if row.min() < 0.02**2 else (-1, np.inf))
    p = r.random((1500, 3)) * [1, 1, 0.02]
    p[:300] *= [1, 1, 50]
    far = np.sort(((p[:, None] - p[None]) ** 2).sum(2), axis=1)
    got = np.sort(search.closest(p, p, 21, 0.2, search.fitted(p, 8)), axis=1)
    assert np.allclose(got, np.where(far < 0.04, far, np.inf)[:, :21], atol=1e-12)


def test_a_dense_cloud_is_not_compared_with_all_within_the_radius(monkeypatch):
    """40,000 targets within the radius of each query; about as many entries for a query as in a thin cloud."""
    r, seen, squares = np.random.default_rng(2), [0], search.squares

    def counted(*args):
        d2 = squares(*args)
        seen[0] += d2.size
        return d2

    monkeypatch.setattr(search, "squares", counted)
    q, t = r.random((20_000, 2)), r.random((40_000, 2))
    best, _ = search.nearest_one(q, t, np.arange(len(t)), 1.25, search.fitted(t, 2))
    assert (best >= 0).all() and seen[0] < 60 * len(q)


def test_exposed_targets_hold_the_nearest_of_all_far_places():
    r = np.random.default_rng(3)
    t = r.random((4000, 2))
    out = search.exposed(t, t, 0.2, search.fitted(t, 6))
    s = r.random((3000, 2)) * 3 - 1
    far = ((s[:, None] - t[None]) ** 2).sum(2)
    assert out.sum() < 500 and out[far.argmin(1)[far.min(1) >= 0.04]].all()


@pytest.mark.parametrize("first", [0.06, None])
def test_nearest_goes_on_with_rims(spark, first):
    r = np.random.default_rng(4)
    street = r.integers(0, 2000, (3000, 2)) * 0.001
    yard = r.integers(1000, 3500, (600, 2)) * 0.001
    rows = [(x, y, i, 2) for i, (x, y) in enumerate(street)] + [(x, y, 0, 7) for x, y in yard]
    p = cloud(spark, rows)
    best = spatial.nearest(p, F.col("cls") == 7, F.col("cls") == 2, 1.25, ["z"], first, cap=500)
    got = {x.point_id: (x.d2, x.n_z) for x in best.collect()}
    far = (yard[:, None, 0] - street[None, :, 0]) ** 2 + (yard[:, None, 1] - street[None, :, 1]) ** 2
    want = {3000 + i: (row.min(), float(np.flatnonzero(row == row.min())[0])) for i, row in enumerate(far) if row.min() < 1.25**2}
    assert got == want and max(v[0] for v in want.values()) > 0.5


def test_points_are_dealt_by_plain_conditions(spark):
    """Once to each leaf that holds them or has a cell within the halo; no function that is interpreted for each point."""
    r = np.random.default_rng(5)
    xy = np.vstack([r.random((300, 2)) * 4, r.random((300, 2)) * 0.3 + 1])
    p = cloud(spark, [(*q, 0, 2) for q in xy])
    placed = quadtree.dealt(p.select("point_id", "x", "y"), 0.25, 60, 0.2)
    plan = placed._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "lambda" not in plan
    got = [(x.point_id, x.level, x.bx, x.by, x.is_core) for x in placed.collect()]
    assert len({g[:4] for g in got}) == len(got) and sorted(g[0] for g in got if g[4]) == list(range(600))
    cell = np.floor(xy / 0.25).astype(int)
    leaf = {tuple(c): g[1:4] for g in got if g[4] for c in [cell[g[0]]]}
    want = set()  # at least these: a block's cells without points are as near as its others
    for i, (x, y) in enumerate(xy):
        for dx in (-1, 0, 1):
            for dy in (-1, 0, 1):
                c = (cell[i][0] + dx, cell[i][1] + dy)
                away = max(c[0] * 0.25 - x, x - (c[0] + 1) * 0.25, c[1] * 0.25 - y, y - (c[1] + 1) * 0.25)
                if c in leaf and away <= 0.2:
                    want.add((i, *leaf[c]))
    assert want <= {g[:4] for g in got} and len(got) < 1.2 * len(want)


def test_outliers_ship_each_point_once_not_27_times(spark, monkeypatch):
    """Lonely points go on by themselves; each round's rows are counted where they are dealt."""
    from pointmill.operators import density

    r = np.random.default_rng(6)
    xyz = np.vstack([r.random((1500, 3)) * [4, 4, 0.05], [[2, 2, 3], [9, 9, 0]]])
    rows = []
    dealt = quadtree.dealt
    monkeypatch.setattr(density, "dealt", lambda *a: rows.append(d := dealt(*a)) or d)
    far = np.sort(np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(2)), axis=1)[:, 1:21].mean(1)
    want = set(np.flatnonzero(far > far.mean() + 2 * far.std()).tolist())
    p = cloud(spark, [(*q, 4) for q in xyz])
    assert {x.point_id for x in density.outliers(p, radius=0.02).collect()} == want and {1500, 1501} <= want
    assert rows[0].count() < 3 * len(xyz)


def test_distances_of_a_dense_yard_match_brute_force(spark):
    r = np.random.default_rng(7)
    towers = np.round(r.random((4000, 2)) * [3, 0.5] + [0, 2], 3)
    street = np.vstack([r.random((400, 2)) * [4, 3], [[30, 2], [2.9, 14]]])
    p = cloud(spark, [(*q, 9, 6) for q in towers] + [(*q, 0, 2) for q in street] + [(float("nan"), 1, 0, 2)])
    got = {x.point_id: x.distance for x in spatial.distances(p, p.where("cls = 6 AND z > 3"), 20.0).collect()}
    far = np.sqrt(((street[:, None] - towers[None]) ** 2).sum(2)).min(1)
    assert len(got) == 4403 and got[4402] is None and all(got[i] == 0 for i in range(4000))
    assert all(got[4000 + i] is None if d >= 20 else abs(got[4000 + i] - d) < 1e-9 for i, d in enumerate(far))
    assert got[4400] is None and got[4401] is not None


def test_ground_beside_cars_follows_the_nearest_point_of_a_dense_car(spark):
    """The rim of a dense car decides for ground beside it, here by its height, and none of its inner points."""
    from pointmill.operators import rules

    r = np.random.default_rng(8)
    car = [(x, y, 0.5 if x > 1.99 else 0.0, 9) for x, y in r.integers(1000, 2001, (3000, 2)) * 0.001]
    p = cloud(spark, [*car, (2.3, 1.5, 0.1, 2), (2.6, 1.5, 0.1, 2), (0.8, 1.5, 0.25, 2), (0.8, 1.2, 0.1, 2)])
    found = rules.nearest(p, F.col("cls") == 2, F.col("cls") == 9, 0.55, ["z"], 0.1, cap=500)
    far = {3000 + i: min(car, key=lambda c, q=q: (c[0] - q[0]) ** 2 + (c[1] - q[1]) ** 2)[2] for i, q in enumerate([(2.3, 1.5), (2.6, 1.5), (0.8, 1.5), (0.8, 1.2)])}
    assert {x.point_id: x.n_z for x in found.collect()} == {k: v for k, v in far.items() if k != 3001}
    got = {x.point_id: x.cls for x in rules.peel_near_cars(p, max_h=0.3).where("point_id >= 3000").collect()}
    assert got == {3000: 9, 3001: 2, 3002: 2, 3003: 9}
