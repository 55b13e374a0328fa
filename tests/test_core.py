"""Core operators: bounds on tiny clouds, partition invariance, oracles on the smallest tables, files, streams and plans."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from pointmill.operators import blobs, density, graph, grid, refine, rules, spatial, terrain
from pointmill.plans import classify, evaluate, tasks, tiles
from pointmill.queries import ORACLES, QUERIES
from pointmill.sources import las
from pointmill.sources.points import scene

SF = "/root/testdata/sf0.001"


def cloud(spark, rows):
    """rows of (x, y, z, cls); gz is 0."""
    return spark.createDataFrame([(i, float(x), float(y), float(z), c, c, 100 + i, 0.0) for i, (x, y, z, c) in enumerate(rows)], "point_id long, x double, y double, z double, cls int, gt int, intensity int, gz double")


def classes(df):
    return {r.point_id: r.cls for r in df.collect()}


def plain(v):
    return round(float(v), 6) if isinstance(v, float) else int(v) if isinstance(v, bool | np.bool_) else v


@pytest.mark.parametrize("name", ["class_histogram", "road_surface", "ground_split", "relayer", "sparse_voxels", "restore_paving", "near_building", "dilate_cells", "open_2x2", "components", "precision_recall", "release_gate", "task_rollup", "stale_lease", "density_groups", "density_cars_strict", "restore_asphalt", "quadtree_leaves", "window_scan", "crop_fallback", "intensity_profile", "claim_task", "last_cars"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    at = {d[0]: i for i, d in enumerate(want.description)}
    expected = sorted(str([plain(r[at[c]]) for c in columns]) for r in want.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str([plain(r[c]) for c in columns]) for r in got.collect()) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_ids_are_unique(spark):
    p = scene(spark, SF)
    assert p.select("point_id").distinct().count() == p.count()


def test_partitioning_changes_nothing(spark):
    p = scene(spark, SF)
    for rule in (rules.detect_walls, rules.restore_asphalt, rules.recover_landscape, blobs.restore_curbs):
        assert classes(rule(p.repartition(1))) == classes(rule(p.repartition(7)))


def test_layer_bounds(spark):
    p = cloud(spark, [(0, 0, z, 5) for z in (-0.1, 0.08, 0.0801, 0.3499, 0.35, 2.1999, 2.2)])
    assert list(classes(rules.relayer(p)).values()) == [2, 2, 3, 3, 4, 4, 5]
    assert list(classes(rules.layers(p)).values()) == [5, 3, 3, 3, 4, 4, 5]


def test_radius_is_exclusive_and_ties_go_to_the_smaller_id(spark):
    p = cloud(spark, [(0, 0, 0, 6), (0.5, 0, 0, 3), (0.4999, 0, 0, 3), (10, 0, 1, 2), (12, 0, 2, 2), (11, 0, 1, 7)])
    near = spatial.near(p, rules.is_class(3), rules.is_class(6), 0.5)
    assert {r.point_id for r in near.where("near").collect()} == {2}
    best = spatial.nearest(p, rules.is_class(7), rules.is_class(2), 3.0, ["point_id", "z"]).collect()
    assert [(r.point_id, r.n_point_id, r.n_z) for r in best] == [(5, 3, 1.0)]


def test_sparse_rule_needs_enough_points_in_all(spark):
    few = cloud(spark, [(0, 0, 1, 4), (5, 5, 1, 4)])
    assert set(classes(rules.sparse_voxels(few, least=3)).values()) == {4}
    more = cloud(spark, [(0, 0, 1, 4), (5, 5, 1, 4), (5.01, 5, 1, 4), (5.02, 5, 1, 4)])
    assert list(classes(rules.sparse_voxels(more, least=3)).values()) == [7, 4, 4, 4]


def test_opening_and_dilation_match_numpy(spark):
    r = np.random.default_rng(0)
    z = r.normal(size=(23, 9))
    table = spark.createDataFrame([(int(i), int(j), float(z[i, j])) for i in range(23) for j in range(9)], "ix long, iy long, v double")

    def slide(a, take, k):
        b = np.pad(a, k, mode="symmetric")
        return np.array([[take(b[i : i + 2 * k + 1, j : j + 2 * k + 1]) for j in range(a.shape[1])] for i in range(a.shape[0])])

    got = {(x.ix, x.iy): x.v for x in grid.opening(table, "v", 7).collect()}
    want = slide(slide(z, np.min, 3), np.max, 3)
    assert all(got[i, j] == want[i, j] for i in range(23) for j in range(9))
    mask = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (5, 5)], "ix long, iy long")
    assert {tuple(x) for x in grid.opened(mask, 2).collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert grid.dilate(mask.where("ix = 5"), 1, cross=True).count() == 5 and grid.dilate(mask.where("ix = 5"), 2).count() == 25


def test_components_of_chains_stars_and_random_edges(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(150)] + [(None, 5)]
    got = {x.id: x.component for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges if None not in e for v in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {v: find(v) for v in root}


def test_shapes_in_closed_form_match_numpy(spark):
    r = np.random.default_rng(4)
    xyz = r.normal(size=(200, 3)) @ np.diag([3, 1, 0.5]) @ np.linalg.qr(r.normal(size=(3, 3)))[0]
    p = cloud(spark, [(*x, 4) for x in xyz]).withColumn("group_id", F.lit(1))
    values = np.linalg.eigvalsh(np.cov(xyz.T, bias=True))
    assert math.isclose(blobs.group_shapes(p).first().flatness, values[0] / values[-1], rel_tol=1e-6)


def test_density_groups_match_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(*(np.array(c) + r.normal(0, 0.1, 3)), 4) for c in ((1, 1, 1), (9.98, 5, 1), (15, 15, 1)) for _ in range(120)] + [(*r.uniform(0, 20, 3), 4) for _ in range(60)] + [(3 + i / 4, 9, 1, 4) for i in range(60)] * 2
    p = cloud(spark, rows)
    for least, samples, epsilon, voxel in ((30, 6, 0.4, 0.08), (10, 2, 0.3, 0.2), (100, 3, 0.26, 0.01)):
        cells = {}
        for i, row in enumerate(rows):
            cells.setdefault(tuple(math.floor(v / voxel) for v in row[:3]), []).append(i)
        own = list(cells.values())
        xyz = np.array([np.mean([rows[i][:3] for i in o], axis=0) for o in own])
        near = ((xyz[:, None] - xyz[None]) ** 2).sum(2) <= epsilon * epsilon
        dense = near @ np.array([len(o) for o in own]) >= samples
        label = np.arange(len(own))
        while True:
            least_near = np.array([label[near[i] & dense].min() if dense[i] else label[i] for i in range(len(own))])
            if (least_near == label).all():
                break
            label = least_near
        groups = {}
        for i in np.flatnonzero(dense):
            groups.setdefault(label[i], set()).update(own[i])
        want = {frozenset(g) for g in groups.values() if len(g) >= least}
        got = {}
        for x in density.density_groups(p, least, samples, epsilon, voxel).where("group_id IS NOT NULL").collect():
            got.setdefault(x.group_id, set()).add(x.point_id)
        assert {frozenset(g) for g in got.values()} == want and want
    assert density.density_groups(p.limit(0)).count() == 0


def test_distances_to_the_nearest_target_match_brute_force(spark):
    r = np.random.default_rng(8)
    xy = np.vstack([r.uniform(0, 60, (400, 2)), r.normal((5, 5), 0.3, (200, 2)), [[500.0, 500.0]], r.uniform(-3, 3, (50, 2))])
    p = cloud(spark, [(*q, 0, 6 if i % 9 == 0 and i < 600 else 2) for i, q in enumerate(xy.tolist())])
    towers = p.where("cls = 6")
    t = np.array([q for i, q in enumerate(xy) if i % 9 == 0 and i < 600])
    d = np.sqrt(((xy[:, None] - t[None]) ** 2).sum(2)).min(1)
    for limit, finest in ((20.0, 0.16), (5.0, 1.0), (3.0, 0.7)):
        got = {x.point_id: x.distance for x in spatial.nearest_distance(p, towers, limit, finest).collect()}
        assert set(got) == set(np.flatnonzero(d < limit).tolist())
        assert all(abs(got[i] - d[i]) < 1e-9 for i in got)
    assert spatial.nearest_distance(p, towers.limit(0), 20.0).count() == 0
    e = {x.point_id: x.d_bldg for x in refine.building_distance(p.withColumn("z", F.lit(9.0))).collect()}
    assert e[600] == 20.0 and e[0] == 0.0


def test_outliers(spark):
    r = np.random.default_rng(6)
    p = cloud(spark, [(*r.uniform(0, 1, 3), 4) for _ in range(300)] + [(1.7, 1.7, 1.7, 4)])
    assert {x.point_id for x in density.outliers(p, 10, 4.0).collect()} == {300}


def test_outliers_of_sparse_clouds(spark):
    r = np.random.default_rng(7)
    xyz = np.vstack([np.column_stack([r.uniform(0, 6, (540, 2)), np.zeros(540)]), [[3, 3, 48], [3, 3, 5]]])
    far = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(2))
    mean = np.sort(far, axis=1)[:, 1:11].mean(1)
    want = set(np.flatnonzero(mean > mean.mean() + 2.2 * mean.std()).tolist())
    p = cloud(spark, [(*row, 4) for row in xyz.tolist()])
    assert 540 in want and {x.point_id for x in density.outliers(p, 10, 2.2, 0.5).collect()} == want
    assert density.outliers(p.limit(1), 10, 2.2, 0.5).count() == 0 and density.outliers(p.limit(5), 10, 2.2, 0.5).count() == 0


def test_forest_learns_and_overrides(spark):
    table = refine.features(scene(spark, SF))
    model = refine.train(refine.balanced(table.where("gt IN (2, 6, 9)"), 300), trees=10, depth=6, leaf=2)
    scored = refine.score(table.where("gt IN (2, 6, 9)"), model)
    right = scored.withColumn("cls", refine.override()).agg(F.avg((F.col("cls") == F.col("gt")).cast("double"))).first()[0]
    assert right > 0.7 and scored.count() == table.where("gt IN (2, 6, 9)").count()


def test_scores_and_gate_extremes(spark):
    m = spark.createDataFrame([(2, 2, 10), (6, 2, 5), (9, 7, 1)], "gt int, pred int, n long")
    got = {r.cls: (r.precision, r.recall, r.f1) for r in evaluate.scores(m).collect()}
    assert got[6] == (0.0, 0.0, 0.0) and got[7] == (0.0, None, 0.0) and got[2][1] == 1.0
    assert all(r.ok for r in evaluate.gate(m, m).collect())
    worse = spark.createDataFrame([(2, 7, 10), (6, 2, 5), (9, 7, 1)], "gt int, pred int, n long")
    assert {r.check for r in evaluate.gate(m, worse).collect() if not r.ok} >= {"allowed", "ground_lost", "accuracy"}


def test_task_rollup_and_queue(spark):
    rows = [(1, 1, "success"), (2, 1, "skipped"), (3, 2, "pending"), (4, 2, "processing"), (5, 3, "cancelled"), (6, 4, "error"), (7, 4, "cancelled")]
    sub = spark.createDataFrame([(i, t, s, f"/o/{i % 2}", "w") for i, t, s in rows], "id long, task_id long, status string, output_file string, worker_id string")
    got = {r.task_id: (r.status, r.total, r.done) for r in tasks.rolled_up(sub).collect()}
    assert got == {1: ("completed", 2, 2), 2: ("processing", 2, 0), 3: ("cancelled", 1, 1), 4: ("error", 2, 2)}
    found = spark.createDataFrame([(1, "pending", "/a/100%_x"), (12, "error", "/a/100Xyz")], "id long, status string, input_path string")
    assert [r.id for r in tasks.search(found, "100%_X").collect()] == [1] and [r.id for r in tasks.search(found, "12").collect()] == [12]
    assert classes_of(tasks.cancelled(sub, 2)) == {1: "success", 2: "skipped", 3: "cancelled", 4: "processing", 5: "cancelled", 6: "error", 7: "cancelled"}
    assert classes_of(tasks.completed(sub, 4, "w", "error", True))[4] == "cancelled" and classes_of(tasks.completed(sub, 4, "other", "success"))[4] == "processing"


def classes_of(df):
    return {r.id: r.status for r in df.collect()}


def test_claims_restarts_and_sticky_states(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    sub = spark.createDataFrame(
        [(1, 1, "pending", "/o/a", None, None, 0.0), (2, 1, "pending", "/o/a", None, None, 0.0), (3, 2, "processing", "/o/b", "old", "2024-01-01 00:00:00", 5.0), (4, 2, "pending", "/o/c", None, None, 0.0), (5, 3, "pending", "/o/d", None, None, 0.0), (6, 2, "processing", "/o/e", "live", "2024-01-01 23:59:00", 9.0), (7, 2, "pending", "/o/e", None, None, 0.0)],
        "id long, task_id long, status string, output_file string, worker_id string, started_at string, progress double",
    ).withColumn("started_at", F.col("started_at").cast("timestamp"))
    found = spark.createDataFrame([(1, "pending"), (2, "processing"), (3, "cancelled"), (4, "pending")], "id long, status string")
    workers = spark.createDataFrame([("live", "2024-01-01 23:59:30", 6)], "worker_id string, last_heartbeat string, current_subtask_id long").withColumn("last_heartbeat", F.col("last_heartbeat").cast("timestamp"))
    got = {r.id: (r.status, r.worker_id) for r in tasks.claimed(found, sub, workers, "me", now, 2).collect()}
    assert got == {1: ("processing", "me"), 2: ("pending", None), 3: ("processing", "me"), 4: ("pending", None), 5: ("pending", None), 6: ("processing", "live"), 7: ("pending", None)}
    rolled = {r.task_id: (r.status, r.total) for r in tasks.rolled_up(sub, found).collect()}
    assert rolled == {1: ("pending", 2), 2: ("processing", 4), 3: ("cancelled", 1), 4: ("completed", 0)}
    task, rows = tasks.restarted(found, sub, 2, 9)
    assert task.first().id == 9 and {(r.task_id, r.output_file, r.status) for r in rows.collect()} == {(9, f"/o/{c}", "pending") for c in "bce"}
    assert {r.progress for r in tasks.progressed(sub, 6, "live", 250).where("id = 6").collect()} == {100.0} and tasks.progressed(sub, 6, "other", 50).where("id = 6").first().progress == 9.0
    listed = spark.createDataFrame([(1, "pending", "ab%_c", "/in/x", "/out/y"), (2, "error", "u2", "/in/AB%_C", None), (3, "error", "u3", "/in/abxyc", "/OUT/Ab%_c")], "id long, status string, uid string, input_path string, output_path string")
    assert [r.id for r in tasks.search(listed, "B%_c").collect()] == [3, 2, 1] and [r.id for r in tasks.search(listed, "3").collect()] == [3]
    files = spark.createDataFrame([("/in.d/(x)/a.las",), ("/in.d/(x)/s/B.LAZ",), ("/in.d/(x)/c.txt",)], "path string")
    assert {r.output_file for r in tasks.new_tasks(files, 1, "/in.d/(x)", "/out").collect()} == {"/out/a.las", "/out/s/B.LAZ"}


def test_tiles_cover_once_and_sizes_are_sane(spark):
    p = cloud(spark, [(x / 2, y / 2, 0, 2) for x in range(30) for y in range(30)])
    halo = tiles.with_halo(p, 5.0, 1.0)
    assert halo.where("is_core").groupBy("point_id").count().where("count <> 1").count() == 0 and halo.where("is_core").count() == 900
    assert tiles.uncovered(p, halo.where("is_core")).count() == 0 and tiles.uncovered(p, halo.where("is_core AND point_id <> 7")).collect()[0].point_id == 7 and tiles.uncovered(p, halo).count() > 0
    assert terrain.radius_low_points(p).count() == 0
    assert sum((r.x1 - r.x0) * (r.y1 - r.y0) for r in tiles.tile_grid(0, 14.5, 0, 14.5, 5)) == pytest.approx(14.5**2)
    assert p.where(tiles.window(0, 14.5, 0, 14.5, 14.5, 14.5)).count() == 900 and p.where(tiles.window(0, 5, 0, 5, 14.5, 14.5)).count() == 100


def test_las_round_trip(spark, tmp_path):
    spark.dataSource.register(las.LasSource)
    p = cloud(spark, [(i * 0.5, i * 0.25, -i * 0.001, i % 12) for i in range(2500)])
    path = str(tmp_path / "a.LAS")
    assert las.write(p, path) == 2500 and las.header(path)["count"] == 2500
    back = spark.read.format("las").option("records", "700").load(path)
    assert back.rdd.getNumPartitions() == 4
    rows = back.orderBy("point_id").collect()
    assert [(r.x, r.z, r.cls, r.intensity) for r in rows[:3]] == [(0.0, 0.0, 0, 100), (0.5, -0.001, 1, 101), (1.0, -0.002, 2, 102)]
    assert las.same_points(back, back) and not las.same_points(back, back.where("point_id > 0"))
    raw = las.load(spark, path, records="700", raw="true")
    copy = str(tmp_path / "b.las")
    assert las.write(raw.withColumn("cls", F.lit(9)), copy, like=path) == 2500
    receipt = str(tmp_path / "receipt.json")
    assert las.validate(spark, path, copy, receipt) and las.validate(spark, path, copy, receipt) and not las.validate(spark, path, str(tmp_path / "none.las"))
    assert {r.cls for r in las.load(spark, copy).select("cls").distinct().collect()} == {9} and las.load(spark, copy).agg(F.sum("intensity")).first() == back.agg(F.sum("intensity")).first()
    las.write(p.withColumn("z", F.col("z") + F.when(F.col("point_id") == 77, 1.0).otherwise(0.0)), copy)
    assert not las.validate(spark, path, copy, receipt)
    las.write(p.where("point_id < 2000"), copy)
    assert not las.validate(spark, path, copy) and [x.name for x in tmp_path.iterdir() if "writing" in x.name] == []
    (tmp_path / "bad.las").write_bytes(b"nonsense")
    with pytest.raises(ValueError):
        las.header(str(tmp_path / "bad.las"))


def test_stream_of_files(spark, tmp_path):
    from pointmill.streaming import landing

    p = cloud(spark, [(i, 0, 0.05 * i, 3) for i in range(20)])
    for i in range(3):
        p.write.mode("append").parquet(str(tmp_path / "in"))
    stream = landing.landing(spark, str(tmp_path / "in"), p.schema, 1)
    q = landing.classify_batches(stream, rules.relayer, str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 60 and {r.cls for r in out.select("cls").distinct().collect()} == {2, 3, 4}


def small_scene(spark):
    """A street of 12 m x 9 m: sloping ground, a car, a building with walls and a roof, a stray point."""
    r = np.random.default_rng(12)
    u = lambda a, b, n: r.uniform(a, b, n)
    ground = np.column_stack([u(0, 12, 9000), u(0, 9, 9000), u(0, 0.02, 9000)])
    roof = np.column_stack([u(1, 10, 1500), u(6.6, 9, 1500), u(5.9, 6.1, 1500)])
    wall = np.column_stack([u(1, 10, 2500), u(6.5, 6.6, 2500), u(0.1, 6, 2500)])
    car = np.vstack([np.column_stack([u(2, 6.2, 1800), u(2, 3.8, 1800), u(1.2, 1.4, 1800)]), np.column_stack([u(2, 6.2, 700), np.where(u(0, 1, 700) < 0.5, 2.0, 3.8), u(0.4, 1.3, 700)])])
    parts = [(ground, 2), (roof, 6), (wall, 6), (car, 9), (np.array([[11.0, 1.0, 5.0]]), 7)]
    rows = [(x, y, z + 0.01 * x, c) for xyz, c in parts for x, y, z in xyz]
    return cloud(spark, rows)


def test_all_stages_on_a_small_street(spark):
    p = small_scene(spark)
    changes = []
    out = classify.classify(p, changes=changes, reset=True)
    assert out.count() == p.count() and out.columns == p.columns and len(changes) == sum(len(steps) for _, steps in classify.STAGES)
    share = {r.gt: r.right for r in out.groupBy("gt").agg(F.avg((F.col("cls") == F.col("gt")).cast("double")).alias("right")).collect()}
    assert share[2] > 0.95 and share[9] > 0.95 and share[6] > 0.3 and share[7] == 1.0, share
    assert {name for name, _, n in changes if n} >= {"ground", "building", "layers", "objects", "sparse", "finalize"}


def test_changes_are_those_of_each_rule(spark):
    p = scene(spark, SF).limit(3000)
    changes, stages = [], ["ground", "building", "layers", "paving"]
    out = classify.classify(p, stages, changes)
    assert out.count() == p.count() and out.columns == p.columns and out.where("cls = 2").count() > 0
    before = p
    for k, name in enumerate(stages):
        after = classify.classify(p, stages[: k + 1])
        moved = before.select("point_id", F.col("cls").alias("was")).join(after, "point_id").where("was <> cls").count()
        steps = [n for s, _, n in changes if s == name]
        assert max(steps) <= sum(steps) and moved <= sum(steps) and (len(steps) > 1 or moved == steps[0])
        before = after
    assert terrain.road_surface(scene(spark, SF)).count() == 400


def test_layout_reads_few_files(spark, tmp_path):
    from pointmill.plans import layout

    r = random.Random(4)
    p = cloud(spark, [(r.uniform(-40, 40), r.uniform(-40, 40), 0, 2) for _ in range(4000)])
    path = str(tmp_path / "z")
    layout.write(p, path, 1.0, 3)
    whole = spark.read.parquet(path)
    some = layout.read_window(spark, path, -7.5, 4.25, 10.0, 21.0, 1.0, 3)
    some.collect()
    read = some._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numFiles").get().value()
    assert 0 < read * 5 < len(whole.inputFiles())
    want = {x.point_id for x in p.where("x >= -7.5 AND x < 4.25 AND y >= 10 AND y < 21").collect()}
    assert {x.point_id for x in some.collect()} == want and whole.count() == 4000
    scan = layout.read_window(spark, path, 100.0, 101.0, 0.0, 1.0, 1.0, 3)
    assert scan.count() == 0 and scan.columns == p.columns
    for x0, x1, y0, y1 in ((3, 9, 2, 17), (0, 0, 0, 0), (5, 500, 7, 8)):
        held = layout.ranges(x0, x1, y0, y1)
        assert all(any(a <= layout._interleaved(x, y) <= b for a, b in held) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)) and len(held) <= 64


def test_scenes_left_out_in_turn(spark, tmp_path):
    table = refine.features(scene(spark, SF)).where("gt IN (2, 6, 9)").withColumn("scene", F.pmod("point_id", F.lit(3)))
    table = table.cache()

    def refined(rows, model):
        return refine.score(rows, model).withColumn("new", refine.override())

    out = evaluate.leave_one_out(table, lambda rows: refine.train(rows, trees=5, depth=5, leaf=2), refined)
    rows = {x.scene: x for x in out.collect()}
    assert set(rows) == {0, 1, 2} and sum(x.n for x in rows.values()) == table.count() and all(x.after > x.before for x in rows.values())
    evaluate.write_report(out, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3
    table.unpersist()


def test_heartbeats_drop_late_events(spark, tmp_path):
    from pointmill.streaming import landing

    schema = "worker_id string, ts timestamp"
    batches = [[("a", "2024-01-01 00:01:00"), ("a", "2024-01-01 00:03:00"), ("b", "2024-01-01 00:02:00")], [("a", "2024-01-01 01:00:00")], [("a", "2024-01-01 01:30:00")], [("b", "2024-01-01 00:04:00"), ("a", "2024-01-01 02:00:00")], [("a", "2024-01-01 03:00:00")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "worker_id string, ts string").select("worker_id", F.col("ts").cast("timestamp").alias("ts")).coalesce(1).write.parquet(str(tmp_path / f"b{k}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        for f in (tmp_path / f"b{k}").glob("*.parquet"):
            f.rename(tmp_path / "in" / f"{k}.parquet")
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = landing.heartbeats(events).writeStream.format("memory").queryName("beats").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(x.worker_id, str(x.last_heartbeat), x.n) for x in spark.table("beats").collect()}
    assert {("a", "2024-01-01 00:03:00", 2), ("b", "2024-01-01 00:02:00", 1)} <= got and not any(n == 2 and w == "b" for w, _, n in got)
