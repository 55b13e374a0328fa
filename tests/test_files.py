"""LAS files as a data source both ways: pruned scans, all-or-nothing writes, release checks."""

import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from pointmill.sources import las

SCHEMA = "point_id long, x double, y double, z double, cls int, gt int, intensity int, gz double"


def cloud(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y), float(z), c, c, 100 + i, 0.0) for i, (x, y, z, c) in enumerate(rows)], SCHEMA)


def reader(folder, *names):
    files = sorted(os.path.join(folder, x) for x in os.listdir(folder) if x.endswith(".las"))
    return las._PrunedReader(files, 1_000_000, list(names))


def test_boxes_skip_files_and_schemas_skip_columns(spark, tmp_path):
    for k in range(4):
        las.write(cloud(spark, [(10 * k + i / 50, i / 100, k, 2) for i in range(400)]), str(tmp_path / f"{k}.las"))
    everything = las.load(spark, str(tmp_path))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = las.load(spark, str(tmp_path)).where((F.col("x") >= 12) & (F.col("x") < 15) & (F.col("z") == 1))
        want = {tuple(r) for r in everything.collect() if 12 <= r.x < 15 and r.z == 1}
        assert {tuple(r) for r in some.collect()} == want and len(want) == 150
        assert some.rdd.getNumPartitions() == 1 < everything.rdd.getNumPartitions()
        assert las.load(spark, str(tmp_path)).where("x > 1000").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    r = reader(tmp_path, "x", "cls")
    filters = [GreaterThanOrEqual(("x",), 12.0), LessThan(("x",), 25.0), EqualTo(("cls",), 2)]
    assert list(r.pushFilters(filters)) == filters
    read = r.partitions()
    assert [os.path.basename(p.path) for p in read] == ["1.las", "2.las"] and [p.base for p in read] == [400, 800]
    batch = next(r.read(read[0]))
    assert batch.schema.names == ["x", "cls"] and batch.num_rows == 400
    thin = las.load(spark, str(tmp_path), "cls int, x double")
    assert thin.columns == ["cls", "x"] and thin.agg(F.sum("x")).first() == everything.agg(F.sum("x")).first()


def test_folder_round_trip_append_and_overwrite(spark, tmp_path):
    p = cloud(spark, [(i * 0.5, -i * 0.25, i * 0.001, i % 12) for i in range(1000)])
    folder = str(tmp_path / "out")
    las.save(p.repartition(3), folder)
    back = las.load(spark, folder)
    key = lambda df: sorted((round(r.x, 3), round(r.y, 3), round(r.z, 3), r.cls, r.intensity) for r in df.collect())
    assert key(back) == key(p) and len(os.listdir(folder)) == 3
    las.save(p.where("cls = 1").coalesce(1), folder)
    assert las.load(spark, folder).count() == 1000 + p.where("cls = 1").count()
    las.save(p.where("cls = 2").coalesce(1), folder, "overwrite", scales="0.01,0.01,0.01", offsets="5,5,0")
    assert las.load(spark, folder).count() == p.where("cls = 2").count() and len(os.listdir(folder)) == 1
    h = las.header(os.path.join(folder, os.listdir(folder)[0]))
    assert h["scales"] == (0.01,) * 3 and h["offsets"] == (5.0, 5.0, 0.0) and h["box"]["x"] == (1.0, 499.0)
    las.save(p.limit(0), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == [] and las.load(spark, str(tmp_path / "none")).count() == 0


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    p = cloud(spark, [(i, 0, 0, 2) for i in range(90)]).repartition(3)
    folder = str(tmp_path / "out")
    las.save(p, folder)
    before = sorted(os.listdir(folder))
    broken = p.withColumn("z", F.when(F.col("point_id") == 70, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("z")))
    with pytest.raises(Exception, match="lost"):
        las.save(broken, folder)
    assert sorted(os.listdir(folder)) == before
    with pytest.raises(Exception, match="columns"):
        las.save(p.drop("cls"), folder)


def test_only_committed_attempts_count(tmp_path):
    w = las._Writer(str(tmp_path), False, (0.001,) * 3, (0.0,) * 3)
    os.makedirs(w.parts)
    names = [os.path.join(w.parts, f"part-00000-{attempt}.las") for attempt in (7, 8)]
    for name in names:
        with open(name, "wb") as f:
            f.write(b"LASF")
    w.commit([las._Written(names[1]), las._Written(None), None])
    assert os.listdir(tmp_path) == [f"part-00000-{w.job}.las"]
    w.abort([])


def test_renames_are_tried_again(tmp_path, monkeypatch):
    tries, real = [], os.replace

    def refusing(a, b):
        tries.append(a)
        if len(tries) < 3:
            raise OSError("busy")
        return real(a, b)

    monkeypatch.setattr(os, "replace", refusing)
    (tmp_path / "a").write_text("x")
    las.replaced(str(tmp_path / "a"), str(tmp_path / "b"), 5, 0.001)
    assert (tmp_path / "b").read_text() == "x" and len(tries) == 3
    with pytest.raises(OSError):
        las.replaced(str(tmp_path / "none"), str(tmp_path / "b"), 2, 0.001)


def test_a_release_must_not_change_other_attributes(spark, tmp_path):
    p = cloud(spark, [(i, i, i, i % 9) for i in range(300)])
    a, b = str(tmp_path / "a.las"), str(tmp_path / "b.las")
    las.write(p, a)
    las.write(las.load(spark, a, raw="true").withColumn("cls", F.lit(6)), b, like=a)
    assert las.same_attributes(spark, a, b)
    with open(b, "r+b") as f:
        f.seek(las.header(b)["start"] + 30 * 17 + 12)
        f.write(struct.pack("<H", 9999))  # one point's intensity
    assert not las.same_attributes(spark, a, b) and las.validate(spark, a, b)
