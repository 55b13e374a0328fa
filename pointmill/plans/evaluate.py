"""Quality of a classification against the truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_table
from ..functions.storage import cut
from ..operators.grid import with_cells

GROUND, BUILDING, NOISE, VEHICLE = 2, 6, 7, 9


def confusion(points: DataFrame, truth: str = "gt", predicted: str = "cls") -> DataFrame:
    return points.groupBy(F.col(truth).alias("gt"), F.col(predicted).alias("pred")).agg(F.count("*").alias("n"))


def scores(matrix: DataFrame) -> DataFrame:
    """cls, precision (0 without predictions), recall (null without truth), f1 (0 then)."""
    both = matrix.select(F.col("gt").alias("cls"), F.lit(0).alias("p"), F.col("n").alias("t"), F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"))
    both = both.union(matrix.select("pred", "n", F.lit(0), F.lit(0)))
    s = both.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("p", "t", "tp")])
    precision = F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(0.0)
    recall = F.when(F.col("t") > 0, F.col("tp") / F.col("t"))
    f1 = F.when((F.col("t") > 0) & (F.col("tp") > 0), 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return s.select("cls", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def retention(matrix: DataFrame, vehicle: int = VEHICLE) -> DataFrame:
    """One row: what the removal classes took, and what they missed."""
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    g, p = F.col("gt"), F.col("pred")
    removed = p.isin(NOISE, vehicle)
    return matrix.agg(
        (F.sum(F.when(g == p, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
        n((g == GROUND) & removed).alias("ground_lost"),
        n((g == BUILDING) & removed).alias("buildings_lost"),
        n((g == vehicle) & ~removed).alias("vehicles_left"),
        n((g == NOISE) & ~removed).alias("noise_left"),
        n(g.isin(NOISE, vehicle) & (p == GROUND)).alias("in_ground"),
    )


def gate(old: DataFrame, new: DataFrame, vehicle: int = VEHICLE) -> DataFrame:
    """check, ok: nine no-regression checks between two confusion matrices, and whether all hold."""
    name = lambda df, k: df.select(*[F.col(c).alias(f"{k}_{c}") for c in df.columns])
    one = name(retention(old, vehicle), "o").join(F.broadcast(name(retention(new, vehicle), "n")))
    for k, m in (("o", old), ("n", new)):
        s = scores(m).groupBy(F.lit(1)).agg(*[F.max(F.when(F.col("cls") == c, F.coalesce(v, F.lit(0.0)))).alias(f"{k}_{v}_{c}") for c, v in ((GROUND, "precision"), (GROUND, "recall"), (BUILDING, "f1"))]).drop("1")
        one = one.join(F.broadcast(s))
    up = [("accuracy", "accuracy"), ("ground_precision", f"precision_{GROUND}"), ("ground_recall", f"recall_{GROUND}"), ("building_f1", f"f1_{BUILDING}")]
    down = ["ground_lost", "buildings_lost", "vehicles_left", "noise_left", "in_ground"]
    z = lambda c: F.coalesce(c, F.lit(0.0))
    checks = [F.struct(F.lit(n).alias("check"), (z(F.col(f"n_{c}")) >= z(F.col(f"o_{c}"))).alias("ok")) for n, c in up]
    checks += [F.struct(F.lit(c).alias("check"), (F.col(f"n_{c}") <= F.col(f"o_{c}")).alias("ok")) for c in down]
    every = F.array(*checks)
    allowed = F.struct(F.lit("allowed").alias("check"), F.forall(every, lambda x: x["ok"]).alias("ok"))
    return one.select(F.explode(F.concat(every, F.array(allowed))).alias("c")).select("c.*")


def transitions(points: DataFrame, old: str, new: str) -> DataFrame:
    return points.groupBy(F.col(old).alias("old"), F.col(new).alias("new")).agg(F.count("*").alias("n"))


def top_confusions(matrix: DataFrame, k: int = 25) -> DataFrame:
    """The k largest off-diagonal cells with their share of the true class."""
    total = matrix.groupBy("gt").agg(F.sum("n").alias("total"))
    wrong = matrix.where("gt <> pred").join(total, "gt").select("gt", "pred", "n", (F.col("n") / F.col("total")).alias("share"))
    return wrong.orderBy(F.desc("n"), "gt", "pred").limit(k)


def band_shares(points: DataFrame, bands=(-0.05, 0.05, 0.12, 0.35, 1.0, 2.2, 4.0)) -> DataFrame:
    """gt, band (its lower edge, null below the first), n and share of the class's points in each height band."""
    h = F.col("z") - F.col("gz")
    band = F.array_max(F.filter(F.array(*[F.lit(float(b)) for b in bands]), lambda b: b <= h))
    counts = points.groupBy("gt", band.alias("band")).agg(F.count("*").alias("n"))
    total = counts.groupBy("gt").agg(F.sum("n").alias("total"))
    return counts.join(total, "gt").select("gt", "band", "n", (F.col("n") / F.col("total")).alias("share"))


def with_percentiles(counts: DataFrame, rows: DataFrame, columns: dict, shares: list[float]) -> DataFrame:
    """The rows of `counts`, one a class, with the class's percentiles; classes are matched with nulls too."""
    table = F.broadcast(quantile_table(rows, columns, shares, "gt"))  # a row for each class
    return counts.join(table, counts["gt"].eqNullSafe(table["gt"]), "left").drop(table["gt"])


def cell_spans(points: DataFrame, cell: float = 0.5, least: int = 8) -> DataFrame:
    """gt, n_cells, and percentiles of the height spans and tops of cells with at least so many points of the class."""
    cells = with_cells(points, cell).groupBy("gt", "ix", "iy").agg(F.count("*").alias("n"), (F.max("z") - F.min("z")).alias("span"), F.max(F.col("z") - F.col("gz")).alias("top"))
    full = cut(cells.where(F.col("n") >= least))
    return with_percentiles(full.groupBy("gt").agg(F.count("*").alias("n_cells")), full, {"span": F.col("span"), "top": F.col("top")}, [0.5, 0.95])


def leave_one_out(scenes: DataFrame, train, refine, truth: str = "gt") -> DataFrame:
    """scene, accuracy before and after, n_changed: each scene refined by a model of the others (train(rows) -> model, refine(rows, model) -> rows with `new`)."""
    names = [r[0] for r in scenes.select("scene").distinct().orderBy("scene").collect()]
    out = None
    for name in names:
        rows = refine(scenes.where(F.col("scene") == name), train(scenes.where(F.col("scene") != name)))
        right = lambda c: F.avg((F.col(c) == F.col(truth)).cast("double"))
        one = rows.agg(F.lit(name).alias("scene"), F.count("*").alias("n"), right("cls").alias("before"), right("new").alias("after"), F.count_if(F.col("new") != F.col("cls")).alias("n_changed"))
        out = one if out is None else out.union(one)
    return out


def write_report(table: DataFrame, path: str) -> None:
    """A report as JSON lines: metrics tables are small, so one file."""
    table.coalesce(1).write.mode("overwrite").json(path)


def profile(points: DataFrame, intensity: bool = False) -> DataFrame:
    """Per true class: count, mean and spread of the height, and percentiles of the height and, if asked, the intensity."""
    h = F.col("z") - F.col("gz")
    counts = points.groupBy("gt").agg(F.count("*").alias("n"), F.avg(h).alias("mean"), F.stddev_pop(h).alias("std"))
    columns = {"h": h} | ({"intensity": F.col("intensity")} if intensity else {})
    return with_percentiles(counts, points, columns, [0.05, 0.25, 0.5, 0.75, 0.95])
