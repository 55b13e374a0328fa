"""Random-forest refinement: scene-wide features, training and the override rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.quantiles import quantiles
from ..sources.points import BUILDING, height
from . import grid
from .spatial import distances

FEATURES = ["h", "log_n", "v_span", "v_hmean", "inten", "d_bldg", "cls_f", "h030", "h220", "h400"]


def intensity_norm(points: DataFrame) -> DataFrame:
    """Adds inten: intensity over the 95th percentile of the positive ones, at most 2; unchanged if none is positive."""
    top = quantiles(points, {"i": F.when(F.col("intensity") > 0, F.col("intensity"))}, [0.95]).get(("i", 0.95, None))
    i = F.col("intensity").cast("double")
    return points.withColumn("inten", i if top is None else F.least(F.greatest(i / max(top, 1e-6), F.lit(0.0)), F.lit(2.0)))


def building_distance(points: DataFrame, tall: float = 3.5, limit: float = 20.0) -> DataFrame:
    """point_id, d_bldg: distance to the nearest tall building point, at most `limit`."""
    towers = points.where((F.col("cls") == BUILDING) & (height() >= tall))
    return distances(points, towers, limit).select("point_id", F.coalesce("distance", F.lit(limit)).alias("d_bldg"))


def features(points: DataFrame, voxel: float = 0.35) -> DataFrame:
    """point_id, gt and the ten feature columns; voxels begin at the cloud's least corner."""
    h = height()
    origin = points.agg(*[F.min(c).alias(f"__{c}") for c in "xyz"])
    p = intensity_norm(points.withColumn("h", h)).join(F.broadcast(origin))
    p = p.select("*", *[F.floor((F.col(c) - F.col(f"__{c}")) / voxel).alias(f"v{c}") for c in "xyz"])
    keys = ["vx", "vy", "vz"]
    voxels = p.groupBy(*keys).agg(F.log1p(F.count("*").cast("double")).alias("log_n"), (F.max("z") - F.min("z")).alias("v_span"), F.avg("h").alias("v_hmean"))
    p = p.join(voxels, keys).join(building_distance(points), "point_id").withColumn("cls_f", F.col("cls").cast("double"))
    for name, least in (("h030", 0.30), ("h220", 2.20), ("h400", 4.00)):
        p = p.withColumn(name, (F.col("h") >= least).cast("double"))
    return p.select("point_id", "cls", "gt", *FEATURES)


def balanced(points: DataFrame, most: int, key: str = "gt") -> DataFrame:
    """At most `most` rows of each class, by a hash of the id."""
    w = Window.partitionBy(key).orderBy(F.xxhash64("point_id"), "point_id")
    return points.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def train(table: DataFrame, trees: int = 140, depth: int = 14, leaf: int = 15, seed: int = 42):
    """A forest over the features, weighted by class frequency."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    counts = table.groupBy("gt").count()
    total = counts.agg((F.sum("count") / F.count("*")).alias("mean"))
    weighted = table.join(F.broadcast(counts.join(total).select("gt", (F.col("mean") / F.col("count")).alias("weight"))), "gt")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(weighted).withColumn("label", F.col("gt").cast("double"))
    return RandomForestClassifier(featuresCol="v", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed).fit(rows)


def score(table: DataFrame, model) -> DataFrame:
    """Adds rf (best class) and conf (its probability)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="v").transform(table))
    p = vector_to_array("probability")
    return out.select(*table.columns, F.col("prediction").cast("int").alias("rf"), F.array_max(p).alias("conf"))


def override(conf_min: float = 0.60, ambiguous=(3, 4, 5, 6, 7, 9)) -> Column:
    """The refined class from cls, rf and conf."""
    ground = (F.col("cls") == 2) & (F.col("rf") != 2) & (F.col("conf") >= 0.75) & F.col("rf").isin(3, 9, 6)
    change = (F.col("cls").isin(*ambiguous) & (F.col("conf") >= conf_min) | ground) & (F.col("rf") != F.col("cls"))
    return F.when(change, F.col("rf")).otherwise(F.col("cls"))
