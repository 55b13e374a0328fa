"""Point clouds as DataFrames.

A cloud has point_id, x, y, z (metres), cls (class code), intensity and, where
known, gt (true class) and gz (terrain height). `scene` derives one from the
star-schema table lineitem by integer arithmetic, so any SQL engine makes the
same points; it grows with that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Class codes, fixed values.
DEFAULT, GROUND, LOW_VEG, MED_VEG, HIGH_VEG, BUILDING, NOISE, GHOST, VEHICLE, DIRTY, CAR, PEDESTRIAN = 1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 66, 67

#: Steps from lineitem to points, each a list of new columns; {div} is integer division (`div` in Spark, `//` elsewhere).
SCENE_STEPS = (
    (
        "l_orderkey*131 + l_linenumber*17 + l_partkey*1009 + l_suppkey*7 + CAST(l_quantity AS BIGINT)*3 AS a",
        "CAST(round(l_extendedprice*100) AS BIGINT) AS cents",
    ),
    ("(a*7919 + cents*104729) % 2147483647 AS pt_hash",),
    ("pt_hash % 20000 AS xi", "(pt_hash {div} 20000) % 20000 AS yi", "(pt_hash*31 + cents) % 1000003 AS r"),
    (
        """CASE WHEN r % 200 = 0 THEN 7
    WHEN yi >= 17000 THEN 6
    WHEN yi < 13000 AND xi % 6500 BETWEEN 1000 AND 5199 AND yi % 6000 BETWEEN 1500 AND 3399 AND r % 4 <> 0 THEN 9
    WHEN (xi-3000)*(xi-3000) + (yi-15000)*(yi-15000) < 2250000 AND r % 5 <> 0 THEN 5
    WHEN xi BETWEEN 10000 AND 10399 AND yi BETWEEN 14500 AND 14899 AND r % 5 <> 0 THEN 8
    ELSE 2 END AS gt""",
    ),
    (
        """(xi {div} 50) + CASE gt WHEN 2 THEN r % 40 WHEN 9 THEN 250 + r % 1300 WHEN 6 THEN r % 12000
    WHEN 5 THEN 2500 + r % 3500 WHEN 8 THEN r % 1750
    ELSE CASE WHEN r % 400 = 0 THEN -600 ELSE 3000 + r % 500 END END AS zi""",
    ),
)
SCENE_COLUMNS = (
    "CAST(pt_hash*1000003 + (l_orderkey*31 + l_linenumber*7 + l_partkey*13 + l_suppkey*17) % 1000003 AS BIGINT) AS point_id",
    "xi * CAST(0.001 AS DOUBLE) AS x",
    "yi * CAST(0.001 AS DOUBLE) AS y",
    "zi * CAST(0.001 AS DOUBLE) AS z",
    "CAST(CASE WHEN r % 7 = 0 THEN 7 WHEN r % 7 = 1 THEN 3 WHEN r % 7 = 2 THEN 4 WHEN gt = 8 THEN 4 ELSE gt END AS INTEGER) AS cls",
    "CAST(gt AS INTEGER) AS gt",
    "CAST(cents % 65536 AS INTEGER) AS intensity",
    "(xi {div} 50) * CAST(0.001 AS DOUBLE) AS gz",
)


def scene_sql(div: str = "//") -> str:
    """The scene as one SELECT over lineitem."""
    inner = "lineitem"
    for i, step in enumerate(SCENE_STEPS):
        inner = f"(SELECT *, {', '.join(step)} FROM {inner}) AS s{i}"
    return f"SELECT {', '.join(SCENE_COLUMNS)} FROM {inner}".replace("{div}", div)


def scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived cloud; cls is a disturbed copy of gt, gz the known slope.

    Each step ends in inline(array(struct)), which the optimizer keeps apart;
    else it would expand all steps into each use of each column.
    """
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    for step in (*SCENE_STEPS, None):
        df = df.selectExpr(*(x.replace("{div}", "div") for x in (SCENE_COLUMNS if step is None else ("*", *step))))
        df = df.select(F.inline(F.array(F.struct(*df.columns))))
    return df


def height() -> Column:
    return F.col("z") - F.col("gz")


def relabel(points: DataFrame, condition: Column, target: int | Column) -> DataFrame:
    """cls becomes target where the condition holds (a null condition does not)."""
    return points.withColumn("cls", F.when(condition, target).otherwise(F.col("cls")).cast("int"))
