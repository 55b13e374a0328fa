"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local session without one gets a folder of its own."""
    there = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_pointmill_dir", None)
    if not there:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = spark._pointmill_dir = tempfile.mkdtemp(prefix="pointmill-")
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write a frame into the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._pointmill_path = path
    return written


def discard(*written: DataFrame) -> None:
    """Remove tables of `cut` that nothing reads any more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._pointmill_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
