"""Points that arrive as Parquet files in a folder, judged as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def landing(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def running_histogram(points: DataFrame) -> DataFrame:
    """Counts by class over all that has come; use output mode complete or update."""
    return points.groupBy("cls").agg(F.count("*").alias("n"))


def heartbeats(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Last sign of each worker by event-time window; events later than `late` are dropped with their state."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "worker_id").agg(F.max("ts").alias("last_heartbeat"), F.count("*").alias("n"))


def classify_batches(points: DataFrame, rule, target: str, checkpoint: str):
    """Write each micro-batch after a rule; the batch id names its folder, so a repeated batch replaces itself."""

    def run(batch: DataFrame, number: int) -> None:
        rule(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return points.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
