"""The task queue's tables and queries, as plans over tasks, subtasks and workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN = ("pending", "processing")


def from_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tasks, subtasks, workers) that the events table stands for."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    state = F.create_map(*[F.lit(x) for p in (("signup", "pending"), ("view", "processing"), ("purchase", "success"), ("click", "skipped"), ("error", "error")) for x in p])
    task = F.floor(F.col("event_id") / 3).cast("long")
    sub = e.select(
        F.col("event_id").cast("long").alias("id"),
        task.alias("task_id"),
        F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("worker_id"),
        state[F.col("event_type")].alias("status"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.concat(F.lit("/out/f"), F.pmod("event_id", F.lit(977)).cast("string"), F.lit(".las")).alias("output_file"),
    )
    workers = sub.groupBy("worker_id").agg(F.max("started_at").alias("last_heartbeat"), F.max_by("id", F.struct("started_at", "id")).alias("current_subtask_id"))
    tasks = rolled_up(sub).select(F.col("task_id").alias("id"), "status", F.concat(F.lit("/in/"), F.col("task_id").cast("string")).alias("input_path"), F.concat(F.lit("/Out/"), F.pmod("task_id", F.lit(7)).cast("string"), F.lit("_%")).alias("output_path"), F.concat(F.lit("u"), F.col("task_id").cast("string")).alias("uid"))
    return tasks, sub, workers


def rolled_up(subtasks: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """task_id, total, done, status of each task from its subtasks; with tasks (id, status), one without subtasks is completed and a cancelled one stays so."""
    has = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    status = (
        F.when(has("processing"), "processing")
        .when(has("pending"), "pending")
        .when(has("cancelled") & ~has("error"), "cancelled")
        .when(has("error"), "error")
        .otherwise("completed")
    )
    rolled = subtasks.groupBy("task_id").agg(F.count("*").alias("total"), F.count_if(~F.col("status").isin(*OPEN)).alias("done"), status.alias("status"))
    if tasks is None:
        return rolled
    every = tasks.select(F.col("id").alias("task_id"), F.col("status").alias("before")).join(rolled, "task_id", "left")
    final = F.when(F.col("before") == "cancelled", "cancelled").otherwise(F.coalesce("status", F.lit("completed")))
    return every.select("task_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "done")], final.alias("status"))


def search(tasks: DataFrame, text: str, status: str | None = None, page: int = 0, size: int = 20) -> DataFrame:
    """Newest first; the text is literal, any case, in the uid or one of the paths, or equal to the id."""
    columns = [c for c in ("uid", "input_path", "output_path") if c in tasks.columns]
    hit = F.greatest(F.lit(False), F.lit(False), *[F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False)) for c in columns])
    if text.isascii() and text.isdigit() and len(text) < 19:
        hit = hit | (F.col("id") == int(text))
    rows = tasks.where(hit) if status is None else tasks.where(hit & (F.col("status") == status))
    return rows.orderBy(F.desc("id")).offset(page * size).limit(min(size, 100))


def status_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count("*").alias("n"))


def busy_outputs(subtasks: DataFrame) -> DataFrame:
    return subtasks.where("status = 'processing'").select("output_file").distinct()


def claimable(tasks: DataFrame, subtasks: DataFrame) -> DataFrame:
    """Pending subtasks of open tasks whose output nobody writes, first come first served."""
    waiting = subtasks.where("status = 'pending'").join(tasks.where(F.col("status").isin(*OPEN)).select(F.col("id").alias("task_id")), "task_id")
    return waiting.join(busy_outputs(subtasks), "output_file", "left_anti").select("task_id", "id", "output_file")


def claim(tasks: DataFrame, subtasks: DataFrame, n: int = 1) -> DataFrame:
    return claimable(tasks, subtasks).orderBy("task_id", "id").limit(n)


def claimed(tasks: DataFrame, subtasks: DataFrame, workers: DataFrame, worker: str, now: Column, n: int = 1) -> DataFrame:
    """subtasks after a worker's claim: first the stale ones go back to pending, then the first n that may be claimed,
    each still pending and with an output that no other holds, become the worker's."""
    gone = stale(subtasks, workers, now).select(F.col("id").alias("gone"))
    back = subtasks.join(gone, F.col("id") == F.col("gone"), "left")
    free = F.col("gone").isNotNull()
    none = lambda c: F.when(~free, F.col(c)).alias(c)
    reclaimed = back.select(*[F.when(free, "pending").otherwise(F.col(c)).alias(c) if c == "status" else none(c) if c in ("worker_id", "started_at") else F.col(c) for c in subtasks.columns])
    # one claim an output: the first of each
    once = claimable(tasks, reclaimed).groupBy("output_file").agg(F.min(F.struct("task_id", "id")).alias("first"))
    taken = once.select("first.*").orderBy("task_id", "id").limit(n).select(F.col("id").alias("taken"))
    mine = F.col("taken").isNotNull() & (F.col("status") == "pending")
    put = {"status": F.lit("processing"), "worker_id": F.lit(worker), "started_at": now}
    held = reclaimed.join(F.broadcast(taken), F.col("id") == F.col("taken"), "left")  # at most n rows
    return held.select(*[F.when(mine, put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in subtasks.columns])


def restarted(tasks: DataFrame, subtasks: DataFrame, task_id: int, new_id: int) -> tuple[DataFrame, DataFrame]:
    """(task row, subtask rows) of a new task over the files and outputs of an old one, all pending again."""
    task = tasks.where(F.col("id") == task_id).withColumn("id", F.lit(new_id).cast("long")).withColumn("status", F.lit("pending"))
    rows = subtasks.where(F.col("task_id") == task_id).select(F.lit(new_id).cast("long").alias("task_id"), "output_file", F.lit("pending").alias("status"))
    return task, rows


def progressed(subtasks: DataFrame, subtask_id: int, worker: str, progress: float) -> DataFrame:
    """The owner's progress, clamped to 0..100; others change nothing."""
    hit = (F.col("id") == subtask_id) & (F.col("worker_id") == worker) & (F.col("status") == "processing")
    return subtasks.withColumn("progress", F.when(hit, min(max(float(progress), 0.0), 100.0)).otherwise(F.col("progress")))


def stale(subtasks: DataFrame, workers: DataFrame, now: Column, lease: str = "30 minutes") -> DataFrame:
    """Processing subtasks whose worker is gone, silent past the lease, or long busy with another one."""
    cutoff = now - F.expr(f"INTERVAL {lease}")
    rows = subtasks.where("status = 'processing'").join(workers, "worker_id", "left")
    late = F.col("last_heartbeat").isNull() | (F.col("last_heartbeat") < cutoff)
    elsewhere = (F.col("started_at") < cutoff) & ~F.col("current_subtask_id").eqNullSafe(F.col("id"))
    return rows.where(late | elsewhere).select("id", "task_id", "worker_id")


def cancelled(subtasks: DataFrame, task_id: int) -> DataFrame:
    """Pending subtasks of the task are cancelled; running ones are left to their workers."""
    hit = (F.col("task_id") == task_id) & (F.col("status") == "pending")
    return subtasks.withColumn("status", F.when(hit, "cancelled").otherwise(F.col("status")))


def completed(subtasks: DataFrame, subtask_id: int, worker: str, status: str, task_cancelled: bool = False) -> DataFrame:
    """The owner's final status; in a cancelled task an error counts as cancelled, success and skipped stand."""
    final = "cancelled" if task_cancelled and status == "error" else status
    hit = (F.col("id") == subtask_id) & (F.col("worker_id") == worker) & (F.col("status") == "processing")
    return subtasks.withColumn("status", F.when(hit, final).otherwise(F.col("status")))


def new_tasks(files: DataFrame, first_id: int, root: str, output: str) -> DataFrame:
    """Subtask rows, one a file (column path): relative path kept under the output root."""
    begin = root.rstrip("/") + "/"
    relative = F.when(F.startswith("path", F.lit(begin)), F.substring("path", len(begin) + 1, 1 << 30)).otherwise(F.col("path"))
    rows = files.where(F.lower("path").rlike(r"\.(las|laz)$"))
    return rows.select(F.lit(first_id).cast("long").alias("task_id"), F.col("path").alias("input_file"), relative.alias("relative_path"), F.concat(F.lit(output.rstrip("/") + "/"), relative).alias("output_file"), F.lit("pending").alias("status"))
