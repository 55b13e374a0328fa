"""Small Spark helpers of the corpus operators: row keys and bounded filters."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut, shared_dir  # noqa: F401  used by the operators


@contextmanager
def batches_of(spark, rows: int):
    """Arrow batches of so many rows for the actions inside: for columns of large values."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart; 0 for null texts."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def join_counted(rows: DataFrame, counted: DataFrame, key: str, n: str, least: int = 100_000, most: int = 10_000) -> DataFrame:
    """Inner join with a written table of one row a key that says how many of the rows hold the key.

    Keys of more than `least` rows and more than a share of 1 / most of all are
    broadcast: there are fewer than `most` of them whatever the input. The others
    are shuffled, so no task gets more than that many rows of one key.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    limit = max(least, total // most)
    hot = F.broadcast(counted.where(F.col(n) > limit))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(counted.where(F.col(n) <= limit), key))


def bit_filter(hashes: DataFrame, log2_bits: int = 22) -> bytes:
    """A bitmap of a long column `h`, of a fixed size whatever the input.

    Aggregated on the executors to at most 2**log2_bits / 64 rows. False
    positives only cost time; every caller checks again exactly.
    """
    slot = F.expr(f"h & {(1 << log2_bits) - 1}")
    rows = (
        hashes.select(slot.alias("s"))
        .groupBy(F.expr("s div 64").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b"))
        .collect()
    )
    words = np.zeros(1 << (log2_bits - 6), np.int64)
    for r in rows:
        words[r.w] = r.b
    return words.tobytes()


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap, given as np.frombuffer(..., np.uint8)."""
    slot = h & np.uint64(len(bits) * 8 - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
