"""A cloud laid out along a Morton curve, so that a window reads few files and row groups.

Cells of the plane are numbered by interleaving the bits of their two numbers.
Points are range-sorted by that number once and written in folders of equal
blocks (squares of 4**bits cells), which are runs of the curve. A window is a few
ranges of block numbers: folders outside them are not listed for reading, and
inside a file the order by cell lets row groups be skipped by their least and
greatest x and y.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cell numbers are shifted by this, so that they are not negative within a million cells of zero.
HALF = 1 << 20
MASKS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(c: Column) -> Column:
    """Bits moved to the even places."""
    for shift, mask in MASKS:
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def morton(ix: Column, iy: Column) -> Column:
    at = lambda c: _spread(c.cast("long") + HALF)
    return at(ix).bitwiseOR(F.shiftleft(at(iy), 1))


def write(points: DataFrame, path: str, cell: float = 1.0, bits: int = 2) -> None:
    """Blocks have 2**bits cells on each side. Coordinates must lie within a million cells of zero."""
    z = morton(F.floor(F.col("x") / cell), F.floor(F.col("y") / cell))
    keyed = points.withColumn("__z", z).withColumn("block", F.shiftright("__z", 2 * bits))
    ordered = keyed.repartitionByRange("__z", "x", "y").sortWithinPartitions("__z")
    ordered.drop("__z").write.partitionBy("block").parquet(path)


def _interleaved(ix: int, iy: int) -> int:
    out = 0
    for k in range(21):
        out |= (ix >> k & 1) << 2 * k | (iy >> k & 1) << 2 * k + 1
    return out


def ranges(x0: int, x1: int, y0: int, y1: int, most: int = 64) -> list[tuple[int, int]]:
    """Ranges of Morton numbers, first and last, that hold all squares of a window of square numbers (not negative, ends included); about `most` at most, so some squares outside may be in them."""
    open_, done = [(0, 0, 21)], []
    while open_:
        bx, by, level = open_.pop(0)
        low_x, low_y, side = bx << level, by << level, 1 << level
        if low_x > x1 or low_y > y1 or low_x + side - 1 < x0 or low_y + side - 1 < y0:
            continue
        whole = x0 <= low_x and low_x + side - 1 <= x1 and y0 <= low_y and low_y + side - 1 <= y1
        if whole or not level or len(open_) + len(done) >= most:
            first = _interleaved(low_x, low_y)
            done.append((first, first + side * side - 1))
        else:
            open_ += [(2 * bx + i, 2 * by + j, level - 1) for j in (0, 1) for i in (0, 1)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def read_window(spark: SparkSession, path: str, x0: float, x1: float, y0: float, y1: float, cell: float = 1.0, bits: int = 2) -> DataFrame:
    """Points with x0 <= x < x1 and y0 <= y < y1 of a cloud that `write` laid out with the same cell and bits."""
    square = lambda v: (int(v // cell) + HALF) >> bits
    runs = ranges(square(x0), square(x1), square(y0), square(y1))
    wanted = F.lit(False)
    for a, b in runs:
        wanted = wanted | F.col("block").between(a, b)
    rows = spark.read.parquet(path).where(wanted)
    return rows.where((F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)).drop("block")
