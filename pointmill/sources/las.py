"""LAS point files as a Spark data source, by the public LAS 1.2 to 1.4 record layouts.

spark.dataSource.register(LasSource); spark.read.format("las").load(path).
A partition is a range of records, so one large file is read by many tasks.
Compressed LAZ files are refused. With option raw the whole record comes along
as bytes, so that a file can be written again with all its other attributes.
`write.format("las")` makes a folder of files, one a task, all or nothing. `write`
makes one file from a cloud in point_id order: executors write ordered parts,
which are joined and replace the target only when they are whole.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import struct
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

SCHEMA = "point_id bigint, x_raw int, y_raw int, z_raw int, x double, y double, z double, cls int, intensity int"


def header(path: str) -> dict:
    """Count, format, record length, offset, scales and offsets."""
    with open(path, "rb") as f:
        h = f.read(375)
    if h[:4] != b"LASF":
        raise ValueError(f"not a LAS file: {path}")
    minor, size, offset = h[25], struct.unpack_from("<H", h, 94)[0], struct.unpack_from("<I", h, 96)[0]
    kind, length, count = struct.unpack_from("<BHI", h, 104)
    if kind & 0x80:
        raise ValueError(f"compressed points (LAZ) are not supported: {path}")
    if minor >= 4 and size >= 375:
        count = struct.unpack_from("<Q", h, 247)[0] or count
    scales, offsets = struct.unpack_from("<3d", h, 131), struct.unpack_from("<3d", h, 155)
    box = struct.unpack_from("<6d", h, 179)  # max and min of x, y and z in turn
    return {"box": {c: (box[2 * j + 1], box[2 * j]) for j, c in enumerate("xyz")}, "count": count, "format": kind, "length": length, "start": offset, "scales": scales, "offsets": offsets, "version": f"1.{minor}"}


def _layout(kind: int, length: int) -> np.dtype:
    where = 15 if kind < 6 else 16
    return np.dtype({"names": ["x", "y", "z", "i", "c"], "formats": ["<i4", "<i4", "<i4", "<u2", "u1"], "offsets": [0, 4, 8, 12, where], "itemsize": length})


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int, base: int) -> None:
        self.path, self.first, self.count, self.base = path, first, count, base


class _Reader(DataSourceReader):
    """Reads the columns that its schema names."""

    def __init__(self, paths: list[str], records: int, names: list[str]) -> None:
        self.paths, self.records, self.names = paths, records, names
        self.low, self.high = dict.fromkeys("xyz", -math.inf), dict.fromkeys("xyz", math.inf)

    def _wanted(self, h: dict) -> bool:
        # a box may be rounded by a step of the raw coordinates
        step = dict(zip("xyz", h["scales"], strict=True))
        return all(h["box"][c][1] + step[c] >= self.low[c] and h["box"][c][0] - step[c] <= self.high[c] for c in "xyz")

    def partitions(self) -> list[_Range]:
        out, base = [], 0
        for p in self.paths:
            h = header(p)
            if self._wanted(h):
                out += [_Range(p, at, min(self.records, h["count"] - at), base) for at in range(0, h["count"], self.records)]
            base += h["count"]
        return out or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if not part.count:
            return
        h = header(part.path)
        layout = _layout(h["format"], h["length"])
        with open(part.path, "rb") as f:
            for at in range(part.first, part.first + part.count, 100_000):
                n = min(100_000, part.first + part.count - at)
                f.seek(h["start"] + at * h["length"])
                data = f.read(n * h["length"])
                r = np.frombuffer(data[: len(data) // h["length"] * h["length"]], layout)
                if len(r) < n:
                    raise ValueError(f"{part.path} ends before record {at + n}")
                place = {c: (lambda c=c, j=j: r[c] * h["scales"][j] + h["offsets"][j]) for j, c in enumerate("xyz")}
                made = {
                    "point_id": lambda: np.arange(part.base + at, part.base + at + n),
                    "cls": lambda: (r["c"] & 31 if h["format"] < 6 else r["c"]).astype(np.int32),
                    "intensity": lambda: r["i"].astype(np.int32),
                    "record": lambda: pa.Array.from_buffers(pa.binary(h["length"]), n, [None, pa.py_buffer(data)]).cast(pa.binary()),
                }
                made |= place | {f"{c}_raw": (lambda c=c: r[c].astype(np.int32)) for c in "xyz"}
                yield pa.RecordBatch.from_arrays([pa.array(made[c]()) for c in self.names], self.names)


class _PrunedReader(_Reader):
    """Files whose header box lies outside the filters on x, y and z are not read."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            c = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if c in self.low and isinstance(getattr(f, "value", None), int | float):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low[c] = max(self.low[c], f.value)
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high[c] = min(self.high[c], f.value)
            yield f  # a box says nothing about single points: Spark tests them


def _words(option: str | None, default: tuple[float, ...]) -> tuple[float, ...]:
    return tuple(float(v) for v in option.split(",")) if option else default


def replaced(temporary: str, path: str, attempts: int = 5, wait: float = 0.1) -> None:
    """Rename over path; where the file system refuses, try again after 1, 2, 4 ... waits."""
    for k in range(attempts):
        try:
            return os.replace(temporary, path)
        except OSError:
            if k == attempts - 1:
                raise
            time.sleep(wait * 2**k)


def _head(n: int, low: np.ndarray, high: np.ndarray, scales: tuple[float, ...], offsets: tuple[float, ...]) -> bytes:
    """The header of a LAS 1.4 file of format 6."""
    h = bytearray(375)
    h[:4], h[24], h[25] = b"LASF", 1, 4
    struct.pack_into("<HII", h, 94, 375, 375, 0)
    struct.pack_into("<BHI", h, 104, 6, 30, 0)
    struct.pack_into("<3d", h, 131, *scales)
    struct.pack_into("<3d", h, 155, *offsets)
    struct.pack_into("<6d", h, 179, *([v for j in range(3) for v in (high[j], low[j])] if n else [0.0] * 6))
    struct.pack_into("<Q", h, 247, n)
    return bytes(h)


def _records(b: pa.RecordBatch, scales: tuple[float, ...], offsets: tuple[float, ...]) -> np.ndarray:
    """Records of format 6 with coordinates, class and intensity."""
    get = lambda c: b.column(b.schema.get_field_index(c))
    out = np.zeros(b.num_rows, _layout(6, 30))
    for j, c in enumerate("xyz"):
        out[c] = np.round((get(c).to_numpy(zero_copy_only=False) - offsets[j]) / scales[j]).astype(np.int32)
    out["c"] = get("cls").to_numpy(zero_copy_only=False).astype(np.uint8)
    if "intensity" in b.schema.names:
        out["i"] = get("intensity").fill_null(0).to_numpy(zero_copy_only=False)
    return out


@dataclass
class _Written(WriterCommitMessage):
    """A task's file, or None if it had no rows."""

    path: str | None


class _Writer(DataSourceArrowWriter):
    """A file for each task that has rows.

    Tasks write into a folder of their own beside the target's files; a commit moves
    the files of the tasks that ended well, so what a failed, slow or repeated
    attempt left is never seen, and drops the rest. No bytes reach the driver.
    """

    def __init__(self, folder: str, overwrite: bool, scales: tuple[float, ...], offsets: tuple[float, ...]) -> None:
        self.folder, self.overwrite, self.scales, self.offsets = folder, overwrite, scales, offsets
        self.job = uuid.uuid4().hex
        self.parts = os.path.join(folder, f".writing-{self.job}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        context = TaskContext.get()
        os.makedirs(self.parts, exist_ok=True)
        name = os.path.join(self.parts, f"part-{context.partitionId():05d}-{context.taskAttemptId()}.las")
        low, high, n = np.full(3, np.inf), np.full(3, -np.inf), 0
        with open(name, "wb") as f:
            f.write(bytes(375))
            for b in batches:
                if b.num_rows:
                    r = _records(b, self.scales, self.offsets)
                    f.write(r.tobytes())
                    xyz = np.column_stack([r[c] * self.scales[j] + self.offsets[j] for j, c in enumerate("xyz")])
                    low, high, n = np.minimum(low, xyz.min(0)), np.maximum(high, xyz.max(0)), n + len(r)
            f.seek(0)
            f.write(_head(n, low, high, self.scales, self.offsets))
            f.flush()
            os.fsync(f.fileno())
        return _Written(name if n else None)

    def commit(self, messages: list[_Written | None]) -> None:
        old = [os.path.join(self.folder, x) for x in os.listdir(self.folder) if x.lower().endswith(".las")] if self.overwrite and os.path.isdir(self.folder) else []
        os.makedirs(self.folder, exist_ok=True)
        kept = []
        for m in messages:
            if m is not None and m.path:
                partition = os.path.basename(m.path).rsplit("-", 1)[0]
                kept.append(os.path.join(self.folder, f"{partition}-{self.job}.las"))
                replaced(m.path, kept[-1])
        for path in old:
            os.remove(path)
        shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[_Written | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


class LasSource(DataSource):
    """Options: path (a file or a folder, searched for .las in any case), records (points a partition), raw (true for a column `record` of each record's bytes).

    A schema given to the reader may name some of the columns; the others are not made.
    With option prune, filters on x, y and z skip files by their header boxes; the
    session must allow such filters (spark.sql.python.filterPushdown.enabled), and
    `load` sets the option where it does. Writing takes
    options scales and offsets, three numbers each, and makes files of format 6.
    """

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA + (", record binary" if self.options.get("raw", "false").lower() == "true" else "")

    def reader(self, schema) -> _Reader:
        path = self.options["path"]
        found = [path] if os.path.isfile(path) else sorted(os.path.join(d, x) for d, _, names in os.walk(path) for x in names if x.lower().endswith((".las", ".laz")) and ".writing-" not in d)
        kind = _PrunedReader if self.options.get("prune", "false").lower() == "true" else _Reader
        return kind(found, int(self.options.get("records", 1_000_000)), schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> _Writer:
        missing = {"x", "y", "z", "cls"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"points need columns {sorted(missing)}")
        return _Writer(self.options["path"], overwrite, _words(self.options.get("scales"), (0.001,) * 3), _words(self.options.get("offsets"), (0.0,) * 3))


def write(points: DataFrame, path: str, scales=(0.001, 0.001, 0.001), offsets=(0.0, 0.0, 0.0), like: str | None = None) -> int:
    """One LAS file in point_id order; returns the number of points. The folder must be one that executors share.

    A LAS 1.4 file of format 6 with coordinates, class and intensity; or, with `like`, the header and
    records of that file (points read with option raw) with new classes.
    """
    folder, at = os.path.dirname(os.path.abspath(path)), ["point_id", "x", "y", "z", "cls", "intensity", *(["record"] if like else [])]
    parts = os.path.join(folder, f".writing-{uuid.uuid4().hex}")
    shape = header(like) if like else {"format": 6, "length": 30}
    layout = _layout(shape["format"], shape["length"])

    def store(batches):
        name = os.path.join(parts, f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}")
        low, high, n = np.full(3, np.inf), np.full(3, -np.inf), 0
        with open(name, "wb") as f:
            for b in batches:
                xyz = np.column_stack([b[c].to_numpy() for c in "xyz"])
                cls = b["cls"].to_numpy().astype(np.uint8)
                if like:
                    # as plain bytes: a structured copy would not keep what lies between the fields
                    out = np.frombuffer(bytearray(b"".join(b["record"].to_pylist())), np.uint8).reshape(-1, shape["length"])
                    at = layout.fields["c"][1]
                    out[:, at] = cls if shape["format"] >= 6 else (out[:, at] & 0xE0) | (cls & 31)
                else:
                    out = _records(b, scales, offsets)
                f.write(out.tobytes())
                if b.num_rows:
                    low, high, n = np.minimum(low, xyz.min(0)), np.maximum(high, xyz.max(0)), n + b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([low.tolist()]), pa.array([high.tolist()])], ["name", "n", "low", "high"])

    os.makedirs(parts)
    try:
        ordered = points.select(*at).repartitionByRange("point_id").sortWithinPartitions("point_id")
        done = ordered.mapInArrow(store, "name string, n bigint, low array<double>, high array<double>").collect()  # one row a partition
        done = sorted((r for r in done if r.n), key=lambda r: r.name)
        n = sum(r.n for r in done)
        if like:
            with open(like, "rb") as f:
                head = f.read(shape["start"])
        else:
            low, high = np.array([r.low for r in done]).min(0) if n else None, np.array([r.high for r in done]).max(0) if n else None
            head = _head(n, low, high, scales, offsets)
        whole = os.path.join(parts, "whole")
        with open(whole, "wb") as f:
            f.write(head)
            for r in done:
                with open(r.name, "rb") as part:
                    shutil.copyfileobj(part, f, 1 << 20)
        replaced(whole, path)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return n


def load(spark: SparkSession, path: str, columns: str | None = None, **options) -> DataFrame:
    """Points of a file or folder; columns, such as "x double, cls int", names those to make."""
    spark.dataSource.register(LasSource)
    prune = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    read = spark.read.format("las").options(**({"prune": prune} | options))
    return (read.schema(columns) if columns else read).load(path)


def save(points: DataFrame, folder: str, mode: str = "append", **options) -> None:
    """A folder of LAS files, one a task."""
    points.sparkSession.dataSource.register(LasSource)
    points.write.format("las").mode(mode).options(**options).save(folder)


def validate(spark: SparkSession, source: str, output: str, receipt: str | None = None) -> bool:
    """Whether output holds the points of source: as many, on the same scales and offsets, with the same raw coordinates in the same order.

    A missing output is no result; a malformed one, or a file that changes meanwhile, is an error.
    A receipt of files that passed, known by path, size and time, spares a second check.
    """
    if not os.path.exists(output):
        return False
    stamp = lambda: [[os.path.abspath(f), os.stat(f).st_size, os.stat(f).st_mtime_ns] for f in (source, output)]
    before = stamp()
    if receipt and os.path.exists(receipt):
        with open(receipt) as f:
            if json.load(f) == before:
                return True
    a, b = header(source), header(output)
    same = all(a[k] == b[k] for k in ("count", "scales", "offsets")) and same_points(load(spark, source), load(spark, output))
    if stamp() != before:
        raise RuntimeError(f"{source} or {output} changed during the check")
    if same and receipt:
        fd, temporary = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(receipt)))
        with os.fdopen(fd, "w") as f:
            json.dump(before, f)
        os.replace(temporary, receipt)
    return same


def same_attributes(spark: SparkSession, source: str, output: str) -> bool:
    """Whether all bytes of all records but the class are the same, record by record: what a release must not change."""
    h = header(source)
    if any(h[k] != header(output)[k] for k in ("count", "format", "length", "scales", "offsets")):
        return False
    at = 16 if h["format"] < 6 else 17  # the byte after the class, counted from 1
    rest = lambda df, name: df.select("point_id", F.concat(F.substring("record", 1, at - 1), F.substring("record", at + 1, h["length"])).alias(name), *([(F.conv(F.hex(F.substring("record", at, 1)), 16, 10).cast("int").bitwiseAND(0xE0)).alias(f"{name}_flags")] if h["format"] < 6 else []))
    a, b = rest(load(spark, source, raw="true"), "a"), rest(load(spark, output, raw="true"), "b")
    differs = "NOT (a <=> b)" + (" OR NOT (a_flags <=> b_flags)" if h["format"] < 6 else "")
    return a.join(b, "point_id", "full").where(differs).isEmpty()


def same_points(source: DataFrame, output: DataFrame) -> bool:
    """Whether both have the same ids with the same raw coordinates."""
    a = source.select("point_id", "x_raw", "y_raw", "z_raw")
    b = output.select("point_id", *[output[c].alias(f"o_{c}") for c in ("x_raw", "y_raw", "z_raw")])
    wrong = a.join(b, "point_id", "full").where("NOT (x_raw <=> o_x_raw AND y_raw <=> o_y_raw AND z_raw <=> o_z_raw)")
    return wrong.limit(1).count() == 0
