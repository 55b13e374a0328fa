"""Quality scores from random Fourier features of document statistics.

Statistics of each whole text (shares of byte classes, word lengths, repetition)
are standardised by corpus-wide means and deviations; random Fourier features of
them approximate a Gaussian kernel; each partition sums its normal equations and
the sums give ridge scores. Two folds, summed apart, give out-of-fold scores, on
whose binned counts an isotonic step function is fitted. Every labelled row
takes part; the driver only ever sees sums of a fixed size.

Null and empty texts have all statistics 0 and are scored like others. Each
input row gives one output row, with repeated rows and null ids; several labels
of one id count as their smallest; without two kinds of labels every score is
the rate of label 1 (0.5 without labels). Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark_tools import cut
from .toxicity import held_out, slices
from .words import SPACED, split, utf8

CLASSES = ("upper", "lower", "digit", "space", "newline", "beyond", "stop", "comma", "symbol")
NAMES = ("log_bytes", "log_words", *CLASSES, "word_mean", "word_std", "distinct", "top", "distinct_pairs", "short", "shouted", "ends_odd", "peak")
D, FEATURES = len(NAMES), 256


def _classes() -> np.ndarray:
    out = np.zeros((256, len(CLASSES)))
    for b in range(256):
        c = chr(b)
        kind = "beyond" if b > 127 else "upper" if c.isupper() else "lower" if c.islower() else "digit" if c.isdigit() else "newline" if c == "\n" else "space" if c.isspace() else "stop" if c == "." else "comma" if c in ",;:" else "symbol"
        out[b, CLASSES.index(kind)] = 1
    return out


_CLASSES = _classes()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of D statistics for each text."""
    out = np.zeros((len(texts), D))
    for lo, hi in slices(texts):
        w = split(texts[lo:hi], SPACED)
        raw, offsets = utf8(texts[lo:hi])
        pairs, whole = w.grams(2)
        size = (w.end - w.start).astype(np.float64)
        last = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
        odd = (last < 128) & (_CLASSES[last][:, CLASSES.index("symbol")] > 0)
        first_upper = (raw[w.start] < 128) & (_CLASSES[raw[w.start]][:, 0] > 0) & (size > 1) if len(w.start) else np.zeros(0, bool)
        second = raw[np.minimum(w.start + 1, max(len(raw) - 1, 0))] if len(w.start) else np.zeros(0, np.uint8)
        shouted = first_upper & (_CLASSES[second][:, 0] > 0)
        for r in range(hi - lo):
            n = int(offsets[r + 1] - offsets[r])
            if not n:
                continue
            a, b = int(w.first[r]), int(w.first[r + 1])
            shares = np.bincount(raw[offsets[r] : offsets[r + 1]], minlength=256) @ _CLASSES / n
            x = out[lo + r]
            x[0], x[1], x[2 : 2 + len(CLASSES)] = np.log1p(n), np.log1p(b - a), shares
            if b > a:
                _, counts = np.unique(w.hash[a:b], return_counts=True)
                k = 2 + len(CLASSES)
                two = pairs[a : b - 1]
                x[k:] = (
                    size[a:b].mean(),
                    min(size[a:b].std(), 50),
                    len(counts) / (b - a),
                    counts.max() / (b - a),
                    len(np.unique(two)) / max(len(two), 1),
                    (size[a:b] <= 3).mean(),
                    shouted[a:b].mean(),
                    odd[a:b].mean(),
                    min(size[a:b].max(), 1000) ** 0.5,
                )
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of D statistics) per row."""

    def run(batches):
        for b in batches:
            x = statistics(b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.ListArray.from_arrays(np.arange(0, x.size + 1, D, dtype=np.int32), pa.array(x.ravel()))], ["doc_id", "x"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>")


class Fourier:
    """Standardisation and random Fourier features; `expand` adds an intercept and the statistics themselves."""

    def __init__(self, mean, std, features: int = FEATURES, width: float = 1.0, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.std = np.asarray(mean, float), np.maximum(np.asarray(std, float), 1e-9)
        self.weights = rng.normal(0, 1 / (width * np.sqrt(D)), (D, features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def expand(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((x - self.mean) / self.std, -8, 8)
        return np.hstack([np.ones((len(s), 1)), s, np.cos(s @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))])


def normal_equations(rows: DataFrame, fourier: Fourier, branches: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """rows: x, y, fold (0 or 1). (sums of z z', sums of z y) by fold; each partition sends one matrix a fold, added up in two steps."""
    size = 1 + D + len(fourier.phase)

    def sums(batches):
        total, branch = np.zeros((2, size, size + 1)), 0
        for b in batches:
            branch = b["branch"][0].as_py() if b.num_rows else branch
            x = np.asarray(b["x"].flatten().to_numpy(zero_copy_only=False)).reshape(-1, D)
            y, fold = b["y"].to_numpy(), b["fold"].to_numpy()
            for lo in range(0, len(x), 2000):
                z = fourier.expand(x[lo : lo + 2000])
                zy = np.hstack([z, y[lo : lo + 2000, None]])
                for f in (0, 1):
                    own = fold[lo : lo + 2000] == f
                    total[f] += z[own].T @ zy[own]
        at = [(f, i) for f in (0, 1) for i in range(size)]
        yield pa.RecordBatch.from_arrays([pa.array([branch] * len(at), pa.int32()), pa.array([f * size + i for f, i in at], pa.int32()), pa.array([total[f, i].tobytes() for f, i in at], pa.binary())], ["branch", "i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size + 1)
        for v in table["sums"]:
            total += np.frombuffer(v.as_py())
        return table.slice(0, 1).set_column(table.schema.get_field_index("sums"), "sums", pa.array([total.tobytes()], pa.binary()))

    kind = "branch int, i int, sums binary"
    parts = rows.withColumn("branch", F.spark_partition_id() % branches).mapInArrow(sums, kind)
    got = parts.groupBy("branch", "i").applyInArrow(add, kind).groupBy("i").applyInArrow(add, kind).collect()
    total = np.zeros((2 * size, size + 1))
    for r in got:
        total[r.i] = np.frombuffer(r.sums)
    total = total.reshape(2, size, size + 1)
    return total[:, :, :-1], total[:, :, -1]


def ridge(gram: np.ndarray, moment: np.ndarray, penalty: float) -> np.ndarray:
    hold = np.eye(len(gram)) * penalty
    hold[0, 0] = 1e-6
    return np.linalg.solve(gram + hold, moment)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing means."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


BINS = 2000


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.floor((np.clip(raw, -0.5, 1.4999) + 0.5) * (BINS / 2)).astype(np.int64)


class Model:
    def __init__(self, fourier: Fourier | None, beta, at, level) -> None:
        self.fourier, self.beta, self.at, self.level = fourier, beta, at, level

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.level)
        return np.clip(np.interp(self.fourier.expand(x) @ self.beta, self.at, self.level), 0, 1)


def fit(stats: DataFrame, labels: DataFrame, keep: Column | None = None, penalty: float = 1.0) -> Model:
    """stats: doc_id, x. labels: doc_id, quality; keep: a condition on `id`."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.min("y").cast("double").alias("y"))
    if keep is not None:
        known = known.where(keep)
    rows = cut(stats.join(known, F.col("doc_id") == F.col("id")).select("x", "y", (F.xxhash64("id") % 2 != 0).cast("int").alias("fold")))
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or positive in (0, n):
        return Model(None, None, None, positive / n if n else 0.5)
    moments = stats.agg(*[f(F.get("x", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(D)]).first()
    fourier = Fourier(moments[:D], moments[D:])
    gram, moment = normal_equations(rows, fourier)
    apart = [ridge(gram[1 - f], moment[1 - f], penalty) if gram[1 - f][0, 0] else np.zeros(len(gram[0])) for f in (0, 1)]

    def out_of_fold(batches):
        for b in batches:
            x = np.asarray(b["x"].flatten().to_numpy(zero_copy_only=False)).reshape(-1, D)
            z, fold = fourier.expand(x), b["fold"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_bin(np.where(fold == 0, z @ apart[0], z @ apart[1]))), b["y"]], ["bin", "y"])

    bins = rows.mapInArrow(out_of_fold, "bin bigint, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("rate")).orderBy("bin").collect()
    level = isotonic(np.array([b.rate for b in bins]), np.array([b.n for b in bins], float))
    at = (np.array([b.bin for b in bins]) + 0.5) * (2 / BINS) - 0.5
    return Model(fourier, ridge(gram.sum(0), moment.sum(0), penalty), at, level)


def quality_scores(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> DataFrame:
    """doc_id, score per row of docs."""
    stats = cut(document_statistics(docs))
    model = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, keep))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(model.value.score(np.vstack(s.to_numpy()) if len(s) else np.zeros((0, D))))

    return stats.select("doc_id", F.pandas_udf(score, "double")("x").alias("score"))


def op2_quality(spark, sf_dir) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_scores(docs, labels, ~held_out("id", 3, 1))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
