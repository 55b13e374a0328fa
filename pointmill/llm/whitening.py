"""Whitening of embeddings through the exact characteristic polynomial.

Entries become integers x = floor(64 c) + 1000000. Over the distinct vectors the
sums S and the Gram matrix are summed exactly by partitions (in limbs, so that
float products lose nothing), which gives the integer scatter M = n G - S S' =
n**2 V. Its characteristic polynomial is found modulo as many 31-bit primes as
its coefficients need, one Hessenberg reduction a prime, dealt over tasks, and
put together by Chinese remaindering. All roots are real, so the sign changes of
the shifted polynomial count the roots above a point: bisection isolates the
largest ones and refines them to about 100 bits. A null vector of M - root comes
from inverse iteration in fixed-point integers, again a task for each root. Only
tables whose size is set by the dimension reach the driver.

Dropped: vectors that are null, empty, or hold null or non-finite entries, and
those whose length is not the commonest (the greater of equals). Rows that repeat
count once in the fit and are all returned; null ids stay null. Components of
eigenvalue 0 do not exist, so one distinct vector, or an empty table, gives no
rows. Equal roots get an orthonormal basis. Integers, or deviations, beyond 64
bits are an error. Other columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spark_tools import cut

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LIMB, BASE = 20, 40


def integers(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x (array of long) of the rows that take part; x has one length."""
    v = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    common = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    v = v.where(F.size("v") == (common.d if common else 0))
    return v.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits to the base 2**20, lowest first, as floats."""
    out, half = [], 1 << (LIMB - 1)
    while not out or y.any():
        low = ((y + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(float))
        y = (y - low) >> LIMB
    return out


def exact_gram(x: np.ndarray) -> np.ndarray:
    """x' x in Python integers, of int64 rows."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), 1 << 13):  # 2**13 products of digits up to 2**19 stay below 2**53
        digits = _limbs(x[at : at + (1 << 13)])
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _split(value: int, parts: int) -> list[int]:
    """Digits to the base 2**40, the last one signed and the rest."""
    out = [(value >> (BASE * k)) & ((1 << BASE) - 1) for k in range(parts - 1)]
    return [*out, value >> (BASE * (parts - 1))]


def moments(fit_list: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, Gram matrix) of x - SHIFT over the rows, exact."""
    parts = 5

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            if b.num_rows:
                y = _matrix(b.column(0)) - SHIFT
                y = np.column_stack([np.ones(len(y), np.int64), y])  # its first row of the Gram matrix: n and the sums
                g = exact_gram(y)
                total = g if total is None else total + g
        if total is not None:
            i, j = np.triu_indices(len(total))
            digits = [_split(int(total[a, b]), parts) for a, b in zip(i, j, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array([d[k] for d in digits], pa.int64()) for k in range(parts)]], ["i", "j", *[f"l{k}" for k in range(parts)]])

    cells = fit_list.select("x").mapInArrow(sums, "i int, j int, " + ", ".join(f"l{k} bigint" for k in range(parts)))
    rows = cells.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(parts)]).collect()  # a row for each pair of dimensions
    if not rows:
        return 0, np.zeros(0, object), np.zeros((0, 0), object)
    full = np.zeros((max(r.j for r in rows) + 1,) * 2, object)
    for r in rows:
        full[r.i, r.j] = full[r.j, r.i] = sum(r[f"l{k}"] << (BASE * k) for k in range(parts))
    return full[0, 0], full[0, 1:], full[1:, 1:]


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all 32-bit numbers."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        y = pow(a, d, n)
        if y not in (1, n - 1) and all((y := y * y % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(top: int, bits: int) -> list[int]:
    """Primes downwards from top until their product has so many bits."""
    out, have, n = [], 0.0, top - 1 | 1
    while have <= bits:
        if is_prime(n):
            out.append(n)
            have += math.log2(n)
        n -= 2
    return out


def characteristic_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - m) modulo p, from the constant one, by reduction to Hessenberg form."""
    h = m.copy() % p
    d = len(h)
    for k in range(1, d - 1):
        pivot = k + np.flatnonzero(h[k:, k - 1])[:1]
        if not len(pivot):
            continue
        if (i := int(pivot[0])) != k:
            h[[i, k]] = h[[k, i]]
            h[:, [i, k]] = h[:, [k, i]]
        u = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - u[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * u % p).sum(1)) % p
    # the polynomials of the leading blocks, one from those before
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1]) % p
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % p
            if not below:
                break
            polys[k] = (polys[k] - below * int(h[k - i - 1, k - 1]) % p * polys[k - i - 1]) % p
    return polys[d]


def characteristic(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Integer coefficients of det(x - m), from the constant one, for a positive semidefinite integer matrix."""
    bits = len(m) * (int(np.trace(m)) + 1).bit_length() + 2  # roots lie between 0 and the trace; a sign
    primes = primes_below(1 << 31, bits)
    whole = m.tolist()

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                c = characteristic_mod(np.array([[v % p for v in row] for row in whole], np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([c.tolist()])], ["p", "c"])

    tasks = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 64))
    found = {r.p: r.c for r in tasks.mapInArrow(residues, "p bigint, c array<bigint>").collect()}  # d numbers a prime
    product = math.prod(primes)
    weights = {p: product // p * pow(product // p, -1, p) for p in primes}
    values = [sum(found[p][k] * weights[p] for p in primes) % product for k in range(len(m) + 1)]
    return [v - product if 2 * v > product else v for v in values]


class Roots:
    """The roots of a polynomial whose roots are all real and not below 0."""

    def __init__(self, coefficients: list[int]) -> None:
        self.c = coefficients[::-1]  # from the leading one

    def _scaled(self, exponent: int) -> list[int]:
        return [v << (exponent * k) for k, v in enumerate(self.c)]

    def above(self, m: int, exponent: int) -> int:
        """How many roots, each as often as it occurs, are greater than m / 2**exponent."""
        c = self._scaled(exponent)
        for last in range(len(c) - 1, 0, -1):
            for k in range(1, last + 1):
                c[k] += m * c[k - 1]
        signs = [v > 0 for v in c if v]
        return sum(a != b for a, b in zip(signs, signs[1:], strict=False))

    def _positive(self, m: int, exponent: int) -> bool:
        value = 0
        for v in self._scaled(exponent):
            value = value * m + v
        return value > 0

    def largest(self, most: int, bits: int = 100) -> list[tuple[Fraction, int]]:
        """(root, how often) downwards until `most` roots that are not 0 are covered; roots within 2**-bits of each other, relatively, count as equal."""
        total, out, covered = self.above(0, 0), [], 0
        top = max(1, -self.c[1])  # the sum of the roots
        stack = [(0, top, 0, total, 0)]  # roots in (low, high] / 2**exponent: `count` of them, `over` above high
        while stack and covered < min(most, total):
            low, high, exponent, count, over = stack.pop()
            if not count:
                continue
            if high - low <= low >> bits:
                out.append((Fraction(low + high, 2 << exponent), count))
                covered += count
                continue
            if high - low == 1:
                low, high, exponent = 2 * low, 2 * high, exponent + 1
            middle = (low + high) // 2
            if count == 1 and over + 1 == self.above(low, exponent):
                out.append((self._refined(low, high, exponent, over, bits), 1))
                covered += 1
                continue
            upper = self.above(middle, exponent) - over
            stack.append((low, middle, exponent, count - upper, over + upper))
            stack.append((middle, high, exponent, upper, over))
        return out

    def _refined(self, low: int, high: int, exponent: int, over: int, bits: int) -> Fraction:
        """The only root in (low, high]: beyond it the sign is that of `over` roots above."""
        beyond = over % 2 == 0
        while high - low > low >> bits:
            if high - low == 1:
                low, high, exponent = 2 * low, 2 * high, exponent + 1
            middle = (low + high) // 2
            if self._positive(middle, exponent) == beyond:
                high = middle
            else:
                low = middle
        return Fraction(low + high, 2 << exponent)


def null_space(m: list[list[int]], root: Fraction, count: int, bits: int = 320, rounds: int = 3) -> list[list[float]]:
    """`count` orthonormal vectors v with (m - root) v about 0, by inverse iteration in fixed-point integers."""
    d, one = len(m), 1 << bits
    size = max(1, sum(m[i][i] for i in range(d)))
    shift = (root.numerator << bits) // (root.denominator * size)
    a = [[(v << bits) // size - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(m)]
    swaps: list[tuple[int, int]] = []
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[best] = a[best], a[k]
        swaps.append((k, best))
        if a[k][k] == 0:
            a[k][k] = 1
        top = a[k]
        for i in range(k + 1, d):
            row = a[i]
            if row[k]:
                f = (row[k] << bits) // top[k]
                row[k] = f
                for j in range(k + 1, d):
                    row[j] -= f * top[j] >> bits

    def solved(b: list[int]) -> list[int]:
        b = list(b)
        for k, best in swaps:  # rows were exchanged whole, factors too
            b[k], b[best] = b[best], b[k]
        for i in range(d):
            b[i] -= sum(a[i][j] * b[j] for j in range(i)) >> bits
        for i in range(d - 1, -1, -1):
            b[i] = ((b[i] << bits) - sum(a[i][j] * b[j] for j in range(i + 1, d))) // a[i][i]
        return b

    def unit(b: list[int]) -> list[int]:
        norm = math.isqrt(sum(v * v for v in b)) or 1
        return [(v << bits) // norm for v in b]

    draw = random.Random(d)
    basis = [unit([draw.randrange(-one, one) for _ in range(d)]) for _ in range(count)]
    for _ in range(rounds):
        done: list[list[int]] = []
        for b in map(solved, basis):
            b = unit(b)
            for other in done * 2:
                dot = sum(x * y for x, y in zip(b, other, strict=True)) >> bits
                b = [x - (dot * y >> bits) for x, y in zip(b, other, strict=True)]
            done.append(unit(b))
        basis = done
    return [[v / one for v in b] for b in basis]


@dataclass(frozen=True)
class Whitening:
    """n, sums of x, and for each component (eigenvalue of n**2 V, unit vector); trace of n**2 V."""

    n: int
    sums: list[int]
    values: list[Fraction]
    vectors: np.ndarray
    trace: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S: integers, of 64 bits where these suffice."""
        most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        room = self.n * most + max(map(abs, self.sums), default=0) < 1 << 62
        return (x if room else x.astype(object)) * self.n - np.array(self.sums, np.int64 if room else object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        scale = np.array([math.sqrt(v) for v in self.values])
        return centred.astype(float) @ self.vectors.T / scale


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The components of the rows of a written table of distinct x."""
    n, sums, gram = moments(fit_list)
    d = len(sums)
    scatter = gram * n - np.outer(sums, sums) if n else gram
    trace = int(sum(scatter[i, i] for i in range(d)))
    every = [int(s) + n * SHIFT for s in sums]
    if not trace:
        return Whitening(n, every, [], np.zeros((0, d)), 0)
    spark = fit_list.sparkSession
    found = Roots(characteristic(spark, scatter)).largest(components)
    whole = scatter.tolist()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                basis = null_space(whole, Fraction(int(r["num"]), int(r["den"])), r["times"])
                yield pa.RecordBatch.from_arrays([pa.array([r["at"]]), pa.array([basis])], ["at", "basis"])

    tasks = [(k, str(root.numerator), str(root.denominator), times) for k, (root, times) in enumerate(found)]
    work = spark.createDataFrame(tasks, "at bigint, num string, den string, times int").repartition(len(tasks), "at")
    basis = {r["at"]: r.basis for r in work.mapInArrow(vectors, "at bigint, basis array<array<double>>").collect()}  # d numbers a component
    values = [root for root, times in found for _ in range(times)][:components]
    return Whitening(n, every, values, np.array([v for k in range(len(found)) for v in basis[k]])[:components], trace)


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = model.project(model.centred(_matrix(b.column(0))))
                total += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    cells = fit_list.select("x").mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg((F.sum("s") / model.n).alias("c"))
    return cells.agg(F.max(F.abs(F.col("c") - F.expr("cast(i = j as double)")))).first()[0]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, deviation, whitened, explained for each row of `integers` and component."""
    key = rows.schema["vec_id"].dataType.simpleString()
    k = len(model.values)
    share = [float(v / model.trace) for v in model.values]
    step = max(1, 100_000 // max(k, 1))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                centred = model.centred(_matrix(b.column(1)))
                if centred.dtype != object and centred.size and centred.shape[1] * int(np.abs(centred).max()) ** 2 >= 1 << 63:
                    centred = centred.astype(object)
                deviation = (centred * centred).sum(1)
                if centred.dtype == object and any(v >= 1 << 63 for v in deviation):
                    raise OverflowError("a deviation does not fit 64 bits")
                n = b.num_rows
                ids = b.column(0).take(pa.array(np.repeat(np.arange(n), k)))
                columns = [ids, np.tile(np.arange(1, k + 1, dtype=np.int32), n), np.repeat(deviation.astype(np.int64), k), model.project(centred).ravel(), np.tile(share, n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["vec_id", "component", "deviation", "whitened", "explained"])

    schema = f"vec_id {key}, component int, deviation bigint, whitened double, explained double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.select("vec_id", "x").mapInArrow(apply, schema)


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows = integers(vectors, key, vector)
    fit_list = cut(rows.select("x").distinct())
    model = fit(fit_list, components)
    error = identity_error(fit_list, model) if model.values else 0.0
    done = transform(rows, model)
    return done.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
