"""Whitening against numpy's eigenvectors, and its exact parts against plain integers."""

import math

import numpy as np
import pytest

from pointmill.llm import whitening

rng = np.random.default_rng(11)


def of_roots(roots):
    """Coefficients of the product of (x - root), from the constant one."""
    c = [1]
    for q in roots:
        c = [(c[i - 1] if i else 0) - q * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    return c


def plain_characteristic(m):
    """Faddeev and LeVerrier's recurrence, in integers."""
    d = len(m)
    eye = np.array([[int(i == j) for j in range(d)] for i in range(d)], object)
    out, work = [1], eye
    for k in range(1, d + 1):
        product = m.dot(work)
        c = -int(sum(product[i, i] for i in range(d))) // k
        out.append(c)
        work = product + c * eye
    return out[::-1]


def test_characteristic_polynomial_is_exact(spark):
    for d, top in ((1, 9), (2, 3), (6, 10**12), (9, 50)):
        x = rng.integers(-top, top, (12, d))
        x[:, -1] = x[:, 0]  # singular but for one dimension
        m = whitening.exact_gram(x)
        assert (m == x.astype(object).T.dot(x.astype(object))).all()
        assert whitening.characteristic(spark, m) == plain_characteristic(m)
    zero = np.zeros((4, 4), np.int64)
    assert whitening.characteristic_mod(zero, 101).tolist() == [0, 0, 0, 0, 1]


def test_roots_with_repeats_and_close_ones():
    found = whitening.Roots(of_roots([9, 9, 9, 4, 4, 1, 0, 0])).largest(16)
    assert [(round(float(r), 9), n) for r, n in found] == [(9, 3), (4, 2), (1, 1)]
    found = whitening.Roots(of_roots([10**15, 10**15 + 1, 7, 3])).largest(3)
    assert [abs(r - want) < 1e-9 for (r, _), want in zip(found, (10**15 + 1, 10**15, 7), strict=True)] == [True] * 3
    assert whitening.Roots(of_roots([0, 0])).largest(4) == []


def test_null_space_of_repeated_roots_is_orthonormal():
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], object)
    m = q.dot(np.diag([5, 5, 2, 0]).astype(object)).dot(q.T)  # roots 20, 20, 8, 0
    v = np.array(whitening.null_space(m.tolist(), whitening.Roots(plain_characteristic(m)).largest(1)[0][0], 2))
    assert np.abs(v @ v.T - np.eye(2)).max() < 1e-14 and np.abs(v @ m.astype(float) - 20 * v).max() < 1e-12


def check(rows, vectors, components=16):
    """vectors: {vec_id: entries} that take part."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors.values()])
    fit = np.unique(x, axis=0)
    n, mean = len(fit), fit.mean(0)
    values, basis = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    want = (x - mean) @ basis[:, :k] / np.sqrt(values[:k])
    got = {(r.vec_id, r.component): r for r in rows}
    assert set(got) == {(i, c + 1) for i in vectors for c in range(k)}
    for j, (i, row) in enumerate(zip(vectors, x, strict=True)):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, fit.sum(0), strict=True))
        for c in range(k):
            r = got[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert abs(abs(r.whitened) - abs(want[j, c])) < 1e-6 and abs(r.explained / (values[c] / values.sum()) - 1) < 1e-9
    signs = {c: {np.sign(got[i, c + 1].whitened * want[j, c]) for j, i in enumerate(vectors) if abs(want[j, c]) > 1e-6} for c in range(k)}
    assert all(len(s) == 1 for s in signs.values())


def test_op11_matches_numpy(spark, tmp_path):
    base = rng.normal(0, 1, (150, 20)) @ rng.normal(0, 1, (20, 20))
    vectors = {i: [float(np.float32(c)) for c in v] for i, v in enumerate(base)}
    vectors |= {1000 + i: vectors[3] for i in range(60)}  # repeats count once in the fit
    rows = [(i, v, "n", 1) for i, v in vectors.items()]
    rows += [(2000, None, "n", 1), (2001, [], "n", 1), (2002, [None] * 20, "n", 1), (2003, [float("nan")] * 20, "n", 1), (2004, [float("inf")] + [0.0] * 19, "n", 1), (2005, [1.0] * 19, "n", 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, n int").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = whitening.op11_whitening(spark, str(tmp_path))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), vectors)


def test_few_dimensions_repeated_rows_and_null_ids(spark):
    vectors = {1: [0.0, 1.0, 0.0], 2: [2.0, 1.0, -3.0], 3: [5.5, 1.0, 1.0], None: [1.0, 1.0, 1.0]}
    rows = list(vectors.items())
    schema = "vec_id long, embedding array<double>"
    check(whitening.whiten(spark.createDataFrame(rows, schema)).collect(), vectors)
    twice = whitening.whiten(spark.createDataFrame(rows * 2, schema), 1)
    assert twice.count() == 8 and {r.component for r in twice.collect()} == {1}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_fit(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert out.collect() == [] and out.columns[-1] == "identity_error"


def test_large_entries_stay_exact():
    x = np.array([[1 << 40, -(1 << 41), 3], [-(1 << 50) + 7, 1 << 33, -5]], np.int64)
    assert (whitening.exact_gram(x) == x.astype(object).T.dot(x.astype(object))).all()
    digits = whitening._split(-12345678901234567890123, 5)
    assert sum(d << (40 * k) for k, d in enumerate(digits)) == -12345678901234567890123
