import math

import numpy as np
import pytest

from punctual.llm import contour, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n string"


def symmetric(values, seed=1):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


SPECTRA = {
    "spread": np.linspace(1, 90, 64),
    "steep": 10.0 ** np.linspace(-6, 5, 40),
    "double": np.repeat([9.0, 4.0, 4.0 + 1e-9, 1.0], 5),
    "equal": np.full(30, 7.0),
    "rank two": np.array([5.0, 3.0] + [0.0] * 20),
    "one": np.array([2.0]),
    "signs": np.linspace(-5, 5, 31),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts(name):
    values = SPECTRA[name]
    form = contour.tridiagonal(symmetric(values))
    at = np.array([-6, 0.5, 1.7, 3.9, 6.1, 50.3, 1e6])
    assert contour.below(form, at).tolist() == [np.count_nonzero(values < v) for v in at]


def test_inertia_without_a_diagonal():
    m = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]])
    assert contour.below(contour.tridiagonal(m), np.array([-2, -0.5, 0.5, 2])).tolist() == [0, 1, 2, 3]
    assert contour.below(contour.tridiagonal(np.zeros((3, 3))), np.array([-1.0, 1.0])).tolist() == [0, 3]


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("wanted", [1, 5, 16])
def test_largest_eigenpairs(name, wanted):
    values = np.sort(SPECTRA[name])[::-1]
    m = symmetric(values)
    floor = 1e-10 * values[0]
    got, vectors = contour.largest(m, wanted, floor)
    expected = values[values > floor][:wanted]
    assert np.allclose(got, expected, rtol=0, atol=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(m @ vectors - vectors * got).max() < 1e-11 * values[0]


def brute(rows, most=16):
    width = max(
        (len(v) for _, v, *_ in rows if v), key=lambda w: (sum(len(v or []) == w for _, v, *_ in rows), w)
    )
    fine = [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v, *_ in rows
        if v and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    ]
    x = np.array(sorted({tuple(v) for _, v in fine}))
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    k = min(most, np.count_nonzero(values > 1e-10 * values[-1]))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for row, (i, v) in enumerate(fine):
        d = [n * int(a) - int(b) for a, b in zip(v, s)]
        w = (np.array(v) - s / n) @ vectors / np.sqrt(values)
        out[row] = (i, n, sum(e * e for e in d), w)
    return out, values / np.trace(y.T @ y / n)


def checked(spark, rows, most=16):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = whitening.whitened(df, most).collect()
    expected, explained = brute(rows, most)
    k = len(explained)
    assert len(got) == len(expected) * k
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in got)
    assert all(r.identity_error < 1e-9 for r in got)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    signs = np.zeros(k)
    for i, n, deviation, w in expected.values():
        found = by_row[(i, n, deviation)]
        assert sorted(found) == list(range(1, k + 1))
        for c in range(k):
            assert any(abs(abs(v) - abs(w[c])) < 1e-8 for v in found[c + 1])
            if abs(w[c]) > 1e-3 and len(found[c + 1]) == 1:
                sign = np.sign(found[c + 1][0]) * np.sign(w[c])
                assert signs[c] in (0, sign)
                signs[c] = sign
    return got


def vectors(n=300, width=24, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, width)) * np.linspace(0.5, 3, width) + rng.standard_normal(width)
    return [(i, [float(c) for c in v], "x", "n") for i, v in enumerate(m.astype(np.float32))]


def test_against_a_dense_solver(spark):
    checked(spark, vectors())
    checked(spark, vectors(width=5))


def test_edges(spark):
    rows = vectors(60, 6)
    bad = [(100, None), (101, []), (102, [None] * 6), (103, [1.0] * 5 + [float("nan")])]
    bad += [(104, [float("-inf")] + [0.0] * 5), (105, [1.0, 2.0]), (106, [3e38] * 6)]
    extra = [(None, rows[0][1], "", ""), (None, rows[1][1], "", ""), (7, rows[2][1], "", "")]
    every = rows + extra + rows[:4] * 50 + [(i, v, "", "") for i, v in bad]
    df = spark.createDataFrame(every, SCHEMA)
    got = checked(spark, rows + extra + rows[:4] * 50)
    assert len(whitening.whitened(df).collect()) == len(got)
    for few in ([], rows[:1] * 3, [(1, None, "", "")]):
        assert whitening.whitened(spark.createDataFrame(few, SCHEMA)).collect() == []
    checked(spark, rows[:3])


def test_numbers_beyond_64_bits(spark):
    fit = whitening.Fit(3, (2**62, -5), np.eye(2), np.ones(2), 2.0)
    x = np.array([[2**61, 4]])
    assert fit.deviations(x) == [(3 * 2**61 - 2**62) ** 2 + 17**2]
    rows = [(i, [1e12 * i, 1.0 * i], "", "") for i in range(4)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) in (4, 8) and all(r.n == 4 and math.isfinite(r.whitened) for r in got)
    assert all(r.deviation is None for r in got)
