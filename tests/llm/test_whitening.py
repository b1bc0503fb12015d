"""Whitening against numpy's own decomposition, and exact sums in Python integers."""

import math

import numpy as np
import pytest

from rankstream.llm import whitening

ROWS = "vec_id long, embedding array<float>"


def direct(vectors, components=16):
    """n, per-vector deviation, eigenvalue shares and whitened values up to sign."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n = len(fit)
    sums = [sum(col) for col in zip(*fit)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit) - mean
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    white = (np.array(x) - mean) @ columns / np.sqrt(values)
    return n, deviation, values / (centred**2).sum() * n, white


def rows_of(df, **options):
    return sorted((tuple(r) for r in whitening.whitened(df, **options).collect()), key=repr)


@pytest.mark.parametrize("width", [24, 5])
def test_whitening(spark, width):
    rng = np.random.default_rng(width)
    vectors = (rng.standard_normal((300, width)) * np.linspace(3, 1, width)).astype(np.float32).tolist()
    vectors += vectors[:40]
    n, deviation, shares, white = direct(vectors)
    df = spark.createDataFrame(list(enumerate(vectors)), ROWS)
    found = whitening.whitened(df).collect()
    assert len(found) == len(vectors) * min(16, width)
    for r in found:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[r.vec_id, r.component - 1]), abs=1e-7)
        assert 0 <= r.identity_error < 1e-9
    signs = {(r.component, r.whitened * white[r.vec_id, r.component - 1] > 0)
             for r in found if abs(r.whitened) > 1e-3}
    assert len(signs) == min(16, width)


def test_odd_rows(spark):
    """Unusable vectors go; repeated rows and null ids stay; columns may have any names."""
    good = [(1, [0.0, 1.0, 5.0]), (2, [2.0, -1.0, 0.5]), (3, [4.0, 0.25, 0.0]), (4, [1.0, 1.0, 1.0])]
    extra = [(4, [1.0, 1.0, 1.0]), (None, [0.0, 1.0, 5.0])]
    bad = [(0, None), (5, []), (6, [1.0, None, 2.0]), (7, [math.nan, 1.0, 1.0]),
           (8, [1.0, -math.inf, 1.0]), (9, [1.0, 2.0])]
    df = spark.createDataFrame(
        [(*r, 1, "y", 2.0) for r in good + extra + bad], ROWS + ", n int, component string, x double"
    )
    found = whitening.whitened(df).collect()
    assert {r.n for r in found} == {4}
    assert sorted((r.vec_id or -1, r.component) for r in found) == sorted(
        (i, c) for i in (1, 2, 3, 4, 4, -1) for c in (1, 2, 3)
    )
    same = {r.component: r.whitened for r in found if r.vec_id == 1}
    for r in found:
        if r.vec_id is None:
            assert r.whitened == pytest.approx(same[r.component], rel=1e-12)


def test_no_spread_gives_no_rows(spark):
    assert rows_of(spark.createDataFrame([], ROWS)) == []
    assert rows_of(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], ROWS)) == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], ROWS)
    assert {r[1] for r in rows_of(line)} == {1}


def test_large_numbers_are_exact(spark):
    vectors = [[1e11, 1.0], [-1e11, 2.0], [3e10, -5.0], [0.0, 0.0]]
    n, deviation, shares, _ = direct(vectors)
    found = whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), ROWS)).collect()
    for r in found:
        assert r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 1 << 63 else None)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-6)


def test_counts_and_slices():
    """Clusters, equal and zero eigenvalues, indefinite matrices with a zero diagonal."""
    rng = np.random.default_rng(2)
    spectra = ([9, 5, 5, 5, 1, 0, 0], [3, 3, 3, 3], [4, 4 - 1e-9, 2, 1e-3], [7, 1e-30, 0],
               rng.random(40) + 1, [2.0] + [1.0] * 20)
    for spectrum in spectra:
        spectrum = np.sort(np.array(spectrum, float))[::-1]
        d = len(spectrum)
        basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
        matrix = basis * spectrum @ basis.T
        matrix = (matrix + matrix.T) / 2
        for shift in rng.random(5) * 6 - 0.5:
            assert whitening.above(matrix, shift) == int((spectrum > shift).sum())
        values, columns = whitening.leading(matrix, 16)
        wanted = spectrum[spectrum > 1e-12][:16]
        assert values == pytest.approx(wanted, abs=1e-12 * spectrum[0])
        assert columns.T @ columns == pytest.approx(np.eye(len(wanted)), abs=1e-12)
        assert matrix @ columns == pytest.approx(columns * values, abs=1e-12 * spectrum[0])
    assert whitening.above(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0
