import math
from fractions import Fraction

import numpy as np
import pytest

from quarrysight.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, id string, v long, n long, whitened string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1, 2, "w") for i, v in rows], SCHEMA).repartition(parts)


def brute(rows):
    """n, x by row, covariance as fractions of whole numbers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    v = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(d)] for i in range(d)]
    return n, x, s, v


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    turn = rng.normal(size=(7, 7)) * np.array([3, 2, 1.2, .7, .4, .2, .05])
    return [(k, [float(np.float32(c)) for c in rng.normal(size=7) @ turn]) for k in range(300)]


def test_components_match_fractions_and_eigh(spark, cloud):
    n, x, s, v = brute(cloud)
    awkward = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0]), (903, [math.nan] * 7),
               (904, [math.inf] + [0.0] * 6), (905, [1.0, 2.0])]
    got = W.whiten_components(frame(spark, cloud + awkward)).collect()
    assert len(got) == n * 7 and {r.vec_id for r in got} == {k for k, _ in cloud}
    values, unit = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    values, unit = values[::-1], unit[:, ::-1]
    white = np.zeros((n, 7))
    for r in got:
        white[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10
        assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[r.vec_id], s)) and r.identity_error < 1e-9
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(row, s)] for row in x])
    expect = centred @ unit / np.sqrt(values)
    assert np.abs(np.abs(white) - np.abs(expect)).max() < 1e-9
    assert np.abs(white.T @ white / n - np.eye(7)).max() < 1e-9


def test_the_fit_does_not_hang_on_the_partitions(spark, cloud):
    a, b = (W.fit(W.vectors(frame(spark, cloud, p))) for p in (1, 6))
    assert a.sums == b.sums and (a.components == b.components).all() and (a.eigenvalues == b.eigenvalues).all()


def test_graded_spectra_keep_their_small_end():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    d = 10.0 ** -np.arange(20)
    v = (q * d) @ q.T
    values, unit = W.jacobi(W.pivoted_cholesky((v + v.T) / 2))
    k = len(values)
    assert k >= 14 and np.allclose(values[:12], d[:12], rtol=1e-3)
    assert np.abs(unit.T @ unit - np.eye(k)).max() < 1e-12
    # a diagonal of any grading is met to the last digits
    values, _ = W.jacobi(W.pivoted_cholesky(np.diag(d[::-1])[:14, :14] + np.diag(d[:14])))
    assert np.allclose(values, np.sort(np.diag(np.diag(d[::-1])[:14, :14] + np.diag(d[:14])))[::-1], rtol=1e-14)


def test_rank_and_no_variance(spark):
    line = [(k, [k / 64.0, 2 * k / 64.0, 0.5]) for k in range(9)]
    got = W.whiten_components(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9 and all(abs(r.explained - 1) < 1e-12 for r in got)
    for rows in ([], [(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 4, [(1, None), (2, [])]):
        assert W.whiten_components(frame(spark, rows)).collect() == []


def test_huge_entries_and_repeated_ids(spark):
    rows = [(None, [1e30, 0.0]), (1, [-1e30, 1.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0])]
    got = W.whiten_components(frame(spark, rows)).collect()
    # the second entry's variance is under the last digit of the first's
    assert len(got) == 4 and sorted({r.vec_id for r in got}, key=str) == [1, None]
    assert all(r.identity_error < 1e-6 for r in got)
    assert sum(r.deviation is None for r in got) == 2      # past a long


def test_sums_of_any_size_are_exact():
    d = np.array([[3, -5], [1 << 40, 7], [(1 << 53) - 1, -(1 << 53)]])
    for rows in (d[:1], d[:2], d):
        want = [[sum(int(r[i]) * int(r[j]) for r in rows) for j in range(2)] for i in range(2)]
        assert W.gram(rows).tolist() == want
