import math
import random

import numpy as np
import pytest

from wearcast.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, n int, component string")


def usable(v, dim):
    return v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, dim):
    x = {k: [math.floor(256 * c) + 0 for c in v] for k, (_, v) in enumerate(rows) if usable(v, dim)}
    fit = sorted(set(map(tuple, x.values())))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[float(n * a - b) / n for a, b in zip(v, s)] for v in fit])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    return x, n, s, e, u, float((z * z).sum() / n)


def check(spark, rows, dim, k=4, rel=1e-9):
    got = W.whiten(frame(spark, rows)).collect()
    x, n, s, e, u, trace = brute(rows, dim)
    assert len(got) == k * len(x)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-4
    sign = {}
    for i in x:
        vid, z = rows[i][0], np.array([float(n * a - b) / n for a, b in zip(x[i], s)])
        dev = sum((n * a - b) ** 2 for a, b in zip(x[i], s))
        for c in range(1, k + 1):
            want = float(z @ u[:, c - 1] / math.sqrt(e[c - 1]))
            close = [r for r in by[vid, c] if r["deviation_exact"] == str(dev)
                     and abs(abs(r["whitened"]) - abs(want)) <= rel * (1 + abs(want)) * 100]
            assert close, (vid, c, want, by[vid, c])
            r = close[0]
            assert r["n"] == n and r["deviation"] == (dev if dev < 2**63 else None)
            assert r["explained"] == pytest.approx(e[c - 1] / trace, rel=1e-6)
            if abs(want) > 1e-3 and len(by[vid, c]) == 1:
                assert sign.setdefault(c, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
    return got


def spread(seed, rows, dim, scale, shift=0.0):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return (rng.normal(size=(rows, dim)) * scale @ turn + shift).tolist()


def test_equals_eigenvectors(spark):
    vs = spread(1, 300, 6, np.array([3.0, 2, 1.2, 0.7, 0.3, 0.1]))
    rows = list(enumerate(vs)) + [(5, vs[5]), (900, vs[7]), (None, vs[8])]  # copies count once in the fit
    rows += [(901, None), (902, [1.0] * 5 + [None]), (903, [float("nan")] + [0.0] * 5), (904, [float("inf")] * 6),
             (905, [1.0] * 4), (906, []), (907, [1e300] + [0.0] * 5)]
    random.Random(1).shuffle(rows)
    x = [r for r in rows if r[0] != 907]  # too large for an integer: left out
    got = W.whiten(frame(spark, rows)).collect()
    assert sorted(map(str, got)) != [] and 907 not in {r["vec_id"] for r in got}
    check(spark, x, 6)


def test_mean_far_from_zero_and_large_counts(spark):
    check(spark, list(enumerate(spread(2, 200, 5, np.array([1.0, 0.8, 0.5, 0.3, 0.2]), shift=3e6))), 5, rel=1e-7)
    big = W.Whitening(2, 10**9, [5 * 10**9, -3], np.ones(1), np.ones((2, 1)), 1.0)
    x = np.array([[7, -2], [2**40, 2**41]])
    assert big.deviations(x) == [sum((10**9 * int(a) - s) ** 2 for a, s in zip(v, big.sums)) for v in x]


def test_rank_and_degenerate_tables(spark):
    vs = spread(3, 80, 2, np.array([2.0, 1.0]))
    flat = [v + [5.0, v[0]] for v in vs]  # a constant and a copied dimension: rank 2
    got = W.whiten(frame(spark, list(enumerate(flat)))).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] <= 1e-4
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3):
        assert W.whiten(frame(spark, rows)).collect() == []


def test_independent_of_partitioning(spark):
    rows = list(enumerate(spread(4, 150, 8, np.arange(8, 0, -1.0))))
    a, b = ({(r["vec_id"], r["component"]): r["whitened"] for r in W.whiten(frame(spark, rows).repartition(p)).collect()}
            for p in (1, 9))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 7), (33, 20), (64, 64)])
def test_factor_and_rotations(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(200, rank)) * 10.0 ** rng.uniform(-2, 2, rank) @ rng.normal(size=(rank, d))
    a = a.T @ a
    low = W.pivoted_cholesky(a)
    assert low.shape == (d, rank) and np.allclose(low @ low.T, a, rtol=0, atol=1e-9 * np.abs(a).max())
    values, vectors = W.principal(a)
    e, u = np.linalg.eigh(a)
    assert np.allclose(values, e[::-1][:rank], rtol=1e-6, atol=1e-12 * e.max())
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-10)
    assert np.allclose(vectors * values @ vectors.T, a, rtol=0, atol=1e-10 * np.abs(a).max())
