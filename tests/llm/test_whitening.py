import math

import numpy as np
import pytest

from gaffer.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", "y") for i, v in rows], SCHEMA)


def brute(rows):
    """n, per row: deviation and whitened up to signs, eigenvalues' shares, by numpy."""
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    y = np.array([[(n * c - t) / n for c, t in zip(r, s)] for r in x])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    k = min(32, rank)
    return [i for i, _ in good], n, dev, y @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def same(got, rows):
    ids, n, dev, white, shares = brute(rows)
    assert len(got) == white.size
    w = np.full(white.shape, np.nan)
    at = {i: k for k, i in enumerate(ids)}
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == dev[at[r.vec_id]]
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    sign = np.sign((w * white).sum(0))
    assert np.allclose(w, white * sign, atol=1e-7)
    assert len({r.identity_error for r in got}) <= 1


@pytest.mark.parametrize("n, d, parts", [(300, 40, 1), (300, 40, 9), (50, 5, 4), (20, 33, 3)])
def test_equals_numpy(llm, n, d, parts):
    rnd = np.random.default_rng(n + d)
    v = (rnd.normal(size=(n, d)) * np.linspace(3, .2, d) + rnd.normal(size=(n, 3)) @ rnd.normal(size=(3, d))).astype(np.float32)
    rows = [(i, r) for i, r in enumerate(v.tolist())]
    rows += [(1001, None), (1002, []), (1003, [float("nan")] * d), (1004, [None] * d), (1005, [float("inf")] * d)]
    same(whitening.whitened(table(llm, rows).repartition(parts)).collect(), rows)


def test_factorisation():
    rnd = np.random.default_rng(3)
    for n, r in ((1, 1), (6, 6), (9, 4), (30, 30)):
        g = rnd.normal(size=(n, r)) * np.logspace(0, -4, r)
        a = g @ g.T
        order, factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (n, r) and np.allclose(np.triu(factor[:r], 1), 0)
        assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-13)
        turned = whitening.one_sided_jacobi(factor)
        gram = turned.T @ turned
        assert np.allclose(gram - np.diag(np.diag(gram)), 0, atol=1e-12)
        values, axes = whitening.components(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:r], rtol=1e-6)
        assert np.allclose(a @ axes, axes * values, atol=1e-12) and np.allclose(axes.T @ axes, np.eye(r), atol=1e-8)


def test_rounds_meet_every_pair_once():
    for n in (1, 2, 5, 8):
        met = sorted((int(a), int(b)) for i, j in whitening.rounds(n) for a, b in zip(i, j))
        assert met == [(a, b) for a in range(n) for b in range(a + 1, n)]


def test_edge_cases(llm):
    assert whitening.whitened(table(llm, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    assert whitening.whitened(table(llm, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whitened(table(llm, [(k, [1.0, 2.0]) for k in range(9)])).count() == 0
    # ids may be null or repeat; other lengths take no part
    got = whitening.whitened(table(llm, [(None, [1.0, 5.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (4, [1.0]), (5, [])])).collect()
    assert sorted((str(r.vec_id), r.n, r.component) for r in got) == [("2", 3, 1), ("2", 3, 1), ("None", 3, 1)]
    assert [r.explained for r in got] == [1.0] * 3


def test_deviations_of_any_size():
    x = np.array([[1 << 40, -(1 << 40)], [3, 5]], np.int64)
    total = x.sum(0).tolist()
    exact = [sum((2 * v - t) ** 2 for v, t in zip(r, total)) for r in x.tolist()]
    assert whitening.deviations(x, 2, total, False) == [e if e < 1 << 63 else None for e in exact]
    y = np.array([[7, 9], [1, -4]], np.int64)
    assert whitening.deviations(y, 2, y.sum(0).tolist(), True) == whitening.deviations(y, 2, y.sum(0).tolist(), False)
