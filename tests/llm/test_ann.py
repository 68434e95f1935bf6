import math

import numpy as np
from pyspark.sql import functions as F

from gaffer.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    best = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            best[i] = min(best.get(i, v), v)
    out = {}
    for q, u in best.items():
        if q % 50:
            continue
        scored = []
        for j, w in best.items():
            if j != q and len(w) == len(u):
                a, b = np.array([u]), np.array([w])
                s = float((a * b).sum(1)[0] / (np.sqrt((a * a).sum(1)[0]) * np.sqrt((b * b).sum(1)[0])))
                scored.append((-s, j))
        out[q] = [(j, -s) for s, j in sorted(scored)[:k]]
    return {q: x for q, x in out.items() if x}


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(j, s) for _, j, s in sorted(x)] for q, x in got.items()}


def same(got, want):
    assert set(got) == set(want)
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-14, atol=0)


def rows_of(rnd, n, d=16):
    v = rnd.normal(size=(n, d)).astype(np.float32)
    v[n // 2:] = v[:n - n // 2]  # exact copies: ties go to the smaller id
    v[5] = v[5] * 1e-20
    v[6] = v[6] * 1e18
    return [(i, v[i].tolist()) for i in range(n)]


def test_exact_against_brute_force_both_ways(llm, monkeypatch):
    rows = rows_of(np.random.default_rng(1), 400)
    want = brute(rows, 5)
    same(run(llm, rows), want)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 17)
    same(run(llm, rows), want)
    monkeypatch.setattr(ann, "BROADCAST_BYTES", 0)
    same(run(llm, rows), want)


def test_vectors_that_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [2.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (50, [0.0, 0.0]), (100, [-1.0, 0.0]),
            (-50, [1.0, 2.0])]
    same(run(llm, rows), brute(rows, 5))
    assert run(llm, rows[:0]) == {}
    assert run(llm, [(50, [1.0, 1.0])]) == {}  # no candidate at all


def test_bounds_hold(llm):
    rnd = np.random.default_rng(2)
    v = rnd.normal(size=(64, 40))
    vectors, codes, scale, error = ann.code(v)
    unit = vectors / np.sqrt((vectors ** 2).sum(1))[:, None]
    about = ann.code_products(codes.astype(np.float32), codes.astype(np.float32)) * scale[:, None] * scale
    bound = (1 + error)[:, None] * error[None, :] + error[:, None]
    assert (np.abs(unit @ unit.T - about) <= bound + 1e-12).all()
