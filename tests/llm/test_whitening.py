"""Whitening against a covariance and eigenvectors by definition."""

import math
import random

import numpy as np
import pytest

from detlake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, component int"


def whole(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def good(vector, d):
    return vector is not None and len(vector) == d and all(c is not None and math.isfinite(c) for c in vector)


def check(spark, rows, d):
    out = W.whitened(spark.createDataFrame([(*r, 5) for r in rows], SCHEMA).repartition(3)).collect()
    kept = [(i, whole(v)) for i, v in rows if good(v, d)]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[n * x[k] - s[k] for k in range(d)] for x in fit], float) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(16, int((e > 1e-12 * e[0]).sum()))
    assert len(out) == k * len(kept)
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-6
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for id, x in kept:
        dev = sum((n * v - t) ** 2 for v, t in zip(x, s))
        got = by[id, dev if dev < 2 ** 63 else None]
        want = (np.array([n * v - t for v, t in zip(x, s)], float) / n) @ q[:, :k] / np.sqrt(e[:k])
        for c in range(k):
            assert got[c + 1].explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
            if (c == 0 or e[c - 1] > 1.01 * e[c]) and (c + 1 == len(e) or e[c] > 1.01 * e[c + 1]):
                assert abs(got[c + 1].whitened) == pytest.approx(abs(want[c]), rel=1e-6, abs=1e-6)


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 70)
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1 + k) for k in range(20)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)] + [(None, rows[6][1]), (5, rows[7][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [math.nan] * 20), (2004, [math.inf, *[0.0] * 19]), (2005, [1.0, 2.0])]
    check(spark, rows, 20)


def test_wide_range(spark):
    rnd = random.Random(2)
    check(spark, [(i, [rnd.uniform(-1e12, 1e12), rnd.gauss(0, 1e9), rnd.gauss(0, 1e11)]) for i in range(100)], 3)


def test_few_rows_and_constant_dimensions(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 4):
        assert W.whitened(spark.createDataFrame([(*r, 5) for r in rows], SCHEMA)).collect() == []
    check(spark, [(i, [float(i), 3.0]) for i in range(9)], 2)


def test_cross_products_are_exact():
    rnd = random.Random(3)
    for wide in (3, 40, 61):
        x = np.array([[rnd.randint(-(1 << wide), 1 << wide) for _ in range(4)] for _ in range(130)], np.int64)
        sums, inner = W.cross_products(x)
        rows = x.tolist()
        assert sums == [sum(r[i] for r in rows) for i in range(4)]
        assert all(inner[i][j] == sum(r[i] * r[j] for r in rows) for i in range(4) for j in range(i, 4))
