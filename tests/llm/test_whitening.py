import math
from collections import defaultdict

import numpy as np
import pytest

from lexspark.llm.whitening import Spectrum, rank_one, secular_roots, whiten_embeddings

SCHEMA = "vec_id long, embedding array<double>, x int, n string, part int, component string"


def brute(rows, components=4):
    """Rows of the whitening by numpy's eigendecomposition of the covariance of exactly centred integers."""
    fits = defaultdict(dict)
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = tuple(math.floor(c * 256) for c in v)
            fits[len(x)].setdefault(x, []).append(i)
    out = []
    for dim, fit in fits.items():
        n, sums = len(fit), [sum(x[k] for x in fit) for k in range(dim)]
        off = np.array([[float(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fit]).reshape(n, dim)
        e, q = np.linalg.eigh(off.T @ off / n) if dim else (np.zeros(0), np.zeros((0, 0)))
        for c, k in enumerate(np.argsort(-e)[:components], 1):
            if e[k] > 1e-9 * e.sum():
                axis = q[:, k] * np.sign(q[np.abs(q[:, k]).argmax(), k])
                for (x, ids), o in zip(fit.items(), off, strict=True):
                    far = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
                    out += [(i or -1, c, n, far if far < 1 << 63 else None, o @ axis / math.sqrt(e[k]), e[k] / e.sum()) for i in ids]
    return sorted(out, key=str)


def check(spark, rows, **how):
    got = whiten_embeddings(spark.createDataFrame([(i, v, 1, "n", 2, "c") for i, v in rows], SCHEMA), **how).collect()
    want = brute(rows)
    got = sorted([(r.vec_id or -1, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got], key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    # The sort is by text; equal keys only repeat equal vectors or pair up vectors of one id.
    assert np.allclose(sorted(g[4] for g in got), sorted(w[4] for w in want), rtol=1e-9, atol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10) and all(g[6] < 1e-9 for g in got)


@pytest.mark.parametrize("part", [4096, 7])
def test_same_as_brute_force(spark, part):
    rng = np.random.default_rng(1)
    spread = np.array([5, 3, 2, 1, 0.5, 0.2, 0.1, 0.05, 0.02, 0.01])
    turn = np.linalg.qr(rng.standard_normal((10, 10)))[0]
    rows = [(k, ((rng.standard_normal(10) * spread) @ turn + 3).tolist()) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(300, 350)] + [rows[1], (None, rows[2][1])]
    rows += [(400, None), (401, [None] * 10), (402, [float("nan")] * 10), (403, [float("inf")] + [0.0] * 9), (404, []), (405, [1.0, 2.0])]
    check(spark, rows, part=part)


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(2)
    line = rng.standard_normal(6)
    check(spark, [(k, (np.round(64 * a) * np.round(4 * line) / 256).tolist()) for k, a in enumerate(rng.standard_normal(50))])
    check(spark, [(k, [float(k % 5), float(k % 3)]) for k in range(40)], part=3)
    check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whiten_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_great_numbers(spark):
    rng = np.random.default_rng(3)
    check(spark, [(k, (rng.standard_normal(3) * 2.0**33).tolist()) for k in range(30)], part=8)
    far = whiten_embeddings(spark.createDataFrame([(1, [1e300, 0.0], 1, "", 1, ""), (2, [0.0, 1.0], 1, "", 1, ""), (3, [1.0, 0.0], 1, "", 1, "")], SCHEMA)).collect()
    assert {(r.vec_id, r.n) for r in far} == {(2, 2), (3, 2)}


def test_driver_table(spark):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(spark, [(r.vec_id, r.embedding) for r in v.collect()], part=100)


def test_rank_one_updates():
    rng = np.random.default_rng(0)
    for trial in range(200):
        k = int(rng.integers(1, 24))
        d = np.sort(rng.choice([0, 0, 1, 1 + 1e-15, 2, 5, 1e-9, 1e6], k) * 1.0) if trial % 2 else np.sort(rng.random(k) * 10 ** rng.uniform(-6, 6))
        q = np.linalg.qr(rng.standard_normal((k, k)))[0]
        v, rho = rng.standard_normal(k) * rng.choice([0, 1e-12, 1, 1, 1e3], k), float(10 ** rng.uniform(-6, 6))
        values, basis = rank_one(d, q, rho, v)
        want = (q * d) @ q.T + rho * np.outer(v, v)
        assert np.abs((basis * values) @ basis.T - want).max() <= 1e-12 * max(np.abs(want).max(), 1e-300)
        assert np.abs(basis.T @ basis - np.eye(k)).max() < 1e-12 and (np.diff(values) >= 0).all()
    roots, gap = secular_roots(np.array([0.0, 1.0, 2.0]), np.array([0.5, 1e-30, 0.5]), 1.0)
    assert 0 < roots[0] < 1 <= roots[1] < 2 < roots[2] and np.allclose(gap[0], [0, 1, 2] - roots[0])


def test_merged_spectra():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (90, 12))
    one, parts = Spectrum.empty(12), [Spectrum.empty(12) for _ in range(3)]
    one.add(x)
    for p, rows in zip(parts, (x[:5], x[5:80], x[80:]), strict=True):
        p.add(rows)
        if p is not parts[0]:
            parts[0].merge(p)
    assert parts[0].n == 90 and list(parts[0].sums) == x.sum(0).tolist() == list(one.sums)
    scatter = np.cov(x.T.astype(float), bias=True) * 90
    for s in (one, parts[0]):
        assert np.allclose((s.basis * s.values) @ s.basis.T, scatter, rtol=1e-11, atol=1e-6)
