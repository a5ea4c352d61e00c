"""Descent and ellipses against plain numpy."""

from __future__ import annotations

import numpy as np

from volcohort.operators import cohort, spikes


def test_logistic(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 2))
    y = (x @ [1.5, -1] + rng.normal(size=80) > 0).astype(float)
    df = spark.createDataFrame([(*map(float, r), bool(v)) for r, v in zip(x, y, strict=True)] + [(None, 1.0, True), (1.0, 1.0, None)], "a double, b double, y boolean")
    a, w = np.hstack([x, np.ones((80, 1))]), np.zeros(3)
    for _ in range(25):
        w = w - 0.5 * (a.T @ (1 / (1 + np.exp(-a @ w)) - y) / 80 + 1e-3 * np.append(w[:-1], 0))
    assert np.allclose(cohort.fit_logistic(df, ["a", "b"], "y", 25), w)
    assert cohort.fit_logistic(df.limit(0), ["a", "b"], "y", 3).tolist() == [0, 0, 0]


def test_ellipse_residues(spark):
    rng = np.random.default_rng(2)
    groups = {}
    for g in range(4):
        t = rng.uniform(0, 2 * np.pi, 60)
        groups[g] = np.stack([5 * np.cos(t) + 0.3 * np.sin(t), 2 * np.sin(t)], axis=1) + rng.normal(size=(60, 2)) * 0.1
    groups[1][7] *= 2.5
    groups[4], groups[5], groups[6] = groups[0][:11], np.ones((20, 2)), np.stack([np.arange(20.0), np.zeros(20)], axis=1)
    df = spark.createDataFrame([(g, float(a), float(b)) for g, p in groups.items() for a, b in p], "g int, x double, y double")
    got = {r.g: r for r in spikes.ellipse_residues(df, ["g"], "x", "y").collect()}
    for g, p in groups.items():
        q = p - p.mean(0)
        lam, v = np.linalg.eigh(np.cov(q.T))
        rad = np.linalg.norm(q @ (v @ np.diag(1 / np.sqrt(np.maximum(lam, 1e-9))) @ v.T).T, axis=1)
        med, want = np.median(rad), (0.0, 0.0)
        if len(p) >= 12 and med > 0:
            res = (rad - med) * np.median(np.linalg.norm(q, axis=1)) / med
            want = (res.max(), np.percentile(res, 95))
        assert got[g].points == len(p) and np.allclose((got[g].largest, got[g].p95), want, atol=1e-6), g
    assert got[1].largest > 3 * got[0].largest
