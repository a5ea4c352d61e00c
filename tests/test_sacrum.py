"""Quantiles and the oriented cut against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from volcohort.functions import stats
from volcohort.operators import sacrum


def test_quantile(spark):
    rng = np.random.default_rng(1)
    groups = {0: rng.normal(size=500), 1: np.round(rng.normal(size=300)), 2: rng.normal(size=7), 3: np.ones(60), 4: np.array([2.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [(0, None)], "g int, v double").repartition(5)
    for q in (0.0, 0.03, 0.1, 0.5, 0.97, 1.0):
        got = {r.g: (r.n, r["quantile"]) for r in stats.quantile(df, ["g"], "v", q).collect()}
        assert set(got) == set(groups) and all(got[g][0] == len(x) and abs(got[g][1] - np.quantile(x, q)) < 1e-12 for g, x in groups.items())


@pytest.mark.parametrize("seeded", [False, True])
def test_carved(spark, seeded):
    """Turned grids; one case without a seed, one without a sacrum."""
    rng, rows, seeds, grids, want = np.random.default_rng(2), [], [], [], {}
    for c in range(4):
        m = np.eye(4)
        m[:3, :3] = np.linalg.qr(rng.normal(size=(3, 3)) * 0.3 + np.eye(3))[0] @ np.diag([1.0, 1.5, 2.0])
        m[:3, 3] = rng.normal(size=3) * 9
        grids.append((c, m.ravel().tolist()))
        places = [p for p in np.ndindex(6, 5, 9) if rng.random() < 0.8 and abs(p[0] - p[2] / 2) < 3]
        labels = {p: 5 if c == 3 else 26 if seeded or c == 2 or p[2] < 5 or rng.random() < 0.2 else 29 for p in places}
        top = [p for p in places if p[2] >= 5 and rng.random() < 0.7] if seeded and c != 2 else [p for p, v in labels.items() if v == 29]
        seeds += [(c, p[2], p[1], p[0]) for p in [*top, (50, 50, 50)]] if c != 2 else []
        want[c] = dict(labels)
        if top and c != 3:
            w = {p: (m @ [*p, 1])[:3] for p in places}
            x = np.array(list(w.values()))
            val, vec = np.linalg.eigh(np.cov((x - x.mean(0)).T))
            n = next((n for n in np.argsort(val)[::-1] if abs(vec[2, n]) > 0.3), int(np.argmax(val)))
            axis = vec[:, n] * np.sign(vec[2, n])
            axis[0] = 0
            axis /= np.linalg.norm(axis)
            cut = np.percentile([(w[p] - x.mean(0)) @ axis for p in top], 10)
            want[c] = {p: 29 if (w[p] - x.mean(0)) @ axis >= cut else 26 for p in places}
        rows += [(c, p[2], p[1], p[0], v) for p, v in labels.items()]
    v = spark.createDataFrame(rows, "case_id int, k int, j int, i int, label int")
    g = spark.createDataFrame(grids, "case_id int, affine array<double>")
    out = sacrum.carved(v, g, spark.createDataFrame(seeds, "case_id int, k int, j int, i int") if seeded else None).collect()
    got = {c: {} for c in want}
    for r in out:
        got[r.case_id][(r.i, r.j, r.k)] = r.label
    assert got == want and {29, 26} == set(got[0].values())
