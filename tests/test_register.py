"""Labels laid onto scans against plain loops."""

from __future__ import annotations

import numpy as np

from volcohort.operators import register


def test_shifts(spark):
    rng = np.random.default_rng(1)
    shape, a, b, want = (6, 5, 4), {}, {}, set()
    for c in (1, 2):
        a[c] = rng.random(shape) < 0.3
        for flip in (0, 3):
            b[c, flip] = rng.random(shape) < 0.3
            met = {d: int((a[c] & np.roll(b[c, flip], d, (0, 1, 2))).sum()) for d in np.ndindex(*shape)}
            best = min(met, key=lambda d: (-met[d], d))
            want.add((c, flip, *[d - n if d > n // 2 else d for d, n in zip(best, shape, strict=True)]))
    rows = lambda held: [(*(k if isinstance(k, tuple) else (k,)), *map(int, p[::-1])) for k, m in held.items() for p in np.argwhere(m)]
    fixed = spark.createDataFrame(rows(a), "case_id int, k int, j int, i int")
    moving = spark.createDataFrame(rows(b), "case_id int, flip int, k int, j int, i int")
    sizes = spark.createDataFrame([(c, *shape) for c in (1, 2)], "case_id int, ni int, nj int, nk int")
    assert {tuple(r) for r in register.shifts(fixed, moving, sizes).collect()} == want


def test_laid(spark):
    """A label mirrored along two axes and moved comes back onto its bone; one that lies nowhere is left out."""
    rng = np.random.default_rng(2)
    bone = np.zeros((20, 16, 16), bool)
    for _ in range(6):
        p = rng.integers(3, 10, 3)
        bone[p[0] : p[0] + 6, p[1] : p[1] + 4, p[2] : p[2] + 4] = True
    label = np.roll(bone[::-1, :, ::-1], (2, 0, -2), (0, 1, 2))
    cells = lambda c, m, name: [(c, *map(int, p[::-1]), 300 if name == "hu" else 7) for p in np.argwhere(m)]
    hu = spark.createDataFrame(cells(1, bone, "hu") + [(c, *map(int, p[::-1]), 0) for c in (1, 2) for p in np.argwhere(~bone)], "case_id int, k int, j int, i int, hu int")
    moving = spark.createDataFrame(cells(1, label, "l") + cells(2, label, "l"), "case_id int, k int, j int, i int, label int")
    grid = np.eye(4).ravel().tolist()
    grids = spark.createDataFrame([(c, grid, 20, 16, 16) for c in (1, 2)], "case_id int, affine array<double>, ni int, nj int, nk int")
    voxels, found = register.laid(moving, grids, hu, grids, least=50, stride=2)
    r = found.first()
    assert found.count() == 1 and (r.case_id, r.flip, r.percent, r.voxels) == (1, 5, 100.0, int(bone.sum()))
    assert {(v.i, v.j, v.k) for v in voxels.collect() if v.case_id == 1} == set(map(tuple, np.argwhere(bone).tolist()))
