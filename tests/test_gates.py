"""Exact distances against all pairs, and the checks of labels on phantoms of full size thresholds."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from volcohort.operators import distance, gates, voxel

VOXELS = "case_id int, k int, j int, i int, label int"
GRIDS = "case_id int, nk int, nj int, ni int, sk double, sj double, si double, up int"


def box(case, label, k, j, i):
    return [(case, a, b, c, label) for a in range(*k) for b in range(*j) for c in range(*i)]


def test_envelope():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, m = rng.integers(1, 9), rng.integers(1, 6)
        at, to = (np.sort(rng.choice(30, x, replace=False)) for x in (n, rng.integers(1, 20)))
        f, step = rng.integers(0, 50, (n, m)).astype(float), rng.choice([0.5, 1, 2.7])
        assert np.allclose(distance.envelope(f, at, to - 5, step), (f[None] + ((to[:, None] - 5 - at) * step)[:, :, None] ** 2).min(1))


def test_nearest(spark):
    """Anisotropic spacing; a case without sources has no distance, one without a grid has a spacing of 1."""
    rng = random.Random(2)
    points = lambda n: sorted({(c, rng.randrange(9), rng.randrange(7), rng.randrange(11)) for c in (1, 2, 3) for _ in range(n)})
    t, s = points(60), [p for p in points(6) if p[0] != 3]
    steps = {1: (2.5, 0.7, 1.1), 2: (1.0, 1.0, 1.0)}
    grids = spark.createDataFrame([(1, *steps[1])], "case_id int, sk double, sj double, si double")
    df = spark.createDataFrame([(*p, n) for n, p in enumerate(t)], "case_id int, k int, j int, i int, label int")
    got = {(r.case_id, r.k, r.j, r.i): (r.label, r.distance) for r in distance.nearest(df, spark.createDataFrame(s, "case_id int, k int, j int, i int"), grids, ["case_id"]).collect()}
    assert len(got) == len(t)
    for n, p in enumerate(t):
        near = [sum(((a - b) * w) ** 2 for a, b, w in zip(p[1:], q[1:], steps[p[0]], strict=True)) ** 0.5 for q in s if q[0] == p[0]]
        assert got[p][0] == n and (got[p][1] is None if not near else abs(got[p][1] - min(near)) < 1e-9)


@pytest.mark.parametrize("reach", [voxel.ALL_26, voxel.FACES, [t for t in voxel.FACES if t[2] == 0]])
def test_components(spark, reach):
    rng = random.Random(3)
    cells = {(c, rng.randrange(6), rng.randrange(6), rng.randrange(8)): rng.randint(1, 2) for c in (1, 2) for _ in range(150)}
    got = {(r.case_id, r.k, r.j, r.i): tuple(r.component) for r in voxel.components(spark.createDataFrame([(*p, v) for p, v in cells.items()], VOXELS), reach).collect()}
    left, want = set(cells), {}
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            p = todo.pop()
            part.add(p)
            for d in reach:
                q = (p[0], *[a + b for a, b in zip(p[1:], d, strict=True)])
                if q in left and cells[q] == cells[p]:
                    left.remove(q)
                    todo.append(q)
        want |= dict.fromkeys(part, min(part)[1:])
    assert got == want


def test_gate_of_full_volumes(spark):
    """Case 1 is clean; 2 has a hip in two halves and a vertebra of two bodies; 3 the same at the edge of the scan."""
    clean = lambda c: box(c, 24, (6, 26), (0, 24), (0, 24)) + box(c, 23, (27, 47), (0, 24), (0, 24))
    split = lambda c, k: box(c, 31, (k, k + 16), (30, 40), (0, 20)) + box(c, 31, (k, k + 16), (30, 40), (30, 50))
    double = lambda c, k: box(c, 22, (k, k + 26), (0, 30), (0, 30)) + box(c, 22, (k + 26, k + 28), (11, 13), (11, 13)) + box(c, 22, (k + 28, k + 54), (0, 30), (0, 30))
    rows = clean(1) + clean(2) + split(2, 10) + double(2, 48) + clean(3) + split(3, 0) + double(3, 48)
    v = spark.createDataFrame(rows, VOXELS).repartition(4)
    grids = spark.createDataFrame([(1, 60, 60, 60, 1.0, 1.0, 1.0, 1), (2, 120, 60, 60, 1.0, 1.0, 1.0, 1), (3, 103, 60, 60, 1.0, 1.0, 1.0, 1)], GRIDS)
    found = gates.faults("class_mixing", v, grids, v).cache()
    assert {(r.case_id, r.label, r.fault, r.blocks) for r in found.collect()} == {(2, 31, "split", True), (2, 22, "two bodies", True), (3, 31, "split", False)}
    got = {r.case_id: (r.ok, r.messages) for r in gates.verdicts(v, found).collect()}
    assert [got[c][0] for c in (1, 2, 3)] == [True, False, True] and got[1][1] == []
    assert got[2][1] == ["X class_mixing: two bodies 22 (1.00)", "X class_mixing: split 31 (0.50)"] and got[3][1] == ["note class_mixing: split 31 (0.50)"]
    thinned = {(r.case_id, r.label, r.fault, r.blocks) for r in gates.faults("class_mixing", v, grids, v, stride=2).collect()}
    assert thinned == {(2, 31, "split", True), (2, 22, "two bodies", True), (3, 31, "split", False)}


def test_gate_of_ribs(spark):
    """Rib 5 is detached from T5, rib 6 is what is left of an old number on rib 7, which is joined with rib 8 in one bone."""
    spine = box(1, 12, (20, 36), (0, 10), (0, 10))
    ribs = box(1, 38, (28, 32), (0, 16), (40, 50)) + box(1, 40, (10, 30), (20, 34), (0, 10)) + box(1, 41, (10, 30), (20, 34), (10, 20)) + box(1, 39, (24, 26), (34, 36), (2, 4))
    v = spark.createDataFrame(spine + ribs, VOXELS)
    grids = spark.createDataFrame([(1, 80, 60, 60, 1.0, 1.0, 1.0, 1)], GRIDS)
    got = {(r.check, r.label, r.fault, r.blocks) for r in gates.faults("ribs", v, grids, v.withColumn("label", F.when(F.col("label") == 12, 13).otherwise(F.col("label")))).collect()}
    blocks = {x[:3] for x in got if x[3]}
    assert ("rib gap", 38, "detached") not in blocks  # 640 voxels: cut off at j = 0
    assert {("rib labels", 40, "mixed"), ("rib labels", 41, "mixed")} <= blocks and ("spine", 0, "spine altered") not in blocks
    assert {r.label for r in gates.halo_specks(v).collect()} == {39}


def test_empty_volumes(spark):
    none, grids = spark.createDataFrame([], VOXELS), spark.createDataFrame([], GRIDS)
    for check in ("class_mixing", "spine_extend", "both"):
        assert gates.faults(check, none, grids, none).count() == 0
