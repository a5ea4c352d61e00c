"""Refinement and resampling against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest

from volcohort.operators import refine, resample, voxel

VOXELS = "case_id int, k int, j int, i int, label int"
GRIDS = "case_id int, affine array<double>, ni int, nj int, nk int"
STEPS = [np.array(d) for d in voxel.FACES]


def rows(spark, arrays, name="label"):
    cells = [(c, *map(int, p), int(a[tuple(p)])) for c, a in arrays.items() for p in np.argwhere(np.ones(a.shape, bool))]
    return spark.createDataFrame(cells, VOXELS.replace("label", name)).repartition(3)


def flood(start, inside):
    """Places of `inside` that hang together by faces with those of `start`."""
    seen, todo = set(start), list(start)
    while todo:
        p = todo.pop()
        for d in STEPS:
            q = tuple(int(x) for x in np.array(p) + d)
            if q in inside and q not in seen:
                seen.add(q)
                todo.append(q)
    return seen


def filled(mask):
    """Holes of slices along k, j, i, one axis after the other."""
    out = mask.copy()
    for axis in range(3):
        for n in range(out.shape[axis]):
            cut = np.take(out, n, axis=axis)
            free = {(0, *p) for p in map(tuple, np.argwhere(~np.pad(cut, 1)).tolist())}
            outer = flood([(0, 0, 0)], free)
            hole = np.zeros(cut.shape, bool)
            for _, a, b in free - outer:
                hole[a - 1, b - 1] = True
            index = [slice(None)] * 3
            index[axis] = n
            out[tuple(index)] |= hole
    return out


def grown(mask, within, steps):
    cells, allowed = set(map(tuple, np.argwhere(mask).tolist())), set(map(tuple, np.argwhere(within).tolist()))
    for _ in range(steps):
        cells |= {tuple(int(x) for x in np.array(p) + d) for p in cells for d in STEPS} & allowed
    out = np.zeros(mask.shape, bool)
    for p in cells:
        out[p] = True
    return out


def parts(mask):
    left = set(map(tuple, np.argwhere(mask).tolist()))
    while left:
        part = flood([min(left)], left)
        left -= part
        yield part


def wanted(v1, v2, hu, mode, fill, grow, purity, bleed, floor):
    hand = (v1 >= 1) & (v1 <= 9)
    pred = np.where(~hand & (v2 >= 1) & (v2 <= 9), v2, 0)
    if not pred.any() or not hand.any():
        return v2, None, []
    inner = hand.copy()
    for p in map(tuple, np.argwhere(hand).tolist()):
        near = [tuple(np.array(p) + d) for d in STEPS]
        inner[p] = all(all(0 <= x < n for x, n in zip(q, hand.shape, strict=True)) and hand[q] for q in near)
    thr = max(float(np.percentile(hu[inner if inner.any() else hand], 10)), floor)
    bone = (hu >= thr) & ~hand
    out, flags = v2.copy(), []
    out[pred > 0] = 0
    spots = np.argwhere(pred > 0)

    def nearest(mask):
        for p in np.argwhere(mask):
            d = np.round(np.sqrt(((spots - p) ** 2).sum(1)), 9)
            out[tuple(p)] = min((x, pred[tuple(q)]) for x, q in zip(d, spots, strict=True))[1]

    if mode == "clip" and not grow:
        for c in np.unique(pred[pred > 0]):
            seg = (pred == c) & bone
            out[filled(seg) & (pred == c) if fill else seg] = c
    elif mode == "clip":
        every = np.zeros(bone.shape, bool)
        for c in np.unique(pred[pred > 0]):
            g = grown((pred == c) & bone, bone, grow)
            every |= filled(g) & ~hand if fill else g
        nearest(every)
    elif mode == "resegment":
        kept = np.zeros(bone.shape, bool)
        for part in parts(bone):
            if any(pred[p] for p in part):
                for p in part:
                    kept[p] = True
        nearest(filled(kept) & ~hand if fill else kept)
    else:
        new = np.zeros(bone.shape, int)
        for part in parts(bone):
            got = [int(pred[p]) for p in part if pred[p]]
            if not got:
                continue
            best = max(set(got), key=lambda c: (got.count(c), -c))
            minor = len(got) - got.count(best)
            m = np.zeros(bone.shape, bool)
            for p in part:
                m[p] = True
            if minor <= purity * len(got) or minor <= bleed:
                new[grown(m & (pred > 0), m, grow)] = best
            else:
                new[m & (pred > 0)] = pred[m & (pred > 0)]
                flags.append((best, len(got), round(minor / len(got), 3)))
        for c in np.unique(new[new > 0]) if fill else []:
            new[filled(new == c) & (new == 0)] = c
        out[new > 0] = new[new > 0]
    return out, thr, flags


@pytest.mark.parametrize("mode,fill,grow", [("clip", True, 0), ("clip", True, 2), ("resegment", True, 0), ("compete", True, 1), ("compete", False, 0)])
def test_refined(spark, mode, fill, grow):
    rng = np.random.default_rng(7)
    v1, v2, hu = {}, {}, {}
    for c in range(4):
        shape = (5, 8, 9)
        hu[c] = rng.integers(0, 100, shape)
        hu[c][1:4, 1:7, 1:8] += 60
        hu[c][2, 3:5, 3:5] = 0
        hu[c][:, :, 5] -= 70
        v1[c] = np.zeros(shape, int)
        if c:
            v1[c][0:3, 0:3, 0:3] = 3
        v2[c] = np.where(rng.random(shape) < 0.5, rng.integers(6, 9, (1, 1, 1)), np.where(rng.random(shape) < 0.1, 5, 0))
        v2[c][:, :, 5:] = np.where(v2[c][:, :, 5:] > 0, 4, 0)
        v2[c] = np.where(v1[c] > 0, v1[c], v2[c] if c != 3 else 12)
    kw = {"mode": mode, "fill": fill, "grow": grow, "purity": 0.2, "bleed": 2, "floor": 50.0}
    out, thr, flags = refine.refined(rows(spark, v1), rows(spark, v2), rows(spark, hu, "hu"), **kw)
    got = {c: np.zeros(v2[c].shape, int) for c in v2}
    for r in out.collect():
        assert not got[r.case_id][r.k, r.j, r.i]
        got[r.case_id][r.k, r.j, r.i] = r.label
    want = {c: wanted(v1[c], v2[c], hu[c], mode, fill, grow, 0.2, 2, 50.0) for c in v2}
    for c in v2:
        assert (got[c] == want[c][0]).all(), c
    assert {r.case_id: r.threshold for r in thr.collect()} == {c: w[1] for c, w in want.items() if w[1] is not None}
    if mode == "compete":
        assert sorted((r.case_id, r.dominant, r.voxels, r.minority) for r in flags.collect()) == sorted((c, *f) for c, w in want.items() for f in w[2])


def affine(rng, turned):
    m = np.diag(rng.uniform(0.7, 2.2, 3) * rng.choice([-1, 1], 3))
    if turned:
        a, b = rng.uniform(-0.5, 0.5, 2)
        m = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]]) @ np.array([[1, 0, 0], [0, np.cos(b), -np.sin(b)], [0, np.sin(b), np.cos(b)]]) @ m
    out = np.eye(4)
    out[:3, :3], out[:3, 3] = m, rng.uniform(-6, 6, 3)
    return out


@pytest.mark.parametrize("turned", [True, False])
def test_resampled(spark, turned):
    rng = np.random.default_rng(8 + turned)
    volumes, source, target, want = {}, [], [], set()
    for c in range(4):
        a = volumes[c] = rng.integers(0, 3, (5, 6, 7))  # k, j, i
        s, t, n = affine(rng, turned), affine(rng, turned), rng.integers(4, 12, 3)
        t[:3, 3] = (s @ [3, 2, 2, 1] - np.append(t[:3, :3] @ (n // 2), 0))[:3]
        source.append((c, s.ravel().tolist(), 7, 6, 5))
        target.append((c, t.ravel().tolist(), *map(int, n)))
        for p in np.ndindex(*n):
            i, j, k = (int(x) for x in np.floor((np.linalg.inv(s) @ t @ [*p, 1])[:3] + 0.5))
            if 0 <= i < 7 and 0 <= j < 6 and 0 <= k < 5 and a[k, j, i]:
                want.add((c, *p[::-1], int(a[k, j, i])))
    v, grids = rows(spark, volumes), [spark.createDataFrame(x, GRIDS) for x in (source, target)]
    assert len(want) > 100 and {tuple(r) for r in resample.resampled(v, *grids).collect()} == want
    if not turned:
        got = {(r.case_id, r.k, r.j, i, r.label) for r in resample.resampled_runs(voxel.runs(v), *grids).collect() for i in range(r.i0, r.i1 + 1)}
        assert got == want
    assert {tuple(r) for r in resample.resampled_and_remapped(v, *grids, {2: 9}).collect()} == {(*w[:4], 9) for w in want if w[4] == 2}


def test_mirrored_and_reoriented(spark):
    a = np.arange(1, 61).reshape(3, 4, 5)
    m = np.array([[0, 0, 2.0, 5], [-1.5, 0, 0.1, 7], [0, 1, 0, -3], [0, 0, 0, 1]])  # i runs to P, j to S, k to R
    grids = spark.createDataFrame([(1, m.ravel().tolist(), 5, 4, 3)], GRIDS)
    v = rows(spark, {1: a})
    out, g = resample.reoriented(v, grids, "PIR")
    b = np.array(g.first().affine).reshape(4, 4)
    assert (g.first().ni, g.first().nj, g.first().nk) == (5, 4, 3) and [np.argmax(np.abs(b[:3, c])) for c in range(3)] == [1, 2, 0] and b[1, 0] < 0 and b[2, 1] < 0 < b[0, 2]
    where = lambda d, f: {r.label: tuple(np.round(f @ [r.i, r.j, r.k, 1], 6)[:3]) for r in d.collect()}
    assert where(out, b) == where(v, m)
    plain = spark.createDataFrame([(1, np.diag([1.0, 1.0, 1.0, 1.0]).ravel().tolist(), 5, 4, 3)], GRIDS)
    got = {(r.k, r.j, r.i): r.label for r in resample.mirrored(v, plain.selectExpr("*", "1.0D y"), 1, resample.F.col("y")).collect()}
    assert got == {(k, j, i): int(a[k, 2 - j, i]) for k in range(3) for j in range(3) for i in range(5)}
