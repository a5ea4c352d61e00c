"""Exact distances to the nearest voxel, one axis after the other.

The squared distance to the nearest source is a minimum over lines along i, then j, then k. Along i it is that to the next source on
either side; along the others it is the lower envelope of parabolas, one for each place with a value. Spark deals slices: a few
neighbouring ones of k for the first two axes, of j for the third, so that a task holds slices and never a volume, and no pair of
voxels is made."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.operators.storage import dealt, staged
from volcohort.operators.voxel import surface

#: Neighbouring slices that a task works on in one call.
SLICES = 16
#: Values that are compared with all others rather than by their envelope.
FEW = 1 << 18


def _along(marked: np.ndarray, step: float) -> np.ndarray:
    """Squared distance along the last axis to the nearest marked place; infinite in lines without any."""
    at = np.arange(marked.shape[-1], dtype=float)
    left = np.maximum.accumulate(np.where(marked, at, -np.inf), axis=-1)
    right = np.minimum.accumulate(np.where(marked, at, np.inf)[..., ::-1], axis=-1)[..., ::-1]
    return (np.minimum(at - left, right - at) * step) ** 2


def envelope(f: np.ndarray, at: np.ndarray, to: np.ndarray, step: float) -> np.ndarray:
    """min over r of f[r] + ((to - at[r]) * step) ** 2 for each column of f, which is finite; at and to ascend."""
    n, m = f.shape
    x, every = at * step, np.arange(m)
    rows, cut, top = np.zeros((n, m), np.int64), np.full((n + 1, m), np.inf), np.zeros(m, np.int64)
    cut[0] = -np.inf  # parabola rows[t] is the lowest from cut[t] up to cut[t + 1]
    for r in range(1, n):
        live = every
        while len(live):
            last = rows[top[live], live]
            meet = (f[r, live] + x[r] ** 2 - f[last, live] - x[last] ** 2) / (2 * (x[r] - x[last]))
            hidden = meet <= cut[top[live], live]
            shown = live[~hidden]
            top[shown] += 1
            rows[top[shown], shown], cut[top[shown], shown], cut[top[shown] + 1, shown] = r, meet[~hidden], np.inf
            live = live[hidden]
            top[live] -= 1
    out, t = np.empty((len(to), m)), np.zeros(m, np.int64)
    for p, y in enumerate(to * step):
        while (over := cut[t + 1, every] < y).any():
            t += over
        r = rows[t, every]
        out[p] = f[r, every] + (y - x[r]) ** 2
    return out


def lowest(f: np.ndarray, at: np.ndarray, to: np.ndarray, step: float) -> np.ndarray:
    """`envelope` of each f[n]; rows of f[n] may be infinite as a whole, but not all. Few values are compared with all others."""
    if f.size * len(to) <= FEW:
        return (f[:, :, None, :] + (((to - at[:, None]) * step) ** 2)[:, :, None]).min(axis=1)
    held = np.isfinite(f).all(axis=2)
    return np.stack([envelope(x[h], at[h], to, step) for x, h in zip(f, held, strict=True)])


def nearest(targets: DataFrame, sources: DataFrame, grids: DataFrame, keys: list[str]) -> DataFrame:
    """`targets` (keys, k, j, i, ...) with `distance`, that to the nearest of the `sources` (keys, k, j, i) with the same keys; NULL
    without any. grids: (case_id, sk, sj, si), the spacing along each axis; a case that isn't there has 1."""
    schema = ", ".join(f"{c} {targets.schema[c].dataType.simpleString()}" for c in keys)
    box = targets.groupBy(*keys).agg(*[f(c).cast("int").alias(f"{c}{e}") for c in "ji" for f, e in ((F.min, 0), (F.max, 1))])
    step = grids.select("case_id", *[F.col(f"s{c}").cast("double").alias(f"s{c}") for c in "kji"])
    wide = sources.select(*keys, "k", "j", "i").hint("merge").join(box.hint("merge"), keys).join(step.hint("merge"), "case_id", "left").fillna(1.0, ["sk", "sj", "si"])
    more = keys[1:]
    of = lambda d: d.groupby(more).indices if more else {0: np.arange(len(d))} if len(d) else {}

    def slabs(d: pd.DataFrame) -> pd.DataFrame:
        col = {c: d[c].to_numpy() for c in ("k", "j", "i", *(f"{c}{e}" for c in "ji" for e in "01"), "sk", "sj", "si")}
        at, out = [], {"k": [], "j": [], "far": []}
        for rows in of(d).values():
            k, j, i = (col[c][rows] for c in "kji")
            j0, j1, i0, i1 = (int(col[c][rows[0]]) for c in ("j0", "j1", "i0", "i1"))
            ks, js, lo, to = np.unique(k), np.unique(j), min(i.min(), i0), np.arange(j0, j1 + 1)
            marked = np.zeros((len(ks), len(js), max(i.max(), i1) - lo + 1), bool)
            marked[np.searchsorted(ks, k), np.searchsorted(js, j), i - lo] = True
            far = lowest(_along(marked, col["si"][rows[0]])[:, :, i0 - lo : i1 - lo + 1], js, to, col["sj"][rows[0]])
            at.append(np.full(len(ks) * len(to), rows[0]))
            out["k"].append(np.repeat(ks, len(to)))
            out["j"].append(np.tile(to, len(ks)))
            out["far"] += list(far.reshape(len(ks) * len(to), -1))
        at = np.concatenate(at)
        return pd.DataFrame({**{c: d[c].to_numpy()[at] for c in keys}, "k": np.concatenate(out["k"]), "j": np.concatenate(out["j"]), "i0": col["i0"][at], "sk": col["sk"][at], "far": out["far"]})

    # The slices of all the keys of a case go to one call: calls of few voxels cost more than the work.
    near = lambda c: F.floor(F.col(c) / SLICES).alias("_s")
    lines = dealt(wide.select("*", near("k")), "case_id", "_s").groupBy("case_id", "_s").applyInPandas(slabs, f"{schema}, k int, j int, i0 int, sk double, far array<double>")
    put = [f.name for f in targets.schema.fields]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.schema.fields), "distance double"])

    def columns(t: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        t, found, distance = t[put], of(s), np.full(len(t), np.nan)
        held = {c: s[c].to_numpy() for c in ("k", "j", "i0", "sk", "far")}
        k, j, i = (t[c].to_numpy() for c in "kji")
        for n, rows in of(t).items():
            if (lines := found.get(n)) is not None:  # then every j of the targets has lines
                ks, js, to = np.unique(held["k"][lines]), np.unique(held["j"][lines]), np.unique(k[rows])
                f = np.full((len(js), len(ks), len(held["far"][lines[0]])), np.inf)
                f[np.searchsorted(js, held["j"][lines]), np.searchsorted(ks, held["k"][lines])] = np.stack(held["far"][lines])
                far = lowest(f, ks, to, held["sk"][lines[0]])
                distance[rows] = np.sqrt(far[np.searchsorted(js, j[rows]), np.searchsorted(to, k[rows]), i[rows] - held["i0"][lines[0]]])
        return t.assign(distance=distance)

    both = [dealt(d.select("*", near("j")), "case_id", "_s").groupBy("case_id", "_s") for d in (targets, lines)]
    return both[0].cogroup(both[1]).applyInPandas(columns, out)


def surface_distances(a: DataFrame, b: DataFrame, grids: DataFrame) -> DataFrame:
    """(case_id, label, assd, hd95): distances between the surfaces of both volumes, each voxel to the nearest of the other. Labels
    that one side lacks are left out."""
    p, q = (staged(surface(v), "surface") for v in (a, b))  # read several times each
    keys = ["case_id", "label"]
    both = nearest(p, q, grids, keys).unionByName(nearest(q, p, grids, keys)).where("distance is not null")
    return both.groupBy(*keys).agg(F.round(F.avg("distance"), 6).alias("assd"), F.round(F.percentile("distance", F.lit(0.95)), 6).alias("hd95"))
