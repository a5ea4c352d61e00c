"""Plans that shuffle and compute less, with the same results on odd rows."""

from __future__ import annotations

import random

import pytest

from volcohort.operators import density, morphology, refine, voxel
from volcohort.operators.storage import staged
from volcohort.plans import compare as plans
from volcohort.plans import every

SF = "/root/testdata/sf0.001"
VOXELS = "case_id int, k int, j int, i int, label int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def holes(places, axis):
    """Background in the slices of a label's box that doesn't reach the box's rim, by flooding from the rim."""
    out, n = set(), "kji".index(axis)
    for s in {p[n] for p in places}:
        flat = {p[:n] + p[n + 1 :] for p in places if p[n] == s}
        (a0, a1), (b0, b1) = [(min(x) - 1, max(x) + 1) for x in zip(*flat, strict=True)]
        todo, seen = [(a0, b0)], {(a0, b0)}
        while todo:
            a, b = todo.pop()
            for q in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if a0 <= q[0] <= a1 and b0 <= q[1] <= b1 and q not in flat and q not in seen:
                    seen.add(q)
                    todo.append(q)
        shut = {(a, b) for a in range(a0, a1 + 1) for b in range(b0, b1 + 1)} - flat - seen
        out |= {(*p[:n], s, *p[n:]) for p in shut}
    return out


@pytest.mark.parametrize("axis", "kji")
def test_holes_by_flooding(spark, axis):
    """Also with a missing case, places that come twice, missing places, background rows and labels that share a place."""
    rng = random.Random(5)
    at = lambda share: {(k, j, i) for k in range(5) for j in range(7) for i in range(8) if rng.random() < share}
    volumes = {(c, n): at(share) for c, n, share in ((None, 5, 0.75), (1, 5, 0.8), (1, 6, 0.7), (2, 5, 0.6), (3, 5, 0.1))}
    rows = [(c, *p, n) for (c, n), v in volumes.items() for p in v]
    rows += rows[::3] + [(1, None, 1, 1, 5), (1, 1, None, 1, 5), (1, 1, 1, None, 5), (1, 2, 2, 2, 0), (1, 2, 2, 2, None)]
    got = [tuple(r) for r in morphology.fill_slices(spark.createDataFrame(rows, VOXELS), axis).collect()]
    assert len(got) == len(set(got)) > 50
    assert set(got) == {(c, *p, n) for (c, n), v in volumes.items() for p in holes(v, axis)}


def test_only_gaps_become_places(spark, monkeypatch):
    """Slices without a label, rims and bays aren't exploded, and volumes dealt by case aren't shuffled place by place."""
    made = []
    monkeypatch.setattr(morphology, "components", lambda df, reach: made.append(df) or voxel.components(df, reach))
    every.QUERIES["filled_holes"](spark, SF)
    found = plan(made[0])
    assert "Join" not in found and found.count("Exchange") == 2  # of suppliers and of gaps
    assert made[0].count() == 10 * 8 * 2


def test_layers_of_conflicts_are_worked_out_once(spark, monkeypatch):
    """Against plain loops, with cases of several weights, of none, and with missing labels and places."""
    rng = random.Random(8)
    at = [(c, k, j, i) for c in range(1, 7) for k in (0, 1, None) for j in range(4) for i in range(3)]
    volumes = [{p: rng.choice([0, 0, 5, 6, 7, None]) for p in at if rng.random() < 0.9} for _ in range(3)]
    hu = {p: rng.choice([50, 150, 250, None]) for p in at if rng.random() < 0.9}
    weights = [(1, 2.0, 1.0), (1, 2.0, 1.0), (2, 1.0, 2.0), (2, 1.0, 1.1), (2, None, 4.0), (3, 1.0, 1.0), (4, 0.0, 1.0), (None, 9.0, 1.0)]
    rows = lambda d, name: spark.createDataFrame([(*p, v) for p, v in d.items()], f"case_id int, k int, j int, i int, {name} int")
    layers = (*[rows(v, "label") for v in volumes], rows(hu, "hu"), spark.createDataFrame(weights, "case_id int, wa double, wb double"))
    written = []
    monkeypatch.setattr(plans, "_layers", lambda *_: layers)
    monkeypatch.setattr(plans, "staged", lambda df, tag: written.append(plan(df)) or staged(df, tag))
    got = {r[0]: tuple(r[1:]) for r in every.QUERIES["class_conflicts"](spark, SF).collect()}

    expected = {}
    for p in at:
        o, x, y = (v.get(p) or 0 for v in volumes)
        if (o, x, y) == (0, 0, 0):
            continue
        conflict = x != y and x != o and y != o
        dense = conflict and (x == 0) != (y == 0) and hu.get(p) is not None and not 100 <= hu[p] < 200
        own = [(1.0 if a is None else a, b) for c, a, b in weights if c == p[0]] or [(1.0, 1.0)]
        decided = [x != 0 and y != 0 and (a / b >= 1.5 or (a != 0 and a / b <= 1 / 1.5)) for a, b in own]
        n = [int(conflict), int(conflict and not dense), sum(conflict and not dense and not d for d in decided)]
        expected[p[0]] = [s + t for s, t in zip(expected.get(p[0], (0, 0, 0)), n, strict=True)]
    assert got == {c: (a, a - b, b - o, o) for c, (a, b, o) in expected.items()}
    assert len(written) == 1 and "SortAggregate" not in written[0]


def test_refined_reads_places_that_lie_by_case(spark, monkeypatch):
    """Places meet thresholds, bone and what was made by hand without a shuffle; only thresholds and their cases are dealt."""
    written = []
    monkeypatch.setattr(refine, "staged", lambda df, tag: written.append(plan(df)) or staged(df, tag))
    every.QUERIES["refined_resegment"](spark, SF)
    assert "Join" not in written[0] and "ENSURE_REQUIREMENTS" not in written[0] and "Broadcast" not in written[1]
    assert all("k#" not in x and "hu#" not in x for x in written[1].splitlines() if "ENSURE_REQUIREMENTS" in x)


def test_thresholds_count_rows_that_come_twice(spark):
    """A density counts once for each row of the mask at its place, and for each row of the density."""
    at = [(1, 0, 0, i) for i in range(5)]
    mask = spark.createDataFrame([(*p, 3) for p in at] + [(*at[0], 3)] * 3 + [(1, None, 0, 0, 3), (None, 0, 0, 0, 3)], VOXELS)
    hu = spark.createDataFrame([(*p, 10 * n) for n, p in enumerate(at)] + [(*at[4], 99), (1, None, 0, 0, 500), (None, 0, 0, 0, 7)], "case_id int, k int, j int, i int, hu int")
    got = density.calibrated(mask, hu, 0.5).collect()
    assert [tuple(r) for r in got] == [(1, 10.0)]  # of 0, 0, 0, 0, 10, 20, 30, 40, 99


def test_named_runs_become_places_again(spark):
    """Places that come twice give one row, missing ones none; nothing is joined by place."""
    rows = [(1, 0, 0, i, 5) for i in (0, 1, 2, 5)] * 2 + [(1, 0, 1, 2, 5), (1, None, 0, 1, 5), (1, 0, 0, None, 5), (None, 0, 0, 0, 5), (1, 3, 0, 0, 0)]
    got = voxel.components(spark.createDataFrame(rows, VOXELS)).collect()
    assert sorted((r.k, r.j, r.i, tuple(r.component)) for r in got) == [(0, 0, 0, (0, 0, 0)), (0, 0, 1, (0, 0, 0)), (0, 0, 2, (0, 0, 0)), (0, 0, 5, (0, 0, 5)), (0, 1, 2, (0, 0, 0))]
