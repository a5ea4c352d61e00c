"""What lets queries grow with the tables: how their work is dealt and how their joins are made."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from volcohort.functions import stats
from volcohort.operators import morphology, refine, voxel
from volcohort.operators.storage import staged
from volcohort.plans import catalogue, every

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bone_percent", "confusion", "bone_leak", "surface_voxels", "calibrated_threshold"])
def test_joins_of_volumes_shuffle(spark, name):
    assert "Broadcast" not in plan(every.QUERIES[name](spark, "/root/testdata/sf0.1"))


def test_places_are_dealt_by_case(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "PLACES", 2048)
    v = catalogue._voxels(spark, SF, 3, 8)
    assert v.rdd.getNumPartitions() == 10  # as many as suppliers, which are in one file
    dealt = v.select("case_id", F.spark_partition_id().alias("p")).distinct()
    assert dealt.count() == 10 and v.count() == 10 * 2048


def test_joins_of_staged_tables_shuffle(spark):
    a, b = (staged(spark.range(10), "small") for _ in range(2))
    assert "Broadcast" not in plan(a.join(b, "id")) and a.join(b, "id").count() == 10


def test_series_of_masks_shuffle(spark):
    assert "Broadcast" not in plan(every.QUERIES["best_series"](spark, SF)).split("SortMergeJoin", 1)[1]


def test_fisher_of_large_counts(spark):
    """Against log gamma in floating point, at counts whose log factorials are sums of many thousand terms."""
    rows = [(642, 6555, 700, 6490), (3, 0, 1, 40), (25, 31, 32, 33), (650, 6500, 650, 6500), (0, 0, 0, 5)]

    def p(a, b, c, d):
        logs = lambda n: math.lgamma(n + 1)
        at = lambda x: math.exp(logs(a + b) - logs(x) - logs(a + b - x) + logs(c + d) - logs(a + c - x) - logs(d - a + x) - logs(a + b + c + d) + logs(a + c) + logs(b + d))
        every_ = [at(x) for x in range(max(0, a - d), min(a + b, a + c) + 1)]
        return min(1.0, sum(x for x in every_ if x <= at(a) * (1 + 1e-7)))

    got = spark.createDataFrame(rows, "a long, b long, c long, d long").select(stats.fisher(*(F.col(x) for x in "abcd")).alias("p")).collect()
    assert [r["p"] for r in got] == pytest.approx([p(*r) for r in rows], rel=1e-9)


@pytest.mark.parametrize("name", ["surface_voxels", "hu_resolution", "dilated", "eroded_in_plane", "three_way_merge"])
def test_places_meet_by_aggregates(spark, name):
    """Volumes are dealt by case once; no join of places with places."""
    found = plan(every.QUERIES[name](spark, SF))
    assert "Join" not in found and "REPARTITION_BY_NUM" in found and "ENSURE_REQUIREMENTS" not in found


def test_surface_growth_and_wear_by_plain_loops(spark):
    rng = random.Random(3)
    v = {(k, j, i): rng.choice([0, 1, 1, 1, 2]) for k in range(5) for j in range(6) for i in range(7)}
    v = {p: n for p, n in v.items() if n}
    df = spark.createDataFrame([(9, *p, n) for p, n in v.items()], "case_id int, k int, j int, i int, label int")
    beside = lambda p, reach: [tuple(a + b for a, b in zip(p, d, strict=True)) for d in reach]
    at = lambda d: {(r.k, r.j, r.i): r.label for r in d.collect()}
    assert at(voxel.surface(df)) == {p: n for p, n in v.items() if any(v.get(q) != n for q in beside(p, voxel.FACES))}
    assert at(morphology.erode(df, 1, voxel.FACES)) == {p: n for p, n in v.items() if all(v.get(q) == n for q in beside(p, voxel.FACES))}
    grown = {}
    for p, n in v.items():
        for q in beside(p, voxel.FACES):
            grown[q] = min(n, grown.get(q, n))
    assert at(morphology.dilate(df)) == grown | v


def test_spikes_shuffle(spark):
    assert "Broadcast" not in plan(every.QUERIES["front_spikes"](spark, SF))


@pytest.mark.parametrize("name", ["filled_holes", "largest_component", "bright_objects", "sacral_openings", "resampled_labels"])
def test_joins_of_joins_shuffle(spark, name):
    """Joins lose the hint of their tables, and packed or exploded tables look small."""
    assert "Broadcast" not in plan(every.QUERIES[name](spark, SF))


def test_thresholds_of_bone_shuffle(spark, monkeypatch):
    written = []
    monkeypatch.setattr(refine, "staged", lambda df, tag: written.append(plan(df)) or staged(df, tag))
    every.QUERIES["refined_clip"](spark, SF)
    assert written and not any("Broadcast" in p for p in written)


def test_grids_are_dealt_before_their_places_are_made(spark):
    rows = [(1, k, j, i, 5) for k in range(2) for j in range(3) for i in range(3) if (j, i) != (1, 1)]
    made = []
    v = spark.createDataFrame(rows, "case_id int, k int, j int, i int, label int")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(morphology, "components", lambda df, reach: made.append(plan(df)) or voxel.components(df, reach))
        assert sorted(tuple(r) for r in morphology.fill_slices(v).collect()) == [(1, 0, 1, 1, 5), (1, 1, 1, 1, 5)]
    assert "REPARTITION_BY_NUM" in made[0].split("Generate explode", 1)[1]


def test_python_works_on_a_fixed_number_of_tasks(spark):
    found = plan(every.QUERIES["fitted_spheres"](spark, SF))
    assert "REPARTITION_BY_NUM" in found.split("FlatMapGroupsInPandas", 1)[1].split("HashAggregate", 1)[0]


@pytest.mark.parametrize("name", ["border_analysis", "pasted_crops", "classes_present", "disjoint_classes", "slice_changes"])
def test_crops_are_dealt_before_their_places_are_made(spark, name):
    """Lines are shuffled by case; the four places of each aren't, for the labels to meet."""
    below = plan(every.QUERIES[name](spark, SF)).split("Generate explode([0,1,2,3])")
    assert len(below) > 1 and all("REPARTITION_BY_NUM" in part for part in below[1:])
