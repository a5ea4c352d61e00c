"""What the findings of round 4 changed."""

from __future__ import annotations

import random

from volcohort.operators import density, gates, register, sacrum, voxel
from volcohort.plans import every
from volcohort.sources import volumes

VOXELS = "case_id int, k int, j int, i int, label int"
GRIDS = "case_id int, nk int, nj int, ni int, sk double, sj double, si double, up int"


def test_ribs_meet_the_spine_on_all_voxels(spark):
    """A rib on odd lines alone, and one whose nearest voxel lies between those of every second one."""
    spine = [(1, k, j, i, 19) for k in range(4, 8) for j in range(2, 6) for i in range(2, 5)]
    ribs = [(1, 5, 3, i, 35) for i in range(21, 25, 2)] + [(1, 6, 4, i, 36) for i in range(19, 26)]
    v, grid = spark.createDataFrame(spine + ribs, VOXELS), spark.createDataFrame([(1, 40, 20, 40, 1.0, 1.0, 1.0, 1)], GRIDS)
    got = {r["label"]: (r["fault"], r["value"]) for r in gates.rib_spine_gap(v, grid, detached=4.0, level=2, halo=1).collect()}
    assert got == {35: ("detached", 17.0), 36: ("detached", 15.0)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_errors_near_surfaces_meet_by_one_aggregate(spark):
    found = plan(every.QUERIES["boundary_errors"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in found and "ENSURE_REQUIREMENTS" not in found


def test_boundary_share_by_plain_loops(spark):
    rng = random.Random(5)
    t, p = ({(k, j, i) for k in range(5) for j in range(6) for i in range(6) if rng.random() < 0.8} for _ in range(2))
    beside = lambda a: [a, *(tuple(x + y for x, y in zip(a, d, strict=True)) for d in voxel.FACES)]
    near = {b for a in t for b in beside(a)} - {a for a in t if all(b in t for b in beside(a))}
    rows = lambda held: spark.createDataFrame([(1, *a, 21) for a in held] + [(1, 9, 9, 9, 20)], VOXELS)
    got = density.boundary_share(rows(t), rows(p), 21).first()
    assert (got["errors"], got["near"]) == (len(t ^ p), len((t ^ p) & near))


def test_masks_and_images_shuffle(spark):
    found = plan(every.QUERIES["spine_masks"](spark, "/root/testdata/sf0.001"))
    assert "Broadcast" not in found and "REPARTITION_BY_NUM" in found


def test_small_volume_files_share_tasks(spark, tmp_path):
    runs = spark.range(300).selectExpr("id case_id", "cast(id % 2 as int) k", "1 j", "1 i0", "3 i1", "cast(1 + id % 3 as int) label")
    grids = spark.range(301).selectExpr("id case_id", "4 ni", "3 nj", "2 nk", "1D si", "1D sj", "2D sk")
    path = f"file://{tmp_path}/v"
    assert volumes.write_volumes(runs, grids, path).count() == 301
    read = volumes.volumes(spark, path)
    assert read.rdd.getNumPartitions() < 150
    assert {tuple(r) for r in read.collect()} == {(str(n), n % 2, 1, 1, 3, 1 + n % 3) for n in range(300)}


def test_labels_on_wide_scans(spark):
    """Lines of more than one block of bits, a shift from one block into the next; cases share calls of Python."""
    bone = {(k, j, i) for k in range(1, 5) for j in range(2, 6) for i in range(60, 70)} | {(k, j, i) for k in (1, 2) for j in (6, 7, 8) for i in (60, 61, 62)}
    every_ = [(k, j, i) for k in range(8) for j in range(12) for i in range(80)]
    hu = spark.createDataFrame([(c, *p, 300 if p in bone else 0) for c in (1, 2) for p in every_], "case_id int, k int, j int, i int, hu int")
    moving = spark.createDataFrame([(c, k, j, i - 8 * c, 7) for c in (1, 2) for k, j, i in bone], VOXELS)
    flat = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    grids = spark.createDataFrame([(c, flat, 80, 12, 8) for c in (1, 2)], "case_id int, affine array<double>, ni int, nj int, nk int")
    voxels, found = register.laid(moving, grids, hu, grids, least=20, stride=2)
    assert {tuple(r) for r in found.collect()} == {(c, 0, 8 * c, 0, 0, len(bone), 100.0) for c in (1, 2)}
    assert {tuple(r) for r in voxels.select("case_id", "k", "j", "i").collect()} == {(c, *p) for c in (1, 2) for p in bone}


def test_shifts_of_many_cases_take_few_calls(spark):
    places = spark.range(400).selectExpr("cast(id as int) case_id", "0 k", "cast(id % 2 as int) j", "1 i")
    sizes = spark.range(400).selectExpr("cast(id as int) case_id", "4 ni", "3 nj", "2 nk")
    moving = spark.range(400).selectExpr("cast(id as int) case_id", "0 flip", "0 k", "0 j", "0 i")
    got = register.shifts(places, moving, sizes)
    assert "_call" in plan(got).split("FlatMapCoGroupsInPandas", 1)[1].split("\n", 1)[0]
    assert {tuple(r) for r in got.collect()} == {(n, 0, 1, n % 2, 0) for n in range(400)}


def openings_by_plain_loops(bone, slab, step, least_view, cell):
    """(left, right, offset in slices) of the best slab; half widths of 1."""
    js, mid = sorted({j for _, j, _ in bone}), sum(i for *_, i in bone) / len(bone)
    around = lambda p: [(p[0] + a, p[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    faces = lambda p: [(p[0] + a, p[1] + b) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    best = (0, 0, None)
    for y in range(js[0], max(js[0], js[-1] - slab) + 1, step):
        seen = {(k, i) for k, j, i in bone if y <= j < y + slab}
        if len(seen) < least_view:
            continue
        grown = {q for p in seen for q in around(p)}
        closed = {p for p in grown if all(q in grown for q in around(p))}
        ends = [(min(p[n] for p in closed) - 1, max(p[n] for p in closed) + 1) for n in (0, 1)]
        grid = {(k, i) for k in range(ends[0][0], ends[0][1] + 1) for i in range(ends[1][0], ends[1][1] + 1)}

        def part(start, held, faces=faces):
            got, todo = {start}, [start]
            while todo:
                for q in faces(todo.pop()):
                    if q in held and q not in got:
                        got.add(q)
                        todo.append(q)
            return got

        left = grid - part((ends[0][0], ends[1][0]), grid - closed) - seen
        sides = [0, 0]
        while left:
            p = part(next(iter(left)), left)
            left = left - p
            if 8 <= len(p) * cell <= 700:
                sides[sum(i for _, i in p) / len(p) > mid] += 1
        if sum(sides) > sum(best[:2]) or best[2] is None:
            best = (*sides, y - js[0])
    return best


def test_openings_by_plain_loops(spark):
    """Bone over more than one block of bits along j, at places below zero too; slabs of four slices, one apart."""
    rng, rows, want = random.Random(7), [], {}
    for c, (j0, i0) in enumerate([(60, -5), (-3, 0), (126, 40), (5, 7)]):
        holes = [(rng.randrange(3, 14), rng.randrange(3, 22), rng.randrange(1, 4), rng.randrange(8)) for _ in range(9)]
        bone = [(k, j0 + j, i0 + i) for k in range(18) for j in range(9) for i in range(26) if not any(abs(k - a) < s and abs(i - b) < s and abs(j - d) < 6 for a, b, s, d in holes) and rng.random() < 0.9]
        rows += [(c, *p, 26) for p in bone]
        want[c] = openings_by_plain_loops(bone, 4, 1, 50, 4.0)
    v = spark.createDataFrame(rows, VOXELS)
    grids = spark.createDataFrame([(c, 2.0, 2.0, 2.0) for c in want], "case_id int, si double, sj double, sk double")
    got = sacrum.openings(v, grids, least=100, view=50)
    assert "_call" in plan(got).split("FlatMapCoGroupsInPandas", 1)[1].split("\n", 1)[0]
    assert {r["case_id"]: (r["left"], r["right"], r["offset"] / 2) for r in got.collect()} == want
    assert sum(sum(w[:2]) for w in want.values()) > 4


def test_leaks_hold_no_more_than_a_portion_of_items(spark, monkeypatch):
    """Items in several portions give the same leaks, each portion is sent on its own, and windows are written without their shingles."""
    from volcohort.llm import decontaminate

    rng = random.Random(4)
    items = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(40)) for _ in range(12)) for _ in range(20)]
    docs = spark.createDataFrame([(n, f"x{n} y z {items[n % 20]} w {items[(n * 7) % 20]} q") for n in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = {tuple(r) for r in decontaminate.leaks(docs, bench).collect()}
    written, stage = {}, decontaminate.stage
    monkeypatch.setattr(decontaminate, "stage", lambda df, tag: written.setdefault(tag, df.columns) and stage(df, tag))
    monkeypatch.setattr(decontaminate, "PORTION", 40)
    parts = decontaminate.leaks(docs, bench)
    assert {tuple(r) for r in parts.collect()} == whole and len(whole) > 60
    assert plan(parts).count("BroadcastHashJoin") >= 8 and "SortMergeJoin" not in plan(parts)
    assert "shingles" not in written["windows"]
