"""Column functions and operators on small literal inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import coerce, grades, stats
from volcohort.operators import qc, voxel


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_coercion(spark):
    r = one(
        spark, a=coerce.optional_double(F.lit("NaN")), b=coerce.optional_double(F.lit(" 2.5")), c=coerce.optional_double(F.lit("")), d=coerce.optional_boolean(F.lit(" TRUE")),
        e=coerce.canonical_uid(F.lit("1.2.0007")), f=coerce.canonical_uid(F.lit("CTC-007")), g=coerce.safe_name(F.lit("00012")), h=coerce.safe_name(F.lit("7")), i=coerce.safe_name(F.lit("//")),
        j=coerce.years(F.lit("018M")), k=coerce.years(F.lit("x")), l=coerce.lookup(F.lit("HFP"), coerce.POSITIONS),
    )
    assert tuple(r) == (None, 2.5, None, True, "1.2.7", "CTC-007", "0012", "0007", "unknown", 1, None, "prone")


def test_ages(spark):
    rows = spark.createDataFrame([(17,), (18,), (79,), (95,), (None,)], "a int").select(*coerce.public_age(F.col("a"))).collect()
    assert [tuple(r) for r in rows] == [(None, None), (18, "10-19"), (79, "70-79"), (95, "80-89"), (None, None)]


def test_published_intervals(spark):
    lo, hi = stats.wilson(F.lit(615.0), F.lit(706.0))
    r = one(spark, lo=F.round(lo, 1), hi=F.round(hi, 1), p=F.round(stats.fisher(F.lit(1), F.lit(7), F.lit(6), F.lit(1)), 3), none=stats.wilson(F.lit(0.0), F.lit(0.0))[1])
    assert tuple(r) == (84.4, 89.4, 0.010, 0.0)


def test_grades(spark):
    df = spark.createDataFrame([("II", "III"), ("I", "I"), (None, "II"), (None, None), ("I", "II")], "a string, b string")
    assert [r[0] for r in df.select(grades.both_sides(F.col("a"), F.col("b"))).collect()] == ["IV", "Ib", "IIa", None, "atypical:I_left/II_right"]
    agree = spark.createDataFrame([("x", "x"), ("x", "y"), ("", "y"), (None, "y")], "a string, b string")
    assert [r[0] for r in agree.select(grades.three_valued_agreement(F.col("a"), F.col("b"))).collect()] == [True, False, None, None]


def test_merge_checks_keeps_cases_of_one_source(spark):
    mixing = spark.createDataFrame([("1", "fused", 1, 0.2)], "token string, config string, flag int, metric double")
    leak = spark.createDataFrame([("1", "fused", 0, 0.01), ("2", "spine_only", 1, 0.3)], mixing.schema)
    other = spark.createDataFrame([("3", "fused", 0, 0.0)], mixing.schema)
    rows = {r.token: r for r in qc.merge_checks(["token", "config"], {"mixing": mixing, "leak": leak, "structure": other}).collect()}
    assert len(rows) == 3 and rows["2"].n_flags == 1 and rows["2"].flag_mixing == 0 and rows["3"].needs_review == 0


def test_recalibrate(spark):
    base = spark.createDataFrame([(0.01 + i * 0.001,) for i in range(20)], "x double")
    got = qc.recalibrate(spark.createDataFrame([("hi", 0.06), ("lo", 0.015), ("none", None)], "k string, x double"), base, "x", 0.95)
    assert {r.k: r.flag for r in got.collect()} == {"hi": 1, "lo": 0, "none": 0}
    empty = qc.recalibrate(spark.createDataFrame([("a", 9.0)], "k string, x double"), base.limit(0), "x", 0.95)
    assert [r.flag for r in empty.collect()] == [0]


def test_empty_volumes_agree(spark):
    none = spark.createDataFrame([], "case_id int, k int, j int, i int, label int")
    assert voxel.dice_of_runs(voxel.runs(none), voxel.runs(none)).count() == 0
    some = spark.createDataFrame([(1, 0, 0, i, 5) for i in range(4)], none.schema)
    assert [r.dice for r in voxel.dice_of_runs(voxel.runs(some), voxel.runs(none)).collect()] == [0.0]


def test_components_join_diagonals(spark):
    cells = [(1, 0, 0, 0, 5), (1, 1, 1, 1, 5), (1, 5, 5, 5, 5), (1, 1, 1, 2, 6)]
    got = voxel.components(spark.createDataFrame(cells, "case_id int, k int, j int, i int, label int")).collect()
    assert len({tuple(r.component) for r in got if r.label == 5}) == 2
    faces = voxel.components(spark.createDataFrame(cells, "case_id int, k int, j int, i int, label int"), voxel.FACES).collect()
    assert len({tuple(r.component) for r in faces if r.label == 5}) == 3


def vec(*x):
    return F.array(*[F.lit(float(v)) for v in x])


def test_geometry(spark):
    from volcohort.functions import geometry as g

    up, front, back = vec(0, 0, 1), vec(0, 30, -20), vec(0, 0, 0)
    plate = g.midpoint(front, back)
    got = g.pelvic_angles(vec(0, 40, -70), plate, front, back, up)
    eye = F.array(*[F.lit(float(i % 5 == 0)) for i in range(16)])
    r = one(
        spark, d=g.distance(vec(0, 3, 0), vec(4, 0, 0)), a=F.round(g.angle(vec(1, 0, 0), vec(1, 1, 0)), 6), none=g.angle(vec(0, 0, 0), vec(1, 0, 0)), rej=g.rejection(vec(1, 2, 3), up),
        w=g.world(eye, F.lit(1), F.lit(2), F.lit(3)), ok=g.valid_affine(eye), bad=g.valid_affine(vec(1, 2)), s=g.valid_shape(F.array(F.lit(512), F.lit(512), F.lit(4))),
        same=g.same_grid(eye, eye, 0.5, 0.99), pi=F.round(got["incidence"], 4), pt=F.round(got["tilt"], 4), ss=F.round(got["slope"], 4),
    )
    assert (r.d, r.a, r.none, r.rej, r.w, r.ok, r.bad, r.s, r.same) == (5.0, 45.0, None, [1.0, 2.0, 0.0], [1.0, 2.0, 3.0], True, False, False, True)
    assert abs(r.pi - (r.pt + r.ss)) < 0.01 or abs(r.pi - abs(r.pt - r.ss)) < 0.01


def test_review(spark):
    from volcohort.functions import review

    r = one(
        spark, a=review.is_flag(F.lit("1.0")), b=review.is_flag(F.lit(None).cast("string")), c=review.provenance_after(F.lit("pseudo"), F.lit(True)), d=review.provenance_after(F.lit("manual"), F.lit(True)),
        e=review.qualifier(F.lit("x_semi_sacralized"), F.lit("supine")), f=review.qualifier(F.lit("semisomething"), F.lit("supine")), g=review.percent_difference(F.lit(3.0), F.lit(0.0)),
        h=review.verdict(F.lit(0.1), F.lit(0.9)), i=review.verdict(F.lit(0.5), F.lit(0.5)), j=review.verdict(F.lit(None).cast("double"), F.lit(0.5)),
    )
    assert tuple(r) == (True, False, "pseudo_corrected", "manual", "semi", "supine", None, "FLIPPED", "MIXED", "SKIP")


def test_groups_follow_the_running_mean(spark):
    from volcohort.operators import ribs

    zs = [100.0, 97.0, 93.0, 60.0, 59.0, 20.0]
    got = ribs.group_pieces(spark.createDataFrame([(1, "L", z) for z in zs] + [(2, "R", 5.0)], "case int, side string, z double"), 6.0).collect()
    assert [(r.n, round(r.z, 3)) for r in sorted(got, key=lambda r: (r.case, r.group))] == [(3, 96.667), (2, 59.5), (1, 20.0), (1, 5.0)]


def test_filling_leaves_open_bays(spark):
    from volcohort.operators import morphology

    ring = [(1, 0, j, i, 5) for j in range(5) for i in range(5) if j in (0, 4) or i in (0, 4)]
    df = spark.createDataFrame(ring, "case_id int, k int, j int, i int, label int")
    assert morphology.fill_slices(df).count() == 9
    assert morphology.fill_slices(df.where("not (j = 2 and i = 4)")).count() == 0


def test_strays(spark):
    from volcohort.operators import morphology

    cells = [(1, 0, 0, i, 5) for i in range(10)] + [(1, 0, 5, 0, 5)]
    parts = voxel.components(spark.createDataFrame(cells, "case_id int, k int, j int, i int, label int"))
    assert [r.voxels for r in morphology.stray_parts(parts, 2, 0.05).collect()] == [1]
    assert voxel.without_specks(parts, 2).count() == 10


def test_sphere_and_bright_parts(spark):
    import math

    from volcohort.operators import density

    ball = [(1, k, j, i, 7) for k in range(21) for j in range(21) for i in range(21) if abs(math.dist((k, j, i), (10, 9, 11)) - 8) <= 0.6]
    noise = [(1, 0, 0, i, 7) for i in range(12)]
    cells = spark.createDataFrame(ball + noise, "case_id int, k int, j int, i int, label int")
    r = density.fit_spheres(cells).first()
    assert abs(r.k - 10) < 0.1 and abs(r.j - 9) < 0.1 and abs(r.i - 11) < 0.1 and abs(r.radius - 8) < 0.2
    assert density.fit_spheres(cells.limit(5)).count() == 0
    bone = spark.createDataFrame([(1, 0, 0, 0, 20), (1, 0, 0, 9, 21)], cells.schema)
    hu = spark.createDataFrame([(1, 0, 0, i, 2500 if i in (1, 2, 30) else 0) for i in range(40)], "case_id int, k int, j int, i int, hu int")
    got = density.bright_objects(bone, hu, least=2).collect()
    assert [(x.voxels, x.touched) for x in got] == [(2, [20])]
