"""Names, geometry, classes and panels by values worked out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions.stats import middle
from volcohort.operators import panels, registry
from volcohort.sources import index

FIELDS = "series_dir string, file string, patient_id string, series_uid string, study_uid string, series_number int, patient_position string, description string, origin array<double>, cosines array<double>, pixel array<double>, between double, thickness double"


def test_series_geometry(spark):
    flat = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    rows = [("a", f"{i:02}", "1.2.007", "1.9.01", "st", 3, "hfs", "axial", [10.0, 20.0, 1.5 * i], flat, [0.7, 0.8], None, 9.0) for i in range(60)]
    rows += [("one", "0", "1.2.8", "1.9.2", None, None, "HFDR", None, [0.0, 0.0, 0.0], flat, [1.0, 1.0], None, 2.0)]
    rows += [("gapless", "0", "1.2.8", "1.9.3", None, 4, None, None, [0.0, 0.0, 0.0], flat, [1.0, 1.0], None, None)]
    rows += [("bent", "0", "1.2.8", "1.9.4", None, 4, None, None, [0.0, 0.0, 0.0], [0.0] * 6, [1.0, 1.0], None, 2.0)]
    rows += [("scout", "0", "1.2.8", "1.9.5", None, 4, None, "Localizer 3", [0.0, 0.0, 0.0], flat, [1.0, 1.0], None, 2.0)]
    rows += [("anonymous", "0", "  ", "1.9.6", None, 4, None, None, [0.0, 0.0, 0.0], flat, [1.0, 1.0], None, 2.0)]
    got = {r.series_dir: r for r in index.series(spark.createDataFrame(rows, FIELDS)).collect()}
    assert set(got) == {"a", "one", "gapless", "bent", "scout"}
    a = got["a"]
    assert (a.patient_uid, a.patient_token, a.series_uid, a.n_slices, a.is_ct, a.patient_position) == ("1.2.7", "7", "1.9.1", 60, True, "SUPINE")
    assert a.origin == [-10.0, -20.0, 45.0] and a.spacing == [0.8, 0.7, 1.5] and a.direction == [-1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, 1.0]
    assert got["one"].spacing == [1.0, 1.0, 2.0] and got["one"].patient_position == "UNKNOWN" and not got["one"].is_ct
    assert got["gapless"].spacing is None and got["bent"].origin is None and got["scout"].direction is None and got["scout"].is_scout
    assert index.series(spark.createDataFrame([], FIELDS)).count() == 0


def test_names_of_masks(spark):
    names = ["x/1.3.6.1.4.1.9328.50.4.0017_seg.nii.gz", "ctc-12_SEG.nii.gz", "1.3.6.1.4.1.9328.50.81.1_seg.nii.gz", "ctc-12_seg.nii", ""]
    files = spark.createDataFrame([(n,) for n in names] + [(None,)], "path string")
    assert {r.patient_token for r in index.spine_masks(files).collect()} == {"17", "CTC-12"}
    assert index.first_folder(files, ["none"], ".nii.gz").count() == 0
    long_ = "dataset2_1.3.6.1.4.1.9328.50.4.0022_5_400_hard_semisacralization_mask_4label.nii.gz"
    r = index.pelvis_masks(spark.createDataFrame([(long_,), (long_ + "x",)], "path string")).collect()
    assert len(r) == 1 and (r[0].patient_token, r[0].series_number, r[0].n_slices, r[0].label, r[0].qualifiers) == ("22", 5, 400, "SEMI_SACRAL", "hard_semisacralization")
    assert r[0].flags["hard"] and not r[0].flags["sacralization"]


def test_classes_and_boxes(spark):
    want = {("SACRALIZATION", "LUMBARIZATION"): 3, ("normal", "lumbarization"): 1, (None, "SACRALIZATION"): 3, ("HARD_SACRAL", "LUMBARIZATION"): 0, (None, None): 0}
    df = spark.createDataFrame(list(want), "p string, v string")
    number, source = registry.transition_class(F.col("p"), F.col("v"))
    got = {(r.p, r.v): (r.n, r.s) for r in df.select("p", "v", number.alias("n"), source.alias("s")).collect()}
    assert {k: n for k, (n, _) in got.items()} == want and got[None, None][1] == "default_normal" and got["normal", "lumbarization"][1] == "vertebral_scan:lumbarization"
    turned = [-1.0, 0.0, 0.0, 10.0, 0.0, 2.0, 0.0, 0.0, 0.0, 0.0, 1.0, 5.0, 0.0, 0.0, 0.0, 1.0]
    lows, highs = registry.world_box(F.col("a"), F.col("s"))
    row = spark.createDataFrame([(turned, [11, 3, 2])], "a array<double>, s array<int>").select(F.array(*lows).alias("l"), F.array(*highs).alias("h")).first()
    assert row.l == [0.0, 0.0, 5.0] and row.h == [10.0, 4.0, 6.0]


def test_middle_is_exact(spark):
    values = {"even": [float(i % 50) for i in range(1000)], "odd": [i * i / 7 for i in range(501)], "two": [1.0, 2.0], "one": [3.0], "ties": [4.0] * 99 + [5.0], "low": [4.0] * 30 + [5.0] * 70}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("none", None), ("one", None)], "k string, v double")
    assert {r.k: (r.n, r.median) for r in middle(df, ["k"], "v").collect()} == {k: (len(v), sorted(v)[len(v) // 2]) for k, v in values.items()}


def test_panels_need_enough(spark):
    rows = [("F", 40, float(i), 2.0) for i in range(20)] + [("male", 99, float(i), 0.0) for i in range(19)] + [(None, 100, 1.0, None)]
    df = spark.createDataFrame(rows, "sex string, age int, x double, w double")
    assert panels.by_sex(df, "sex", ["x"]).count() == 0 and panels.by_sex(df, "sex", ["x"], 19).count() == 1
    rel = panels.with_relative(df, ["w"], ["x"]).collect()
    assert all((r.rel_x is None) == (r.x == 0 or not r.w) for r in rel)
    assert [(r.decade, r.n, r.median) for r in panels.ridges(df, "age", "x", least=20).collect()] == [(40, 20, 10.0)]
    assert panels.gradient(df, {"a": "x", "b": "w"}).count() == 0 and panels.gradient(df, {"a": "x", "b": "w"}, fewest=2).count() == 2
