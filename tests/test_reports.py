"""Calls and reports on cases written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import calls
from volcohort.operators import reports

BONE = "array<struct<name:string,n_warped:long,n_source:long,bone_fit:double,jac_bad:double,vol_ratio:double>>"


def test_gate(spark):
    nan = float("nan")
    rows = [
        (1, [("sacrum", 5, 0, 0.9, 0.0, 1.0), ("left_hip", 0, 0, 0.0, 9.0, 9.0)]), (2, [("sacrum", 5, 5, 0.21, 0.5, 1.75)]), (3, [("sacrum", 0, 1, nan, nan, nan)]),
        (4, [("sacrum", 0, None, 0.1, None, None)]), (5, []), (6, None), (7, [("sacrum", 1, 1, None, None, None)]),
    ]
    accept, reasons = calls.gate(F.col("bones"), 0.5, 0.1, 0.5, 1.5)
    got = {r.k: (r.a, r.r) for r in spark.createDataFrame(rows, f"k int, bones {BONE}").select("k", accept.alias("a"), reasons.alias("r")).collect()}
    none = (False, ["no_bone_warped"])
    assert got == {
        1: (True, []), 2: (False, ["sacrum_lowfit=0.21", "sacrum_bonewarp=0.50", "sacrum_volratio=1.75"]), 3: (True, []), 4: none, 5: none, 6: none, 7: (True, []),
    }


def test_hint(spark):
    rows = [
        ("1", "0.4", "2", "0", None, None, None, None, None, None), ("0", "", "", "True", "0.1", "1.0", "1", "0.0", "1", ""), (None, "", "", "", "", " 1 ", "0", " 0 ", "0", "0"),
        (*[None] * 5, "0", "1", "3", "1", "1"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in calls.HINT_COLUMNS))
    assert [r.h for r in df.select(calls.flag_hint().alias("h")).collect()] == [
        "vertebra MIXING (off_main=0.4, order-inv=2)", "OFF-BONE leak (off_bone=0.1)  |  structure: L/R HIP SWAP, pelvis incomplete", "structure: issue", "(flagged)",
    ]


def test_order_and_extent(spark):
    rows = [([12], [10, 11, 12]), ([11], [10, 11, 12]), ([12], [10, 12]), ([], [12]), ([11, 12], [11, 12]), (None, None), ([13], [12, 13])]
    shift, problem = calls.shift_by_order(F.col("l"), F.col("h"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "l array<int>, h array<int>").select(shift, problem).collect()]
    many = (None, "not one lumbar rib")
    assert got == [(1, None), (None, "not the lowest rib"), (None, "no rib above"), many, many, many, (0, None)]
    nan = float("nan")
    rows = [([10.0, 5.0, 1.0], [8.0, 10.0, 1.0]), ([nan, 1.0], [1.0, 0.0]), ([None, 2.0], [1.0, 1.0]), ([], [])]
    got = [r.w for r in spark.createDataFrame(rows, "a array<double>, b array<double>").select(calls.worst_extent(F.col("a"), F.col("b")).alias("w")).collect()]
    assert got == [50.0, None, 100.0, None]


def test_shift_by_vertebra(spark):
    near = [
        (1, "left", 12, 9000, 11, 16.9), (1, "left", 12, 9000, 10, 56.4), (1, "left", 11, 100, 9, 1.0),  # one clear claim; the small body has none
        (2, "left", 12, 9000, 11, 10.0), (2, "left", 12, 9000, 10, 25.0),  # two at a similar range
        (3, "left", 12, 9000, 12, 1.0), (3, "left", 11, 9000, 10, 1.0),  # votes that disagree; a rib alone is clear
        (4, "left", 13, 9000, 12, 1.0),
    ]
    df = spark.createDataFrame(near, "case_id int, side string, level int, voxels int, rib int, distance double")
    got = {r.case_id: (r["shift"], r.problem) for r in reports.shift_by_vertebra(df).collect()}
    assert got == {1: (1, None), 2: (None, "no clear vertebra"), 3: (None, "vertebrae disagree"), 4: (None, "no clear vertebra")}


def test_fillsheet(spark):
    schema = "match_type string, spine struct<bone_pct:double,method:string>, pelvic struct<bone_pct:double>, lstv_pelvic string"
    rows = [("fused", (80.0, None), None, "Semi_Sacralization"), ("fused", (90.0, "XCORR"), None, None), ("spine_only", None, None, "lumbarization")]
    got = {r.key: r.value for r in reports.fillsheet(spark.createDataFrame(rows, schema)).collect()}
    want = {
        "n_dataset": "3", "n_fused": "2", "n_spine_native": "3", "spine_bone_pct_mean": "85.0", "spine_bone_pct_sd": "7.1", "spine_bone_pct_min": "80.0", "n_spine_placed": "2", "pelv_bone_pct_sd": "NEEDS_MANIFEST", "n_affine_placed": "1",
        "n_xcorr_placed": "1", "n_anchor_placed": "NEEDS_NIFTI", "n_lstv_total": "2", "n_sacralization": "0", "n_semi_sacralization": "1", "n_normal_cases": "1", "n_fused_train": "1", "n_fused_val": "0",
    }
    assert {k: got[k] for k in want} == want
    empty = {r.key: r.value for r in reports.fillsheet(spark.createDataFrame([], schema)).collect()}
    assert empty["n_dataset"] == "0" and empty["spine_bone_pct_mean"] == "NEEDS_MANIFEST"


def test_split_strata(spark):
    rows = [(f"t{i}", "fused", "NORMAL", True) for i in range(40)] + [("a", "separate", "lumbarization", True), ("b", "fused", "semi_sacralization", True), ("c", "fused", "SACRALIZATION", True), ("d", "fused", None, False)]
    out = reports.split_strata(spark.createDataFrame(rows, "token string, config string, lstv_label string, ok boolean"))
    got = {r.stratum: tuple(r)[1:] for r in reports.split_counts(out).collect()}
    assert got == {"fused_normal": (40, 28, 6, 6), "lumbarization_separate": (1, 1, 0, 0), "sacralization_fused": (2, 1, 1, 0)}


def test_crest_levels(spark):
    rows = [(5.0, "L4")] * 12 + [(5.0, "T12")] * 3 + [(4.0, " L4 ")] * 14 + [(6.9, "L5")] * 15 + [(5.0, "n/a")] * 9 + [(7.0, "L3")] * 20
    got = {(r.rib_free, r.level): (r.n, r["count"], round(r.pct, 2)) for r in reports.crest_levels(spark.createDataFrame(rows, "g double, lv string"), "g", "lv").collect()}
    # Four of them are too few; the sixth has no L3, which no group reaches.
    assert got == {(5, "L4"): (15, 12, 80.0), (5, "L5"): (15, 0, 0.0), (6, "L4"): (15, 0, 0.0), (6, "L5"): (15, 15, 100.0)}


def test_finals(spark):
    rows = [("7__fused", "accept", "a", 1), ("7__fused", "accept", "b", 2), ("7__x__y", None, "c", 3), ("8", "reject", "d", 4), ("9__s", "accept", "", 5), ("9__t", "accept", None, 6)]
    df = spark.createDataFrame(rows, "case_id string, decision string, label string, nth int")
    got = {r.token: [tuple(d) for d in r.decisions] for r in reports.finals_by_token(df).collect()}
    assert got == {"7": [("fused", "accept"), ("fused", "accept"), ("x__y", "?")], "8": [("", "reject")], "9": [("s", "accept"), ("t", "accept")]}
    assert {r.case_id: r.label for r in reports.final_labels(df).collect()} == {"7__fused": "b", "7__x__y": "c"}
