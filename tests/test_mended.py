"""Functions on the literals that their rules were written for."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import codes, coerce, review, stats
from volcohort.operators import compare, reports, sequence, transitions, voxel


def column(spark, values, kind, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_ages_and_positions(spark):
    assert column(spark, ["052W", "104W", "45", " 095y ", "1000D", "x", "", None], "string", coerce.years) == [0, 1, 45, 89, 2, None, None, None]
    assert column(spark, ["HFS", " ffp ", "HFDR", "XDL", "Sitting", "", None], "string", coerce.position) == ["supine", "prone", "decubitus_right", "decubitus_left", "sitting", None, None]


def test_auto_accept(spark):
    cases = [
        (True, []), (True, None), (True, ["OK all", " ", None]), (True, ["OK", "note: rib 12 clipped by the scan edge"]), (True, ["note: rib on L1"]), (True, ["X gap"]), (False, ["OK"]), (None, []),
        (True, ["clipped by the scan edge"]),
    ]
    df = spark.createDataFrame(cases, "ok boolean, m array<string>")
    got = [r[0] for r in df.select(review.auto_accept(F.col("ok"), F.col("m"))[1]).collect()]
    assert got == ["accepted", "accepted", "accepted", "accepted", "note", "blocking", "not_ok", "not_ok", "note"]


def test_pitch_counts_neighbours_only(spark):
    rows = [("a", "left", 1, 0.0), ("a", "left", 2, 18.0), ("a", "left", 5, 90.0), ("a", "right", 6, 0.0), ("a", "right", 7, 22.0), ("b", "left", 1, 0.0), ("b", "left", 3, 50.0)]
    df = spark.createDataFrame(rows, "c string, side string, n int, z double")
    assert {r.c: r.pitch for r in sequence.pitch(df, ["c"], "n", "z", 20.0, ["side"]).collect()} == {"a": 20.0, "b": 20.0}
    assert {r.c: r.pitch for r in sequence.pitch_of_range(df.where("side = 'left'"), ["c"], "n", "z", 20.0).collect()} == {"a": 22.5, "b": 25.0}


def test_median_of_even_numbers(spark):
    df = spark.createDataFrame([("k", float(v)) for v in range(8)], "k string, v double")
    r = stats.median_interval(df, ["k"], "v").first()
    assert r.median == 4.0 and abs(r.hi - 4 - 1.58 * (5 - 1) / 8**0.5) < 1e-9


def test_nth_without_an_order(spark):
    df = spark.range(0, 40000).select(((F.col("id") * 7919) % 40000).cast("double").alias("v"))
    assert stats.nth(df, "v", [0, 1, 19999, 39999]) == [0.0, 1.0, 19999.0, 39999.0]
    assert stats.nth(spark.range(30000).select(F.lit(3.0).alias("v")), "v", [5]) == [3.0]


def test_density_of_few_values(spark):
    few = spark.range(7).select(F.col("id").cast("double").alias("v"))
    assert stats.reflected_kde(few, "v", 0.0, 10.0, 5).count() == 0
    n, h = stats.robust_bandwidth(spark.range(9).select(F.col("id").cast("double").alias("v")), "v", 0.0, 10.0)
    assert n == 9 and abs(h - 1.15 * 0.9 * min(7.5**0.5, 4 / 1.34) * 9**-0.2) < 1e-9
    lo, hi = codes.density_band(F.lit(0.1), F.lit(100), F.lit(1.0))
    r = spark.range(1).select(lo, hi).first()
    assert abs(r[0] - (0.1 - 1.96 * (0.1 * 0.28209479 / 100) ** 0.5)) < 1e-5 and abs(r[0] + r[1] - 0.2) < 2e-5


def test_codes(spark):
    assert column(spark, [34, 45, 46, 50, 57], "int", codes.adjacent_ribs) == [[35], [44], [47], [49, 51], [56]]
    assert column(spark, [1, 12, 13, 24, 25], "int", codes.rib_from_sequence) == [46, 57, 34, 45, None]
    flags = spark.range(1).select(*codes.qualifiers(F.lit("_hard_semisacralization_rl"))).first()
    assert flags[1] == "SEMI_SACRAL" and flags[0]["hard"] and flags[0]["rl"] and not flags[0]["sacralization"] and flags[2] == "UNKNOWN"
    assert column(spark, [[[1, 2]], [[1, 1]], []], "array<array<int>>", codes.swap_pairs) == [[[1, 2]], None, []]


def volume(spark, rows):
    return spark.createDataFrame(rows, "case_id int, k int, j int, i int, label int")


def test_agreement_and_conflicts(spark):
    """A 6 x 6 x 6 label against one that lacks a class and numbers another one differently."""
    cells = [(k, j, i) for k in range(6) for j in range(6) for i in range(6)]
    label = lambda p: 34 if p[0] == 0 else 35 if p[0] == 1 else 36 if p[0] == 2 else 0
    a = volume(spark, [(1, *p, label(p)) for p in cells])
    b = volume(spark, [(1, *p, {34: 34, 35: 40, 36: 0, 0: 0}[label(p)]) for p in cells])
    got = compare.agreement(a, b, 0.9).first()
    assert (got.worst, got.agree) == (0.0, False) and compare.agreement(a, a, 1.0).first().agree
    none = volume(spark, [(1, 0, 0, 0, 0)])
    assert compare.agreement(none, none, 1.0).first().metric == 1.0
    kinds = {r.label: r.kind for r in compare.disjoint_classes(compare.cells(a, b)).collect()}
    assert kinds == {35: "RENUMBER", 36: "MISSING", 40: "RENUMBER"}


def test_crop_round_trip(spark):
    full = volume(spark, [(1, k, 0, i, 0) for k in range(4) for i in range(4)])
    crop = volume(spark, [(1, k, 0, i, 7) for k in range(2) for i in range(2)])
    origin = spark.createDataFrame([(1, 1, 0, 2)], "case_id int, k0 int, j0 int, i0 int")
    got = {(r.k, r.i): r.label for r in compare.paste(full, crop, origin).collect()}
    assert len(got) == 16 and {p for p, v in got.items() if v} == {(1, 2), (1, 3), (2, 2), (2, 3)}


def test_edits_keep_what_is_given(spark):
    given, edit = volume(spark, [(1, 0, 0, i, v) for i, v in enumerate([20, 40, 0, 0, 5])]), volume(spark, [(1, 0, 0, i, v) for i, v in enumerate([41, 0, 42, 10, 0])])
    got = lambda d: {r.i: r.label for r in d.collect()}
    assert got(compare.with_ribs_of(given, edit)) == {0: 20, 2: 42, 4: 5}
    assert got(compare.with_vertebrae_of(given, edit)) == {0: 20, 1: 40, 3: 10, 4: 5}
    assert got(compare.with_bones_of(given, edit)) == {0: 20, 1: 40, 3: 10}


def test_automatic_adjudication(spark):
    base, a, b = (volume(spark, [(c, 0, 0, i, v) for c in (1, 2) for i, v in enumerate(row)]) for row in ([34, 34, 34, 34], [34, 35, 0, 35], [34, 34, 34, 36]))
    hu = volume(spark, [(c, 0, 0, i, 300) for c in (1, 2) for i in range(4)]).withColumnRenamed("label", "hu")
    checks = spark.createDataFrame([(1, True), (2, True)], "case_id int, ok boolean")
    weights = spark.createDataFrame([(1, 3.0, 1.0), (2, 1.0, 1.0)], "case_id int, wa double, wb double")
    final, made = compare.adjudicated(base, a, b, hu, checks, weights, specks=1)
    assert {r.case_id: (r.open, r.decision) for r in made.collect()} == {1: (0, "auto_finalize"), 2: (1, "needs_manual")}
    assert {(r.case_id, r.i): r.label for r in final.collect()} == {(1, 0): 34, (1, 1): 35, (1, 3): 35, (2, 0): 34, (2, 1): 35, (2, 3): 34}


def test_ledger_transitions(spark):
    cases = spark.createDataFrame([(1, "ribs", "v4", 0, ["z"], False, [])], "case_id int, region string, label_file string, priority int, deferred_by array<string>, needs_expert boolean, rereads array<struct<by:string,reason:string,at:timestamp>>")
    slots = spark.createDataFrame([(1, "1", "ann", "t1", False, True, None), (1, "2", "bob", "t2", True, False, None)], "case_id int, slot string, reviewer string, claim_token string, done boolean, amend boolean, amend_base string")
    ask = lambda *rows: spark.createDataFrame(rows, "case_id int, slot string, claim_token string, reviewer_id string, reason string")
    assert transitions.amend_next(cases, slots, "ann").first().base == "v4" and transitions.amend_next(cases, slots, "bob").count() == 0
    after, left, refused = transitions.defer(cases, slots, ask((1, "1", "t1", None, None), (1, "2", "t2", None, None), (1, "9", "t", None, None)))
    assert after.first().deferred_by == ["z", "ann"] and [r.slot for r in left.collect()] == ["2"]
    assert {r.slot: r.problem for r in refused.collect()} == {"2": "already submitted", "9": "no open claim"}
    after, left, refused = transitions.flag(cases, slots, ask((1, "2", "drifted", "bob", "L6"), (1, "1", "no", "bob", "")), F.lit("2024-01-02"))
    r = after.first()
    assert r.needs_expert and [(x.by, x.reason, str(x.at)[:10]) for x in r.rereads] == [("bob", "L6", "2024-01-02")] and left.count() == 2 and refused.count() == 1
    assert transitions.set_priority(cases, cases.select("case_id"), 9).first().priority == 9
    assert [r.accepted for r in transitions.gate(slots.withColumn("label", F.lit("x")), slots.where("false").selectExpr("case_id", "slot", "done ok", "array('') messages"), "ribs").collect()] == [False, False]


def test_null_lists_of_a_case_count_as_empty(spark):
    kind = "case_id int, region string, label_file string, priority int, deferred_by array<string>, needs_expert boolean, rereads array<struct<by:string,reason:string,at:timestamp>>"
    cases = spark.createDataFrame([(1, "ribs", "v4", 0, None, None, None), (2, "ribs", "v4", 0, None, None, None)], kind)
    slots = spark.createDataFrame([(1, "1", "ann", "t1", False, False, None), (2, "1", None, "t2", False, False, None)], "case_id int, slot string, reviewer string, claim_token string, done boolean, amend boolean, amend_base string")
    ask = lambda *rows: spark.createDataFrame(rows, "case_id int, slot string, claim_token string, reviewer_id string, reason string")
    after = {r.case_id: r for r in transitions.defer(cases, slots, ask((1, "1", "t1", None, None)))[0].collect()}
    assert (after[1].deferred_by, after[2].deferred_by) == (["ann"], [])
    after = {r.case_id: r for r in transitions.flag(cases, slots, ask((2, "1", "t2", "cy", "")), F.lit("2024-01-02"))[0].collect()}
    assert after[2].needs_expert and after[2].deferred_by == ["cy"] and [(x.by, x.reason) for x in after[2].rereads] == [("cy", "(no reason given)")]
    assert not after[1].needs_expert and after[1].rereads == []


def test_conflicts_without_weights_stay_open(spark):
    base, a, b = (volume(spark, [(c, 0, 0, 0, v) for c in (1, 2)]) for v in (34, 40, 41))
    weights = spark.createDataFrame([(2, 2.0, 1.0)], "case_id int, wa double, wb double")
    got = {r.case_id: r.label for r in compare.resolve_classes(voxel.three_way(base, a, b), a, b, weights).collect()}
    assert got == {1: None, 2: 40}


def test_specks_hang_together_by_faces(spark):
    """A block of 4 x 4 x 4, a voxel that touches it by a corner, and a class in one small piece."""
    block = [(1, k, j, i, 34) for k in range(4) for j in range(4) for i in range(4)]
    v = volume(spark, [*block, (1, 4, 4, 4, 34), (1, 8, 0, 0, 35)])
    hu = volume(spark, [(1, 0, 0, 0, 300)]).withColumnRenamed("label", "hu")
    checks = spark.createDataFrame([(1, True)], "case_id int, ok boolean")
    final, _ = compare.adjudicated(v, v, v, hu, checks)
    assert {(r.k, r.label) for r in final.collect() if r.k > 3} == {(8, 35)} and final.count() == 65


def test_border_of_grids(spark):
    """Windows follow each case's own spacing and number of slices."""
    truth = volume(spark, [(c, k, 0, 0, 5 if k == 10 else 7) for c in (1, 2, 3) for k in range(20)])
    pred = volume(spark, [(c, k, 0, 0, 7) for c in (1, 2, 3) for k in range(20)])
    grids = spark.createDataFrame([(1, 5.0, 20), (2, 3.0, 13)], "case_id int, spacing double, slices int")
    got = {r.case_id: (r.lo, r.hi, r.voxels) for r in compare.border(pred, truth, grids).collect()}
    assert got == {1: (6, 14, 8), 2: (3, 13, 10)}
    assert {(r.case_id, r.truth, r.pred): r.n for r in compare.border_confusion(pred, truth, grids).collect()} == {(1, 5, 7): 1, (1, 7, 7): 7, (2, 5, 7): 1, (2, 7, 7): 9}


def test_stated_totals_go_first(spark):
    cases = spark.createDataFrame([("fused", None, None, None)], "match_type string, spine struct<bone_pct: double, method: string>, pelvic struct<bone_pct: double>, lstv_pelvic string")
    got = {r.key: r.value for r in reports.fillsheet(cases, spark.createDataFrame([(7, None)], "n_cases int, n_fused int")).collect()}
    assert (got["n_dataset"], got["n_fused"]) == ("7", "1")
