"""More of the catalogue: calls about rows and reports on a release, on tables made from parts, orders and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import calls
from volcohort.operators import compare, reports
from volcohort.plans.catalogue import query, table
from volcohort.plans.compare import CROP_SQL, _pair
from volcohort.plans.index import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

# --- checked rows ----------------------------------------------------------------------------------------------------

#: The columns of a checked row, in words that both engines read.
CHECKED = """case p_partkey % 5 when 0 then '1' when 1 then '0' when 2 then 'True' when 3 then '1.0' end mixing_flag, case when p_partkey % 7 > 0 then cast(p_size as varchar(9)) end off_main_frac,
  cast(p_partkey % 4 as varchar(9)) n_order_inversions, case when p_size % 2 = 0 then ' 1 ' else '0' end leak_flag, cast(p_size as varchar(9)) off_bone_frac, case when p_partkey % 3 = 0 then 'true' end struct_flag,
  case when p_size % 3 = 0 then '1' end lr_swap, case p_size % 4 when 0 then '2' when 1 then '0.0' when 2 then '' end vertebra_gap, case when p_size % 5 = 0 then '1' else '0' end pelvis_incomplete, case when p_partkey % 9 = 0 then '1' end duplication_flag, case when p_partkey % 11 = 0 then '1' end needs_review"""


def _checked(spark, sf_dir):
    return spark.sql(f"select p_partkey, {CHECKED} from {{parts}}", parts=table(spark, sf_dir, "part"))


@query(f"""with r as (select p_partkey, {CHECKED} from part),
f as (select *, coalesce(mixing_flag in ('1', '1.0', 'True'), false) m, trim(leak_flag) = '1' l, coalesce(struct_flag = 'true', false) s from r),
h as (select *, concat_ws(', ', case when lr_swap = '1' then 'L/R HIP SWAP' end, case when vertebra_gap = '2' then 'missing level' end, case when pelvis_incomplete = '1' then 'pelvis incomplete' end, case when duplication_flag = '1' then 'duplicated structure' end) parts from f)
select p_partkey, coalesce(nullif(concat_ws('  |  ', case when m then 'vertebra MIXING (off_main=' || coalesce(off_main_frac, '?') || ', order-inv=' || n_order_inversions || ')' end,
  case when l then 'OFF-BONE leak (off_bone=' || off_bone_frac || ')' end, case when s then 'structure: ' || case when parts = '' then 'issue' else parts end end), ''), '(flagged)') hint from h""")
def flag_hints(spark, sf_dir):
    return _checked(spark, sf_dir).select("p_partkey", calls.flag_hint().alias("hint"))


@query("select p_partkey from part where p_partkey % 5 in (0, 2, 3) or p_size % 2 = 0 or p_partkey % 3 = 0 or p_partkey % 11 = 0")
def fix_list(spark, sf_dir):
    return reports.fix_list(_checked(spark, sf_dir)).select("p_partkey")


@query("select o_orderkey k, case when o_orderkey % 3 > 0 or (o_orderkey % 5 <> 0 and o_orderpriority like '1%') then 'submit' else 'skip' end action from orders")
def resume_actions(spark, sf_dir):
    accepted = F.expr("if(o_orderkey % 5 = 0, null, o_orderpriority like '1%')")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), calls.resume_action(F.col("o_orderkey") % 3, accepted).alias("action"))


@query("""with b as (select o_orderkey k, case when o_orderkey % 11 > 0 then (o_orderkey % 100) / 100.0::double end fit, (o_orderkey % 7) / 10.0::double bent, (o_orderkey % 13) / 10.0::double ratio, o_orderkey % 4 > 0 sacrum, o_orderkey % 6 > 0 hip from orders),
r as (select *, concat_ws(',', case when sacrum and fit < 0.3 then 'sacrum_lowfit=' || printf('%.2f', fit) end, case when sacrum and bent > 0.4 then 'sacrum_bonewarp=' || printf('%.2f', bent) end, case when sacrum and not ratio between 0.2 and 1.0 then 'sacrum_volratio=' || printf('%.2f', ratio) end,
  case when hip and bent < 0.3 then 'left_hip_lowfit=' || printf('%.2f', bent) end, case when hip and ratio > 0.4 then 'left_hip_bonewarp=' || printf('%.2f', ratio) end) told from b)
select k, not (sacrum or hip) or told <> '' is_refused, case when sacrum or hip then told else 'no_bone_warped' end reasons from r""")
def gated_bones(spark, sf_dir):
    bones = F.expr("""array(named_struct('name', 'sacrum', 'n_warped', o_orderkey % 4, 'n_source', 0L, 'bone_fit', if(o_orderkey % 11 > 0, (o_orderkey % 100) / 100D, null), 'jac_bad', (o_orderkey % 7) / 10D, 'vol_ratio', (o_orderkey % 13) / 10D),
      named_struct('name', 'left_hip', 'n_warped', 0L, 'n_source', o_orderkey % 6, 'bone_fit', (o_orderkey % 7) / 10D, 'jac_bad', (o_orderkey % 13) / 10D, 'vol_ratio', double('NaN')))""")
    accept, reasons = calls.gate(bones, 0.3, 0.4, 0.2, 1.0)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (~accept).alias("is_refused"), F.array_join(reasons, ",").alias("reasons"))


@query("""with e as (select l_orderkey k, l_linenumber n, case when l_suppkey % 3 > 0 then abs(100 * (l_quantity - l_suppkey % 3) / (l_suppkey % 3)) end a, abs(100 * (l_linenumber * 2 - (l_linenumber + 1)) / (l_linenumber + 1)::double) b, case when l_partkey % 3 > 0 then 25.0 end c from lineitem)
select k, n, round(greatest(a, b, c), 6) worst from e""")
def worst_extents(spark, sf_dir):
    a, b = F.expr("array(l_quantity, l_linenumber * 2D, if(l_partkey % 3 > 0, 5D, null))"), F.expr("array(double(l_suppkey % 3), l_linenumber + 1D, 4D)")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.round(calls.worst_extent(a, b), 6).alias("worst"))


@query("""with g as (select l_orderkey k, list(distinct l_linenumber + 6) have, list(distinct l_linenumber + 6) filter (l_returnflag = 'R' and l_linenumber >= 4) lum from lineitem group by l_orderkey),
h as (select *, lum[1] n, case when coalesce(len(lum), 0) <> 1 then 'not one lumbar rib' when lum[1] <> list_max(have) then 'not the lowest rib' when not list_contains(have, lum[1] - 1) then 'no rib above' end problem from g)
select k, case when problem is null then cast(13 - n as int) end shift, problem from h""")
def shift_by_order(spark, sf_dir):
    rib = F.col("l_linenumber") + 6
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(rib).alias("have"), F.collect_set(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 4), rib)).alias("lum"))
    shift, problem = calls.shift_by_order(F.col("lum"), F.col("have"))
    return g.select("k", shift.cast("int").alias("shift"), problem.alias("problem"))


@query("""select o_orderkey k, case o_orderkey % 3 when 0 then 'SAME_SERIES' when 1 then case when o_orderkey % 2 = 0 and o_orderkey % 7 > 0 and o_orderkey % 100 > 50 then 'PRONE_SUPINE_MISMATCH' else 'DIFFERENT_SERIES' end
  else case when o_orderkey % 5 = 0 or o_orderkey % 11 < 5 then 'LIKELY_SAME_SERIES' else 'UNCERTAIN' end end verdict from orders""")
def series_verdicts(spark, sf_dir):
    same, flip = F.expr("element_at(array(true, false, null), cast(o_orderkey % 3 + 1 as int))"), F.expr("o_orderkey % 2 = 0")
    over, far = F.expr("if(o_orderkey % 7 > 0, o_orderkey % 100, null)").cast("double"), F.expr("if(o_orderkey % 5 = 0, null, o_orderkey % 11)").cast("double")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), calls.series_verdict(same, flip, over, far).alias("verdict"))


# --- a release ---------------------------------------------------------------------------------------------------------

#: Names of the figures that count what is said of a case.
LSTV = "case o_orderkey % 6 when 0 then 'normal' when 1 then 'Sacralization' when 2 then 'SEMI_SACRALIZATION' when 3 then 'lumbarization' when 4 then '' end"
METHOD = "case o_custkey % 5 when 0 then 'World_Space' when 1 then '' when 2 then 'phase_xcorr' when 3 then 'anchor_nifti' end"
MATCH = "case o_orderkey % 4 when 0 then 'fused' when 1 then 'separate' when 2 then 'spine_only' else 'pelvic_only' end"


def _row(key, value):
    return f"{{'key': '{key}', 'value': {value}}}"


def _figures(name, c):
    return [
        _row(f"{n}", f"case when {c}n > 0 then {v} else 'NEEDS_MANIFEST' end")
        for n, v in ((f"{name}_bone_pct_mean", f"printf('%.1f', {c}mean)"), (f"{name}_bone_pct_sd", f"printf('%.1f', coalesce({c}sd, 0))"), (f"{name}_bone_pct_min", f"printf('%.1f', {c}min)"), (f"n_{name}_placed", f"{c}n::varchar"))
    ]


ROWS = [
    *[_row(k, f"({v})::varchar") for k, v in {
        "n_dataset": "n", "n_fused": "f", "n_separate": "e", "n_spine_only": "so", "n_pelvic_only": "po", "n_lstv_total": "sac + lum + sem", "n_sacralization": "sac", "n_lumbarization": "lum", "n_semi_sacralization": "sem", "n_normal_cases": "nor",
        "n_fused_training": "f", "n_spine_native": "f + so", "n_pelvic_native": "f + po", "n_fused_train": "round_even(f * 0.70::double, 0)::bigint", "n_fused_val": "round_even(f * 0.15::double, 0)::bigint", "n_fused_test": "round_even(f * 0.15::double, 0)::bigint",
    }.items()],
    *_figures("spine", "s"), *_figures("pelv", "p"), *[_row(f"n_{k}_placed", f"case when {v} > 0 then {v}::varchar else 'NEEDS_NIFTI' end") for k, v in {"affine": "aff", "xcorr": "xc", "anchor": "anc"}.items()],
]


@query(f"""with c as (select {MATCH} m, case when o_orderkey % 4 < 3 then coalesce({METHOD}, '') end method, case when o_orderkey % 4 < 3 and o_custkey % 3 > 0 then o_orderkey % 97 end s, case when o_orderkey % 4 <> 2 then o_orderkey % 89 end p, lower(coalesce({LSTV}, '')) l from orders),
t as (select count(*) n, count(*) filter (m = 'fused') f, count(*) filter (m = 'separate') e, count(*) filter (m = 'spine_only') so, count(*) filter (m = 'pelvic_only') po, avg(s) smean, stddev_samp(s) ssd, min(s)::double smin, count(s) sn, avg(p) pmean, stddev_samp(p) psd, min(p)::double pmin, count(p) pn,
  count(*) filter (method in ('', 'World_Space')) aff, count(*) filter (method = 'phase_xcorr') xc, count(*) filter (method = 'anchor_nifti') anc, count(*) filter (l = 'sacralization') sac, count(*) filter (l = 'lumbarization') lum, count(*) filter (l like 'semi%') sem, count(*) filter (l in ('', 'normal')) nor from c)
select unnest([{", ".join(ROWS)}], recursive := true) from t""")
def fillsheet(spark, sf_dir):
    cases = table(spark, sf_dir, "orders").selectExpr(
        f"{MATCH} match_type", f"if(o_orderkey % 4 < 3, named_struct('bone_pct', if(o_custkey % 3 > 0, o_orderkey % 97, null), 'method', {METHOD}), null) spine", "if(o_orderkey % 4 <> 2, named_struct('bone_pct', o_orderkey % 89), null) pelvic", f"{LSTV} lstv_pelvic",
    )
    return reports.fillsheet(cases)


@query("""with c as (select 4 + o_orderkey % 4 g, case o_custkey % 7 when 0 then 'L3' when 1 then 'L4' when 2 then ' L5' when 3 then '' when 4 then 'n/a' when 5 then 'T12' end lv from orders),
t as (select g, count(*) n, count(*) filter (lv = 'L3') a, count(*) filter (lv = 'L4') b, count(*) filter (lv = ' L5') d from c where g in (4, 5, 6) and lv not in ('', 'n/a') group by g),
u as (select g, n, unnest(['L3', 'L4', 'L5']) lv, unnest([a, b, d]) k from t where n >= 15 and (select count(*) from t where n >= 15) >= 2),
w as (select *, k / n p, 1 + 1.96 * 1.96 / n den from u)
select cast(g as int) rib_free, n, lv "level", k "count", round(100.0 * k / n, 6) pct, round(100 * greatest(0, (p + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4.0 * n * n))) / den), 2) lo,
  round(100 * least(1, (p + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4.0 * n * n))) / den), 2) hi from w""")
def crest_levels(spark, sf_dir):
    levels = "case o_custkey % 7 when 0 then 'L3' when 1 then 'L4' when 2 then ' L5' when 3 then '' when 4 then 'n/a' when 5 then 'T12' end lv"
    return reports.crest_levels(table(spark, sf_dir, "orders").selectExpr("4 + o_orderkey % 4 g", levels), "g", "lv").withColumn("pct", F.round("pct", 6))


@query(f"""with {CROP_SQL}, d as (select c, l, na, nb, 2.0 * z / (na + nb) dice from o where l between 34 and 57)
select c case_id, cast(l as int) "label", na::bigint na, nb::bigint nb, round(dice, 9) dice, na = 0 or nb = 0 missing, cast(row_number() over (partition by c order by dice, l) as int) nth from d where dice < 0.999""")
def contested_structures(spark, sf_dir):
    return reports.contested(compare.cells(*_pair(spark, sf_dir)), *compare.RIBS).withColumn("dice", F.round("dice", 9))


@query("""with r as (select l_orderkey c, case when l_suppkey % 2 = 0 then 'left' else 'right' end s, l_linenumber t, 5000 + 400 * (l_partkey % 10) v, l_linenumber + i - case when l_partkey % 5 = 0 then 1 else 0 end rib, 1.0 + abs(i - 1) * (l_quantity % 7) + i / 64.0 d from lineitem, range(3) x(i)),
k as (select *, row_number() over (partition by c, s, t order by d, rib) q from r where v >= 6000),
b as (select a.c, a.s, a.t - a.rib vote from k a left join k z on z.c = a.c and z.s = a.s and z.t = a.t and z.q = 2 where a.q = 1 and (z.d is null or z.d > 2.5 * a.d)),
g as (select c, s, count(distinct vote) n, min(vote) m from b group by c, s)
select h.c case_id, h.s side, case when n = 1 then cast(m as int) end shift, case when n is null then 'no clear vertebra' when n > 1 then 'vertebrae disagree' end problem from (select distinct c, s from r) h left join g on g.c = h.c and g.s = h.s""")
def shift_by_vertebra(spark, sf_dir):
    near = table(spark, sf_dir, "lineitem").selectExpr("*", "explode(array(0, 1, 2)) i").selectExpr(
        "l_orderkey case_id", "if(l_suppkey % 2 = 0, 'left', 'right') side", "l_linenumber level", "5000 + 400 * (l_partkey % 10) voxels", "cast(l_linenumber + i - if(l_partkey % 5 = 0, 1, 0) as int) rib", "1D + abs(i - 1) * (l_quantity % 7) + i / 64D distance",
    )
    return reports.shift_by_vertebra(near)


@query("""with r as (select l_orderkey c, l_suppkey % 2 = 0 lft, 'T' || (l_partkey % 3 + 11) t, l_partkey nth from lineitem where l_linenumber = 3),
g as (select c, min_by(t, nth) filter (lft) l, min_by(t, nth) filter (not lft) r from r group by c)
select k.c case_id, 'l12->' || coalesce(l, 'absent') || ' r12->' || coalesce(r, 'absent') told from (select distinct l_orderkey c from lineitem) k left join g on g.c = k.c""")
def rib_twelve(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey case_id", "if(l_suppkey % 2 = 0, 'left', 'right') side", "9 + l_linenumber rib", "concat('T', l_partkey % 3 + 11) nearest", "l_partkey nth")
    return reports.rib_twelve(rows)


@query("""with g as (select l_linenumber, count(*) filter (l_returnflag <> 'R') n0, avg(l_quantity) filter (l_returnflag <> 'R') mean0, stddev_pop(l_quantity) filter (l_returnflag <> 'R') sd0, count(*) filter (l_returnflag = 'R') n1, avg(l_quantity) filter (l_returnflag = 'R') mean1, stddev_pop(l_quantity) filter (l_returnflag = 'R') sd1 from lineitem group by l_linenumber)
select l_linenumber, n0, n1, round(mean0, 6) mean0, round(sd0, 6) sd0, round(mean1, 6) mean1, round(sd1, 6) sd1, round(abs(mean0 - mean1) / (sd0 + sd1 + 1e-9), 6) separation, abs(mean0 - mean1) / (sd0 + sd1 + 1e-9) > 1.5 separable from g""")
def position_separation(spark, sf_dir):
    out = reports.separation(table(spark, sf_dir, "lineitem"), ["l_linenumber"], F.col("l_returnflag") == "R", "l_quantity")
    return out.withColumns({c: F.round(c, 6) for c in ("mean0", "sd0", "mean1", "sd1", "separation")})


FINALS = "case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then 'reject' else 'accept' end decision, case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 > 0 then 'l' || o_orderkey end label_"


def _finals(spark, sf_dir):
    own = FINALS.replace("'l' || o_orderkey end label_", "concat('l', o_orderkey) end label").split(", case when o_orderkey % 7")
    return table(spark, sf_dir, "orders").selectExpr("concat(o_custkey, '__', if(o_orderkey % 2 = 0, 'fused', 'sep__x')) case_id", own[0], "case when o_orderkey % 7" + own[1], "o_orderkey nth")


@query(f"""with f as (select o_custkey, o_orderkey, {FINALS} from orders)
select '' || o_custkey token, string_agg(case when o_orderkey % 2 = 0 then 'fused' else 'sep__x' end || ':' || coalesce(decision, '?'), ',' order by o_orderkey) decisions from f group by o_custkey""")
def finals_by_token(spark, sf_dir):
    out = reports.finals_by_token(_finals(spark, sf_dir))
    return out.select("token", F.array_join(F.transform("decisions", lambda d: F.concat_ws(":", d["config"], d["decision"])), ",").alias("decisions"))


@query(f"""with f as (select o_custkey || '__' || case when o_orderkey % 2 = 0 then 'fused' else 'sep__x' end case_id, o_orderkey, {FINALS} from orders)
select case_id, max_by(label_, o_orderkey) "label" from f where coalesce(decision, '') <> 'reject' and label_ <> '' group by case_id""")
def final_labels(spark, sf_dir):
    return reports.final_labels(_finals(spark, sf_dir))


@query("""select l_returnflag source, l_linestatus error, count(*) n, count(distinct l_orderkey) cases from lineitem group by grouping sets ((l_returnflag, l_linestatus), (l_returnflag))""")
def corrections(spark, sf_dir):
    return reports.corrections(table(spark, sf_dir, "lineitem").selectExpr("l_returnflag source", "l_linestatus error", "l_orderkey case"))


SPLIT_SQL = f"""c as (select o_orderkey k, case o_orderkey % 3 when 0 then 'fused' else 'separate' end config, upper(coalesce({LSTV}, '')) l, o_orderkey % 13 > 0 ok from orders),
s as (select *, case when l = 'LUMBARIZATION' then 'lumbarization' when l in ('SACRALIZATION', 'SEMI_SACRALIZATION') then 'sacralization' end kind from c where ok),
t as (select *, case when kind is not null then kind || '_' || config when config = 'fused' then 'fused_normal' else 'nonfused_normal' end stratum from s),
r as (select *, row_number() over (partition by stratum order by md5('42/' || k || '/' || config)) - 1 r, count(*) over (partition by stratum) n from t),
x as (select k, stratum, case when n = 1 then 'train' when n = 2 then case when r = 0 then 'train' else 'val' end when r < greatest(1, round_even(n * 0.15::double, 0)) then 'test' when r < 2 * greatest(1, round_even(n * 0.15::double, 0)) then 'val' else 'train' end split from r)"""


def _split(spark, sf_dir):
    cases = table(spark, sf_dir, "orders").selectExpr("o_orderkey k", "cast(o_orderkey as string) token", "if(o_orderkey % 3 = 0, 'fused', 'separate') config", f"{LSTV} lstv_label", "o_orderkey % 13 > 0 ok")
    return reports.split_strata(cases)


@query(f"with {SPLIT_SQL} select k, stratum, split from x")
def split_strata(spark, sf_dir):
    return _split(spark, sf_dir).select("k", "stratum", "split")


@query(f"with {SPLIT_SQL} select stratum, count(*) n_total, count(*) filter (split = 'train') n_train, count(*) filter (split = 'val') n_val, count(*) filter (split = 'test') n_test from x group by stratum")
def split_counts(spark, sf_dir):
    return reports.split_counts(_split(spark, sf_dir))
