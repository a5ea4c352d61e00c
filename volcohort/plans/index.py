"""More of the catalogue: indexes of sources, manifests of cases, series of masks, sides, panels of a cohort.

Series, files and measures are made from orders, lines and parts, so that their number grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions.stats import middle
from volcohort.operators import panels, registry
from volcohort.plans.catalogue import query, table
from volcohort.plans.compare import ORACLES, QUERIES
from volcohort.sources import index

__all__ = ["ORACLES", "QUERIES"]

UID = "1.3.6.1.4.1.9328.50.4."

# --- series and visits ---------------------------------------------------------------------------------------------------


@query(f"""with s as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 r, count(*) over (partition by l_orderkey) n from lineitem),
m as (select s.*, t.l_quantity q2, t.l_linenumber l2 from s join s t on t.l_orderkey = s.l_orderkey and s.r = s.n // 2 and t.r = (s.n // 2 + 1) % s.n),
g as (select *, case when l_orderkey % 2 = 0 then abs(2.5 * (l2 - l_linenumber)) else abs(q2 - l_quantity) end step from m where l_orderkey % 11 <> 0),
h as (select *, case when n >= 2 and step > 1e-9 then step when l_orderkey % 3 = 0 then 3.0 end gap, l_orderkey % 5 = 0 scout from g)
select l_orderkey uid, '' || (l_orderkey % 500) token, n n_slices, scout is_scout, case l_orderkey % 4 when 0 then 'PRONE' when 1 then 'SUPINE' else 'UNKNOWN' end position,
  case when not scout and gap is not null then 0.0 - l_quantity end ox, case when not scout and gap is not null then (2.5 * l_linenumber)::double end oz, case when not scout and gap is not null then 0.5::double end s0,
  case when not scout then gap end s2, case when not scout and gap is not null then case when l_orderkey % 2 = 0 then -1.0::double else 0.0::double end end d0, case when not scout and gap is not null then case when l_orderkey % 2 = 0 then 1.0::double else 0.0::double end end d8 from h""")
def series_index(spark, sf_dir):
    name = "concat_ws('/', lpad(l_linenumber, 3, '0'), lpad(l_partkey, 12, '0'), lpad(l_suppkey, 12, '0'), lpad(cast(l_extendedprice as decimal(20, 2)), 20, '0'))"
    slices = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey series_dir", f"{name} file", f"if(l_orderkey % 11 = 0, ' ', concat('{UID}00', l_orderkey % 500)) patient_id", f"concat('{UID}', l_orderkey) series_uid", "'s' study_uid", "1 series_number",
        "element_at(array('hfp', 'FFS', 'HFDR', null), cast(l_orderkey % 4 + 1 as int)) patient_position", "if(l_orderkey % 5 = 0, 'AP TOPOGRAM', 'axial') description",
        "array(l_quantity, 0D, 2.5D * l_linenumber) origin", "if(l_orderkey % 2 = 0, array(1D, 0D, 0D, 0D, 1D, 0D), array(0D, 1D, 0D, 0D, 0D, 1D)) cosines", "array(0.5D, 0.5D) pixel",
        "cast(null as double) between", "if(l_orderkey % 3 = 0, 3D, null) thickness",
    )
    at = lambda c, i, n: F.get(c, F.lit(i)).alias(n)
    return index.series(slices).select(
        F.element_at(F.split("series_uid", r"\."), -1).cast("long").alias("uid"), F.col("patient_token").alias("token"), "n_slices", "is_scout", F.col("patient_position").alias("position"),
        at("origin", 0, "ox"), at("origin", 2, "oz"), at("spacing", 0, "s0"), at("spacing", 2, "s2"), at("direction", 0, "d0"), at("direction", 8, "d8"),
    )


SERIES_SQL = """s as (select o_custkey p, o_custkey * 100 + year(o_orderdate) u, o_orderkey k, o_orderkey % 9 nr, 40 + o_orderkey % 40 n, case o_orderkey % 3 when 0 then 'PRONE' when 1 then 'SUPINE' else 'UNKNOWN' end pos, o_orderpriority like '5%' scout from orders),
t as (select *, n >= 50 and not scout ct from s),
g as (select p, u, min(nr * 1000 + n) first, count(*) n_series, count(*) filter (ct) n_ct, count(*) filter (scout) n_scouts, count(*) filter (ct and pos = 'PRONE') pr, count(*) filter (ct and pos = 'SUPINE') su, count(*) filter (ct and pos = 'UNKNOWN') un from t group by p, u),
h as (select *, greatest(0, n_ct - case when pr > 0 then 1 else 0 end - case when su > 0 then 1 else 0 end - case when un > 0 then 1 else 0 end) extra, row_number() over (partition by p order by first, u) visit from g),
v as (select *, case when n_ct + n_scouts = 0 then 'empty' else concat_ws('+', case when pr > 0 then 'prone' end, case when su > 0 then 'supine' end, case when un > 0 then un || '×unknown-pos' end, case when n_scouts > 0 then n_scouts || '×scout' end, case when extra > 0 then extra || '×extra-kernel' end) end comp from h)"""


def _series(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey patient_uid", "o_custkey * 100 + year(o_orderdate) study_uid", "o_orderkey % 9 series_number", "40 + o_orderkey % 40 n_slices", "element_at(array('PRONE', 'SUPINE', 'UNKNOWN'), cast(o_orderkey % 3 + 1 as int)) patient_position",
        "if(o_orderpriority like '5%', 'Scout 512', 'abdomen') description",
    ).withColumn("is_scout", index.is_scout(F.col("description"))).withColumn("is_ct", (F.col("n_slices") >= index.FEWEST_SLICES) & ~F.col("is_scout"))


@query(f"with {SERIES_SQL} select p patient_uid, u study_uid, visit visit_index, n_series, n_ct, n_scouts, extra n_extra, comp composition from v")
def visit_composition(spark, sf_dir):
    out = index.visits(_series(spark, sf_dir))
    return out.select("patient_uid", "study_uid", F.col("visit_index").cast("long").alias("visit_index"), "n_series", "n_ct", "n_scouts", "n_extra", "composition")


@query(f"""with {SERIES_SQL} select 'visits' kind, '' || c "value", count(*) n from (select p, count(*) c from v group by p) group by c union all select 'composition', comp, count(*) from v group by comp
  union all select 'series', case when ct then 'ct ' || pos when scout then 'scout' else 'other' end, count(*) from t group by 2""")
def index_counts(spark, sf_dir):
    s = _series(spark, sf_dir)
    return index.index_counts(s, index.visits(s))


# --- masks by their names --------------------------------------------------------------------------------------------------


def _mask_files(spark, sf_dir):
    words = "element_at(array('', '_hard_sacralization', '_semisacralization', '_SUPINE_rl', '_prone_metal', '_xsupinex'), cast(p_partkey % 6 + 1 as int))"
    return table(spark, sf_dir, "part").selectExpr(f"concat('m/dataset2_{UID}00', p_partkey, '_', p_size, '_', p_partkey % 700, {words}, if(p_partkey % 13 = 0, '_mask', '_mask_4label'), if(p_partkey % 2 = 0, '.nii.gz', '.nii')) path")


@query("""select '' || p_partkey token, p_size::bigint series_number, p_partkey % 700 n_slices, case p_partkey % 6 when 3 then 'SUPINE' when 4 then 'PRONE' when 5 then 'SUPINE' else 'UNKNOWN' end position,
  case p_partkey % 6 when 1 then 'SACRALIZATION' when 2 then 'SEMI_SACRAL' else 'NORMAL' end "label", p_partkey % 6 = 1 hard, p_partkey % 6 = 3 flipped from part where p_partkey % 13 <> 0""")
def pelvis_masks(spark, sf_dir):
    out = index.pelvis_masks(_mask_files(spark, sf_dir))
    return out.select(F.col("patient_token").alias("token"), "series_number", "n_slices", "position", "label", F.col("flags")["hard"].alias("hard"), F.col("flags")["rl"].alias("flipped"))


@query("""select case when p_partkey % 3 = 0 then 'CTC-' || p_partkey else '' || p_partkey end token, case when p_partkey % 4 = 0 then 'r/raw_data/volumes/' when p_partkey % 4 = 1 then 'r/x/volumes/COLONOG/' when p_partkey % 4 = 2 then 'r/' end
  || case when p_partkey % 3 = 0 then 'ctc-' || p_partkey else '1.3.6.1.4.1.9328.50.4.0' || p_partkey end || case when p_partkey % 4 = 2 then '_ct' else '' end || '.nii.gz' image from part where p_partkey % 7 <> 0""")
def spine_masks(spark, sf_dir):
    base = f"if(p_partkey % 3 = 0, concat('ctc-', p_partkey), concat('{UID}0', p_partkey))"
    parts = table(spark, sf_dir, "part").withColumn("base", F.expr(base))
    masks = parts.selectExpr("concat('r/x/labels/COLONOG/', base, if(p_partkey % 7 = 0, '_segx', '_seg'), '.nii.gz') path")
    images = parts.selectExpr("explode(filter(array(if(p_partkey % 4 = 0, concat('r/raw_data/volumes/', base, '.nii.gz'), null), if(p_partkey % 4 = 1, concat('r/x/volumes/COLONOG/', base, '.nii.gz'), null), if(p_partkey % 4 <= 2, concat('r/', base, '_ct.nii.gz'), null)), p -> p is not null)) path")
    found = index.spine_masks(index.first_folder(masks, ["r/labels", "r/x/labels", "r"], ".nii.gz"))
    return index.with_image(found, images, "r").select(F.col("patient_token").alias("token"), F.col("image_file").alias("image"))


@query("""with d as (select distinct l_orderkey k, l_linenumber n from lineitem), c as (select k, count(*) filter (n <= 6) n, min(n) lo from d group by k)
  select k, case when n = 0 then 'AMBIGUOUS' when n <= 3 then 'INCOMPLETE_SCAN' when n = 4 then 'SACRALIZATION' when n = 5 then 'NORMAL' else 'LUMBARIZATION' end "label", n, case when n > 0 then 'L' || lo end upper from c""")
def lumbar_counts(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_linenumber") + 19).alias("labels"))
    label, n, names = index.lumbar_count(F.col("labels"))
    return own.select("k", label.alias("label"), n.cast("long").alias("n"), F.get(names, F.lit(0)).alias("upper"))


@query("""with f as (select o_custkey k, max(o_orderdate) m from orders group by o_custkey), w as (select c_custkey k, timestamp '1996-06-01 00:00:00' + interval 1 day * (c_custkey % 1000) w from customer where c_custkey % 4 <> 0)
  select coalesce(f.k, w.k) k, w.k is not null and (f.k is null or m <= w) fresh from f full join w on f.k = w.k""")
def fresh_indexes(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("modified"))
    stored = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k"), F.expr("to_timestamp('1996-06-01') + make_dt_interval(cast(c_custkey % 1000 as int))").cast("timestamp").alias("written"))
    return index.stale(files.withColumn("modified", F.col("modified").cast("timestamp")), stored, "k")


# --- manifests, series of masks, sides ------------------------------------------------------------------------------------


ENTRY_SQL = """c as (select p_partkey k, p_partkey % 5 pv, p_partkey % 4 vt from part),
e as (select k, k % 2 = 0 img, case when k % 3 = 0 then 'sp/' || k || '_seg_placed.nii.gz' when k % 3 = 1 then 'old/' || k end seg, case when k % 5 = 1 then 'p/' || k when k % 5 = 2 then 'm/' || k || '_pelvic_placed.nii.gz' when k % 5 = 3 then 'p/' || k end mask,
  case pv when 0 then 3 when 1 then 2 when 2 then case vt when 1 then 1 else 0 end when 3 then 0 else case vt when 1 then 1 else 0 end end cls,
  case pv when 0 then 'pelvic_filename:Sacralization' when 1 then 'pelvic_filename:SEMI_SACRAL' when 3 then 'default_normal' else case vt when 1 then 'vertebral_scan:lumbarization' else 'default_normal' end end src from c)"""


def _entries(spark, sf_dir, kind):
    cases = table(spark, sf_dir, "part").selectExpr(
        "p_partkey k", "cast(p_partkey as string) patient_token", "cast(p_partkey as string) spine_series", "cast(p_partkey as string) pelvic_series", "cast(p_partkey as string) pelvic_stem",
        "if(p_partkey % 3 = 1, concat('old/', p_partkey), null) spine_placed", "if(p_partkey % 5 in (1, 2, 3) and p_partkey % 5 <> 2, concat('p/', p_partkey), null) pelvic_placed",
        "element_at(array('Sacralization', 'SEMI_SACRAL', 'normal', 'other', null), cast(p_partkey % 5 + 1 as int)) lstv_pelvic", "element_at(array('NORMAL', 'lumbarization', '', null), cast(p_partkey % 4 + 1 as int)) lstv_vertebral",
    )
    there = "filter(array(if(p_partkey % 2 = 0, concat('img/', p_partkey, '.nii.gz'), null), if(p_partkey % 3 = 0, concat('sp/', p_partkey, '_seg_placed.nii.gz'), null), if(p_partkey % 5 = 1, concat('p/', p_partkey), null), if(p_partkey % 5 = 2, concat('m/', p_partkey, '_pelvic_placed.nii.gz'), null)), x -> x is not null)"
    return registry.entries(cases, table(spark, sf_dir, "part").selectExpr(f"explode({there}) path"), kind, "img", "sp", ["n", "m"])


def _entry_query(kind, need, label, mask):
    sql = f"with {ENTRY_SQL} select '' || k token, '{kind}' match_type, 'img/' || k || '.nii.gz' image, {label} spine_label, {mask} pelvic_mask, cls lstv_class, src lstv_source from e where img and {need}"

    def run(spark, sf_dir):
        made, _ = _entries(spark, sf_dir, kind)
        return made.select(F.col("patient_token").alias("token"), "match_type", "image", "spine_label", "pelvic_mask", "lstv_class", "lstv_source")

    run.__name__ = f"entries_{kind}"
    return query(sql)(run)


entries_fused = _entry_query("fused", "seg is not null and mask is not null", "seg", "mask")
entries_spine_only = _entry_query("spine_only", "seg is not null", "seg", "cast(null as varchar)")
entries_pelvic_only = _entry_query("pelvic_only", "mask is not null", "cast(null as varchar)", "mask")


def _manifest(spark, sf_dir):
    """Parts as cases of four kinds; some say nothing of their transition, which their patient then does."""
    part = table(spark, sf_dir, "part")
    cases = part.selectExpr(
        "cast(p_partkey as string) patient_token", "element_at(array('fused', 'spine_only', 'pelvic_only', 'separate'), cast(p_size % 4 + 1 as int)) match_type", "cast(p_partkey as string) spine_series", "cast(p_partkey as string) pelvic_series",
        "cast(p_partkey as string) pelvic_stem", "if(p_partkey % 3 = 1, concat('old/', p_partkey), null) spine_placed", "if(p_partkey % 5 in (1, 3), concat('p/', p_partkey), null) pelvic_placed",
        "if(p_partkey % 7 < 3, if(p_partkey % 7 = 0, '', null), if(p_partkey % 7 = 3, 'Sacralization', 'normal')) lstv_pelvic", "cast(null as string) lstv_vertebral", "if(p_partkey % 9 = 0, null, p_partkey % 9 > 4) lstv_agreement",
        "if(p_partkey % 4 = 0, null, p_partkey % 4 = 1) lstv_confusion_zone", "p_partkey % 2 = 0 series_agreement", "double(p_partkey % 100) spine_bone_pct", "concat('dir/', p_partkey) pelvic_series_dir", "if(p_partkey % 6 = 0, null, array('w', 'v')) warnings",
    )
    patients = part.where("p_partkey % 8 > 0").selectExpr("cast(p_partkey as string) patient_token", "if(p_partkey % 2 = 0, 'SEMI_SACRAL', '') lstv_pelvic", "if(p_partkey % 3 = 0, 'lumbarization', null) lstv_vertebral", "p_partkey % 10 = 0 lstv_agreement")
    there = "filter(array(if(p_partkey % 2 = 0, concat('img/', p_partkey, '.nii.gz'), null), if(p_partkey % 3 = 0, concat('sp/', p_partkey, '_seg_placed.nii.gz'), null), if(p_partkey % 5 = 1, concat('p/', p_partkey), null), if(p_partkey % 5 = 2, concat('m/', p_partkey, '_pelvic_placed.nii.gz'), null), if(p_partkey % 11 = 2, concat('n/', p_partkey, '_pelvic_placed.nii.gz'), null)), x -> x is not null)"
    return registry.manifest(cases, patients, part.selectExpr(f"explode({there}) path"), "img", "sp", "m", "n")


MANIFEST_SQL = """c as (select p_partkey k, ['fused', 'spine_only', 'pelvic_only', 'separate'][p_size % 4 + 1] mt, case when k % 7 in (0, 1, 2) then case when k % 8 > 0 and k % 2 = 0 then 'SEMI_SACRAL' when k % 7 = 0 then '' end when k % 7 = 3 then 'Sacralization' else 'normal' end pv,
  case when k % 8 > 0 and k % 3 = 0 then 'lumbarization' end vt, case when k % 9 > 4 or (k % 8 > 0 and k % 10 = 0) then true when k % 9 > 0 then false end agree from part),
o as (select *, mt given, unnest(case mt when 'separate' then ['spine_only', 'pelvic_only'] else [mt] end) kind from c),
f as (select *, case when k % 2 = 0 then 'img/' || k || '.nii.gz' end image, case when k % 3 = 0 then 'sp/' || k || '_seg_placed.nii.gz' when k % 3 = 1 then 'old/' || k end seg,
  case when k % 5 = 1 then 'p/' || k when kind <> 'fused' and k % 11 = 2 then 'n/' || k || '_pelvic_placed.nii.gz' when k % 5 = 2 then 'm/' || k || '_pelvic_placed.nii.gz' when k % 5 = 3 then 'p/' || k end mask from o),
g as (select *, concat_ws(',', case when image is null then 'image' end, case when kind <> 'pelvic_only' and seg is null then 'spine_label' end, case when kind <> 'spine_only' and mask is null then 'pelvic_mask' end) lacking,
  case when pv = 'SEMI_SACRAL' then 2 when pv = 'Sacralization' then 3 when vt is not null then 1 else 0 end cls from f),
e as (select k, given, kind, image, case when kind <> 'pelvic_only' then seg end seg, case when kind <> 'spine_only' then mask end mask, cls, pv, vt, agree from g where lacking = '')"""


@query(f"""with {MANIFEST_SQL} select '' || k token, kind match_type, case kind when 'pelvic_only' then 'pelvic' else 'spine' end dataset, image, seg spine_label, mask pelvic_mask, cls lstv_class, pv lstv_pelvic, vt lstv_vertebral, agree lstv_agreement, k % 4 = 1 zone,
  case when kind = 'fused' then k % 2 = 0 end series_match, case when kind <> 'pelvic_only' then 'placed_dcm2niix' end seg_source, case when kind <> 'pelvic_only' then cast(k % 100 as double) end bone_pct_spine, case when k % 6 = 0 then '' else 'w,v' end warnings,
  case when kind = 'pelvic_only' then image end pelvic_image, case when kind = 'pelvic_only' then 'dir/' || k end series_dir, case when kind = 'pelvic_only' then case given when 'separate' then 'pelvic_native' else 'pelvic_only' end end source from e""")
def whole_manifest(spark, sf_dir):
    made, _, _ = _manifest(spark, sf_dir)
    return made.select(
        F.col("patient_token").alias("token"), "match_type", "dataset", "image", "spine_label", "pelvic_mask", "lstv_class", "lstv_pelvic", "lstv_vertebral", "lstv_agreement", F.col("lstv_confusion_zone").alias("zone"), "series_match", "seg_source", "bone_pct_spine",
        F.array_join("warnings", ",").alias("warnings"), "pelvic_image", "series_dir", "source",
    )


@query(f"with {MANIFEST_SQL} select '' || k token, kind match_type, lacking from g where lacking <> ''")
def manifest_lacking(spark, sf_dir):
    return _manifest(spark, sf_dir)[1].withColumnRenamed("patient_token", "token")


@query(f"""with {MANIFEST_SQL}, n as (select unnest([image, seg, mask]) path, k from e) select count(*) filter (kind = 'fused') n_fused, count(*) filter (kind = 'spine_only') n_spine_only, count(*) filter (kind = 'spine_only' and given = 'separate') n_spine_from_separate,
  count(*) filter (kind = 'pelvic_only') n_pelvic_only, count(*) filter (kind = 'pelvic_only' and given = 'separate') n_pelvic_from_separate, count(*) filter (cls = 0) n_class_0, count(*) filter (cls = 1) n_class_1, count(*) filter (cls = 2) n_class_2, count(*) filter (cls = 3) n_class_3,
  (select count(*) from n where path like 'old/%' or (path like 'p/%' and k % 5 = 3)) n_missing_files from e""")
def manifest_totals(spark, sf_dir):
    return _manifest(spark, sf_dir)[2]


@query(f"with {ENTRY_SQL} select '' || k token, concat_ws(',', case when not img then 'image' end, case when seg is null then 'spine_label' end, case when mask is null then 'pelvic_mask' end) lacking from e where not img or seg is null or mask is null")
def entries_missing(spark, sf_dir):
    return _entries(spark, sf_dir, "fused")[1].select(F.col("patient_token").alias("token"), "lacking")


@query("""with m as (select row_number() over () id, l_orderkey k, l_partkey p, l_linenumber n, -l_quantity x, l_discount * 100 z, 10 + l_suppkey % 30 e from lineitem),
  o as (select p_partkey p, 20 + p_size e, p_retailprice % 20 x from part),
  b as (select id, k, n, m.p, s.i, case when (20 + o.e + 10 * s.i) < 10 then null else greatest(0, least(x1, y1) - greatest(x0, y0)) * greatest(0, least(m.e - 1, o.e - 1 + 10 * s.i)) * greatest(0, least(m.z + 2 * (m.e - 1), 2 * (o.e - 1)) - greatest(m.z, 0)) / greatest(1, (x1 - x0) * (m.e - 1) * (m.e - 1) * 2) end share
    from (select *, x - (e - 1) x0, x x1 from m) m join (select p, e, x, -x - (e - 1) y0, -x y1 from o) o on o.p = m.p, range(2) s(i)),
  r as (select *, row_number() over (partition by id order by round(share, 9) desc, i) r from b)
  select k, n, p, i, round(sum(share), 6) share, count(*) c from r where r = 1 group by k, n, p, i""")
def best_series(spark, sf_dir):
    grid = lambda x, z, e: f"array(-1D, 0D, 0D, {x}, 0D, 1D, 0D, 0D, 0D, 0D, 2D, {z}, 0D, 0D, 0D, 1D) affine, array({e}) shape"
    li = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey k", "l_linenumber n", "l_partkey p", "-l_quantity x", "l_discount * 100 z", "cast(10 + l_suppkey % 30 as int) e").distinct()
    masks = li.selectExpr("struct(k, n, p, x, z, e) mask_id", "p", *_split(grid("x", "z", "e, e, e")))
    part = table(spark, sf_dir, "part").selectExpr("p_partkey p", "20 + p_size e", "-(p_retailprice % 20) x", "explode(array(0, 1)) i")
    series = part.selectExpr("p", "cast(i as string) series_uid", *_split(grid("x", "0D", "e, e + 10 * i, e")))
    broken = part.selectExpr("p", "concat('flat', i) series_uid", *_split(grid("x", "0D", "e, 1, e")))
    out = registry.best_series(masks, series.union(broken), "p")
    li_all = table(spark, sf_dir, "lineitem").selectExpr("struct(l_orderkey k, l_linenumber n, l_partkey p, -l_quantity x, l_discount * 100 z, cast(10 + l_suppkey % 30 as int) e) mask_id")
    g = li_all.join(out, "mask_id").groupBy(F.col("mask_id.k").alias("k"), F.col("mask_id.n").alias("n"), F.col("mask_id.p").alias("p"), F.col("series_uid").cast("long").alias("i"))
    return g.agg(F.round(F.sum("share"), 6).alias("share"), F.count(F.lit(1)).alias("c"))


def _split(text):
    """The two expressions of a grid."""
    affine, shape = text.split(" affine, ")
    return f"{affine} affine", shape


SIDE_SQL = """v as (select l_orderkey c, case when l_linenumber % 2 = 0 then 77 else 78 end x, case when (l_linenumber + l_orderkey % 2 + case when l_orderkey % 7 = 3 then l_suppkey % 2 else 0 end) % 2 = 0 then 8 else 9 end y from lineitem where l_orderkey % 5 > 0
  union all select l_orderkey, 1, 1 from lineitem where l_orderkey % 5 = 0)"""


@query(f"""with {SIDE_SQL}, d as (select c, count(*) filter (x = 77 and y = 8) * 2.0 / nullif(count(*) filter (x = 77) + count(*) filter (y = 8), 0) nl, count(*) filter (x = 78 and y = 9) * 2.0 / nullif(count(*) filter (x = 78) + count(*) filter (y = 9), 0) nr,
  count(*) filter (x = 77 and y = 9) * 2.0 / nullif(count(*) filter (x = 77) + count(*) filter (y = 9), 0) sl, count(*) filter (x = 78 and y = 8) * 2.0 / nullif(count(*) filter (x = 78) + count(*) filter (y = 8), 0) sr from v group by c),
  m as (select c, coalesce(nl, nr, sl, sr) is null none, (coalesce(nl, 0) + coalesce(nr, 0)) / 2 a, (coalesce(sl, 0) + coalesce(sr, 0)) / 2 b from d)
  select c case_id, case when not none then round(a, 4) end straight, case when not none then round(b, 4) end swapped, case when none then 'SKIP' when a > 0.5 and b < 0.1 then 'OK' when b > 0.5 and a < 0.1 then 'FLIPPED' else 'MIXED' end verdict from m""")
def side_audit(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    y = "if((l_linenumber + l_orderkey % 2 + if(l_orderkey % 7 = 3, l_suppkey % 2, 0)) % 2 = 0, 8, 9)"
    v = li.selectExpr("l_orderkey case_id", "case when l_orderkey % 5 = 0 then 1 when l_linenumber % 2 = 0 then 77 else 78 end x", f"if(l_orderkey % 5 = 0, 1, {y}) y")
    return registry.side_audit(v.groupBy("case_id", "x", "y").agg(F.count(F.lit(1)).alias("n")), (77, 8), (78, 9))


# --- panels ----------------------------------------------------------------------------------------------------------------


@query("""select l_suppkey k, count(*) n, list_sort(list(l_extendedprice))[count(*) // 2 + 1] median from lineitem group by l_suppkey""")
def medians(spark, sf_dir):
    return middle(table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_suppkey")), ["k"], "l_extendedprice")


RELATIVE_SQL = """b as (select case when l_suppkey % 3 = 0 then 'female' when l_suppkey % 3 = 1 then 'male' end sex, l_extendedprice x, case when l_linenumber % 4 = 0 then null else l_quantity end a, l_discount * 100 c from lineitem),
r as (select *, case when coalesce(a, 0) <> 0 and coalesce(c, 0) <> 0 then (a + c) / 2 when coalesce(a, 0) <> 0 then a when c <> 0 then c end size from b),
l as (select sex, 'x' measure, x v from r union all select sex, 'rel_x', x / size from r where x <> 0),
m as (select measure, sex, count(*) n, list_sort(list(v))[count(*) // 2 + 1] med from l where sex is not null and v is not null group by measure, sex)"""


@query(f"""with {RELATIVE_SQL} select f.measure, f.n n_female, g.n n_male, round(f.med, 6) female, round(g.med, 6) male, round(f.med - g.med, 6) gap from m f join m g on f.measure = g.measure and f.sex = 'female' and g.sex = 'male' where f.n >= 20 and g.n >= 20""")
def sex_panels(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").selectExpr("element_at(array(' f', 'Male', 'x'), cast(l_suppkey % 3 + 1 as int)) sex", "l_extendedprice x", "if(l_linenumber % 4 = 0, null, l_quantity) a", "l_discount * 100 c")
    out = panels.by_sex(panels.with_relative(li, ["a", "c"], ["x"]), "sex", ["x", "rel_x"])
    return out.withColumns({c: F.round(c, 6) for c in ("female", "male", "gap")})


@query("""with l as (select 'L' || l_linenumber "level", l_quantity v from lineitem where l_linenumber <= 5), m as (select "level", count(*) n, list_sort(list(v))[count(*) // 2 + 1] median from l where v is not null group by "level" having count(*) >= 30)
  select * from m where (select count(*) from m) >= 3""")
def level_gradient(spark, sf_dir):
    names = {f"L{i}": f"w{i}" for i in range(1, 6)}
    wide = table(spark, sf_dir, "lineitem").select(*[F.when(F.col("l_linenumber") == i, F.col("l_quantity")).alias(f"w{i}") for i in range(1, 6)])
    return panels.gradient(wide, names)


@query("""with b as (select (20 + l_partkey % 85) age, l_quantity v from lineitem), d as (select (age // 10 * 10)::int "decade", list_sort(list(v)) a, count(*) n from b where age between 40 and 99 and v is not null group by 1 having count(*) >= 25)
  select "decade", n, round(a[n // 2 + 1], 1) median, a[n // 2 + 1] - 1.58 * (a[cast(floor(0.75 * (n - 1)) as int) + 1] - a[cast(floor(0.25 * (n - 1)) as int) + 1]) / sqrt(n) lo, a[n // 2 + 1] + 1.58 * (a[cast(floor(0.75 * (n - 1)) as int) + 1] - a[cast(floor(0.25 * (n - 1)) as int) + 1]) / sqrt(n) hi from d""")
def decade_ridges(spark, sf_dir):
    return panels.ridges(table(spark, sf_dir, "lineitem").withColumn("age", 20 + F.col("l_partkey") % 85), "age", "l_quantity")
