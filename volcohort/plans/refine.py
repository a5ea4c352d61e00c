"""More of the catalogue: labels moved to other grids and refined by density, on a volume for each supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import refine, resample, voxel
from volcohort.plans.catalogue import VOXEL_SQL, _voxels, places, query, table
from volcohort.plans.gates import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

# --- other grids -------------------------------------------------------------------------------------------------------

#: Spacing and origin of the source and of the target; the target is turned about z by the angle whose sine is 0.28.
GRID_SQL = """g as (select s_suppkey c, 1.0 + s_nationkey % 3 * 0.25 sx, 1.0 sy, 2.0 sz, 3.17 + s_nationkey % 5 ox, -4.23 oy, 1.31 oz, 1.1 + s_suppkey % 2 * 0.6 tx, 0.9 ty, 1.7 tz, 2.0 px, -5.0 py, 0.5 pz from supplier),
mv as (select A.c, A.k, A.j, A.i, l from A where l <> 0)"""


def _grids(spark, sf_dir, turned):
    num = lambda *x: ", ".join(f"double({v})" for v in x)
    g = table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as int) case_id", "1.0D + s_nationkey % 3 * 0.25D sx", "3.17D + s_nationkey % 5 ox", "1.1D + s_suppkey % 2 * 0.6D tx")
    cos, sin = (0.96, 0.28) if turned else (1.0, 0.0)
    source = g.selectExpr("case_id", f"array({num('sx', 0, 0, 'ox', 0, 1, 0, -4.23, 0, 0, 2, 1.31, 0, 0, 0, 1)}) affine", "16 ni", "16 nj", "8 nk")
    target = g.selectExpr("case_id", f"array({num(f'{cos}D * tx', f'{-sin} * 0.9D', 0, 2, f'{sin}D * tx', f'{cos}D * 0.9D', 0, -5, 0, 0, 1.7, 0.5, 0, 0, 0, 1)}) affine", "14 ni", "18 nj", "10 nk")
    return source, target


def _target(cos, sin):
    return f"""t as (select g.*, i, j, k, {cos} * tx * i - {sin} * ty * j + px x, {sin} * tx * i + {cos} * ty * j + py y, tz * k + pz z from g, range(14) a(i), range(18) b(j), range(10) d(k)),
    s as (select c, i, j, k, cast(floor((x - ox) / sx + 0.5) as int) si, cast(floor((y - oy) / sy + 0.5) as int) sj, cast(floor((z - oz) / sz + 0.5) as int) sk from t),
    r as (select s.c, s.k, s.j, s.i, l from s join mv on mv.c = s.c and mv.i = si and mv.j = sj and mv.k = sk)"""


@query(f"""with {VOXEL_SQL}, {GRID_SQL}, {_target(0.96, 0.28)} select cast(c as int) case_id, l as "label", count(*) n, cast(sum(k) as bigint) k, cast(sum(j) as bigint) j, cast(sum(i) as bigint) i from r group by c, l""")
def resampled_labels(spark, sf_dir):
    out = resample.resampled(_voxels(spark, sf_dir, 3, 8), *_grids(spark, sf_dir, True))
    return out.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in "kji"])


@query(f"""with {VOXEL_SQL}, {GRID_SQL}, {_target(1, 0)}, q as (select *, i - row_number() over (partition by c, k, j, l order by i) q from r)
  select cast(c as int) case_id, cast(k as int) k, cast(j as int) j, l as "label", cast(min(i) as int) i0, cast(max(i) as int) i1 from q group by c, k, j, l, q""")
def resampled_runs(spark, sf_dir):
    r = resample.resampled_runs(voxel.runs(_voxels(spark, sf_dir, 3, 8)), *_grids(spark, sf_dir, False))
    return r.select("case_id", "k", "j", "label", "i0", "i1")


@query(f"""with {VOXEL_SQL}, {GRID_SQL}, {_target(0.96, 0.28)} select cast(c as int) case_id, cast(case l when 20 then 5 else 7 end as int) as "label", count(*) n from r where l in (20, 22) group by 1, 2""")
def resampled_and_remapped(spark, sf_dir):
    out = resample.resampled_and_remapped(_voxels(spark, sf_dir, 3, 8), *_grids(spark, sf_dir, True), {20: 5, 22: 7})
    return out.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL}, {GRID_SQL}, m as (select A.c, A.k, A.j, cast(floor(2 * (9.0 - ox) / sx - A.i + 0.5) as int) i, l from A join g on g.c = A.c where l <> 0)
  select cast(c as int) case_id, l as "label", count(*) n, cast(sum(i) as bigint) i from m where i between 0 and 15 group by c, l""")
def mirrored_labels(spark, sf_dir):
    source, _ = _grids(spark, sf_dir, False)
    out = resample.mirrored(_voxels(spark, sf_dir, 3, 8), source.withColumn("plane", F.lit(9.0)), 0, F.col("plane"))
    return out.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("i"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", cast(sum(i) as bigint) k, cast(sum(7 - k) as bigint) j, cast(sum(15 - j) as bigint) i from A where l <> 0 group by c, l""")
def reoriented_labels(spark, sf_dir):
    """Axes to the right, to the front and up become axes to the back, down and to the right."""
    out, _ = resample.reoriented(_voxels(spark, sf_dir, 3, 8).where("label <> 0"), _grids(spark, sf_dir, False)[0], "PIR")
    return out.groupBy("case_id", "label").agg(*[F.sum(c).alias(c) for c in "kji"])


# --- refinement --------------------------------------------------------------------------------------------------------

#: 4 x 6 x 10 places for each supplier: what was made by hand at one end, a prediction that spills over, and density with gaps.
HAND = "if(i < 3 and j < 4, 3, 0)"
PRED = "if(i < 3 and j < 4, 3, if((i * 7 + j * 3 + k + c) % 5 < 3 and i > 3, if(i > 6 or (i = 6 and c % 2 = 0), 5, 4), 0))"
DENSITY = "if(i < 3 and j < 4, 200 + (i * 31 + j * 17 + k * 7 + c) % 50, if(i % 7 = 3 or (j + c) % 4 = 3, 20, 150 + (i * 13 + j * 29 + k * 11 + c) % 120))"
REFINE_SQL = f"""v as (select s_suppkey c, id // 60 k, (id // 10) % 6 j, id % 10 i from supplier, range(240) t(id)), d as (select c, k, j, i, {HAND} hand, {PRED} pred, {DENSITY} hu from v),
thr as (select c, quantile_cont(hu, 0.1) t from d where hand > 0 and k between 1 and 2 and j between 1 and 2 and i = 1 group by c),
f as (select d.*, t from d join thr on thr.c = d.c), bone as (select * from f where hand = 0 and hu >= t), p as (select * from f where hand = 0 and pred > 0), pb as (select * from p where hu >= t)"""


def _refined(spark, sf_dir, **kw):
    v = places(spark, sf_dir, 240, "s_suppkey c").selectExpr("c", "cast(id div 60 as int) k", "cast((id div 10) % 6 as int) j", "cast(id % 10 as int) i")
    of = lambda rule, name: v.selectExpr("c case_id", "k", "j", "i", f"cast({rule} as int) {name}")
    return refine.refined(of(HAND, "label").where("label <> 0"), of(PRED, "label").where("label <> 0"), of(DENSITY, "hu"), **kw)


def _counts(out):
    return out.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in "kji"])


TOLD = 'select cast(c as bigint) case_id, cast(l as int) "label", count(*) n, cast(sum(k) as bigint) k, cast(sum(j) as bigint) j, cast(sum(i) as bigint) i from o group by c, l'


@query(f"""with {REFINE_SQL}, o as (select c, k, j, i, hand l from d where hand > 0 union all select c, k, j, i, pred from pb) {TOLD}""")
def refined_clip(spark, sf_dir):
    return _counts(_refined(spark, sf_dir, mode="clip", fill=False)[0])


@query(f"""with {REFINE_SQL}, g as (select distinct b.c, b.k, b.j, b.i from bone b join pb on pb.c = b.c and abs(pb.k - b.k) + abs(pb.j - b.j) + abs(pb.i - b.i) <= 1),
  n as (select g.c, g.k, g.j, g.i, p.pred l, row_number() over (partition by g.c, g.k, g.j, g.i order by pow(g.k - p.k, 2) + pow(g.j - p.j, 2) + pow(g.i - p.i, 2), p.pred) r from g join p on p.c = g.c),
  o as (select c, k, j, i, hand l from d where hand > 0 union all select c, k, j, i, l from n where r = 1) {TOLD}""")
def refined_grown(spark, sf_dir):
    return _counts(_refined(spark, sf_dir, mode="clip", fill=False, grow=1)[0])


#: Parts of bone by faces: what each place reaches, named by the least.
BONE_PARTS = """links as (select x.c, x.k * 60 + x.j * 10 + x.i a, y.k * 60 + y.j * 10 + y.i b from bone x join bone y on x.c = y.c and abs(x.k - y.k) + abs(x.j - y.j) + abs(x.i - y.i) <= 1),
reach as (select distinct c, a, a b from links union select r.c, r.a, n.b from reach r join links n on n.c = r.c and n.a = r.b), named as (select c, a, min(b) part from reach group by c, a),
cls as (select pb.c, part, pred l, count(*) n from pb join named on named.c = pb.c and a = pb.k * 60 + pb.j * 10 + pb.i group by all),
won as (select c, part, arg_max(l, n * 100 - l) dom, sum(n) t, sum(n) - max(n) m from cls group by c, part), sure as (select *, m <= 0.2 * t or m <= 1 ok from won)"""


@query(f"""with recursive {REFINE_SQL}, {BONE_PARTS}, seed as (select pb.*, s.part, dom, ok from pb join named on named.c = pb.c and a = pb.k * 60 + pb.j * 10 + pb.i join sure s on s.c = pb.c and s.part = named.part),
  g as (select distinct b.c, b.k, b.j, b.i, s.dom l from bone b join seed s on s.ok and s.c = b.c and abs(s.k - b.k) + abs(s.j - b.j) + abs(s.i - b.i) <= 1),
  new as (select * from g union all select c, k, j, i, pred from seed where not ok),
  o as (select c, k, j, i, hand l from d where hand > 0 union all select * from new) {TOLD}""")
def refined_compete(spark, sf_dir):
    return _counts(_refined(spark, sf_dir, mode="compete", fill=False, grow=1, purity=0.2, bleed=1)[0])


@query(f"""with recursive {REFINE_SQL}, {BONE_PARTS} select cast(c as bigint) case_id, cast(dom as int) dominant, cast(t as bigint) voxels, round(m / t, 3) minority from sure where not ok""")
def fused_parts(spark, sf_dir):
    return _refined(spark, sf_dir, mode="compete", fill=False, purity=0.2, bleed=1)[2].select("case_id", "dominant", "voxels", "minority")


@query(f"""with recursive {REFINE_SQL}, {BONE_PARTS}, kept as (select b.* from bone b join named on named.c = b.c and a = b.k * 60 + b.j * 10 + b.i join (select distinct n.c, n.part from p join named n on n.c = p.c and n.a = p.k * 60 + p.j * 10 + p.i) m on m.c = b.c and m.part = named.part),
  n as (select g.c, g.k, g.j, g.i, p.pred l, row_number() over (partition by g.c, g.k, g.j, g.i order by pow(g.k - p.k, 2) + pow(g.j - p.j, 2) + pow(g.i - p.i, 2), p.pred) r from kept g join p on p.c = g.c),
  o as (select c, k, j, i, hand l from d where hand > 0 union all select c, k, j, i, l from n where r = 1) {TOLD}""")
def refined_resegment(spark, sf_dir):
    return _counts(_refined(spark, sf_dir, mode="resegment", fill=False)[0])
