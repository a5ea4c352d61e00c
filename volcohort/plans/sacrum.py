"""More of the catalogue: the sacrum, on a volume for each supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import sacrum
from volcohort.plans.catalogue import places, query, table
from volcohort.plans.fits import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

#: A leaning block, the same on both sides of the middle, whose upper part is marked with holes in it.
LEAN = "if(i between 5 and 10 and j between 3 + (k * (1 + c % 3)) div 4 and 7 + (k * (1 + c % 3)) div 4, if(k > 8 + c % 3 and (i + 2 * j + k + c) % 4 > 0, 29, 26), 0)"
LEAN_SQL = f"""v as (select s_suppkey c, 1.0 + s_nationkey % 3 * 0.5 sy, 2.0 sz, id // 320 k, (id // 16) % 20 j, id % 16 i from supplier, range(5120) t(id)), w as (select *, {LEAN.replace(" div ", " // ")} l from v),
b as (select c, k, j, i, l, j * sy - 20 y, k * sz + 5 z from w where l <> 0),
m as (select c, avg(y) my, avg(z) mz, covar_samp(y, y) p, covar_samp(y, z) q, covar_samp(z, z) r from b group by c),
e as (select *, (p + r) / 2 h, sqrt(pow((p - r) / 2, 2) + q * q) g from m),
u as (select *, h + g l1, sqrt(q * q + pow(h + g - p, 2)) n1, sqrt(q * q + pow(h - g - p, 2)) n2 from e),
a as (select c, my, mz, case when abs(h + g - p) / n1 > 0.3 then q * sign(h + g - p) / n1 else q * sign(h - g - p) / n2 end ay, case when abs(h + g - p) / n1 > 0.3 then abs(h + g - p) / n1 else abs(h - g - p) / n2 end az from u),
t as (select b.*, round((y - my) * ay + (z - mz) * az, 9) t from b join a on a.c = b.c), cut as (select c, round(quantile_cont(t, 0.1), 9) cut from t where l = 29 group by c)"""


@query(f"""with {LEAN_SQL} select cast(t.c as bigint) case_id, cast(case when t.t >= cut then 29 else 26 end as int) "label", count(*) n, cast(sum(k) as bigint) k, cast(sum(j) as bigint) j from t join cut on cut.c = t.c group by 1, 2""")
def carved_tops(spark, sf_dir):
    v = places(spark, sf_dir, 5120, "s_suppkey c").selectExpr("c", "cast(id div 320 as int) k", "cast((id div 16) % 20 as int) j", "cast(id % 16 as int) i")
    v = v.selectExpr("c case_id", "k", "j", "i", f"cast({LEAN} as int) label").where("label <> 0")
    grids = table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "array(1.0D, 0D, 0D, -8D, 0D, 1.0D + s_nationkey % 3 * 0.5D, 0D, -20D, 0D, 0D, 2.0D, 5D, 0D, 0D, 0D, 1D) affine")
    return sacrum.carved(v, grids).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.sum("j").alias("j"))


#: A plate with canals through it, straight or not, two on each side; the supplier says how many are open and how they lie.
PLATE = """if(i between 3 and 26 and k between 2 and 17 and j between 2 and 11 and not (abs(i - 8) <= 1 and abs(k - 6) <= 1 + c % 2 and c % 5 > 0) and not (abs(i - 8) <= 1 and abs(k - 12) <= 1)
  and not (abs(i - 20) <= 1 and abs(k - 5 - (j * (c % 3)) div 6) <= 1) and not (i > 24 and abs(k - 13) <= 0 and c % 4 = 0), 26, 0)"""
GRIDS = "1.5D + s_nationkey % 2 si, 2.0D sj, 2.0D sk"
PLATE_SQL = f"""v as (select s_suppkey c, 1.5 + s_nationkey % 2 si, id // 420 k, (id // 30) % 14 j, id % 30 i from supplier, range(8400) t(id)), s as (select *, {PLATE.replace(" div ", " // ")} l from v),
mid as (select c, avg(i) mid from s where l = 26 group by c), y as (select unnest(range(2, 8)) y),
pr as (select distinct c, si, y, k, i from s, y where l = 26 and j >= y and j < y + 4), hw as (select distinct c, si, 1 hi, 1 hk from v),
gr as (select distinct p.c, p.y, p.k + a k, p.i + b i from pr p, range(-1, 2) d(a), range(-1, 2) f(b)),
cl as (select x.c, x.y, x.k, x.i from gr x join gr z on x.c = z.c and x.y = z.y and abs(x.k - z.k) <= 1 and abs(x.i - z.i) <= 1 group by all having count(*) = 9),
em as (select g.c, g.y, g.k, g.i from (select distinct v.c, y.y, k, i from v, y) g left join cl on cl.c = g.c and cl.y = g.y and cl.k = g.k and cl.i = g.i where cl.c is null),
ou as (select c, y, k, i from em where k = 0 and i = 0 union select e.c, e.y, e.k, e.i from ou o join em e on e.c = o.c and e.y = o.y and abs(e.k - o.k) + abs(e.i - o.i) = 1),
ho as (select g.c, g.y, g.k, g.i from (select distinct v.c, y.y, k, i from v, y) g anti join ou using (c, y, k, i) anti join pr using (c, y, k, i)),
li as (select x.c, x.y, x.k * 100 + x.i a, z.k * 100 + z.i b from ho x join ho z on x.c = z.c and x.y = z.y and abs(x.k - z.k) + abs(x.i - z.i) <= 1),
re as (select distinct c, y, a, a b from li union select r.c, r.y, r.a, l.b from re r join li l on l.c = r.c and l.y = r.y and l.a = r.b),
na as (select c, y, a, min(b) part from re group by c, y, a),
pa as (select na.c, na.y, part, count(*) * any_value(si) * 2.0 area, avg(a % 100) mi from na join (select distinct c, si from v) q on q.c = na.c group by na.c, na.y, part),
co as (select pa.c, y, count(*) filter (mi <= mid) lf, count(*) filter (mi > mid) rt, median(area) area from pa join mid on mid.c = pa.c where area between 8 and 700 group by pa.c, y),
be as (select *, row_number() over (partition by c order by lf + rt desc, y) r from co)"""


@query(f"""with recursive {PLATE_SQL} select cast(mid.c as bigint) case_id, coalesce(lf, 0) "left", coalesce(rt, 0) "right", coalesce(cast(area as double), 0) area, (y - 2) * 2.0::double "offset" from mid left join be on be.c = mid.c and be.r = 1""")
def sacral_openings(spark, sf_dir):
    v = places(spark, sf_dir, 8400, "s_suppkey c").selectExpr("c", "cast(id div 420 as int) k", "cast((id div 30) % 14 as int) j", "cast(id % 30 as int) i")
    v = v.selectExpr("c case_id", "k", "j", "i", f"cast({PLATE} as int) label").where("label <> 0")
    return sacrum.openings(v, table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", *GRIDS.split(", ")), least=100, view=50)
