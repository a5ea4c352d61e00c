"""More of the catalogue: a regression by descent and outlines against their ellipses."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import cohort, spikes
from volcohort.plans.catalogue import places, query, table
from volcohort.plans.volumes import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

STEPS = 40


@query(f"""with recursive d as (select c_acctbal / 10000.0 x, (c_nationkey - 12) / 12.0 z, case when (c_custkey * 7 + c_nationkey) % 25 > 12 - c_acctbal / 2000 then 1.0 else 0.0 end y from customer),
  w as (select 0 s, 0.0::double a, 0.0::double b, 0.0::double c union all select s + 1, a - 0.5 * (ga / n + 0.001 * a), b - 0.5 * (gb / n + 0.001 * b), c - 0.5 * gc / n
    from (select s, a, b, c, count(*) n, sum(e * x) ga, sum(e * z) gb, sum(e) gc from (select w.*, x, z, 1 / (1 + exp(-(a * x + b * z + c))) - y e from w, d where s < {STEPS}) group by s, a, b, c))
  select unnest(['balance', 'nation', 'constant']) feature, round(unnest([a, b, c]), 6) weight from w where s = {STEPS}""")
def logistic_weights(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_acctbal / 10000D x", "(c_nationkey - 12) / 12D z", "(c_custkey * 7 + c_nationkey) % 25 > 12 - c_acctbal / 2000 y")
    w = cohort.fit_logistic(c, ["x", "z"], "y", STEPS)
    return spark.createDataFrame([(n, round(float(v), 6)) for n, v in zip(("balance", "nation", "constant"), w, strict=True)], "feature string, weight double")


#: Bones like ellipses, with a spur in front that the supplier's key gives a length; one slice in three has it.
BONE = "if(pow((i - 10) / 7.0, 2) + pow((j - 8) / 5.5, 2) <= 1 or (i between 9 and 10 and j between 8 and 13 + c % 6 and k % 3 = 0), 20 + k div 4, 0)"
BONE_SQL = f"""v as (select s_suppkey c, 0.5 + s_nationkey % 3 * 0.4 si, 0.8 sj, id // 480 k, (id // 24) % 20 j, id % 24 i from supplier, range(3840) t(id)), b as (select *, {BONE.replace(" div ", " // ")} l from v),
n as (select c, l, avg(j) mj from b where l <> 0 group by c, l), fr as (select b.* from b join n on n.c = b.c and n.l = b.l where j > mj),
rim as (select x.c, x.l, x.k, any_value(x.i * x.si) x, any_value(x.j * x.sj) y from fr x left join fr y on x.c = y.c and x.l = y.l and x.k = y.k and abs(x.j - y.j) + abs(x.i - y.i) = 1 group by x.c, x.l, x.k, x.j, x.i having count(y.c) < 4),
m as (select c, l, k, count(*) n, avg(x) mx, avg(y) my, covar_samp(x, x) a, covar_samp(x, y) b, covar_samp(y, y) d from rim group by c, l, k having count(*) >= 12),
q as (select rim.c, rim.l, rim.k, sqrt((d * pow(x - mx, 2) - 2 * b * (x - mx) * (y - my) + a * pow(y - my, 2)) / (a * d - b * b)) rad, sqrt(pow(x - mx, 2) + pow(y - my, 2)) mm from rim join m on m.c = rim.c and m.l = rim.l and m.k = rim.k),
h as (select c, l, k, median(rad) med, median(mm) / median(rad) scale from q group by c, l, k),
r as (select q.c, q.l, q.k, count(*) n, max((rad - med) * scale) largest, quantile_cont((rad - med) * scale, 0.95) p95 from q join h on h.c = q.c and h.l = q.l and h.k = q.k group by q.c, q.l, q.k)"""


def _bones(spark, sf_dir):
    v = places(spark, sf_dir, 3840, "s_suppkey c").selectExpr("c", "cast(id div 480 as int) k", "cast((id div 24) % 20 as int) j", "cast(id % 24 as int) i")
    grids = table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "0.5D + s_nationkey % 3 * 0.4D si", "0.8D sj")
    return v.selectExpr("c case_id", "k", "j", "i", f"cast({BONE} as int) label"), grids


@query(f"""with {BONE_SQL} select cast(c as bigint) case_id, cast(l as int) "label", count(*) slices, round(max(largest), 2) spike, round(quantile_cont(p95, 0.95), 2) p95 from r group by c, l""")
def front_spikes(spark, sf_dir):
    return spikes.front_spikes(*_bones(spark, sf_dir), least=100, slice_least=20)
