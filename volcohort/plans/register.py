"""More of the catalogue: labels laid onto scans, on a volume for each supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import register
from volcohort.plans.catalogue import places, query, table
from volcohort.plans.sacrum import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

#: A shape that no flip leaves as it is, and a scan where it lies flipped and shifted as the supplier says, among other bone.
SHAPE = "({i} between 3 and 8 and {j} between 3 and 9 and {k} between 1 and 5 and ({j} < 6 or {i} < 5) and ({k} < 3 or {i} < 4 or {j} > 7))"
LABEL = SHAPE.format(i="i", j="j", k="k")
SCAN = "if(" + SHAPE.format(i="(if(c % 2 = 1, 15 - i, i) - 2 * (c % 3))", j="(if(c % 4 > 1, 15 - j, j) - 2 * (c % 2))", k="if(c % 8 > 3, 7 - k, k)") + " or (i * 7 + j * 3 + k * 5 + c) % 23 = 0, 300, 50)"
REGISTER_SQL = f"""v as (select s_suppkey c, id // 256 k, (id // 16) % 16 j, id % 16 i from supplier, range(2048) t(id)), hu as (select c, k, j, i, {SCAN} hu from v),
fl as (select f, f // 4 fi, (f // 2) % 2 fj, f % 2 fk from range(8) t(f)), mv as (select v.c, f, case when fi = 1 then 15 - i else i end i, case when fj = 1 then 15 - j else j end j, case when fk = 1 then 7 - k else k end k from v, fl where {LABEL}),
co as (select c, f, i // 2 i, j // 2 j, k // 2 k from mv where i % 2 = 0 and j % 2 = 0 and k % 2 = 0), bo as (select c, i // 2 i, j // 2 j, k // 2 k from hu where hu > 200 and i % 2 = 0 and j % 2 = 0 and k % 2 = 0),
cc as (select co.c, f, (bo.i - co.i + 8) % 8 di, (bo.j - co.j + 8) % 8 dj, (bo.k - co.k + 4) % 4 dk, count(*) n from co join bo on bo.c = co.c where (select count(*) from co x where x.c = co.c and x.f = co.f) >= 60 // 8 group by all),
sh as (select c, f, 2 * (di - case when di > 4 then 8 else 0 end) di, 2 * (dj - case when dj > 4 then 8 else 0 end) dj, 2 * (dk - case when dk > 2 then 4 else 0 end) dk from cc qualify row_number() over (partition by c, f order by n desc, di, dj, dk) = 1),
sc as (select sh.*, count(*) n, 100.0 * count(*) filter (hu > 200) / count(*) pct from sh join mv on mv.c = sh.c and mv.f = sh.f join hu on hu.c = mv.c and hu.k = mv.k + dk and hu.j = mv.j + dj and hu.i = mv.i + di group by all)"""


@query(f"""with {REGISTER_SQL} select cast(c as bigint) case_id, cast(f as int) flip, cast(di as int) di, cast(dj as int) dj, cast(dk as int) dk, n voxels, round(cast(pct as double), 6) "percent" from sc where n >= 60 and pct > 0 qualify row_number() over (partition by c order by pct desc, f) = 1""")
def laid_labels(spark, sf_dir):
    v = places(spark, sf_dir, 2048, "s_suppkey c").selectExpr("c", "cast(id div 256 as int) k", "cast((id div 16) % 16 as int) j", "cast(id % 16 as int) i")
    grids = table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "array(1D, 0D, 0D, 0D, 0D, 1D, 0D, 0D, 0D, 0D, 1D, 0D, 0D, 0D, 0D, 1D) affine", "16 ni", "16 nj", "8 nk")
    moving, hu = v.selectExpr("c case_id", "k", "j", "i", f"if({LABEL}, 5, 0) label"), v.selectExpr("c case_id", "k", "j", "i", f"{SCAN} hu")
    voxels, found = register.laid(moving, grids, hu, grids, 60, 2)
    n = voxels.groupBy("case_id").agg(F.count(F.lit(1)).alias("voxels"))
    return found.drop("voxels").join(n, "case_id").withColumn("percent", F.round("percent", 6))
