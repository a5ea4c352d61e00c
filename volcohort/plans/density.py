"""More of the catalogue: labels against density, fitted shapes, errors near surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import density, voxel
from volcohort.plans.catalogue import VOXEL_SQL, _voxels, ledger_status, query
from volcohort.plans.reviewing import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

#: A density by rule on the grid of the volumes.
HU_SQL = "cast(i * 40 + j * 10 - k * 20 - 150 as int)"


def _hu(spark, sf_dir):
    return _voxels(spark, sf_dir, 3, 8).select(*voxel.AT, F.expr(HU_SQL).alias("hu"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", count(*) voxels, round(100.0 * count(case when {HU_SQL} > 200 then 1 end) / count(*), 1) percent from A where l <> 0 group by c, l""")
def bone_percent(spark, sf_dir):
    return density.bone_percent(_voxels(spark, sf_dir, 3, 8), _hu(spark, sf_dir))


@query(f"""with {VOXEL_SQL}, x as (select c, l <> 0 s, {HU_SQL} hu from A) select cast(c as int) case_id, round(count(case when s and hu <= 200 then 1 end) / count(case when s then 1 end), 9) off_bone,
  round(count(case when s and hu < -50 then 1 end) / count(case when s then 1 end), 9) background, round(count(case when not s and hu > 200 then 1 end) / count(case when hu > 200 then 1 end), 9) missed from x group by c""")
def bone_leak(spark, sf_dir):
    return density.leaks(_voxels(spark, sf_dir, 3, 8), _hu(spark, sf_dir))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, quantile_cont({HU_SQL}, 0.1) threshold from A where i - s between 4 and 7 and j between 4 and 8 and k between 1 and 6 group by c""")
def calibrated_threshold(spark, sf_dir):
    return density.calibrated(_voxels(spark, sf_dir, 3, 8), _hu(spark, sf_dir))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", min(k) k0, max(k) k1, count(distinct k) slices from A where l <> 0 group by c, l""")
def slice_profile(spark, sf_dir):
    p = density.profile(_voxels(spark, sf_dir, 3, 8))
    return p.select("case_id", "label", F.col("k0").cast("long").alias("k0"), F.col("k1").cast("long").alias("k1"), "slices")


@query(f"""with {VOXEL_SQL}, e as (select a.c, a.k, a.j, a.i from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i where (a.l = 21) <> (b.l = 21)) select cast(c as int) case_id, count(*) errors, count(*) near, cast(1 as double) share from e group by c""")
def boundary_errors(spark, sf_dir):
    return density.boundary_share(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9), 21)


@query(f"""with {VOXEL_SQL}, p as (select *, row_number() over (partition by c, l order by k, j, i) - 1 r from A where l <> 0)
  select cast(p.c as int) case_id, p.l as "label", round(sqrt(max(pow(p.k - q.k, 2) + pow(p.j - q.j, 2) + pow(p.i - q.i, 2))), 6) extent from p join p q on p.c = q.c and p.l = q.l where p.r % greatest(1, (select count(*) from p z where z.c = p.c and z.l = p.l) // 300) = 0 and q.r % greatest(1, (select count(*) from p z where z.c = q.c and z.l = q.l) // 300) = 0 group by p.c, p.l""")
def longest_extent(spark, sf_dir):
    return density.longest_extent(_voxels(spark, sf_dir, 3, 8))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", round(avg(k), 6) k, round(avg(j), 6) j, round(avg(i), 6) i, cast(1 as double) along_k from A where l <> 0 and k < 3 group by c, l""")
def fitted_planes(spark, sf_dir):
    p = density.planes(_voxels(spark, sf_dir, 3, 8).where("label <> 0 and k < 3"))
    at = lambda c, n: F.round(F.get(F.col(c), F.lit(n)), 6)
    return p.select("case_id", "label", at("centre", 0).alias("k"), at("centre", 1).alias("j"), at("centre", 2).alias("i"), at("normal", 0).alias("along_k"))


@query()
def fitted_spheres(spark, sf_dir):
    return density.fit_spheres(voxel.surface(_voxels(spark, sf_dir, 3, 8)))


@query()
def bright_objects(spark, sf_dir):
    return density.bright_objects(_voxels(spark, sf_dir, 3, 8), _hu(spark, sf_dir), 200, 2, 10).select("case_id", F.array_join(F.transform("touched", lambda x: x.cast("string")), ",").alias("touched"), "voxels")


@query(f"select status, count(*) n, cast(sum(n_done) as bigint) submitted from ({ORACLES['ledger_status']}) group by status")
def status_summary(spark, sf_dir):
    return ledger_status(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("n_done").alias("submitted"))
