"""More of the catalogue: ribs, morphology and reviewing."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import coerce, geometry, review
from volcohort.operators import morphology, ribs, voxel
from volcohort.plans.catalogue import _voxels, query, table
from volcohort.plans.release import ORACLES, QUERIES, VOXEL_SQL

__all__ = ["ORACLES", "QUERIES"]

RIBS_SQL = "(select l_orderkey c, case when l_linenumber % 2 = 0 then 'L' else 'R' end s, cast(l_suppkey % 12 + 1 as int) n, min(l_quantity) z from lineitem group by 1, 2, 3)"


def _ribs(spark, sf_dir):
    side = F.when(F.col("l_linenumber") % 2 == 0, "L").otherwise("R")
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("case"), side.alias("side"), (F.col("l_suppkey") % 12 + 1).cast("int").alias("n")).agg(F.min("l_quantity").alias("z"))


@query(f"""with d as (select *, lag(z) over (partition by c, s order by n) - z dz, n - lag(n) over (partition by c, s order by n) dn from {RIBS_SQL}), p as (select *, median(case when dz > 0 then dz / dn end) over (partition by c, s) p from d)
  select c "case", s side, n, case when dz <= 0 then 'order' else 'span' end fault from p where dz <= 0 or dz > 1.8 * p * dn""")
def rib_order_faults(spark, sf_dir):
    return ribs.order_faults(_ribs(spark, sf_dir), "n", "z")


@query(f"""with g as (select c, list_sort(list_distinct(list(n) filter (s = 'L'))) l, list_sort(list_distinct(list(n) filter (s = 'R'))) r from {RIBS_SQL} group by c)
  select c "case", len(list_filter(coalesce(l, []), lambda x: not list_contains(coalesce(r, []), x))) n_left, len(list_filter(coalesce(r, []), lambda x: not list_contains(coalesce(l, []), x))) n_right,
  n_left + n_right > 2 unequal from g""")
def rib_side_difference(spark, sf_dir):
    d = ribs.side_difference(_ribs(spark, sf_dir), "n")
    return d.select("case", F.size("only_left").cast("long").alias("n_left"), F.size("only_right").cast("long").alias("n_right"), "unequal")


@query(f"""select c "case", count(distinct n) n, max(n) - min(n) + 1 - count(distinct n) gap, count(*) - count(distinct n) doubled from {RIBS_SQL} group by c""")
def rib_structure(spark, sf_dir):
    return ribs.structure(_ribs(spark, sf_dir), "n")


@query(f"""with p as (select a.c, a.s, a.n v, b.n rib, round(abs(a.z - b.z) + 0.1 * abs(a.n - b.n), 6) d from {RIBS_SQL} a join {RIBS_SQL} b on a.c = b.c and a.s = b.s), r as (select *, row_number() over (partition by c, s, v order by d, rib) r, lead(d) over (partition by c, s, v order by d, rib) nx from p),
  g as (select c, s, min(v - rib) delta, count(*) votes, count(distinct v - rib) = 1 agreed from r where r = 1 and (nx is null or nx > 2.5 * d) group by c, s) select c "case", s side, case when agreed then delta end delta, votes, agreed from g""")
def rib_votes(spark, sf_dir):
    a = _ribs(spark, sf_dir)
    b = a.select("case", "side", F.col("n").alias("rib"), F.col("z").alias("rz"))
    d = a.join(b, ["case", "side"]).select("case", "side", F.col("n").alias("vertebra"), "rib", F.round(F.abs(F.col("z") - F.col("rz")) + 0.1 * F.abs(F.col("n") - F.col("rib")), 6).alias("dist"))
    return ribs.votes(d)


@query(f"""with l as (select * from {RIBS_SQL} where n % 3 = 0), a as (select * from {RIBS_SQL} where n % 3 <> 0), p as (select l.c, l.s, l.n piece, l.z, a.n rib, a.z rz, row_number() over (partition by l.c, l.s, l.n order by abs(l.z - a.z), a.n) r from l join a on l.c = a.c and l.s = a.s)
  select c "case", s side, piece, cast(greatest(1, least(12, rib + round_even((rz - z) / case when c % 2 = 0 then 5.0 else 20.0 end, 0))) as int) number from p where r = 1""")
def rib_extrapolation(spark, sf_dir):
    r = _ribs(spark, sf_dir)
    loose = r.where("n % 3 = 0").select("case", "side", F.col("n").alias("piece"), "z")
    held = r.where("n % 3 <> 0").select("case", "side", F.col("n").alias("rib"), F.col("z").alias("rz"))
    step = r.where("case % 2 = 0").select("case", F.lit(5.0).alias("step")).distinct()
    return ribs.extrapolate(loose, held, step)


@query()
def rib_groups(spark, sf_dir):
    return ribs.group_pieces(_ribs(spark, sf_dir), 6.0)


@query(f"""with {VOXEL_SQL}, f as (select unnest([[0, 0, 0], [1, 0, 0], [-1, 0, 0], [0, 1, 0], [0, -1, 0], [0, 0, 1], [0, 0, -1]]) d), g as (select c, k + d[1] k, j + d[2] j, i + d[3] i, l, case when d[1] = 0 and d[2] = 0 and d[3] = 0 then 0 else 1 end far from A, f where l <> 0),
  m as (select c, k, j, i, arg_min(l, far * 1000 + l) l from g group by c, k, j, i) select cast(c as int) case_id, l as "label", count(*) n from m group by c, l""")
def dilated(spark, sf_dir):
    return morphology.dilate(_voxels(spark, sf_dir, 3, 8)).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL}, f as (select unnest([[1, 1], [1, -1], [1, 0], [0, 1], [0, -1], [-1, 0], [-1, 1], [-1, -1]]) d), s as (select a.c, a.k, a.j, a.i, a.l, count(b.l) n from A a, f left join A b on b.c = a.c and b.k = a.k and b.j = a.j + d[1] and b.i = a.i + d[2] and b.l = a.l where a.l <> 0 group by all)
  select cast(c as int) case_id, l as "label", count(*) n from s where n = 8 group by c, l""")
def eroded_in_plane(spark, sf_dir):
    flat = [t for t in voxel.ALL_26 if t[0] == 0]
    return morphology.erode(_voxels(spark, sf_dir, 3, 8), 1, flat).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", count(*) n from A where l <> 0 and i = 7 and j between 5 and 6 group by c, l""")
def filled_holes(spark, sf_dir):
    hole = (F.col("i") == 7) & F.col("j").between(5, 6)
    return morphology.fill_slices(_voxels(spark, sf_dir, 3, 8).where(~hole)).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", round(avg(k), 6) k, round(avg(j), 6) j, round(avg(i), 6) i from A where l <> 0 group by c, l""")
def label_centroids(spark, sf_dir):
    return morphology.centroids(_voxels(spark, sf_dir, 3, 8)).select("case_id", "label", *[F.round(c, 6).alias(c) for c in "kji"])


@query(f"""with {VOXEL_SQL} select distinct cast(c as int) case_id, l as "label" from A where l <> 0 and k in (0, 7)""")
def clipped_labels(spark, sf_dir):
    return morphology.clipped(_voxels(spark, sf_dir, 3, 8), (8, 16, 16))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", count(*) n from A where k % 2 = 0 and j % 2 = 0 and i % 2 = 0 group by c, l""")
def strided(spark, sf_dir):
    return morphology.thin(_voxels(spark, sf_dir, 3, 8), 2).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, case when l = 20 and i > 5 then 30 else l end as "label", count(*) n from A group by 1, 2""")
def lateralized(spark, sf_dir):
    return morphology.lateralize(_voxels(spark, sf_dir, 3, 8), 20, 30, F.lit(5)).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", count(*) voxels, round(greatest(var_pop(k), var_pop(j), var_pop(i)), 6) longest from A where l <> 0 group by c, l""")
def principal_axes(spark, sf_dir):
    p = morphology.principal_axes(_voxels(spark, sf_dir, 3, 8))
    return p.select("case_id", "label", "voxels", F.round(F.col("length") * F.col("length"), 6).alias("longest"))


@query("""select o_orderkey, case when o_orderkey % 4 = 0 then 'not_ok' when o_orderkey % 8 = 2 then 'note' when o_orderkey % 8 = 6 then 'blocking' else 'accepted' end reason from orders""")
def auto_accepted(spark, sf_dir):
    k = F.col("o_orderkey")
    lines = lambda *m: F.array(*[F.lit(x).cast("string") for x in m])
    messages = F.when(k % 8 == 1, lines().cast("array<string>")).when(k % 8 == 2, lines("OK: fine", " ", "note: L6 suspected")).when(k % 8 == 6, lines(None, "X gap", "note: L6"))
    messages = messages.otherwise(lines("OK", "NOTE: rib 12 clipped by the scan edge"))
    _, reason = review.auto_accept(k % 4 != 0, messages)
    return table(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"))


@query("""select c_custkey, case when age is null then null else least(89, case unit when 'M' then age // 12 when 'W' then age * 7 // 365 when 'D' then age // 365 else age end) end as "years",
  case c_custkey % 7 when 0 then null when 1 then 'supine' when 2 then 'prone' when 3 then 'decubitus_left' when 4 then 'decubitus_right' when 5 then 'sitting' else 'supine' end position,
  case when c_custkey % 5 = 0 then 'a_b-' || c_custkey else lpad(cast(c_custkey as varchar), cast(greatest(4, len(cast(c_custkey as varchar))) as int), '0') end safe_name,
  case when c_custkey % 5 = 0 then 'a_b-' || c_custkey else '00' || c_custkey end || '__fused__r_' || c_nationkey || '__r1' review_key
  from (select *, case when c_custkey % 11 = 0 then null else c_custkey % 700 end age, ['Y', 'M', 'W', 'D', ''][c_custkey % 5 + 1] unit from customer)""")
def coded_fields(spark, sf_dir):
    k = F.col("c_custkey")
    unit = F.get(F.array(*[F.lit(x) for x in ("Y", "m", " W", "d ", "")]), (k % 5).cast("int"))
    age = F.when(k % 11 == 0, F.lit("none")).otherwise(F.concat(F.lit(" "), (k % 700).cast("string"), unit))
    code = F.get(F.array(*[F.lit(x) for x in ("", "HFS", " ffp", "HFDL", "FFDR", "Sitting", "FFS")]), (k % 7).cast("int"))
    token = F.when(k % 5 == 0, F.concat(F.lit("_a b-"), k)).otherwise(F.concat(F.lit("00"), k))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", coerce.years(age).cast("long").alias("years"), coerce.position(code).alias("position"), coerce.safe_name(token).alias("safe_name"),
        coerce.review_key(token, F.lit("fused"), F.concat(F.lit("r "), "c_nationkey")).alias("review_key"),
    )


@query("""select o_orderkey, len(list_filter([case when o_orderkey % 4 = 3 then 'd' end, case when o_orderkey % 5 = 0 then 's' end, case when o_orderkey % 7 = 0 then 'c' end, case when o_orderkey % 4 = 0 and o_orderkey % 7 <> 0 and o_orderkey % 3 > 0 then 'a' end], lambda x: x is not null)) n from orders""")
def review_violations(spark, sf_dir):
    k = F.col("o_orderkey")
    decision = F.when(k % 4 == 0, "accept").when(k % 4 == 1, "corrected").when(k % 4 == 2, "reject").otherwise("maybe")
    sha = F.when(k % 5 == 0, "x").otherwise(F.sha2(k.cast("string"), 256))
    changed = F.when(k % 7 == 0, F.lit(None)).otherwise(k % 3)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(review.violations(decision, sha, changed)).cast("long").alias("n"))


@query("""select s_suppkey, round(sqrt(pow(s_suppkey % 7, 2) + pow(s_nationkey, 2) + pow(s_suppkey % 3, 2)), 6) dist, s_suppkey % 4 <> 0 valid, cast(6 * (s_suppkey % 4) as double) det from supplier""")
def affine_checks(spark, sf_dir):
    k = F.col("s_suppkey")
    num = lambda x: F.lit(x).cast("double") if not hasattr(x, "cast") else x.cast("double")
    affine = F.array(*[num(x) for x in (2, 0, 0, 5, 0, k % 4, 0, 6, 0, 0, 3, 7, 0, 0, 0, 1)])
    here, there = F.array(*[num(x) for x in (k % 7, F.col("s_nationkey"), k % 3)]), F.array(num(0), num(0), num(0))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(geometry.distance(here, there), 6).alias("dist"), geometry.valid_affine(affine).alias("valid"), geometry.determinant(affine).alias("det"))
