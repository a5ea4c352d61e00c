"""More of the catalogue: releases, cohort panels and volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import cohort, distance, manifest, voxel
from volcohort.plans.catalogue import LINES_SQL, ORACLES, QUERIES, VOXEL_SQL, _lines, _voxels, query, table

__all__ = ["ORACLES", "QUERIES"]

FINALS_SQL = "(select o_orderkey k, case when o_orderkey % 5 = 0 then 'reject' when o_orderkey % 5 = 1 then 'corrected' else 'accept' end decision, case when o_orderkey % 10 = 1 then 'X' end corrected from orders where o_orderkey % 3 <> 2)"


@query(f"""select o.o_orderkey k, case when decision = 'corrected' then coalesce(corrected, o_orderstatus) else o_orderstatus end status, case when decision = 'corrected' then 'corrected' when decision is not null then 'reviewed' else 'source' end provenance
  from orders o left join {FINALS_SQL} f on f.k = o.o_orderkey where coalesce(decision, '') <> 'reject'""")
def apply_reviews(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    k = F.col("k")
    finals = o.where("k % 3 <> 2").select("k", F.when(k % 5 == 0, "reject").when(k % 5 == 1, "corrected").otherwise("accept").alias("decision"), F.when(k % 10 == 1, "X").alias("corrected"))
    return manifest.apply_reviews(o, finals, "k", "status")


@query("""select c.c_custkey k, case when n.n_nationkey is not null then n.n_name else c.c_mktsegment end segment, n.n_nationkey is not null touched from customer c left join nation n on n.n_nationkey = c.c_custkey""")
def override_by_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    patch = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("segment"))
    return manifest.override(c, patch, "k", ["segment"])


@query("""select token, min(fold) fold from (select p_size % 5 fold, p_partkey token from part) group by token""")
def held_out_folds(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("fold", F.col("p_size") % 5)
    docs = p.groupBy("fold").agg(F.collect_list("p_partkey").alias("x"))
    old = F.col("fold") < 2
    return manifest.held_out(docs.select("fold", F.when(old, F.col("x")).alias("val"), F.when(~old, F.col("x")).alias("val_tokens")))


@query("""select 'expanded' part, count(*) n from customer join orders on c_custkey = o_custkey union all select 'unmapped', count(*) from customer where not exists (select 1 from orders where o_custkey = c_custkey)""")
def expand_tokens(spark, sf_dir):
    cases = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("t"), "o_orderkey")
    found, lost = manifest.expand(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("t")), cases, "t")
    count = lambda df, n: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("part"), "n")
    return count(found, "expanded").union(count(lost, "unmapped"))


@query("""with e as (select distinct 'f' || (o_orderkey % 5000) path from orders), f as (select 'f' || p_partkey path, p_size % 10 size from part)
  select coalesce(e.path, f.path) path, case when f.path is null then 'missing' when e.path is null then 'unnamed' else 'empty' end state from e full join f on e.path = f.path where f.path is null or e.path is null or f.size = 0""")
def manifest_files(spark, sf_dir):
    e = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), F.col("o_orderkey") % 5000).alias("path"))
    f = table(spark, sf_dir, "part").select(F.concat(F.lit("f"), "p_partkey").alias("path"), (F.col("p_size") % 10).alias("size"))
    return manifest.check_files(e, f, "path", "size")


OFFSETS_SQL = f"(select k, n, cast(q as int) % 4 - 1 d from {LINES_SQL})"


@query(f"""with g as (select k, count(distinct d) nd, count(case when d = 0 then 1 end) m, min(n + d) lo, max(n + d) hi, count(*) - count(distinct n + d) same from {OFFSETS_SQL} group by k),
  r as (select k, case when m > 0 then 'has_matches' when nd > 1 then 'several_deltas' when lo < 1 or hi > 7 then 'out_of_range' when same > 0 then 'duplicate_targets' else '' end reason from g)
  select k, case when reason = '' then 'auto' else 'manual' end plan, reason from r""")
def remap_plan(spark, sf_dir):
    x = _lines(spark, sf_dir).withColumn("d", F.col("q").cast("int") % 4 - 1).withColumn("m", F.col("d") == 0)
    return manifest.remap_plan(x, "k", "d", "m", "n", 1, 7)


@query(f"""with c as (select k, d, count(*) n from {OFFSETS_SQL} where d <> 0 group by k, d), r as (select *, row_number() over (partition by k order by n desc, d) r from c) select k, n >= 3 misnumbered, d, n from r where r = 1""")
def misnumber_verdict(spark, sf_dir):
    return manifest.misnumbered(_lines(spark, sf_dir).withColumn("d", F.col("q").cast("int") % 4 - 1), "k", "d")


@query("""select o_orderkey, o_custkey from (select *, row_number() over (partition by o_custkey order by o_orderkey) r from orders) where r = 1""")
def first_record(spark, sf_dir):
    return manifest.first_of(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("""select c_mktsegment, count(case when c_nationkey < 12 then 1 end) n_a, count(case when c_nationkey >= 12 then 1 end) n_b, median(case when c_nationkey < 12 then c_acctbal end) median_a, median(case when c_nationkey >= 12 then c_acctbal end) median_b,
  round(median(case when c_nationkey < 12 then c_acctbal end) - median(case when c_nationkey >= 12 then c_acctbal end), 6) difference from customer group by c_mktsegment having n_a >= 10 and n_b >= 10""")
def group_difference(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("side", F.when(F.col("c_nationkey") < 12, "a").otherwise("b"))
    return cohort.difference(c, ["c_mktsegment"], "side", "a", "b", "c_acctbal", 10).withColumn("difference", F.round("difference", 6))


@query("""select count(*) n, round(100.0 * count(case when p_size % 10 = 0 then 1 end) / count(*), 6) share_of_zeros, round(500.0 * count(case when p_size % 5 = 0 then 1 end) / count(*), 6) "index" from part where p_size between 11 and 48""")
def age_heaping(spark, sf_dir):
    return cohort.heaping(table(spark, sf_dir, "part"), "p_size", 11, 48).select("n", F.round("share_of_zeros", 6).alias("share_of_zeros"), F.round("index", 6).alias("index"))


@query("""select p_brand, p_size // 10 as "decade", count(*) n, round(100.0 * count(case when p_retailprice < 950 then 1 end) / count(*), 6) percent from part group by 1, 2 having count(*) >= 5""")
def low_share_cells(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("decade", F.floor(F.col("p_size") / 10).cast("int"))
    return cohort.shares(p, ["p_brand", "decade"], F.col("p_retailprice") < 950, 5).withColumn("percent", F.round("percent", 6))


@query("""select c_mktsegment, count(case when pos then 1 end) positives, count(case when pos and r <= 20 then 1 end) hits from (select c_mktsegment, c_nationkey % 7 = 0 pos, row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) r from customer) group by c_mktsegment""")
def hits_at_k(spark, sf_dir):
    return cohort.hits_at(table(spark, sf_dir, "customer").withColumn("pos", F.col("c_nationkey") % 7 == 0), ["c_mktsegment"], "c_acctbal", "pos", "c_custkey", 20)


@query()
def discriminant_scores(spark, sf_dir):
    """Documents projected on the linear discriminant of their quality labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("x0"), F.size(F.split("text", " ")).alias("x1"), F.size(F.split("text", "\n")).alias("x2"))
    names = ["x0", "x1", "x2"]
    held = d.join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id")
    return cohort.project(d, names, cohort.fisher_direction(held, names, "good"), "score").select("doc_id", F.round("score", 6).alias("score"))


@query("""select g subgroup, count(*) n from (select unnest(list_filter([case when true then 'all' end, case when c_acctbal < 0 then 'debt' end, case when c_nationkey < 5 then 'near' end, case when c_acctbal < 0 and c_nationkey < 5 then 'both' end], lambda x: x is not null)) g from customer) group by g""")
def overlapping_groups(spark, sf_dir):
    debt, near = F.col("c_acctbal") < 0, F.col("c_nationkey") < 5
    return manifest.membership(table(spark, sf_dir, "customer"), ("all", F.lit(True)), ("debt", debt), ("near", near), ("both", debt & near)).groupBy("subgroup").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL}, m as (select a.c, a.k, a.i, a.l x, b.l y, o.l o from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i join O o on a.c = o.c and a.k = o.k and a.j = o.j and a.i = o.i where a.l <> 0 or b.l <> 0 or o.l <> 0),
  s as (select c, k, i, x, y, case when x = y then 'agree' when y = o then 'only_a' when x = o then 'only_b' else 'conflict' end state, case when x = y then x when y = o then x when x = o then y end l from m),
  r as (select c, state, case when state = 'conflict' and (x = 0) <> (y = 0) and i * 30 + k >= 200 then greatest(x, y) when state = 'conflict' and (x = 0) <> (y = 0) and i * 30 + k < 100 then 0 else l end l from s)
  select cast(c as int) case_id, state, coalesce(l, -1) as "label", count(*) n from r group by 1, 2, 3""")
def hu_resolution(spark, sf_dir):
    a, b, o = _voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9), _voxels(spark, sf_dir, 3, 9, 8)
    hu = a.select(*voxel.AT, (F.col("i") * 30 + F.col("k")).alias("hu"))
    r = voxel.settle_conflicts(voxel.three_way(o, a, b), a, b, hu)
    return r.groupBy("case_id", "state", F.coalesce("label", F.lit(-1)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL}, s as (select c, l, k, count(*) n from A where l <> 0 group by c, l, k) select cast(c as int) case_id, l as "label", count(*) parts, round(max(n) / sum(n), 9) share from s group by c, l""")
def largest_component(spark, sf_dir):
    return voxel.largest_share(voxel.components(_voxels(spark, sf_dir, 3, 8)))


@query(f"""with {VOXEL_SQL},  sa as (select a.c, a.k, a.j, a.i, a.l from A a left join A b on a.c = b.c and a.l = b.l and abs(a.k - b.k) + abs(a.j - b.j) + abs(a.i - b.i) = 1 where a.l <> 0 group by all having count(b.l) < 6),
  sb as (select a.c, a.k, a.j, a.i, a.l from B a left join B b on a.c = b.c and a.l = b.l and abs(a.k - b.k) + abs(a.j - b.j) + abs(a.i - b.i) = 1 where a.l <> 0 group by all having count(b.l) < 6),
  d as (select x.c, x.l, x.k, x.j, x.i, sqrt(min(pow((x.k - y.k) * (1 + n.s_nationkey % 3), 2) + pow((x.j - y.j) * 1.5, 2) + pow((x.i - y.i) * (1 + n.s_suppkey % 2), 2))) d from sa x join sb y on x.c = y.c and x.l = y.l join supplier n on n.s_suppkey = x.c group by all
    union all select x.c, x.l, x.k, x.j, x.i, sqrt(min(pow((x.k - y.k) * (1 + n.s_nationkey % 3), 2) + pow((x.j - y.j) * 1.5, 2) + pow((x.i - y.i) * (1 + n.s_suppkey % 2), 2))) d from sb x join sa y on x.c = y.c and x.l = y.l join supplier n on n.s_suppkey = x.c group by all)
  select cast(c as int) case_id, l as "label", round(avg(d), 6) assd, round(quantile_cont(d, 0.95), 6) hd95 from d group by c, l""")
def surface_distance(spark, sf_dir):
    return distance.surface_distances(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9), _spacing(spark, sf_dir))


def _spacing(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as int) case_id", "1 + s_nationkey % 3 sk", "1.5 sj", "1 + s_suppkey % 2 si")


@query(f"""with {VOXEL_SQL}, ba as (select c, l, min(k) k0, max(k) k1, min(j) j0, max(j) j1, min(i) i0, max(i) i1 from A where l <> 0 group by c, l), bb as (select c, l, min(k) k0, max(k) k1, min(j) j0, max(j) j1, min(i) i0, max(i) i1 from B where l <> 0 group by c, l)
  select cast(a.c as int) case_id, a.l a, b.l b, round((least(a.k1, b.k1) - greatest(a.k0, b.k0) + 1) * (least(a.j1, b.j1) - greatest(a.j0, b.j0) + 1) * (least(a.i1, b.i1) - greatest(a.i0, b.i0) + 1) / ((a.k1 - a.k0 + 1) * (a.j1 - a.j0 + 1) * (a.i1 - a.i0 + 1)), 9) share
  from ba a join bb b on a.c = b.c and a.k0 <= b.k1 and b.k0 <= a.k1 and a.j0 <= b.j1 and b.j0 <= a.j1 and a.i0 <= b.i1 and b.i0 <= a.i1""")
def box_overlap(spark, sf_dir):
    ends = [f(c).alias(f"{c}{e}") for c in "kji" for f, e in ((F.min, 0), (F.max, 1))]
    boxes = lambda v: v.where("label <> 0").groupBy("case_id", F.col("label").alias("id")).agg(*ends)
    return voxel.box_overlap(boxes(_voxels(spark, sf_dir, 3, 8)), boxes(_voxels(spark, sf_dir, 4, 9)))
