"""More of the catalogue: pairs of labelings, ledger transitions, access to cases, codes.

Volumes here are made from the lines of orders, so that their number grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.functions import calls, codes
from volcohort.operators import compare, dataset, transitions, voxel
from volcohort.operators.storage import staged
from volcohort.plans.catalogue import PLACES, query, table
from volcohort.plans.density import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

# --- two labelings of the volume of each order: one slice a line, four places along i ----------------------------------

CROP_SQL = """v as (select distinct l_orderkey c, l_linenumber k, l_suppkey % 4 j, i from lineitem, range(4) t(i)),
a as (select c, k, j, i, case when (k + i) % 3 = 0 then 0 when i = 3 then 5 + k % 3 else 34 + (k + j) % 5 end l from v),
b as (select c, k, j, i, case when (k * i + j) % 4 = 0 then 0 when i = 3 then 5 + (k + c) % 3 else 34 + (k + j + case when c % 3 = 0 and i > 1 then 1 else 0 end) % 5 end l from v),
m as (select a.c, a.k, a.j, a.i, a.l x, b.l y from a join b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i),
n as (select c, x, y, count(*) n from m group by c, x, y),
o as (select c, l, sum(case when x = l then n else 0 end) na, sum(case when y = l then n else 0 end) nb, sum(case when x = l and y = l then n else 0 end) z,
  sum(case when x = l and y = 0 then n else 0 end) ea, sum(case when y = l and x = 0 then n else 0 end) eb from (select *, unnest(case when x = y then [x] else [x, y] end) l from n) where l not in (0, 255) group by c, l)"""

A_RULE = "cast(case when (k + i) % 3 = 0 then 0 when i = 3 then 5 + k % 3 else 34 + (k + j) % 5 end as int)"
B_RULE = "cast(case when (k * i + j) % 4 = 0 then 0 when i = 3 then 5 + (k + case_id) % 3 else 34 + (k + j + case when case_id % 3 = 0 and i > 1 then 1 else 0 end) % 5 end as int)"


def _crops(spark, sf_dir, rule):
    li = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey case_id", "l_linenumber k", "cast(l_suppkey % 4 as int) j")
    # Dealt by case before the places are made, so that what follows by place or case needs no other shuffle.
    tasks = max(spark.sparkContext.defaultParallelism, -(-4 * li.count() // PLACES))
    lines = li.repartition(tasks, "case_id").distinct()
    return lines.selectExpr("*", "explode(array(0, 1, 2, 3)) i").withColumn("label", F.expr(rule))


def _pair(spark, sf_dir):
    return _crops(spark, sf_dir, A_RULE), _crops(spark, sf_dir, B_RULE)


@query(f"""with {CROP_SQL}, w as (select c, min(2.0 * z / (na + nb)) worst from o group by c), f as (select c, sum(case when x > 0 then n else 0 end) na, sum(case when y > 0 then n else 0 end) nb, sum(case when x > 0 and y > 0 then n else 0 end) z from n group by c)
  select f.c case_id, round(coalesce(2.0 * z / nullif(na + nb, 0), 1), 9) overall, round(coalesce(worst, 1), 9) worst, coalesce(worst, 1) >= 0.3 agree, coalesce(2.0 * z / nullif(na + nb, 0), 1) >= 0.7 agree_overall from f left join w on f.c = w.c""")
def reviewer_agreement(spark, sf_dir):
    cell = staged(compare.cells(*_pair(spark, sf_dir)), "cells")
    one, all_ = compare.agreement_of_cells(cell, 0.3), compare.agreement_of_cells(cell, 0.7, overall=True)
    both = one.select("case_id", "worst", "agree").join(all_.select("case_id", F.col("metric").alias("overall"), F.col("agree").alias("agree_overall")), "case_id")
    return both.select("case_id", F.round("overall", 9).alias("overall"), F.round("worst", 9).alias("worst"), "agree", "agree_overall")


@query(f"""with {CROP_SQL} select c case_id, cast(l as int) "label", case when (case when na >= nb then ea / na else eb / nb end) >= 0.7 then 'MISSING' else 'RENUMBER' end kind from o where l between 34 and 57 and z = 0""")
def disjoint_classes(spark, sf_dir):
    return compare.disjoint_classes(compare.cells(*_pair(spark, sf_dir)))


@query(f"""with {CROP_SQL} select c case_id, count(distinct l) structures, count(*) voxels from a where l > 0 group by c""")
def label_completeness(spark, sf_dir):
    return compare.completeness(_crops(spark, sf_dir, A_RULE))


@query(f"""with {CROP_SQL} select distinct c case_id, cast(l as int) "label" from (select c, l from a union all select c, l from b) where l not in (0, 255)""")
def classes_present(spark, sf_dir):
    return compare.classes_present(*_pair(spark, sf_dir))


@query(f"""with {CROP_SQL} select c case_id, k, count(case when y = 0 then 1 end) removed, count(case when x = 0 then 1 end) added, count(case when x <> 0 and y <> 0 then 1 end) relabelled from m where x <> y group by c, k""")
def slice_changes(spark, sf_dir):
    return compare.busiest_slices(*_pair(spark, sf_dir))


@query(f"""with {CROP_SQL}, w as (select c, coalesce(cast(round_even(avg(case when x = 5 then k end), 0) as int), max(case when x = 7 then k end)) z from m group by c), q as (select c, z, greatest(0, z - (2 + c % 2)) lo, least(6 + c % 3, z + 2 + c % 2) hi from w where z is not null),
  s as (select q.c, z, lo, hi, x, y from q join m on m.c = q.c and m.k >= lo and m.k < hi), t as (select c, z, lo, hi, count(case when x in (5, 6, 7) then 1 end) n, count(case when x in (5, 6, 7) and x <> y then 1 end) w,
  count(case when x = 5 then 1 end) x5, count(case when y = 5 then 1 end) y5, count(case when x = 5 and y = 5 then 1 end) z5, count(case when x = 6 then 1 end) x6, count(case when y = 6 then 1 end) y6, count(case when x = 6 and y = 6 then 1 end) z6,
  count(case when x = 7 then 1 end) x7, count(case when y = 7 then 1 end) y7, count(case when x = 7 and y = 7 then 1 end) z7, count(case when x = 5 and y = 7 then 1 end) a, count(case when x = 7 and y = 5 then 1 end) b from s group by c, z, lo, hi)
  select c case_id, z centre, cast(lo as int) lo, cast(hi as int) hi, n voxels, round(list_avg(list_filter([2.0 * z5 / nullif(x5 + y5, 0), 2.0 * z6 / nullif(x6 + y6, 0), 2.0 * z7 / nullif(x7 + y7, 0)], lambda d: d is not null)), 4) dsc,
  round(w / nullif(n, 0), 4) error, round(a / nullif(x5, 0), 4) l5_as_sacrum, round(b / nullif(x7, 0), 4) sacrum_as_l5, y6 > 0 has_l6 from t""")
def border_analysis(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    return compare.border(b, a, _grids(spark, sf_dir))


def _grids(spark, sf_dir):
    """Slices 10 or 8 mm apart: windows of 2 or 3 slices on either side."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey case_id", "if(o_orderkey % 2 = 0, 10.0, 8.0) spacing", "cast(6 + o_orderkey % 3 as int) slices")


@query(f"""with {CROP_SQL}, w as (select c, coalesce(cast(round_even(avg(case when x = 5 then k end), 0) as int), max(case when x = 7 then k end)) z from m group by c)
  select m.c case_id, x truth, y pred, count(*) n from m join w on m.c = w.c where z is not null and x in (5, 6, 7) and m.k >= greatest(0, z - (2 + m.c % 2)) and m.k < least(6 + m.c % 3, z + 2 + m.c % 2) group by m.c, x, y""")
def border_confusion(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    return compare.border_confusion(b, a, _grids(spark, sf_dir))


@query(f"""select count(*) n, round(avg(dsc), 4) dsc, round(avg(error), 4) error, round(avg(l5_as_sacrum), 4) l5_as_sacrum, round(avg(sacrum_as_l5), 4) sacrum_as_l5, count(case when has_l6 then 1 end) with_l6 from ({ORACLES['border_analysis']})""")
def border_summary(spark, sf_dir):
    return compare.border_summary(border_analysis(spark, sf_dir))


@query(f"""with {CROP_SQL}, g as (select c, sum(case when x <> y and (x between 1 and 33 or y between 1 and 33) then n else 0 end) n, list_sort(list_distinct(list(case when x between 1 and 33 then x end))) p, list_sort(list_distinct(list(case when y between 1 and 33 then y end))) q from n group by c)
  select c case_id, cast(n as bigint) changed, coalesce(list_aggregate(list_filter(q, lambda v: not list_contains(p, v)), 'string_agg', ','), '') added, coalesce(list_aggregate(list_filter(p, lambda v: not list_contains(q, v)), 'string_agg', ','), '') removed, n <= 2 or c % 7 = 0 ok from g""")
def bones_untouched(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    u = compare.untouched(a, b, 2, table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("case_id")))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return u.select("case_id", "changed", text("added"), text("removed"), "ok")


def _counted(v):
    return v.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {CROP_SQL}, r as (select c, case when x between 34 and 57 then 0 else x end u, y from m) select c case_id, cast(l as int) "label", count(*) n from (select c, case when u = 0 and y between 34 and 57 then y else u end l from r) where l <> 0 group by c, l""")
def ribs_of_edit(spark, sf_dir):
    return _counted(compare.with_ribs_of(*_pair(spark, sf_dir)))


@query(f"""with {CROP_SQL} select c case_id, cast(l as int) "label", count(*) n from (select c, case when x = 0 and y between 8 and 19 then y else x end l from (select c, x, case when y between 34 and 36 then y - 26 else y end y from m)) where l <> 0 group by c, l""")
def vertebrae_of_edit(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    return _counted(compare.with_vertebrae_of(a, b.withColumn("label", F.when(F.col("label").between(34, 36), F.col("label") - 26).otherwise(F.col("label")))))


@query(f"""with {CROP_SQL} select c case_id, cast(l as int) "label", count(*) n from (select c, case when x >= 34 or y >= 34 then x else y end l from m) where l <> 0 group by c, l""")
def bones_of_edit(spark, sf_dir):
    return _counted(compare.with_bones_of(*_pair(spark, sf_dir)))


@query(f"""with {CROP_SQL}, p as (select c, k + 1 k, j, i, l from b where c % 2 = 0) select coalesce(a.c, p.c) case_id, cast(coalesce(p.l, a.l) as int) "label", count(*) n from a full join p on a.c = p.c and a.k = p.k and a.j = p.j and a.i = p.i group by 1, 2""")
def pasted_crops(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    origin = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("case_id"), F.lit(1).alias("k0"), F.lit(0).alias("j0"), F.lit(0).alias("i0"))
    return _counted(compare.paste(a, b, origin))


WEIGHTS_SQL = "case when c % 4 = 0 then 2.0 when c % 4 = 1 then 0.5 else 1.0 end"
MERGED_SQL = f"""t as (select c, k, j, i, 34 + k % 3 o, x, y, case when x = y then x when y = 34 + k % 3 then x when x = 34 + k % 3 then y end l from m),
s as (select *, case when l is null and (x = 0) <> (y = 0) then (case when j >= 2 then greatest(x, y) when j < 1 then 0 end) else l end l2 from t),
f as (select *, case when l2 is null and x <> 0 and y <> 0 and c % 5 > 0 then (case when {WEIGHTS_SQL} >= 1.5 then x when {WEIGHTS_SQL} <= 1 / 1.5 then y end) else l2 end l3 from s)"""


def _layers(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    base = a.withColumn("label", 34 + F.col("k") % 3)
    hu = a.select(*voxel.AT, (F.col("j") * 100).alias("hu"))
    wa = F.expr(WEIGHTS_SQL.replace("c %", "case_id %")).cast("double")
    return base, a, b, hu, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id")).where("case_id % 5 > 0").select("case_id", wa.alias("wa"), F.lit(1.0).alias("wb"))


@query(f"""with {CROP_SQL}, {MERGED_SQL} select c case_id, count(case when l is null then 1 end) conflicts, count(case when l is null and l2 is not null then 1 end) by_density, count(case when l2 is null and l3 is not null then 1 end) by_weight, count(case when l3 is null then 1 end) open from f group by c""")
def class_conflicts(spark, sf_dir):
    base, a, b, hu, weights = _layers(spark, sf_dir)
    none = F.col("label").isNull()
    # Each layer hands on what was open before it, so all three are worked out once.
    first = voxel.three_way(base, a, b).withColumn("_1", none)
    second = voxel.settle_conflicts(first, a, b, hu, also=("_1",)).withColumn("_2", none)
    third = compare.resolve_classes(second, a, b, weights, also=("_1", "_2"))
    open_ = third.groupBy("case_id").agg(F.count_if("_1").alias("_1"), F.count_if("_2").alias("_2"), F.count_if(none).alias("open"))
    # A case with several weights has as many rows a place, of which the first two layers count one.
    times = weights.groupBy("case_id").agg(F.count(F.lit(1)).alias("_n")).hint("merge")
    out = staged(open_.where("case_id is not null").join(times, "case_id", "left").fillna(1, ["_n"]).selectExpr("case_id", "_1 div _n conflicts", "_2 div _n _2", "open"), "layer")
    return out.select("case_id", "conflicts", (F.col("conflicts") - F.col("_2")).alias("by_density"), (F.col("_2") - F.col("open")).alias("by_weight"), "open")


# --- ledger transitions ------------------------------------------------------------------------------------------------

SLOT_SQL = """s as (select l_orderkey c, cast(l_linenumber as varchar) slot, 'r' || min(l_suppkey) % 9 reviewer, 't' || l_orderkey || '-' || l_linenumber token, min(l_quantity) > 40 done, min(l_quantity) % 5 = 0 amend,
  case when min(l_partkey) % 2 = 0 then 'own-' || l_orderkey end base from lineitem where l_linenumber <= 2 group by l_orderkey, l_linenumber),
q as (select c, slot, case when c % 5 = 0 then 'wrong' else token end token, 'r' || c % 9 reviewer_id, case when c % 2 = 0 then 'L6' else '' end reason from s where c % 3 = 0)"""


def _slots(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("p"), F.min("l_quantity").alias("q"), F.min("l_partkey").alias("b"))
    return li.selectExpr(
        "l_orderkey case_id", "cast(l_linenumber as string) slot", "concat('r', p % 9) reviewer", "concat('t', l_orderkey, '-', l_linenumber) claim_token", "timestamp'2024-01-01' claimed_at", "q > 40 done",
        "q % 5 = 0 amend", "if(b % 2 = 0, concat('own-', l_orderkey), null) amend_base",
    )


def _requests(slots):
    return slots.where("case_id % 3 = 0").selectExpr("case_id", "slot", "if(case_id % 5 = 0, 'wrong', claim_token) claim_token", "concat('r', case_id % 9) reviewer_id", "if(case_id % 2 = 0, 'L6', '') reason")


def _ledger_cases(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey case_id", "if(o_orderkey % 10 = 0, null, 'spine') region", "concat('v4-', o_orderkey) label_file", "cast(o_orderkey % 100 as int) priority", "if(o_orderkey % 4 = 0, null, array('r8')) deferred_by", "if(o_orderkey % 50 = 0, true, null) needs_expert", f"if(o_orderkey % 4 = 0, null, cast(array() as {transitions.REREADS})) rereads")


@query(f"""with {SLOT_SQL} select c case_id, slot, coalesce(base, 'v4-' || c) base from s where reviewer = 'r3' and amend and not done and c % 10 <> 0 order by c, slot limit 1""")
def amend_next(spark, sf_dir):
    return transitions.amend_next(_ledger_cases(spark, sf_dir), _slots(spark, sf_dir), "r3")


@query(f"""with {SLOT_SQL}, g as (select q.c, q.slot, s.reviewer from q join s on s.c = q.c and s.slot = q.slot and s.token = q.token and not s.done), w as (select c, list_sort(list_distinct(list(reviewer))) w from g group by c),
  l as (select c, count(*) n from s where not exists (select 1 from g where g.c = s.c and g.slot = s.slot) group by c)
  select o_orderkey case_id, coalesce(list_aggregate(list_concat(case when o_orderkey % 4 = 0 then [] else ['r8'] end, list_filter(coalesce(w, []), lambda x: o_orderkey % 4 = 0 or x <> 'r8')), 'string_agg', ','), '') deferred_by, coalesce(n, 0) slots from orders left join w on w.c = o_orderkey left join l on l.c = o_orderkey""")
def deferred(spark, sf_dir):
    slots = _slots(spark, sf_dir)
    cases, left, _ = transitions.defer(_ledger_cases(spark, sf_dir), slots, _requests(slots))
    n = left.groupBy("case_id").agg(F.count(F.lit(1)).alias("slots"))
    return cases.join(n, "case_id", "left").select("case_id", F.array_join("deferred_by", ",").alias("deferred_by"), F.coalesce("slots", F.lit(0)).alias("slots"))


@query(f"""with {SLOT_SQL}, g as (select q.c, q.slot, s.reviewer, s.done, case when reason = '' then '(no reason given)' else reason end reason from q join s on s.c = q.c and s.slot = q.slot and (s.token = q.token or s.reviewer = q.reviewer_id)),
  w as (select c, count(*) n, min(reason) why from g group by c), l as (select c, count(*) n from s where not exists (select 1 from g where g.c = s.c and g.slot = s.slot and not g.done) group by c)
  select o_orderkey case_id, o_orderkey % 50 = 0 or w.n is not null needs_expert, coalesce(w.n, 0) rereads, why, case when w.n is not null then timestamp '2024-02-01' end since, coalesce(l.n, 0) slots from orders left join w on w.c = o_orderkey left join l on l.c = o_orderkey""")
def flagged(spark, sf_dir):
    slots = _slots(spark, sf_dir)
    cases, left, _ = transitions.flag(_ledger_cases(spark, sf_dir), slots, _requests(slots), F.lit("2024-02-01"))
    n = left.groupBy("case_id").agg(F.count(F.lit(1)).alias("slots"))
    return cases.join(n, "case_id", "left").select("case_id", "needs_expert", F.size("rereads").cast("long").alias("rereads"), F.get("rereads", F.lit(0))["reason"].alias("why"), F.get("rereads", F.lit(0))["at"].cast("timestamp_ntz").alias("since"), F.coalesce("slots", F.lit(0)).alias("slots"))


ADJ_SQL = SLOT_SQL + """, p as (select c, 'adj' slot, 'a' || c % 4 reviewer, 'adj-' || c token, case when c % 6 = 0 then timestamp '2024-01-01' else timestamp '2024-01-09' end since, c % 8 = 0 done from (select distinct c from s) where c % 2 = 0)"""


def _adjudications(slots):
    cases = slots.select("case_id").distinct().where("case_id % 2 = 0")
    held = cases.selectExpr("case_id", "'adj' slot", "concat('a', case_id % 4) reviewer", "concat('adj-', case_id) claim_token", "if(case_id % 6 = 0, timestamp'2024-01-01', timestamp'2024-01-09') claimed_at", "case_id % 8 = 0 done", "false amend", "cast(null as string) amend_base")
    return slots.unionByName(held)


@query(f"""with {ADJ_SQL} select o_orderkey case_id from orders where o_orderpriority like '1%' and not exists (select 1 from s where s.c = o_orderkey and reviewer = 'r3') and not exists (select 1 from p where p.c = o_orderkey and reviewer <> 'a2' and since + interval 48 hours > timestamp '2024-01-10')""")
def adjudicable(spark, sf_dir):
    states = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), F.when(F.col("o_orderpriority").startswith("1"), "needs_adjudication").otherwise("in_review").alias("status"))
    slots = _adjudications(_slots(spark, sf_dir)).withColumn("reviewer", F.when(F.col("reviewer") == "a2", "r3").otherwise(F.col("reviewer")))
    return transitions.adjudicable(states, slots, "r3", F.lit("2024-01-10").cast("timestamp"), 48)


@query(f"""with {ADJ_SQL}, d as (select c, case when c % 10 = 0 then 'bad' else 'adj-' || c end token, case when c % 3 = 0 then 'reject' else 'accept' end decision, case when c % 7 <> 0 then 'l-' || c end lab from (select distinct c from s)),
  r as (select d.*, p.reviewer, case when p.token is null or p.token <> d.token then 'no open claim' when p.done then 'duplicate' when decision <> 'reject' and lab is null then 'no label' else 'done' end outcome from d left join p on p.c = d.c)
  select c case_id, outcome, case when outcome = 'done' then case when decision = 'reject' then 'reject' else 'corrected' end end final, case when outcome = 'done' then reviewer end by_, case when outcome = 'done' and decision <> 'reject' then lab end "label" from r""")
def adjudicated(spark, sf_dir):
    slots = _slots(spark, sf_dir)
    asked = slots.select("case_id").distinct().selectExpr("case_id", "if(case_id % 10 = 0, 'bad', concat('adj-', case_id)) claim_token", "if(case_id % 3 = 0, 'reject', 'accept') decision", "if(case_id % 7 <> 0, concat('l-', case_id), null) label")
    return transitions.adjudicate(_adjudications(slots), asked).withColumnRenamed("by", "by_")


@query("""select o_orderkey case_id, case when o_custkey % 10 = 0 then 999999 else cast(o_orderkey % 100 as int) end priority from orders""")
def set_priority(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").where("o_custkey % 10 = 0").select(F.col("o_orderkey").alias("case_id"))
    return transitions.set_priority(_ledger_cases(spark, sf_dir), wanted, 999999).select("case_id", "priority")


@query("""select o_orderkey case_id, o_orderkey % 9 = 0 or coalesce(case when o_orderkey % 4 < 3 then o_orderkey % 4 = 0 end, false) accepted,
  case when o_orderkey % 9 = 0 or o_orderkey % 4 = 0 then null when o_orderkey % 4 = 3 then 'the check did not run' when o_orderkey % 8 = 1 then 'X rib; X gap' else 'note' end reason from orders""")
def checked_submissions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), F.lit("1").alias("slot"))
    lines = lambda *m: F.array(*[F.lit(x) for x in m])
    checks = o.where("case_id % 4 < 3").select("case_id", "slot", (F.col("case_id") % 4 == 0).alias("ok"), F.when(F.col("case_id") % 8 == 1, lines("X rib", "note", "X gap")).otherwise(lines("note")).alias("messages"))
    return transitions.gate(o.withColumn("label", F.when(F.col("case_id") % 9 != 0, "l")), checks, "ribs").select("case_id", "accepted", "reason")


# --- access to cases ---------------------------------------------------------------------------------------------------

CASE_SQL = """x as (select c_custkey nth, cast(c_custkey // 2 as varchar) token, case when c_custkey % 2 = 0 then 'fused' else 'spine_only' end config, case c_custkey % 3 when 0 then 'both' else 'one' end match_type, c_mktsegment lab,
  case when c_custkey % 5 = 0 then 'test' else 'trainval' end split, case when c_custkey % 7 = 0 then null else c_acctbal > 0 end ok, c_nationkey from customer)"""


def _cases(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey nth", "cast(c_custkey div 2 as string) token", "if(c_custkey % 2 = 0, 'fused', 'spine_only') config", "if(c_custkey % 3 = 0, 'both', 'one') match_type", "c_mktsegment label", "if(c_custkey % 5 = 0, 'test', 'trainval') split",
        "if(c_custkey % 7 = 0, null, c_acctbal > 0) alignment_ok", "map('discs', c_nationkey < 10) annotations", "concat('ct/', c_custkey) ct_file", "concat('lab/', c_custkey) label_file", "c_nationkey",
    )


@query(f"""with {CASE_SQL} select nth from x where config = 'fused' and lower(lab) = 'building' and split = 'trainval' and c_nationkey < 10 and coalesce(ok, false) and nth % 4 <> 1""")
def selected_cases(spark, sf_dir):
    c = _cases(spark, sf_dir)
    files = c.where("nth % 4 <> 1").select(F.explode(F.array("ct_file", "label_file")).alias("path"))
    return dataset.select(c, "fused", None, "Building", "trainval", "discs", True, files).select("nth")


@query(f"""with {CASE_SQL} select split, count(*) n from x group by split""")
def split_sizes(spark, sf_dir):
    c = _cases(spark, sf_dir)
    return dataset.test_set(c).union(dataset.trainval(c)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {CASE_SQL} select nth, config from x where token = '21' and config = 'spine_only' order by nth desc limit 1""")
def case_by_key(spark, sf_dir):
    return dataset.get(_cases(spark, sf_dir), "21", "spine_only").select("nth", "config")


@query(f"""with {CASE_SQL} select nth, case when cast(token as int) % 5 = 2 then 'val' else 'train' end part from x where cast(token as int) % 11 <> 0""")
def fold_cases(spark, sf_dir):
    folds = spark.range(5).crossJoin(_cases(spark, sf_dir).select("token").distinct()).where("cast(token as int) % 11 <> 0")
    folds = folds.selectExpr("cast(id as int) fold", "if(cast(token as int) % 5 = id, 'val', 'train') part", "token")
    return dataset.fold(_cases(spark, sf_dir), folds, 2).select("nth", "part")


PATIENT_SQL = "p as (select s_suppkey token, s_suppkey % 3 <> 0 spine, s_suppkey % 4 <> 0 pelvis from supplier), k as (select l_suppkey token, case when l_linenumber % 2 = 0 then 'spine' else 'pelvis' end region, l_partkey % 97 c from lineitem)"


def _patients(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").selectExpr("s_suppkey token", "s_suppkey nth", "s_suppkey % 3 <> 0 has_spine", "s_suppkey % 4 <> 0 has_pelvis")
    name = F.get(F.array(*[F.lit(x) for x in ("ambiguous", "unresolved", "low", "medium", "medium", "other", "high")]), (F.col("l_partkey") % 97).cast("int"))
    k = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("token"), F.when(F.col("l_linenumber") % 2 == 0, "spine").otherwise("pelvis").alias("region"), name.alias("confidence"))
    return p, k


@query(f"""with {PATIENT_SQL} select token from p where spine and pelvis and exists (select 1 from k where k.token = p.token and region = 'spine' and c = 6) and exists (select 1 from k where k.token = p.token and region = 'pelvis' and c = 6)""")
def surely_complete(spark, sf_dir):
    return dataset.surely_complete(*_patients(spark, sf_dir)).select("token")


@query(f"""with {PATIENT_SQL} select case when spine and pelvis then 'both' when spine then 'spine' else 'pelvis' end regions, count(*) n from p where spine or pelvis group by 1""")
def patients_by_regions(spark, sf_dir):
    p, _ = _patients(spark, sf_dir)
    p = dataset.by_token(p)
    part = lambda s, q, n: dataset.patients_by_regions(p, s, q).select(F.lit(n).alias("regions"))
    return part(True, True, "both").union(part(True, False, "spine")).union(part(False, True, "pelvis")).groupBy("regions").agg(F.count(F.lit(1)).alias("n"))


# --- codes and decisions -----------------------------------------------------------------------------------------------


@query("""select p_partkey, cast(case when p_size % 2 = 0 then 33 else 45 end + p_size % 12 + 1 as int) code, cast(case when p_size between 1 and 12 then 45 + p_size when p_size between 13 and 24 then 33 + p_size - 12 end as int) from_sequence,
  case when p_size % 12 = 0 then '' || (case when p_size % 2 = 0 then 33 else 45 end + 2) when p_size % 12 = 11 then '' || (case when p_size % 2 = 0 then 33 else 45 end + 11)
    else (case when p_size % 2 = 0 then 33 else 45 end + p_size % 12) || ',' || (case when p_size % 2 = 0 then 33 else 45 end + p_size % 12 + 2) end adjacent from part""")
def rib_codes(spark, sf_dir):
    size = F.col("p_size")
    code = codes.rib_code(F.when(size % 2 == 0, "left").otherwise("right"), size % 12 + 1)
    near = F.array_join(F.transform(codes.adjacent_ribs(code), lambda x: x.cast("string")), ",")
    return table(spark, sf_dir, "part").select("p_partkey", code.cast("int").alias("code"), codes.rib_from_sequence(size).cast("int").alias("from_sequence"), near.alias("adjacent"))


@query("""select o_orderkey, case o_orderkey % 4 when 0 then 'SEMI_SACRAL' when 1 then 'SACRALIZATION' else 'NORMAL' end "label", case when o_orderkey % 3 = 0 then 'PRONE' when o_orderkey % 3 = 1 then 'SUPINE' else 'UNKNOWN' end position,
  o_orderkey % 4 = 1 hard, o_orderkey % 4 = 2 metal, '7_' || o_orderkey || '_seg' stem from orders""")
def mask_qualifiers(spark, sf_dir):
    k = F.col("o_orderkey")
    block = F.concat(F.when(k % 4 == 0, "_hardly_SemiSacralization").when(k % 4 == 1, "hard_sacralization").when(k % 4 == 2, "metal").otherwise("presacralization"), F.when(k % 3 == 0, "_prone").when(k % 3 == 1, "_oldSUPINE_").otherwise(""))
    flags, label, position = codes.qualifiers(block)
    stem = codes.mask_stem(F.concat(F.lit("/raw/a/7_"), k, F.when(k % 2 == 0, "_seg.nii.gz").otherwise("_seg.nii")))
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), position.alias("position"), flags["hard"].alias("hard"), flags["metal"].alias("metal"), stem.alias("stem"))


SPECTRUM_SQL = """select *, case when nl = 5 and ns = 5 and not jl and not jr and not fl and not fr then 'normal' when nl = 6 then 'lumbarization' when (nl = 4 or nl = 5 and (jl or jr)) and (ns = 6 or ns = 5 and nl = 5) then 'sacralization' else 'indeterminate' end family from
  (select l_orderkey, l_linenumber, cast(3 + l_partkey % 4 as int) nl, cast(3 + l_suppkey % 4 as int) ns, l_orderkey % 2 = 0 jl, l_linenumber % 2 = 0 jr, l_partkey % 3 = 0 fl, l_suppkey % 3 = 0 fr from lineitem)"""


@query(f"""select nl, ns, jl, jr, fl, fr, family, case family when 'normal' then 'A' when 'lumbarization' then case when ns = 4 and jl and jr and not fl and not fr then 'C' when ns = 4 and not jl and not jr and not fl and not fr then 'D' when ns = 5 then 'B' end
  when 'sacralization' then case when ns = 6 then case when fl and fr then 'E' when fl or fr then 'D' end when jl and jr then 'C' when jl or jr then 'B' end end grade, count(*) n from ({SPECTRUM_SQL}) group by all""")
def spectrum_grades(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").selectExpr("cast(3 + l_partkey % 4 as int) nl", "cast(3 + l_suppkey % 4 as int) ns", "l_orderkey % 2 = 0 jl", "l_linenumber % 2 = 0 jr", "l_partkey % 3 = 0 fl", "l_suppkey % 3 = 0 fr")
    family, grade = codes.spectrum(*[F.col(c) for c in ("nl", "ns", "jl", "jr", "fl", "fr")])
    g = li.groupBy("nl", "ns", "jl", "jr", "fl", "fr").agg(F.count(F.lit(1)).alias("n"))
    return g.select("nl", "ns", "jl", "jr", "fl", "fr", family.alias("family"), grade.alias("grade"), "n")


@query("""select s_suppkey, case when l > 0 and r > 0 then least(l, r) + 1 when greatest(l, r) > 0 then greatest(l, r) + 1 end segments,
  case when s_suppkey % 6 = 0 then null when u > 10 then 'II' when u >= 7 then 'I' else 'III' end border from (select s_suppkey, s_suppkey % 6 l, s_nationkey % 6 r, cast(s_suppkey % 13 as double) u from supplier)""")
def sacral_segments(spark, sf_dir):
    k, u = F.col("s_suppkey"), (F.col("s_suppkey") % 13).cast("double")
    top = F.when(k % 6 != 0, F.lit(10.0))
    upper = codes.upper_border(top, F.lit(3.0), F.lit(5.0), u - 1, F.when(k % 2 == 0, u + 1).otherwise(u + 1))
    return table(spark, sf_dir, "supplier").select("s_suppkey", codes.sacral_segments(k % 6, (F.col("s_nationkey") % 6).cast("long")).alias("segments"), upper.alias("border"))


@query("""select l_orderkey k, round(min(case when v between 3.5 and 20 then v end), 1) least, nullif(count(case when v between 3.5 and 20 then 1 end), 0) levels, case when count(case when v between 3.5 and 20 then 1 end) between 1 and count(*) - 1 then count(case when v not between 3.5 and 20 then 1 end) end dropped
  from (select l_orderkey, l_quantity / 2 v from lineitem) group by l_orderkey""")
def plausible_minimum(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.col("l_quantity") / 2).alias("v"))
    least, levels, dropped = codes.plausible_minimum(F.col("v"), 3.5, 20.0, 1)
    return g.select("k", least.alias("least"), levels.cast("long").alias("levels"), dropped.cast("long").alias("dropped"))


@query("""select s_suppkey, case when s_suppkey % 8 = 0 then 'no_bone_warped' else concat_ws(';', case when s_suppkey % 5 = 1 then 'sacrum_lowfit=0.25' end, case when s_suppkey % 7 = 1 then 'sacrum_bonewarp=0.50' end, case when s_suppkey % 3 = 1 then 'sacrum_volratio=1.75' end) end reasons from supplier""")
def carried_over(spark, sf_dir):
    k = F.col("s_suppkey")
    nan = F.lit(float("nan"))
    bone = lambda name, n: F.struct(
        F.lit(name).alias("name"), n.alias("n_source"), F.lit(0).alias("n_warped"), F.when(k % 5 == 1, F.lit(0.25)).when(k % 5 == 2, nan).otherwise(0.9).alias("bone_fit"),
        F.when(k % 7 == 1, F.lit(0.5)).otherwise(0.0).alias("jac_bad"), F.when(k % 3 == 1, F.lit(1.75)).otherwise(1.0).alias("vol_ratio"),
    )
    bones = F.array(bone("sacrum", F.when(k % 8 == 0, 0).otherwise(5)), bone("absent", F.lit(0)))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(calls.gate(bones, 0.6, 0.1, 0.5, 1.5)[1], ";").alias("reasons"))
