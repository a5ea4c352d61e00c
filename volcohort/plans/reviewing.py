"""More of the catalogue: seeding, resetting and queueing the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import ledger, voxel
from volcohort.plans.anatomy import ORACLES, QUERIES
from volcohort.plans.catalogue import LEDGER_SQL, VOXEL_SQL, _log, _voxels, ledger_status, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("""select o_custkey case_id, min(case o_orderstatus when 'F' then 'spine' when 'O' then 'pelvis' end) region, max(cast(o_orderkey % 5 as int)) priority from orders where o_orderstatus in ('F', 'O') and o_custkey % 4 <> 0 and o_custkey in (select c_custkey from customer where c_acctbal > 0) group by o_custkey""")
def seed_cases(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id"), F.col("o_orderstatus").alias("config"), (F.col("o_orderkey") % 5).cast("int").alias("triage"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), "c_acctbal")
    return ledger.seed_cases(records, c.where("case_id % 4 = 0"), {"F": "spine", "O": "pelvis"}, c.where("c_acctbal > 0"))


@query(f"""with {LEDGER_SQL}, o as (select c, case when c % 3 = 0 then true when c % 3 = 1 then false end agree, case when c % 17 = 0 then 'reject' end final from (select distinct c from log)), h as (select distinct c from slots where reviewer = 'r2')
  select o.c case_id, case when h.c is null then agree end agree, case when h.c is null then final end final, (select count(*) from slots s where s.c = o.c and reviewer <> 'r2') n_slots from o left join h on h.c = o.c""")
def reset_reviewer(spark, sf_dir):
    log = _log(spark, sf_dir)
    k = F.col("case_id")
    outcomes = log.select("case_id").distinct().select("case_id", F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("agree"), F.when(k % 17 == 0, "reject").alias("final"))
    slots, out = ledger.reset(ledger.slots(log), outcomes, "r2")
    n = slots.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_slots"))
    return out.join(n, "case_id", "left").fillna(0, ["n_slots"])


@query("""select c_custkey case_id, case when c_acctbal < 0 then greatest(c_nationkey, 1000000) else c_nationkey end priority, case when c_acctbal < 0 then case when c_custkey % 2 = 0 then 'r1,r3,x' else 'r1,r3' end else case when c_custkey % 2 = 0 then 'x' else '' end end deferred from customer""")
def expert_take(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cases = c.select(F.col("c_custkey").alias("case_id"), F.col("c_nationkey").alias("priority"), F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("deferred_by"))
    out = ledger.expert_take(cases, "r2", ["r1", "r2", "r3"], c.where("c_acctbal < 0").select(F.col("c_custkey").alias("case_id")))
    return out.select("case_id", "priority", F.array_join("deferred_by", ",").alias("deferred"))


@query(ORACLES["ledger_status"].replace("select c case_id, n_claimed, n_done, agree, final, case when final", "select case_id, case when status = 'needs_adjudication' then 'adjudicate' when n_done = 1 then 'second_review' when n_claimed > 0 then 'claimed' else 'unclaimed' end reason from (select c case_id, n_claimed, n_done, case when final") + ") where status not in ('finalized', 'excluded')")
def queue_report(spark, sf_dir):
    return ledger.pending(ledger_status(spark, sf_dir))


@query(f"""with {VOXEL_SQL} select cast(a.c as int) case_id, case when (a.l in (0, 20, 21)) and (b.l in (0, 20, 21)) then b.l else a.l end as "label", count(*) n from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i group by 1, 2""")
def restored_outside(spark, sf_dir):
    out = ledger.restore_outside(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9), [20, 21], voxel.AT)
    return out.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))
