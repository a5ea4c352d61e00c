"""Every operator applied to the driver's tables, each with the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.functions import coerce, grades, stats
from volcohort.operators import ledger, matching, qc, sequence, voxel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Places of volumes that a task makes, about.
PLACES = 1 << 20


def places(spark: SparkSession, sf_dir: str, n: int, case: str, *more: str) -> DataFrame:
    """Each supplier with `id` 0 to n - 1, the places of its volume. Suppliers are dealt by the case over as many tasks as the places
    need; else the one small file would be one task. Spark takes the exploded table for as small as the suppliers, so its joins are
    told to shuffle."""
    s = table(spark, sf_dir, "supplier")
    tasks = max(spark.sparkContext.defaultParallelism, -(-s.count() * n // PLACES))
    s = s.selectExpr(case, *more)
    return s.repartition(tasks, s.columns[0]).select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("id")).hint("merge")


# --- quality checks ---------------------------------------------------------------------------------------------------

BASE_SQL = """
base as (select l_orderkey k, 1 - max(l_quantity) / sum(l_quantity) om, round(avg(l_discount), 9) ob, count(*) n from lineitem group by l_orderkey),
bound as (select quantile_cont(b.ob, 0.95) t from base b join orders o on o.o_orderkey = b.k where b.k % 3 <> 1 and o.o_orderpriority like '1%'),
mixing as (select k, case when om > 0.8 then 1 else 0 end flag, om metric from base where k % 3 <> 0),
leak as (select k, case when ob > t then 1 else 0 end flag, ob metric from base, bound where k % 3 <> 1),
struct_ as (select k, case when n > 6 then 1 else 0 end flag, n metric from base where k % 3 <> 2),
merged as (select coalesce(m.k, l.k, s.k) k, coalesce(m.flag, 0) fm, coalesce(l.flag, 0) fl, coalesce(s.flag, 0) fs, m.metric om, l.metric ob, s.metric n
  from mixing m full join leak l on m.k = l.k full join struct_ s on coalesce(m.k, l.k) = s.k)
"""


def _checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    base = li.groupBy(F.col("l_orderkey").alias("k")).agg(
        (1 - F.max("l_quantity") / F.sum("l_quantity")).alias("om"), F.round(F.avg("l_discount"), 9).alias("ob"), F.count(F.lit(1)).alias("n")
    )
    leak = base.where("k % 3 <> 1").select("k", F.col("ob").alias("metric"))
    baseline = leak.join(orders.where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("k")), "k", "left_semi")
    return {
        "mixing": base.where("k % 3 <> 0").select("k", (F.col("om") > 0.8).cast("int").alias("flag"), F.col("om").alias("metric")),
        "leak": qc.recalibrate(leak, baseline, "metric", 0.95),
        "structure": base.where("k % 3 <> 2").select("k", (F.col("n") > 6).cast("int").alias("flag"), F.col("n").alias("metric")),
    }


@query(f"""with {BASE_SQL} select k, fm, fl, fs, fm + fl + fs n_flags, case when fm + fl + fs > 0 then 1 else 0 end needs_review,
  round(coalesce(om, 0) + coalesce(ob, 0), 6) severity from merged""")
def qc_merge(spark, sf_dir):
    m = qc.merge_checks(["k"], _checks(spark, sf_dir))
    severity = F.round(F.coalesce("metric_mixing", F.lit(0.0)) + F.coalesce("metric_leak", F.lit(0.0)), 6)
    return m.select("k", F.col("flag_mixing").alias("fm"), F.col("flag_leak").alias("fl"), F.col("flag_structure").alias("fs"), "n_flags", "needs_review", severity.alias("severity"))


@query(f"""with {BASE_SQL} select cast(sum(fm) as bigint) mixing, cast(sum(fl) as bigint) leak, cast(sum(fs) as bigint) structure, count(*) cases, cast(sum(case when fm + fl + fs > 0 then 1 else 0 end) as bigint) flagged from merged""")
def qc_flag_rates(spark, sf_dir):
    m = qc.merge_checks(["k"], _checks(spark, sf_dir))
    return m.agg(F.sum("flag_mixing").alias("mixing"), F.sum("flag_leak").alias("leak"), F.sum("flag_structure").alias("structure"), F.count(F.lit(1)).alias("cases"), F.sum("needs_review").alias("flagged"))


@query(f"""with {BASE_SQL} select k, n_flags, severity from (select k, fm + fl + fs n_flags, round(coalesce(om, 0) + coalesce(ob, 0), 6) severity from merged)
  order by n_flags desc, severity desc, k limit 100""")
def qc_worklist_top(spark, sf_dir):
    return qc_merge(spark, sf_dir).select("k", "n_flags", "severity").orderBy(F.desc("n_flags"), F.desc("severity"), "k").limit(100)


@query("""select l_partkey, count(*) n, case when count(*) >= 4 then round(quantile_cont(l_extendedprice, 0.25) - 1.5 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)), 6) end lo,
  case when count(*) >= 4 then round(quantile_cont(l_extendedprice, 0.75) + 1.5 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)), 6) end hi from lineitem group by l_partkey""")
def tukey_fences(spark, sf_dir):
    return stats.tukey(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_extendedprice").withColumns({"lo": F.round("lo", 6), "hi": F.round("hi", 6)})


@query("""select l_orderkey, l_linenumber, flags, cast(case when flags = '' then 0 else len(string_split(flags, ';')) end as int) n_flags, score from (
  select l_orderkey, l_linenumber, concat_ws(';', case when l_quantity > 45 then 'bulk' end, case when l_discount >= 0.09 then 'cheap' end, case when l_tax > 0.07 then 'taxed' end) flags,
  round(case when l_quantity > 45 then 3.0 else 0 end + case when l_discount >= 0.09 then l_discount * 4 else 0 end + case when l_tax > 0.07 then 1.5 else 0 end, 2) score from lineitem)""")
def triage_score(spark, sf_dir):
    rules = {
        "bulk": (F.col("l_quantity") > 45, F.lit(3.0)), "cheap": (F.col("l_discount") >= 0.09, F.col("l_discount") * 4), "taxed": (F.col("l_tax") > 0.07, F.lit(1.5)),
    }
    return qc.triage(table(spark, sf_dir, "lineitem"), rules).select("l_orderkey", "l_linenumber", "flags", "n_flags", "score")


@query("""select l_orderkey, l_linenumber, 'l_quantity' measure, cast(l_quantity as double) as "value" from lineitem where l_quantity < 2 or l_quantity > 49
  union all select l_orderkey, l_linenumber, 'l_discount', cast(l_discount as double) from lineitem where l_discount < 0.01 or l_discount > 0.09
  union all select l_orderkey, l_linenumber, 'l_tax', cast(l_tax as double) from lineitem where l_tax > 0.075""")
def envelope_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return qc.out_of_range(li, ["l_orderkey", "l_linenumber"], [("quantity", 2, 49), ("discount", 0.01, 0.09), ("tax", -1, 0.075)])


# --- coercion and predicates ------------------------------------------------------------------------------------------


@query("""select o_orderkey, case when o_orderkey % 7 = 0 then null else o_orderpriority end priority, case when o_orderkey % 5 = 0 then null else cast(o_totalprice as double) end price,
  case when o_orderkey % 3 = 0 then true when o_orderkey % 3 = 1 then false end flag from orders""")
def manifest_coerce(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 7 == 0, "").otherwise(F.col("o_orderpriority")).alias("p"),
        F.when(k % 10 == 0, "NaN").when(k % 5 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("t"),
        F.when(k % 3 == 0, " True ").when(k % 3 == 1, "false").otherwise("").alias("f"),
    )
    return raw.select("o_orderkey", coerce.optional_text(F.col("p")).alias("priority"), coerce.optional_double(F.col("t")).alias("price"), coerce.optional_boolean(F.col("f")).alias("flag"))


@query(r"""select c_custkey, case when c_custkey % 11 = 0 then 'CTC-' || c_custkey else '1.2.' || c_nationkey || '.' || c_custkey end uid, cast(case when c_custkey % 11 = 0 then 'CTC-' || c_custkey else cast(c_custkey as varchar) end as varchar) token,
  (case when c_custkey % 11 = 0 then 'CTC-' || c_custkey else cast(c_custkey as varchar) end) || '__' || c_mktsegment case_key from customer""")
def canonical_uid(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = F.when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("CTC-"), "c_custkey")).otherwise(F.concat(F.lit(" 1.2."), "c_nationkey", F.lit(".000"), "c_custkey"))
    c = c.withColumn("raw", raw)
    return c.select("c_custkey", coerce.canonical_uid(F.col("raw")).alias("uid"), coerce.patient_token(F.col("raw")).alias("token"), coerce.case_key(coerce.patient_token(F.col("raw")), F.col("c_mktsegment")).alias("case_key"))


@query("""select p_partkey, case when a >= 18 then a end age, case when a >= 90 then '80-89' when a >= 18 then (a // 10 * 10) || '-' || (a // 10 * 10 + 9) end band from (select p_partkey, cast(p_size * 2 as int) a from part)""")
def age_band(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("a", (F.col("p_size") * 2).cast("int"))
    shown, band = coerce.public_age(F.col("a"))
    return p.select("p_partkey", shown.alias("age"), band.alias("band"))


@query("""select doc_id, n_words_band, agreement from (select d.doc_id, case when d.n_chars < 500 then 'short' when d.n_chars < 2000 then 'middle' else 'long' end n_words_band,
  case when l.quality is not null and l.toxic is not null then (l.quality = 1) = (l.toxic = 0) end agreement from documents d left join labels l on d.doc_id = l.doc_id)""")
def label_agreement(spark, sf_dir):
    d, lab = table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels")
    call = lambda c, yes: F.when(F.col(c) == yes, "good").when(F.col(c).isNotNull(), "bad")
    band = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 2000, "middle").otherwise("long")
    return d.join(lab, "doc_id", "left").select("doc_id", band.alias("n_words_band"), grades.three_valued_agreement(call("quality", 1), call("toxic", 0)).alias("agreement"))


@query("""select l, r, case when l = '' and r = '' then null when l = r then l || 'b' when l = '' or r = '' then l || r || 'a' when l in ('II', 'III') and r in ('II', 'III') then 'IV' else 'atypical:' || l || '_left/' || r || '_right' end grade, count(*) n from (
  select case when l_quantity % 4 = 0 then 'III' when l_linenumber % 3 = 0 then 'II' when l_quantity >= 19 then 'I' else '' end l,
         case when l_partkey % 4 = 0 then 'III' when l_suppkey % 3 = 0 then 'II' when l_orderkey % 40 >= 19 then 'I' else '' end r from lineitem) group by l, r""")
def side_grades(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    left = grades.side_grade(F.col("l_quantity") % 4 == 0, F.col("l_linenumber") % 3 == 0, F.col("l_quantity"))
    right = grades.side_grade(F.col("l_partkey") % 4 == 0, F.col("l_suppkey") % 3 == 0, F.col("l_orderkey") % 40)
    g = li.select(left.alias("a"), right.alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.coalesce("a", F.lit("")).alias("l"), F.coalesce("b", F.lit("")).alias("r"), grades.both_sides(F.col("a"), F.col("b")).alias("grade"), "n")


@query("""select call, count(*) n from (select case when n <= 2 then 'unscreenable' when n = 3 then 'possible_lumbarization' when n = 4 then 'normal' else 'possible_sacralization' end call
  from (select l_orderkey, count(*) n from lineitem group by l_orderkey)) group by call""")
def transition_calls(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(grades.transition(F.col("n")).alias("call")).agg(F.count(F.lit(1)).alias("n"))


# --- matching ---------------------------------------------------------------------------------------------------------


@query("""with c as (select l.l_orderkey ok, l.l_linenumber ln, x.l_orderkey xo, x.l_linenumber xl, x.l_suppkey sk, abs(l.l_quantity - x.l_quantity) dq,
    case when l.l_suppkey = x.l_suppkey then 0 when l.l_quantity = x.l_quantity then 1 when abs(l.l_quantity - x.l_quantity) <= 5 then 2 else 3 end tier
    from lineitem l join lineitem x on l.l_partkey = x.l_partkey and (l.l_orderkey <> x.l_orderkey or l.l_linenumber <> x.l_linenumber)),
  t as (select *, min(tier) over (partition by ok, ln) best from c),
  r as (select *, row_number() over (partition by ok, ln order by dq, sk, xo, xl) rank from t where tier = best)
  select ok, ln, tier, sk, xo, xl from r where rank = 1""")
def candidate_cascade(spark, sf_dir):
    """All lines are matched against all others of their part."""
    a, b, other, tiers, rank = _line_cascade(spark, sf_dir)
    return matching.first_candidate(matching.candidates(a, b, ["l_partkey"], other, tiers, rank, first=True), ["ok", "ln"], tiers, rank, ["sk", "xo", "xl"])


@query("""with c as (select l.l_orderkey ok, l.l_linenumber ln, x.l_orderkey xo, x.l_linenumber xl, x.l_suppkey sk, abs(l.l_quantity - x.l_quantity) dq,
    case when l.l_suppkey = x.l_suppkey then 0 when l.l_quantity = x.l_quantity then 1 when abs(l.l_quantity - x.l_quantity) <= 5 then 2 else 3 end tier
    from lineitem l join lineitem x on l.l_partkey = x.l_partkey and (l.l_orderkey <> x.l_orderkey or l.l_linenumber <> x.l_linenumber)),
  t as (select *, min(tier) over (partition by ok, ln) best from c),
  r as (select *, row_number() over (partition by ok, ln order by dq, sk, xo, xl) rank from t where tier = best)
  select tier, rank, count(*) n, sum(dq) dq from r group by tier, rank""")
def candidate_ranks(spark, sf_dir):
    """How many lines have a candidate of each rank in their first tier, and how far these are."""
    a, b, other, tiers, rank = _line_cascade(spark, sf_dir)
    out = matching.ranked(matching.candidates(a, b, ["l_partkey"], other, tiers, rank), ["ok", "ln"], tiers, rank)
    return out.groupBy(F.col("tier").cast("int").alias("tier"), F.col("rank").cast("long").alias("rank")).agg(F.count(F.lit(1)).alias("n"), F.sum(rank[0]).alias("dq"))


def _line_cascade(spark, sf_dir):
    """Both sides of a join of lines on their part, what tells a line from itself, the tiers and the rank."""
    li = table(spark, sf_dir, "lineitem")
    a = li.select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_suppkey").alias("os"), F.col("l_quantity").alias("oq"), "l_partkey")
    b = li.select(F.col("l_orderkey").alias("xo"), F.col("l_linenumber").alias("xl"), F.col("l_suppkey").alias("sk"), F.col("l_quantity").alias("xq"), "l_partkey")
    dq = F.abs(F.col("oq") - F.col("xq"))
    other = (F.col("ok") != F.col("xo")) | (F.col("ln") != F.col("xl"))
    return a, b, other, [F.col("os") == F.col("sk"), dq == 0, dq <= 5], [dq, F.col("sk"), F.col("xo"), F.col("xl")]


FUSION_SQL = """with b as (select l_orderkey k, l_returnflag f, l_suppkey s, row_number() over (partition by l_orderkey, l_returnflag order by l_extendedprice desc, l_linenumber) r from lineitem),
  a as (select k, s from b where f = 'A' and r = 1), n as (select k, s from b where f = 'N' and r = 1)
  select coalesce(a.k, n.k) k, case when a.k is null then 'b_only' when n.k is null then 'a_only' when a.s = n.s then 'fused' else 'separate' end status from a full join n on a.k = n.k"""


@query(FUSION_SQL)
def fusion_status(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k")
    side = lambda f: matching.best_by(li.where(F.col("l_returnflag") == f), ["k"], "l_extendedprice", "l_linenumber", ["l_suppkey"])
    return matching.fusion(side("A"), side("N"), "k", "l_suppkey")


@query(f"select status, count(*) n from ({FUSION_SQL}) group by status")
def match_type_counts(spark, sf_dir):
    return fusion_status(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""with s as (select l_orderkey k, sum(l_extendedprice) total, count(*) n, min(l_shipdate) d from lineitem group by l_orderkey),
  j as (select o.o_orderkey k, o.o_totalprice p, o.o_orderdate od, s.total, s.n, s.d, s.k sk from orders o left join s on o.o_orderkey = s.k)
  select k, 'NO_LINES' warning from j where sk is null union all select k, 'TOTAL_OVER' from j where total > 1.5 * p
  union all select k, 'TOTAL_UNDER' from j where total < 0.5 * p union all select k, 'SHIPPED_EARLY' from j where d < od""")
def crosscheck_warnings(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("total"), F.min("l_shipdate").alias("d"))
    j = table(spark, sf_dir, "orders").join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("k", F.col("o_orderkey"))
    rules = {
        "NO_LINES": F.col("l_orderkey").isNull(), "TOTAL_OVER": F.col("total") > 1.5 * F.col("o_totalprice"), "TOTAL_UNDER": F.col("total") < 0.5 * F.col("o_totalprice"),
        "SHIPPED_EARLY": F.col("d") < F.col("o_orderdate"),
    }
    return matching.warnings(j, ["k"], rules)


@query("""with r as (select distinct l_orderkey c, l_linenumber a, l_quantity x, l_discount * 100 y, l_tax * 100 z from lineitem where l_linenumber % 2 = 1),
  v as (select distinct l_orderkey c, l_linenumber b, l_quantity x, l_discount * 100 y, l_tax * 100 z from lineitem where l_linenumber % 2 = 0),
  d as (select r.c, a, b, round(min(sqrt((r.x - v.x) * (r.x - v.x) + (r.y - v.y) * (r.y - v.y) + (r.z - v.z) * (r.z - v.z))), 6) dist from r join v on r.c = v.c group by r.c, a, b),
  n as (select *, row_number() over (partition by c, a order by dist, b) q from d)
  select c, a, b, dist, case when dist > 10 then 'no_contact' when b >= 6 then 'lumbar' when b = a + 1 then 'match' else 'offset' end bucket from n where q = 1""")
def nearest_incidence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("c"), "l_linenumber", F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_tax") * 100).alias("z"))
    a = li.where("l_linenumber % 2 = 1").withColumnRenamed("l_linenumber", "a").distinct()
    b = li.where("l_linenumber % 2 = 0").withColumnRenamed("l_linenumber", "b").distinct()
    return matching.incidence(matching.nearest(a, b, "c", "a", "b"), F.col("a") + 1, F.col("b"), 10.0, 6)


# --- rollups ----------------------------------------------------------------------------------------------------------

ROLLUP_SQL = """select o_custkey, max(cast(substr(o_orderpriority, 1, 1) as int)) n_max, bool_or(o_orderstatus = 'F') any_final,
  min(case when o_orderstatus = 'P' then '1P' when o_orderstatus = 'F' then '2F' else '3O' end)[2:] label, count(*) n, arg_min(o_orderpriority, o_orderkey) first_priority from orders group by o_custkey"""


@query(ROLLUP_SQL)
def patient_rollup(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    shown = F.when(F.col("o_orderstatus").isin("P", "F"), F.col("o_orderstatus")).otherwise("O")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max(F.substring("o_orderpriority", 1, 1).cast("int")).alias("n_max"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_final"),
        F.min_by(shown, rank).alias("label"), F.count(F.lit(1)).alias("n"), F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"),
    )


@query("""with a as (select o_custkey, case o_custkey % 4 when 0 then 'LUMBARIZATION' when 1 then 'SACRALIZATION' when 2 then 'SEMI_SACRAL' else '' end pel,
    case when sum(o_orderkey) % 5 = 0 then 'LUMBARIZATION' when sum(o_orderkey) % 5 = 1 then 'SACRALIZATION' else '' end vert, count(*) % 7 nl, bool_or(o_orderkey % 997 = 0) l6 from orders group by o_custkey)
  select subtype, count(*) n from (select case when (vert = 'LUMBARIZATION' and pel in ('SACRALIZATION', 'SEMI_SACRAL')) or (vert = 'SACRALIZATION' and pel = 'LUMBARIZATION') then 'ambiguous'
    when nl = 6 or l6 then 'lumb' when pel = 'SEMI_SACRAL' then 'semisacralization' when vert = 'SACRALIZATION' and nl = 4 then 'sacr_count'
    when vert = 'SACRALIZATION' or pel = 'SACRALIZATION' then 'sacralization' else 'normal' end subtype from a) group by subtype""")
def subtype_counts(spark, sf_dir):
    k = F.col("o_custkey") % 4
    pel = F.when(k == 0, "LUMBARIZATION").when(k == 1, "SACRALIZATION").when(k == 2, "SEMI_SACRAL").otherwise("")
    s = F.sum("o_orderkey") % 5
    a = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.when(s == 0, "LUMBARIZATION").when(s == 1, "SACRALIZATION").otherwise("").alias("vert"), (F.count(F.lit(1)) % 7).alias("nl"), F.bool_or(F.col("o_orderkey") % 997 == 0).alias("l6")
    )
    call = grades.subtype(pel, F.col("vert"), F.lit(""), F.col("nl"), F.col("l6"))
    return a.groupBy(call.alias("subtype")).agg(F.count(F.lit(1)).alias("n"))


@query("""with m as (select o_totalprice p, unnest(case when o_orderstatus = 'F' then ['all', 'status_' || o_orderstatus, 'closed'] else ['all', 'status_' || o_orderstatus] end) g from orders)
  select g subgroup, count(*) n, round(avg(p), 4) mean, round(stddev_pop(p), 4) std from m group by g""")
def subgroup_overlap(spark, sf_dir):
    status = F.concat(F.lit("status_"), "o_orderstatus")
    groups = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("all"), status, F.lit("closed"))).otherwise(F.array(F.lit("all"), status))
    m = table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("p"), F.explode(groups).alias("subgroup"))
    return m.groupBy("subgroup").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 4).alias("mean"), F.round(F.stddev_pop("p"), 4).alias("std"))


@query("""select event_type, round(avg(v), 4) mean, case when count(v) > 1 then round(stddev_pop(v), 4) end std, count(*) n from (select event_type, case when event_id % 9 = 0 then null else "value" end v from events) group by event_type""")
def nan_mean_std(spark, sf_dir):
    v = F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    e = table(spark, sf_dir, "events").withColumn("v", v)
    return e.groupBy("event_type").agg(stats.nan_mean(F.col("v")).alias("mean"), stats.nan_std(F.col("v")).alias("std"), F.count(F.lit(1)).alias("n"))


@query("""select user_id, event_type, event_id, "value" from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) r from events) where r = 1""")
def last_wins(spark, sf_dir):
    return qc.last_of(table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""select o_orderkey, o_custkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')""")
def resume_antijoin(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(done, "o_orderkey", "left_anti")


@query("""select n_name, s, count(*) n from (select o.o_custkey, c.c_nationkey, max(case when o_orderstatus = 'F' then 1 else 0 end) s from orders o join customer c on o.o_custkey = c.c_custkey group by o.o_custkey, c.c_nationkey) x
  join nation on n_nationkey = x.c_nationkey group by n_name, s""")
def cohort_by_nation(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max((F.col("o_orderstatus") == "F").cast("int")).alias("s"))
    named = per.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "s").agg(F.count(F.lit(1)).alias("n"))
    return named.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "s", "n")


# --- splits and sampling ----------------------------------------------------------------------------------------------

FOLDS_SQL = "select c_custkey, c_mktsegment, (row_number() over (partition by c_mktsegment order by md5(c_custkey || '|7'), c_custkey) - 1) % 5 fold from customer"


@query(f"select c_custkey, c_mktsegment, cast(fold as int) fold from ({FOLDS_SQL})")
def kfold_stratified(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return qc.stratified_folds(c, "c_custkey", "c_mktsegment", 5, 7).withColumn("fold", F.col("fold").cast("int"))


@query(f"""with f as ({FOLDS_SQL}), s as (select g fold, c_custkey, case when f.fold = g then 'val' else 'train' end side from f, range(5) t(g))
  select cast(fold as int) fold, side, count(*) n, 0 leaked from s group by fold, side""")
def split_leak_check(spark, sf_dir):
    f = kfold_stratified(spark, sf_dir)
    s = f.select("c_custkey", "fold", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("g"))
    s = s.select("c_custkey", F.col("g").alias("fold"), F.when(F.col("fold") == F.col("g"), "val").otherwise("train").alias("side"))
    leaked = s.groupBy("fold", "c_custkey").agg(F.count_distinct("side").alias("sides")).groupBy("fold").agg(F.count_if(F.col("sides") > 1).cast("int").alias("leaked"))
    return s.groupBy("fold", "side").agg(F.count(F.lit(1)).alias("n")).join(leaked, "fold").select("fold", "side", "n", "leaked")


@query("""with s as (select lang, count(*) g from documents group by lang), t as (select lang, g, 100.0 * g / sum(g) over () e from s),
  b as (select lang, g, greatest(1, floor(e)) base, e - floor(e) rest from t), q as (select *, row_number() over (order by rest desc, lang) nth, sum(base) over () total from b),
  k as (select lang, least(g, base + case when nth <= 100 - total then 1 else 0 end) take from q),
  r as (select doc_id, lang, row_number() over (partition by lang order by md5(doc_id || '|3'), doc_id) n from documents)
  select r.doc_id, r.lang from r join k on r.lang = k.lang where n <= take""")
def stratified_sample(spark, sf_dir):
    return qc.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang", 100, 3).select("doc_id", "lang")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, n, q): one row for each order and line number, which may repeat in the table."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.min("l_quantity").alias("q"))


LINES_SQL = "(select l_orderkey k, l_linenumber n, min(l_quantity) q from lineitem group by 1, 2)"


# --- sequences --------------------------------------------------------------------------------------------------------


@query("""with d as (select distinct l_orderkey k, l_linenumber n from lineitem where l_returnflag <> 'A'), p as (select k, n, lead(n) over (partition by k order by n) nx from d)
  select k, n + g missing from p, range(1, 8) t(g) where n + g < nx""")
def sequence_gaps(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'A'").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"))
    return sequence.gaps(li, ["k"], "n")


@query(f"""select k, n, step from (select k, n, q - lag(q) over (partition by k order by n) step from {LINES_SQL}) where step >= 0""")
def order_inversions(spark, sf_dir):
    return sequence.inversions(_lines(spark, sf_dir), ["k"], "n", "q")


@query(f"""select k, coalesce(median(d), 20.0) pitch from (select a.k, abs(b.q - a.q) d from {LINES_SQL} a left join {LINES_SQL} b on a.k = b.k and b.n = a.n + 1) group by k""")
def pitch(spark, sf_dir):
    return sequence.pitch(_lines(spark, sf_dir), ["k"], "n", "q", 20.0)


@query(f"""with d as (select k, n, case when n = 3 then 12 end anchor, abs(q - lag(q) over (partition by k order by n)) d from {LINES_SQL}),
  m as (select k, quantile_cont(d, 0.5) m from d group by k),
  s as (select d.k, n, anchor, sum(case when d is not null and m > 0 then greatest(1, round_even(d / m, 0)) else 0 end) over (partition by d.k order by n) s from d join m on d.k = m.k)
  select k, n, cast(max(case when anchor is not null then anchor - s end) over (partition by k) + s as bigint) solved from s""")
def anchor_walk(spark, sf_dir):
    li = _lines(spark, sf_dir).withColumn("anchor", F.when(F.col("n") == 3, 12))
    return sequence.walk_from_anchor(li, ["k"], "n", "q", "anchor").select("k", "n", "solved")


@query("""with x as (select l_orderkey c, l_suppkey % 12 num, case when l_linenumber % 2 = 0 then 'L' else 'R' end side, l_quantity < 5 cut from lineitem), b as (select distinct c, num from x where cut)
  select x.c, count(case when side = 'L' then 1 end) n_left, count(case when side = 'R' then 1 end) n_right from x where not exists (select 1 from b where b.c = x.c and b.num = x.num) group by x.c""")
def paired_asymmetry(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("c"), (F.col("l_suppkey") % 12).alias("num"), F.when(F.col("l_linenumber") % 2 == 0, "L").otherwise("R").alias("side"), (F.col("l_quantity") < 5).alias("cut")
    )
    return sequence.paired_counts(x, "c", "num", "side", "cut")


@query(f"""with e as (select k, min((q, n)) a, max((q, n)) b from {LINES_SQL} group by k), p as (select k, abs((b[1] - a[1]) / nullif(b[2] - a[2], 0)) p from e) select k, round(case when p > 0.001 then p else 20.0 end, 9) pitch from p""")
def pitch_of_range(spark, sf_dir):
    return sequence.pitch_of_range(_lines(spark, sf_dir), ["k"], "n", "q", 20.0).withColumn("pitch", F.round("pitch", 9))


# --- statistics -------------------------------------------------------------------------------------------------------


@query("""select cast(least(floor((o_totalprice - 1000) / 24950.0), 19) as int) bin, count(*) n from orders where o_totalprice between 1000 and 500000 group by bin""")
def hist_fixed(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 1000.0, 500000.0, 20)


@query("""with v as (select cast(p_size as double) v from part where p_size between 1 and 50), r as (select v, row_number() over (order by v) - 1 r, count(*) over () n from v),
  u as (select v, lead(v) over (order by v) - v g from (select distinct v from v)), s as (select count(*) u, (select list(g order by g) from u where g is not null) gs from u),
  q as (select max(n) n, (select stddev_samp(v) from v) sd, max(case when r = floor(0.25 * (n - 1)) then v end) a, max(case when r = floor(0.75 * (n - 1)) then v end) b from r),
  k as (select n, (case when n >= 200 then 0.85 when n >= 100 then 1.0 else 1.15 end) * 0.9 * (case when b > a then least(sd, (b - a) / 1.34) else sd end) * pow(n, -0.2) h0 from q),
  h as (select n, case when u > 4 and u < 0.4 * n then greatest(h0, 1.5 * gs[len(gs) // 2 + 1]) else h0 end h from k, s),
  g as (select g point, 1 + g * (49.0 / 63) x from range(64) t(g)), m as (select v, count(*) c from v group by v),
  z as (select point, x, c, n, h, unnest([(x - v) / h, (x - (2 - v)) / h, (x - (100 - v)) / h]) z from g, m, h where n >= 8)
  select cast(point as int) point, round(x, 6) x, round(sum(case when abs(z) < 5 then c * exp(-0.5 * z * z) else 0 end) / (max(n) * max(h) * sqrt(2 * pi())), 9) density from z group by point, x""")
def kde_reflected(spark, sf_dir):
    k = stats.reflected_kde(table(spark, sf_dir, "part"), "p_size", 1.0, 50.0, 64)
    return k.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query("""select l_suppkey, k, n, round(100 * ((k / n + 1.9208 / n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) lo,
  round(100 * ((k / n + 1.9208 / n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) hi from (
  select l_suppkey, cast(count(case when l_returnflag = 'R' then 1 end) as double) k, cast(count(*) as double) n from lineitem group by l_suppkey)""")
def wilson_interval(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").cast("double").alias("k"), F.count(F.lit(1)).cast("double").alias("n"))
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    return g.select("l_suppkey", "k", "n", F.round(lo, 4).alias("lo"), F.round(hi, 4).alias("hi"))


@query("""with r as (select p_brand, p_retailprice v, row_number() over (partition by p_brand order by p_retailprice) - 1 r, count(*) over (partition by p_brand) n from part),
  q as (select p_brand, max(n) n, max(case when r = floor(0.25 * (n - 1)) then v end) a, max(case when r = n // 2 then v end) m, max(case when r = floor(0.75 * (n - 1)) then v end) b from r group by p_brand)
  select p_brand, n, m median, round(m - 1.58 * (b - a) / sqrt(n), 6) lo, round(m + 1.58 * (b - a) / sqrt(n), 6) hi from q where n >= 8""")
def median_interval(spark, sf_dir):
    return stats.median_interval(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice").withColumns({"lo": F.round("lo", 6), "hi": F.round("hi", 6)})


@query("""with t as (select n_name g, least(count(case when c_acctbal < 0 and c_mktsegment = 'BUILDING' then 1 end), 400) a, count(case when c_acctbal >= 0 and c_mktsegment = 'BUILDING' then 1 end) b,
    count(case when c_acctbal < 0 and c_mktsegment = 'MACHINERY' then 1 end) c, count(case when c_acctbal >= 0 and c_mktsegment = 'MACHINERY' then 1 end) d from customer join nation on c_nationkey = n_nationkey group by n_name),
  e as (select *, x from t, range(0, 1001) r(x) where x between greatest(0, a + c - (c + d)) and least(a + b, a + c)),
  p as (select g, a, b, c, d, exp(lgamma(a + b + 1) - lgamma(x + 1) - lgamma(a + b - x + 1) + lgamma(c + d + 1) - lgamma(a + c - x + 1) - lgamma(d - a + x + 1) - lgamma(a + b + c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1)) px,
    exp(lgamma(a + b + 1) - lgamma(a + 1) - lgamma(b + 1) + lgamma(c + d + 1) - lgamma(c + 1) - lgamma(d + 1) - lgamma(a + b + c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1)) p0 from e)
  select g, a, b, c, d, round(least(1, sum(case when px <= p0 * (1 + 1e-7) then px else 0 end)), 6) p from p group by g, a, b, c, d""")
def fisher_exact(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    low = F.col("c_acctbal") < 0
    cell = lambda cond, seg: F.count_if(cond & (F.col("c_mktsegment") == seg))
    t = c.groupBy(F.col("n_name").alias("g")).agg(cell(low, "BUILDING").alias("a"), cell(~low, "BUILDING").alias("b"), cell(low, "MACHINERY").alias("c"), cell(~low, "MACHINERY").alias("d"))
    return t.withColumn("p", F.round(stats.fisher(*(F.col(x) for x in "abcd")), 6))


@query("""with r as (select c_mktsegment, c_nationkey < 10 pos, row_number() over (partition by c_mktsegment order by c_acctbal, c_custkey) r from customer)
  select c_mktsegment, count(case when pos then 1 end) n_pos, count(case when not pos then 1 end) n_neg, round((sum(case when pos then r else 0 end) - count(case when pos then 1 end) * (count(case when pos then 1 end) + 1) / 2) / (count(case when pos then 1 end) * count(case when not pos then 1 end)), 9) auc from r group by c_mktsegment""")
def auc_rank(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("pos", F.col("c_nationkey") < 10)
    return stats.auc(c, ["c_mktsegment"], "c_acctbal", "pos", "c_custkey").withColumn("auc", F.round("auc", 9))


@query("""with g as (select t.t, l.l_returnflag f, l.l_quantity > t.t hit from lineitem l, (select unnest([10, 20, 30, 40]) t) t),
  s as (select t, round(avg(case when hit = (f = 'R') then 1.0 else 0.0 end), 9) score, count(*) n from g group by t) select t best, score, n from s order by score desc, t desc limit 1""")
def sweep_argmax(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", F.explode(F.array(*[F.lit(t) for t in (10, 20, 30, 40)])).alias("t"))
    right = ((F.col("l_quantity") > F.col("t")) == (F.col("l_returnflag") == "R")).cast("double")
    s = li.groupBy("t").agg(F.round(F.avg(right), 9).alias("score"), F.count(F.lit(1)).alias("n"))
    return s.agg(F.max(F.struct("score", "t", "n")).alias("m")).select(F.col("m.t").alias("best"), "m.score", "m.n")


# --- volumes ----------------------------------------------------------------------------------------------------------

#: A volume of 16 x 16 x 8 for each supplier, by rule; the supplier's nation moves its box along i.
VOXEL_SQL = """v as (select id % 16 i, (id // 16) % 16 j, id // 256 k, s_suppkey c, s_nationkey % 4 s from supplier, range(2048) t(id)),
A as (select c, s, k, j, i, cast(case when i - s between 3 and 8 and j between 3 and 9 then 20 + k % 3 else 0 end as int) l from v),
B as (select c, s, k, j, i, cast(case when i - s between 4 and 9 and j between 3 and 9 then 20 + k % 3 else 0 end as int) l from v),
O as (select c, s, k, j, i, cast(case when i - s between 3 and 9 and j between 3 and 8 then 20 + k % 3 else 0 end as int) l from v)"""


def _voxels(spark: SparkSession, sf_dir: str, i0: int, i1: int, j1: int = 9) -> DataFrame:
    v = places(spark, sf_dir, 2048, "cast(s_suppkey as int) case_id", "s_nationkey % 4 s")
    v = v.selectExpr("case_id", "id div 256 k", "(id div 16) % 16 j", "id % 16 i", "s").selectExpr("case_id", "cast(k as int) k", "cast(j as int) j", "cast(i as int) i", "s")
    inside = (F.col("i") - F.col("s")).between(i0, i1) & F.col("j").between(3, j1)
    return v.withColumn("label", F.when(inside, 20 + F.col("k") % 3).otherwise(0).cast("int")).drop("s")


@query(f"""with {VOXEL_SQL}, g as (select *, i - row_number() over (partition by c, k, j, l order by i) g from A where l <> 0)
  select cast(c as int) case_id, cast(k as int) k, cast(j as int) j, l as "label", cast(min(i) as int) i0, cast(max(i) as int) i1 from g group by c, k, j, l, g""")
def rle_runs(spark, sf_dir):
    return voxel.runs(_voxels(spark, sf_dir, 3, 8))


@query(f"""with {VOXEL_SQL}, s as (select a.c, x.l, count(case when a.l = x.l then 1 end) na, count(case when b.l = x.l then 1 end) nb, count(case when a.l = x.l and b.l = x.l then 1 end) n
  from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i, (select unnest([20, 21, 22]) l) x group by a.c, x.l)
  select cast(c as int) case_id, cast(l as int) as "label", na, nb, round(2.0 * n / (na + nb), 9) dice from s""")
def dice_per_class(spark, sf_dir):
    return voxel.dice_of_runs(voxel.runs(_voxels(spark, sf_dir, 3, 8)), voxel.runs(_voxels(spark, sf_dir, 4, 9)))


@query(f"""with {VOXEL_SQL} select cast(a.c as int) case_id, a.l truth, b.l pred, count(*) n from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i where a.l <> 0 group by a.c, a.l, b.l""")
def confusion(spark, sf_dir):
    return voxel.confusion(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9))


@query(f"""with {VOXEL_SQL}, c as (select a.c, a.l t, b.l p, count(*) n from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i where a.l <> 0 and b.l <> 0 group by a.c, a.l, b.l),
  r as (select *, row_number() over (partition by c, t order by n desc, p) r from c) select cast(c as int) case_id, t truth, p best, n, p - t as "offset" from r where r = 1""")
def identification(spark, sf_dir):
    return voxel.identified(voxel.confusion(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9)))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, kind, count(*) n, min(k) k0, max(k) k1, min(j) j0, max(j) j1, min(i) i0, max(i) i1 from (
  select a.c, a.k, a.j, a.i, case when b.l = 0 then 1 when a.l = 0 then 2 else 3 end kind from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i where a.l <> b.l) group by c, kind""")
def label_diff(spark, sf_dir):
    d = voxel.changes(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9))
    ends = [f(c).cast("long").alias(f"{c}{e}") for c in "kji" for f, e in ((F.min, 0), (F.max, 1))]
    return d.groupBy("case_id", "kind").agg(F.count(F.lit(1)).alias("n"), *ends)


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, cast(min(k) as int) k0, cast(max(k) + 1 as int) k1, cast(min(j) - 1 as int) j0, cast(max(j) + 1 as int) j1, cast(min(i) - 1 as int) i0, cast(max(i) + 1 as int) i1 from A where l <> 0 group by c""")
def changed_box(spark, sf_dir):
    return voxel.box(_voxels(spark, sf_dir, 3, 8).where("label <> 0"), 1)


@query(f"""with {VOXEL_SQL}, m as (select o.c, o.l o, a.l x, b.l y from O o join A a on a.c = o.c and a.k = o.k and a.j = o.j and a.i = o.i join B b on b.c = o.c and b.k = o.k and b.j = o.j and b.i = o.i where o.l <> 0 or a.l <> 0 or b.l <> 0)
  select cast(c as int) case_id, case when x = y then 'agree' when y = o then 'only_a' when x = o then 'only_b' else 'conflict' end state, count(*) n, cast(sum(case when x = y then x when y = o then x when x = o then y end) as bigint) labels from m group by 1, 2""")
def three_way_merge(spark, sf_dir):
    m = voxel.three_way(_voxels(spark, sf_dir, 3, 9, 8), _voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9))
    return m.groupBy("case_id", "state").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("labels"))


@query(f"""with {VOXEL_SQL}, m as (select a.c, a.l u, b.l v from A a join B b on a.c = b.c and a.k = b.k and a.j = b.j and a.i = b.i where a.l <> 0 or b.l <> 0)
  select cast(c as int) case_id, case when v = 22 then case when u <> 0 then u else v end when v <> 0 then v else u end as "label", count(*) n from m group by 1, 2""")
def overlay_precedence(spark, sf_dir):
    return voxel.overlay(_voxels(spark, sf_dir, 3, 8), _voxels(spark, sf_dir, 4, 9), [22]).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, case l when 20 then 21 when 21 then 20 else l end as "label", count(*) n from A group by 1, 2""")
def lut_remap(spark, sf_dir):
    return voxel.remap(_voxels(spark, sf_dir, 3, 8), {20: 21, 21: 20}).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL}, p as (select distinct b.c, b.k, b.j, b.i, a.l a, b.l b from A a join A b on a.c = b.c and abs(a.k - b.k) <= 1 and abs(a.j - b.j) <= 1 and abs(a.i - b.i) <= 1 where a.l <> 0 and a.l < b.l)
  select cast(c as int) case_id, a, b, count(*) n from p group by c, a, b""")
def touch_voxels(spark, sf_dir):
    return voxel.touching(_voxels(spark, sf_dir, 3, 8))


@query(f"""with {VOXEL_SQL}, s as (select a.c, a.k, a.j, a.i, a.l, count(b.l) n from A a left join A b on a.c = b.c and a.l = b.l and abs(a.k - b.k) + abs(a.j - b.j) + abs(a.i - b.i) = 1 where a.l <> 0 group by all)
  select cast(c as int) case_id, l as "label", count(*) n from s where n < 6 group by c, l""")
def surface_voxels(spark, sf_dir):
    return voxel.surface(_voxels(spark, sf_dir, 3, 8)).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {VOXEL_SQL} select cast(c as int) case_id, l as "label", count(distinct k) parts, count(*) n from A where l <> 0 group by c, l""")
def components(spark, sf_dir):
    found = voxel.components(_voxels(spark, sf_dir, 3, 8))
    return found.groupBy("case_id", "label").agg(F.count_distinct("component").alias("parts"), F.count(F.lit(1)).alias("n"))


# --- ledger -----------------------------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a ledger: users are cases, event types become claims, submissions and releases of two slots."""
    kind = F.when(F.col("event_id") % 3 == 0, "claim").when(F.col("event_id") % 3 == 1, "submit").otherwise("release")
    kind = F.when((F.col("event_id") % 3 == 2) & (F.col("event_id") % 2 == 0), "submit").otherwise(kind)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("case_id"), (F.col("event_id") % 2 + 1).cast("int").alias("slot"), F.concat(F.lit("r"), F.col("event_id") % 5).alias("reviewer"),
        kind.alias("kind"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.col("value"),
    )


LEDGER_SQL = """log as (select user_id c, cast(event_id % 2 + 1 as int) slot, 'r' || (event_id % 5) reviewer, case when event_id % 3 = 0 then 'claim' when event_id % 3 = 1 then 'submit' when event_id % 2 = 0 then 'submit' else 'release' end kind, ts, event_id seq, "value" v from events),
  cl as (select *, row_number() over (partition by c, slot order by ts desc, seq desc) r from log where kind = 'claim'),
  la as (select c, slot, reviewer, ts, seq from cl where r = 1),
  su as (select l.c, l.slot, max(l.ts) done_at from log l join la on l.c = la.c and l.slot = la.slot where l.kind = 'submit' and (l.ts > la.ts or (l.ts = la.ts and l.seq > la.seq)) group by l.c, l.slot),
  re as (select distinct l.c, l.slot from log l join la on l.c = la.c and l.slot = la.slot where l.kind = 'release' and (l.ts > la.ts or (l.ts = la.ts and l.seq > la.seq))),
  slots as (select la.c, la.slot, la.reviewer, la.ts claimed_at, su.done_at, su.c is not null done from la left join su on la.c = su.c and la.slot = su.slot where not exists (select 1 from re where re.c = la.c and re.slot = la.slot))"""


@query(f"with {LEDGER_SQL} select c case_id, slot, reviewer, done from slots")
def ledger_slots(spark, sf_dir):
    return ledger.slots(_log(spark, sf_dir)).select("case_id", "slot", "reviewer", "done")


@query(f"""with {LEDGER_SQL}, n as (select c, count(*) n_claimed, count(case when done then 1 end) n_done from slots group by c),
  x as (select u.c, coalesce(n_claimed, 0) n_claimed, coalesce(n_done, 0) n_done, case when u.c % 3 = 0 then true when u.c % 3 = 1 then false end agree, case when u.c % 17 = 0 then 'reject' when u.c % 19 = 0 then 'accept' end final from (select distinct user_id c from events) u left join n on n.c = u.c)
  select c case_id, n_claimed, n_done, agree, final, case when final = 'reject' then 'excluded' when final is not null then 'finalized' when n_done >= 2 and agree then 'finalized' when n_done >= 2 and not agree then 'needs_adjudication' when n_done >= 2 or n_claimed > 0 then 'in_review' else 'unassigned' end status from x""")
def ledger_status(spark, sf_dir):
    log = _log(spark, sf_dir)
    cases = log.select("case_id").distinct()
    k = F.col("case_id")
    outcomes = cases.select("case_id", F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("agree"), F.when(k % 17 == 0, "reject").when(k % 19 == 0, "accept").alias("final"))
    return ledger.case_states(cases, ledger.slots(log), outcomes)


@query(f"""with {LEDGER_SQL}, now_ as (select max(ts) t from events), h as (select c, count(case when done or claimed_at + interval 72 hours > t then 1 end) held from slots, now_ group by c)
  select u.c case_id, coalesce(held, 0) held, u.c % 7 priority from (select distinct user_id c from events) u left join h on h.c = u.c where coalesce(held, 0) < 2 order by coalesce(held, 0) > 0, u.c % 7 desc, u.c limit 50""")
def claim_next(spark, sf_dir):
    log = _log(spark, sf_dir)
    now = log.agg(F.max("at").alias("now"))
    cases = log.select("case_id").distinct().withColumn("priority", F.col("case_id") % 7)
    free = ledger.claimable(cases, ledger.slots(log).crossJoin(F.broadcast(now)), F.col("now"), 72)
    return ledger.next_claims(free.select("case_id", "held", "priority"), 50)


@query(f"""with {LEDGER_SQL} select reviewer, count(*) submitted, count(case when v > 50 then 1 end) passed, round_even(100.0 * count(case when v > 50 then 1 end) / count(*), 0) pass_percent, round((count(case when v > 50 then 1 end) + 1) / (count(*) + 2), 6) smoothed from log where kind = 'submit' group by reviewer""")
def reviewer_stats(spark, sf_dir):
    return ledger.reviewer_stats(_log(spark, sf_dir).where("kind = 'submit'").withColumn("passed", F.col("value") > 50))


@query(f"""with {LEDGER_SQL}, s as (select c, slot, sum(cast(floor(v) as bigint)) changed from log where kind = 'submit' group by c, slot), r as (select *, row_number() over (partition by c order by changed, slot) r from s) select c case_id, slot, cast(changed as bigint) changed from r where r = 1""")
def finalize_pick(spark, sf_dir):
    s = _log(spark, sf_dir).where("kind = 'submit'").groupBy("case_id", "slot").agg(F.sum(F.floor("value")).alias("changed"))
    return ledger.final_pick(s)


# --- release gates ----------------------------------------------------------------------------------------------------


@query("""select 'orders_unique' gate, (select count(*) - count(distinct o_orderkey) from orders) bad union all select 'lines_have_order', (select count(*) from lineitem l where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey))
  union all select 'customers_have_nation', (select count(*) from customer c where not exists (select 1 from nation n where n.n_nationkey = c.c_nationkey)) union all select 'discount_in_range', (select count(*) from lineitem where l_discount < 0 or l_discount > 1)
  union all select 'documents_have_text', (select count(*) from documents where text is null or text = '') union all select 'labels_have_document', (select count(*) from labels l where not exists (select 1 from documents d where d.doc_id = l.doc_id))""")
def release_invariants(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    gates = {
        "orders_unique": t("orders").groupBy("o_orderkey").agg((F.count(F.lit(1)) - 1).alias("x")).agg(F.sum("x").alias("bad")),
        "lines_have_order": t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("bad")),
        "customers_have_nation": t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left_anti").agg(F.count(F.lit(1)).alias("bad")),
        "discount_in_range": t("lineitem").where("l_discount < 0 or l_discount > 1").agg(F.count(F.lit(1)).alias("bad")),
        "documents_have_text": t("documents").where("text is null or text = ''").agg(F.count(F.lit(1)).alias("bad")),
        "labels_have_document": t("labels").join(t("documents"), "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("bad")),
    }
    out = None
    for name, df in gates.items():
        row = df.select(F.lit(name).alias("gate"), F.coalesce(F.col("bad"), F.lit(0)).cast("long").alias("bad"))
        out = row if out is None else out.union(row)
    return out


@query("""select c_mktsegment, n, mean, median, p10, p90 from (select c_mktsegment, count(*) n, round(avg(c_acctbal), 4) mean, round(quantile_cont(c_acctbal, 0.5), 4) median, round(quantile_cont(c_acctbal, 0.1), 4) p10, round(quantile_cont(c_acctbal, 0.9), 4) p90 from customer group by c_mktsegment)""")
def cohort_summary(spark, sf_dir):
    p = F.percentile("c_acctbal", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    g = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"), p.alias("p"))
    return g.select("c_mktsegment", "n", "mean", F.round(F.col("p")[1], 4).alias("median"), F.round(F.col("p")[0], 4).alias("p10"), F.round(F.col("p")[2], 4).alias("p90"))


@query("""select "decade", n, round(lo, 4) lo, round(mid, 4) mid, round(hi, 4) hi from (select p_size // 10 * 10 as "decade", count(*) n, list_sort(list(p_retailprice)) v, v[least(count(*) - 1, cast(floor(0.25 * count(*)) as bigint)) + 1] lo, v[least(count(*) - 1, cast(floor(0.5 * count(*)) as bigint)) + 1] mid, v[least(count(*) - 1, cast(floor(0.75 * count(*)) as bigint)) + 1] hi from part group by p_size // 10 * 10) where n >= 25""")
def aging_by_decade(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("decade", (F.floor(F.col("p_size") / 10) * 10).cast("int"))
    r = stats.ranked(p, ["decade"], "p_retailprice")
    at = lambda f: F.round(F.max(F.when(F.col("_r") == F.least(F.col("_n") - 1, F.floor(F.lit(f) * F.col("_n"))), F.col("p_retailprice"))), 4)
    return r.groupBy("decade").agg(F.count(F.lit(1)).alias("n"), at(0.25).alias("lo"), at(0.5).alias("mid"), at(0.75).alias("hi")).where("n >= 25")


@query("""select l_shipdate >= date '1996-01-01' late, l_returnflag, l_linestatus, count(*) n, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue, round(avg(l_quantity), 6) quantity from lineitem group by 1, 2, 3""")
def pricing_rollup(spark, sf_dir):
    late = (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).alias("late")
    return table(spark, sf_dir, "lineitem").groupBy(late, "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_quantity"), 6).alias("quantity")
    )


@query("""with c as (select l_partkey p, l_suppkey s, count(*) n from lineitem group by 1, 2), m as (select *, row_number() over (partition by p order by n desc, s) r, sum(n) over (partition by p) total from c) select p, s modal, n, round(n / total, 6) share from m where r = 1""")
def modal_offset(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    g = c.groupBy("p").agg(F.max(F.struct("n", (-F.col("s")).alias("t"))).alias("m"), F.sum("n").alias("total"))
    return g.select("p", (-F.col("m.t")).alias("modal"), F.col("m.n").alias("n"), F.round(F.col("m.n") / F.col("total"), 6).alias("share"))


@query("""select o_custkey, cast(visit as int) visit, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) visit from orders)""")
def visit_index(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", F.row_number().over(w).alias("visit"), "o_orderkey")


@query("""select l_orderkey, round(l_quantity / median(l_quantity) over (partition by l_orderkey), 6) ratio, l_linenumber from lineitem""")
def case_normalised(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    mid = F.median("l_quantity").over(Window.partitionBy("l_orderkey"))
    return li.select("l_orderkey", F.round(F.col("l_quantity") / mid, 6).alias("ratio"), "l_linenumber")
