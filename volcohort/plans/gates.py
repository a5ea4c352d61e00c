"""More of the catalogue: exact distances and the checks of submitted labels, on a volume for each supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import gates, transitions
from volcohort.plans.catalogue import places, query, table
from volcohort.plans.reports import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

#: A column of six vertebrae, 24 down to 19 from below, four slices each; what is wrong with it follows from the supplier's key.
GIVEN = "if(j between 2 and 5 and i between 4 and 7, 24 - k div 4, 0)"
LAB = """case when c % 7 = 0 and k div 4 = 2 then 0 when j between 2 and 5 and i between 4 and 7 then
  case when c % 13 = 0 and k div 4 = 2 then if(k > 8 or (j = 3 and i = 5), 23, 0) when c % 11 = 0 and k div 4 in (3, 4) then 17 + k div 4 when c % 17 = 0 and k div 4 = 1 then 5 else 24 - k div 4 end
  when c % 5 = 0 and k div 4 = 3 and j between 2 and 3 and i between 10 and 11 then 21 else 0 end"""
COLUMN_SQL = f"""v as (select s_suppkey c, s_nationkey % 2 up, id // 96 k, (id // 12) % 8 j, id % 12 i from supplier, range(2304) t(id)),
g as (select c, k, j, i, {GIVEN.replace(" div ", " // ").replace("if(", "iff(")} l from v), lab as (select c, up, k, j, i, {LAB.replace(" div ", " // ").replace("if(", "iff(")} l from v)"""
COLUMN_SQL = COLUMN_SQL.replace("iff(", "if(")


def _columns(spark, sf_dir, rule):
    v = places(spark, sf_dir, 2304, "s_suppkey c").selectExpr("c", "id div 96 k", "(id div 12) % 8 j", "id % 12 i")
    return v.selectExpr("c case_id", "cast(k as int) k", "cast(j as int) j", "cast(i as int) i", f"cast({rule} as int) label")


def _column_grids(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "24 nk", "8 nj", "12 ni", "2.0D sk", "1.0D sj", "1.0D si", "1 up")


#: The thresholds of thousands of voxels, as few.
SCALE = 0.0005

#: Parts of each label with 26 neighbours: what each voxel reaches, named by the least.
PARTS_SQL = """f as (select c, l, k * 96 + j * 12 + i p, k, j, i from lab where l <> 0),
recursive_links as (select x.c, x.l, x.p a, y.p b from f x join f y on x.c = y.c and x.l = y.l and abs(x.k - y.k) <= 1 and abs(x.j - y.j) <= 1 and abs(x.i - y.i) <= 1),
reach as (select c, l, p a, p b from f union select r.c, r.l, r.a, n.b from reach r join recursive_links n on n.c = r.c and n.l = r.l and n.a = r.b),
named as (select c, l, a p, min(b) part from reach group by c, l, a),
sizes as (select c, l, part, count(*) n from named group by c, l, part),
ranked as (select *, row_number() over (partition by c, l order by n desc) r from sizes),
parts as (select c, l, sum(n) voxels, count(*) pieces, max(n) filter (r = 1) s1, coalesce(max(n) filter (r = 2), 0) s2 from ranked group by c, l),
cut as (select distinct c, l from lab where l <> 0 and (k < 3 or k >= 21))"""

FAULTS = 'cast(c as bigint) case_id, cast(l as int) "label", fault, round(cast(value as double), 6) value, blocks'


def _rounded(found):
    return found.withColumn("value", F.round("value", 6))


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL} select cast(c as bigint) case_id, cast(l as int) "label", cast(voxels as bigint) voxels, pieces, cast(s1 as bigint) "first", cast(s2 as bigint) "second" from parts""")
def label_pieces(spark, sf_dir):
    return gates.pieces(_columns(spark, sf_dir, LAB))


@query(f"""with {COLUMN_SQL} select distinct cast(c as bigint) case_id, cast(l as int) "label" from lab where l <> 0 and (k < 3 or k >= 21)""")
def cut_off_labels(spark, sf_dir):
    return gates.cut_off(_columns(spark, sf_dir, LAB), _column_grids(spark, sf_dir))


STRUCTURE_SQL = """select p.c, p.l, 'split' fault, s1 / voxels value, cut.c is null blocks from parts p left join cut on cut.c = p.c and cut.l = p.l where p.l between 1 and 33 and voxels >= 1.5 and pieces > 1 and s1 < 0.85 * voxels"""


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL}, x as ({STRUCTURE_SQL}) select {FAULTS} from x""")
def structure_faults(spark, sf_dir):
    v = _columns(spark, sf_dir, LAB)
    return _rounded(gates.structure(gates.pieces(v), gates.cut_off(v, _column_grids(spark, sf_dir)), SCALE))


ORDER_SQL = """mid as (select c, l, avg(k) * 2.0 z from lab where l between 1 and 26 group by c, l),
rise as (select m.c, m.l, z - lag(z) over (partition by m.c order by m.l) rise, cut.c is not null or lag(cut.c is not null) over (partition by m.c order by m.l) free from mid m left join cut on cut.c = m.c and cut.l = m.l),
span as (select c, unnest(range(min(l), max(l) + 1)) l from lab where l between 1 and 26 group by c)"""
GAP_SQL = "select s.c, s.l, 'gap' fault, null value, true blocks from span s left join mid m on m.c = s.c and m.l = s.l where m.c is null and s.l <> 25"
RISE_SQL = "select c, l, 'order' fault, rise value, not free blocks from rise where rise >= 0"
MIXED_SQL = "select p.c, p.l, 'pieces' fault, s2 / voxels value, cut.c is null blocks from parts p left join cut on cut.c = p.c and cut.l = p.l where p.l between 1 and 26 and pieces > 1 and s2 >= 0.15 * voxels and s2 >= 0.025"


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL}, {ORDER_SQL}, x as ({MIXED_SQL} union all {GAP_SQL} union all {RISE_SQL}) select {FAULTS} from x""")
def column_faults(spark, sf_dir):
    v, grids = _columns(spark, sf_dir, LAB), _column_grids(spark, sf_dir)
    return _rounded(gates.column(v, grids, gates.pieces(v), gates.cut_off(v, grids), SCALE))


#: The voxels whose 26 neighbours all have their label, and the parts of these.
WORN_SQL = """full_ as (select x.c, x.l, x.k, x.j, x.i, count(*) n from lab x join lab y on x.c = y.c and x.l = y.l and abs(x.k - y.k) <= 1 and abs(x.j - y.j) <= 1 and abs(x.i - y.i) <= 1 where x.l between 1 and 25 group by all),
w as (select c, l, k * 96 + j * 12 + i p, k, j, i from full_ where n = 27 and exists (select 1 from parts q where q.c = full_.c and q.l = full_.l and voxels >= 4) and not exists (select 1 from cut where cut.c = full_.c and cut.l = full_.l)),
wlinks as (select x.c, x.l, x.p a, y.p b from w x join w y on x.c = y.c and x.l = y.l and abs(x.k - y.k) <= 1 and abs(x.j - y.j) <= 1 and abs(x.i - y.i) <= 1),
wreach as (select c, l, p a, p b from w union select r.c, r.l, r.a, n.b from wreach r join wlinks n on n.c = r.c and n.l = r.l and n.a = r.b),
wnamed as (select c, l, a p, min(b) part from wreach group by c, l, a),
wsizes as (select c, l, part, count(*) n from wnamed group by c, l, part),
wranked as (select *, row_number() over (partition by c, l order by n desc) r from wsizes),
wparts as (select c, l, max(n) filter (r = 1) s1, coalesce(max(n) filter (r = 2), 0) s2 from wranked group by c, l)"""
BODIES_SQL = "select c, l, 'two bodies' fault, s2 / s1 value, true blocks from wparts where s2 >= 2.5 and s2 >= 0.35 * s1"


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL}, {WORN_SQL}, x as ({BODIES_SQL}) select {FAULTS} from x""")
def doubled_bodies(spark, sf_dir):
    v = _columns(spark, sf_dir, LAB)
    return _rounded(gates.two_bodies(v, gates.cut_off(v, _column_grids(spark, sf_dir)), SCALE, 3))


#: Bones of the given label are in one piece, so their voxels are their body.
KEPT_SQL = """became as (select g.c, g.l, nullif(lab.l, 0) now, count(*) n from g join lab on g.c = lab.c and g.k = lab.k and g.j = lab.j and g.i = lab.i where g.l between 1 and 33 group by all),
top as (select c, l, arg_max(now, n * 100 - now) filter (now is not null) now from became group by c, l)"""
BECAME_SQL = "select c, l, case when now is null then 'deleted' else 'renumbered' end fault, now value, true blocks from top where now is null or (now <> l and not l between 18 and 25)"


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL}, {ORDER_SQL}, {WORN_SQL}, {KEPT_SQL}, x as ({STRUCTURE_SQL} union all {MIXED_SQL} union all {GAP_SQL} union all {RISE_SQL} union all {BODIES_SQL} union all {BECAME_SQL}) select {FAULTS} from x""")
def class_mixing_faults(spark, sf_dir):
    return _rounded(gates.class_mixing(_columns(spark, sf_dir, LAB), _column_grids(spark, sf_dir), _columns(spark, sf_dir, GIVEN), None, SCALE, 3))


#: The lower half of the column is given; 19 to 21 are added, as bones 8 to 19 are by rule, so numbers are 11 lower here.
LOWER = f"if(({GIVEN}) = 0 or k > 11, 0, ({GIVEN}) - 11)"
UPPER = """case when j between 2 and 5 and i between 4 and 7 then case when c % 7 = 0 and k div 4 = 3 then 0 when c % 9 = 0 and k = 20 then if(j = 3 and i = 5, 8, 0) when c % 9 = 0 and k > 20 then 0 else 13 - k div 4 end
  when c % 5 = 0 and k div 4 = 4 and j = 2 and i = 10 then 9 when c % 6 = 0 and k div 4 = 4 and j between 6 and 7 and i = 0 then 19 else 0 end"""


@query(f"""with recursive {COLUMN_SQL.replace("lab as (", "old as (")}, low as (select c, k, j, i, case when l = 0 or k > 11 then 0 else l - 11 end l from g), lab as (select c, up, k, j, i, {UPPER.replace(" div ", " // ")} l from v), {PARTS_SQL}, {ORDER_SQL}, {WORN_SQL},
  added as (select distinct lab.c, lab.l from lab join low on lab.c = low.c and lab.k = low.k and lab.j = low.j and lab.i = low.i where lab.l between 8 and 19 and low.l = 0),
  q as (select p.*, cut.c is not null cut from added a join parts p on p.c = a.c and p.l = a.l left join cut on cut.c = a.c and cut.l = a.l),
  o as (select distinct x.c, x.l from lab x join lab y on x.c = y.c and abs(x.k - y.k) + abs(x.j - y.j) + abs(x.i - y.i) <= 1 where x.l between 8 and 19 and y.l between 1 and 26 and x.l <> y.l),
  x as ({GAP_SQL} union all {RISE_SQL} union all {BODIES_SQL} union all select c, l, 'cut off', null, false from q where cut union all select c, l, 'small', voxels, true from q where not cut and voxels < 0.4
    union all select c, l, 'pieces', s2 / voxels, true from q where not cut and pieces > 1 and s2 >= 0.025 union all select q.c, q.l, 'floating', null, true from q left join o on o.c = q.c and o.l = q.l where not cut and o.c is null) select {FAULTS} from x""")
def spine_extension_faults(spark, sf_dir):
    return _rounded(gates.spine_extension(_columns(spark, sf_dir, UPPER), _column_grids(spark, sf_dir), _columns(spark, sf_dir, LOWER), None, SCALE, 3))


# --- ribs --------------------------------------------------------------------------------------------------------------

#: Vertebrae 12 up to 19 stand in eight pairs of slices, with ribs of both sides that reach them or don't; the supplier says which.
CHEST = """case when j between 3 and 4 and i between 7 and 8 and not (c % 6 = 0 and k >= 12) then 12 + k div 2
  when j = 3 and i between 9 + (c + k div 2) % 4 * (c % 3) and 15 - c % 2 and k % 2 = 0 and not (c % 5 = 0 and k = 4) then 38 + k div 2 when j = 4 and i between c % 2 and 6 - (c + k) % 5 and k between 1 and 14 then 50 + k div 2
  when c % 4 = 0 and j = 6 and i = 12 and k = 6 then 42 else 0 end"""
CHEST_SQL = f"""chest as (select s_suppkey c, 1 + s_nationkey % 3 sk, 1.5 sj, 1 + s_nationkey % 2 si, case when s_nationkey % 2 = 0 then 1 else -1 end up, k, j, i, {CHEST.replace(" div ", " // ").replace("c %", "s_suppkey %").replace("(c +", "(s_suppkey +")} l
  from (select s_suppkey, s_nationkey, id // 128 k, (id // 16) % 8 j, id % 16 i from supplier, range(2048) t(id)))"""


def _chests(spark, sf_dir):
    v = places(spark, sf_dir, 2048, "s_suppkey c").selectExpr("c", "id div 128 k", "(id div 16) % 8 j", "id % 16 i")
    return v.selectExpr("c case_id", "cast(k as int) k", "cast(j as int) j", "cast(i as int) i", f"cast({CHEST} as int) label")


def _chest_grids(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "16 nk", "8 nj", "16 ni", "1.0D + s_nationkey % 3 sk", "1.5D sj", "1.0D + s_nationkey % 2 si", "if(s_nationkey % 2 = 0, 1, -1) up")


RIB_N = "case when r.l > 45 then r.l - 45 else r.l - 33 end"


@query(f"""with {CHEST_SQL}, r as (select * from chest where l between 34 and 57), b as (select * from chest where l between 8 and 19),
  d as (select r.c, r.l, min(sqrt(pow((r.k - b.k) * r.sk, 2) + pow((r.j - b.j) * r.sj, 2) + pow((r.i - b.i) * r.si, 2))) d from r left join b on b.c = r.c and b.l = 7 + {RIB_N} group by r.c, r.l),
  n as (select c, unnest([l - 7 + 33, l - 7 + 45]) l from b group by c, l having count(*) >= 5),
  x as (select c, l, case when d is null then 'no vertebra' else 'apart' end fault, d value, true blocks from d where d is null or d > 3 union all select n.c, n.l, 'no rib', null, true from n left join d on d.c = n.c and d.l = n.l where d.c is null)
  select {FAULTS} from x""")
def rib_contacts(spark, sf_dir):
    return _rounded(gates.rib_contact(_chests(spark, sf_dir), _chest_grids(spark, sf_dir), least=5))


#: On every s2 voxel from the corner of ribs and spine together.
GAPS_SQL = """h as (select * from chest where l between 1 and 29 or l between 34 and 57), lo as (select c, min(k) k0, min(j) j0, min(i) i0 from h group by c),
t as (select h.* from h join lo on lo.c = h.c where (k - k0) % 2 = 0 and (j - j0) % 2 = 0 and (i - i0) % 2 = 0),
d as (select r.c, r.l, min(sqrt(pow((r.k - b.k) * r.sk, 2) + pow((r.j - b.j) * r.sj, 2) + pow((r.i - b.i) * r.si, 2))) d from t r join t b on b.c = r.c where r.l >= 34 and b.l <= 29 group by r.c, r.l)"""


@query(f"""with {CHEST_SQL}, {GAPS_SQL} select cast(c as bigint) case_id, cast(l as int) "label", round(d, 6) gap from d""")
def rib_gaps(spark, sf_dir):
    return gates.rib_gaps(_chests(spark, sf_dir), _chest_grids(spark, sf_dir)).select("case_id", "label", F.round("gap", 6).alias("gap"))


@query(f"""with {CHEST_SQL}, d as (select r.c, r.l, min(sqrt(pow((r.k - b.k) * r.sk, 2) + pow((r.j - b.j) * r.sj, 2) + pow((r.i - b.i) * r.si, 2))) d from chest r join chest b on b.c = r.c where r.l between 34 and 57 and b.l between 1 and 29 group by r.c, r.l),
  e as (select c, l, min(k) k0, max(k) k1, min(j) j0, max(j) j1, min(i) i0, max(i) i1, count(*) n, any_value(up) up, any_value(sk) sk from chest where l between 34 and 57 group by c, l),
  p as (select e.*, d.d, case when up > 0 then k1 else k0 end head, case when up > 0 then 15 else 0 end face from e join d on d.c = e.c and d.l = e.l where d.d > 4),
  lev as (select p.c, p.l, count(s.c) n from p left join chest s on s.c = p.c and s.l between 1 and 29 and abs(s.k - p.head) <= round_even(20.0 / p.sk, 0) group by p.c, p.l),
  top as (select c, max(k) hi, min(k) lo from chest where l between 1 and 25 or l = 28 group by c),
  halo as (select distinct x.c, x.l from chest x join chest y on x.c = y.c and abs(x.k - y.k) + abs(x.j - y.j) + abs(x.i - y.i) <= 2 join e ex on ex.c = x.c and ex.l = x.l join e ey on ey.c = y.c and ey.l = y.l where ex.n < 3 and ey.n >= 3 and abs(x.l - y.l) = 1 and (x.l > 45) = (y.l > 45)),
  f as (select p.c, p.l, p.d value, case when k0 = 0 or k1 = 15 or j0 = 0 or j1 = 7 or i0 = 0 or i1 = 15 then 'cut off' when abs(head - face) <= round_even(15.0 / sk, 0) then 'from above' when lev.n < 2 then 'no vertebra' when halo.c is not null then 'halo'
    when coalesce(case when up > 0 then head > hi else head < lo end, false) then 'above column' else 'detached' end fault from p join lev on lev.c = p.c and lev.l = p.l left join top on top.c = p.c left join halo on halo.c = p.c and halo.l = p.l),
  x as (select *, fault = 'detached' blocks from f) select {FAULTS} from x""")
def rib_spine_gaps(spark, sf_dir):
    return _rounded(gates.rib_spine_gap(_chests(spark, sf_dir), _chest_grids(spark, sf_dir), detached=4.0, level=2, halo=3))


@query(f"""with {CHEST_SQL}, r as (select distinct c, l from chest where l between 34 and 57), s as (select c, l > 45 s, min(l) a, max(l) b from r group by all), g as (select c, unnest(range(a, b + 1)) l from s),
  x as (select g.c, g.l, 'gap' fault, null value, false blocks from g left join r on r.c = g.c and r.l = g.l where r.c is null) select {FAULTS} from x""")
def rib_number_gaps(spark, sf_dir):
    return _rounded(gates.rib_numbers(_chests(spark, sf_dir)).where("fault = 'gap'"))


@query(f"""with recursive {COLUMN_SQL}, {PARTS_SQL}, {ORDER_SQL}, x as ({MIXED_SQL.replace("0.025", "50")} union all {GAP_SQL} union all {RISE_SQL.replace("not free", "true")}),
  b as (select c, count(*) filter (blocks) n from x group by c) select cast(v.c as bigint) case_id, coalesce(n, 0) = 0 accepted from (select distinct c from v) v left join b on b.c = v.c""")
def gated_submissions(spark, sf_dir):
    """The whole way of a submission: its label is checked, and the ledger accepts it or not."""
    v = _columns(spark, sf_dir, LAB)
    cases = table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "'1' slot", "'l' label")
    checks = gates.verdicts(cases, gates.faults("spine", v, _column_grids(spark, sf_dir))).withColumn("slot", F.lit("1"))
    return transitions.gate(cases, checks, "spine").select("case_id", "accepted")


#: A bar of two rib numbers, thick enough to be worn down; the supplier says where one becomes the other.
BAR = "if(k between 1 and 4 and j between 1 and 4 and i between 1 and 14, if(i < 2 + c % 14, 34, 35), if(c % 3 = 0 and k = 6 and j = 6, 40, 0))"


@query(f"""with v as (select s_suppkey c, id // 128 k, (id // 16) % 8 j, id % 16 i from supplier, range(2048) t(id)), lab as (select c, k, j, i, {BAR} l from v), r as (select * from lab where l <> 0),
  w as (select x.c, x.k, x.j, x.i, x.l from r x join r y on x.c = y.c and abs(x.k - y.k) <= 1 and abs(x.j - y.j) <= 1 and abs(x.i - y.i) <= 1 group by all having count(*) = 27),
  n as (select c, l, count(*) n from w group by c, l having count(*) >= 8), x as (select c, l, 'mixed' fault, n value, true blocks from n qualify count(*) over (partition by c) > 1) select {FAULTS} from x""")
def mixed_rib_labels(spark, sf_dir):
    v = places(spark, sf_dir, 2048, "s_suppkey c").selectExpr("c", "id div 128 k", "(id div 16) % 8 j", "id % 16 i")
    return _rounded(gates.mixed_ribs(v.selectExpr("c case_id", "cast(k as int) k", "cast(j as int) j", "cast(i as int) i", f"cast({BAR} as int) label"), 8))
