"""The queries that SQL can express, in DuckDB's dialect, by plain counting over all windows."""

from __future__ import annotations

from volcohort.llm import decontaminate, quality_rules

WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# Words covered by a window of 20 that starts earlier; kept words in one string.
OP8 = f"""
with d as (select doc_id, {WORDS.format("coalesce(text, '')")} w from documents),
w as (select doc_id, w, unnest(range(1, len(w) - 18)) p from d where len(w) >= 20),
n as (select doc_id, p, array_to_string(w[p:p + 19], ' ') s from w),
f as (select doc_id, p, row_number() over (partition by s order by doc_id, p) r from n),
x as (select distinct doc_id, p + g q from f, range(20) t(g) where r > 1),
g as (select doc_id, list(q) q from x group by doc_id),
k as (select d.doc_id, d.w, list_filter(range(1, len(d.w) + 1), lambda i: not list_contains(coalesce(g.q, []), i)) kept from d left join g on d.doc_id = g.doc_id)
select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - len(kept) as bigint) n_removed, sha256(array_to_string(list_transform(kept, lambda i: w[i]), ' ')) kept_sha256 from k"""

# Bytes covered by a string of 50 that starts in an earlier document; pieces between the covered runs are joined.
OP6 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, strlen(coalesce(text, '')) n from documents),
w as (select doc_id, unnest(range(0, n - 49)) p, h from d where n >= 50),
s as (select doc_id, p, md5_number(substr(h, 2 * p + 1, 100)) m from w),
f as (select doc_id, p, min(doc_id) over (partition by m) first from s),
c as (select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 50 then 0 else 1 end new from f where first < doc_id),
g as (select doc_id, p, sum(new) over (partition by doc_id order by p) r from c),
r as (select doc_id, r, min(p) a, max(p) + 50 b from g group by doc_id, r),
k as (select doc_id, r, coalesce(lag(b) over (partition by doc_id order by r), 0) lo, a hi, b from r),
t as (select doc_id, sum(b - hi) n_removed, count(*) n_spans, max(b) e from k group by doc_id),
j as (select k.doc_id, string_agg(substr(d.h, 2 * lo + 1, 2 * (hi - lo)), '' order by lo) h from k join d on d.doc_id = k.doc_id group by k.doc_id)
select d.doc_id, cast(d.n as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, cast(coalesce(n_spans, 0) as bigint) n_spans,
  sha256(unhex(case when t.doc_id is null then d.h else j.h || substr(d.h, 2 * t.e + 1) end)) kept_sha256
from d left join t on t.doc_id = d.doc_id left join j on j.doc_id = d.doc_id"""

# The best window of each document and item that are similar enough, over all windows of pairs that share a shingle.
OP2 = f"""
with b as (select item_id, {WORDS.format("lower(coalesce(text, ''))")} w from benchmark),
i as (select item_id, w, len(w) n, least(5, len(w)) k from b where len(w) > 0),
ish as (select item_id, n, k, array_to_string(w[q:q + k - 1], ' ') s from (select *, unnest(range(1, n - k + 2)) q from i)),
icount as (select item_id, s, count(*) c from ish group by item_id, s),
d as (select doc_id, {WORDS.format("lower(coalesce(text, ''))")} w from documents),
ks as (select distinct k from i),
dsh as (select doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') s from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) p from d, ks where len(w) >= k)),
pairs as (select distinct dsh.doc_id, ish.item_id, ish.n, ish.k from dsh join ish on dsh.s = ish.s and dsh.k = ish.k),
wins as (select pairs.*, least(len(w), n) size, unnest(range(0, greatest(1, len(w) - n + 1))) st from pairs join d on d.doc_id = pairs.doc_id),
got as (select wins.doc_id, wins.item_id, wins.n, st, size, wins.k, dsh.s, count(*) c from wins join dsh on dsh.doc_id = wins.doc_id and dsh.k = wins.k and dsh.p between st + 1 and st + size - wins.k + 1 group by all),
sim as (select got.doc_id, got.item_id, st, got.n, sum(least(got.c, coalesce(icount.c, 0))) shared, max(size - k + 1) + max(got.n - k + 1) total
  from got left join icount on icount.item_id = got.item_id and icount.s = got.s group by got.doc_id, got.item_id, st, got.n),
best as (select *, shared / (total - shared) similarity from sim where shared >= {decontaminate.THRESHOLD} * (total - shared)),
r as (select *, row_number() over (partition by doc_id, item_id order by similarity desc, st) r from best)
select doc_id, item_id, cast(st as int) as "start", cast(n as int) n_words, round(similarity, 6) similarity from r where r = 1"""


# Lines whose key an earlier document holds go.
OP11 = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select doc_id, unnest(ls) l, generate_subscripts(ls, 1) i from d),
k as (select doc_id, i, l, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from l),
f as (select k, min(doc_id) first from k where length(k) >= 10 group by k),
g as (select k.*, coalesce(first < doc_id, false) gone from k left join f on f.k = k.k)
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped, sha256(coalesce(string_agg(l, chr(10) order by i) filter (not gone), '')) kept_sha256 from g group by doc_id"""

# Runs by comparing all pairs of equal words of a text; crc32 by its polynomial, one bit at a time.
OP12 = f"""
with c as (select doc_id, {WORDS.format("coalesce(text, '')")} w, xor(4294967295::ubigint, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ord(x)::ubigint),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda r, z: xor(r >> 1, 3988292384::ubigint * (r & 1::ubigint))), 4294967295::ubigint))::bigint h from documents),
g as (select *, len(w) n, h // 10 g from c),
a as (select *, case when n > 0 and h % 10 = 0 then g % n end a from g),
p as (select *, 1 + (n - a) // (3 + g % 8) p from a),
d as (select doc_id, n, case when a is null then w else list_transform(range(0, n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) end w from p),
t as (select doc_id, n, unnest(w) x, unnest(range(0, n)) i from d),
m as (select s.doc_id, s.i, e.i - s.i p from t s join t e on s.doc_id = e.doc_id and s.x = e.x where e.i > s.i and 2 * (e.i - s.i) <= s.n),
k as (select *, i - row_number() over (partition by doc_id, p order by i) k from m),
e as (select doc_id, p, min(i) s, count(*) + p l from k group by doc_id, p, k having count(*) + p >= greatest(12, 2 * p)),
r as (select doc_id, s, l, min(p) q from e group by doc_id, s, l),
b as (select *, row_number() over (partition by doc_id order by l desc, s, q) b from r),
o as (select doc_id, count(*) n_runs, max(s) filter (b = 1) "start", max(l) filter (b = 1) length, max(q) filter (b = 1) period, string_agg(concat(s, ',', l, ',', q, chr(10)), '' order by s, q) told from b group by doc_id),
x as (select distinct doc_id, unnest(range(s + q, s + l)) i from r),
y as (select t.doc_id, string_agg(t.x, ' ' order by t.i) kept from t left join x on x.doc_id = t.doc_id and x.i = t.i where x.i is null group by t.doc_id)
select d.doc_id, coalesce(n_runs, 0) n_runs, cast("start" as bigint) "start", cast(length as bigint) length, cast(period as bigint) period, cast(1000 * length // period as bigint) exponent_milli,
  sha256(coalesce(told, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256 from d left join o on o.doc_id = d.doc_id left join y on y.doc_id = d.doc_id"""

# Negatives by all scores of all anchors.
OP13 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id anchor_id, b.vec_id, b.label = a.label same, cast(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) as bigint) s
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id positive_id, s positive_score from s where same qualify row_number() over (partition by anchor_id order by s desc, vec_id) <= 5),
n as (select p.*, s.vec_id negative_id, s.s negative_score, row_number() over (partition by p.anchor_id, positive_id order by s.s desc, s.vec_id) r
  from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * positive_score <= 100 * s.s and s.s <= positive_score)
select anchor_id, positive_id, cast(r as int) rank, negative_id, positive_score, negative_score from n where r <= 5"""


def _op1() -> str:
    q = quality_rules
    every = "['" + "', '".join(sorted({w for ws in q.COMMON_WORDS.values() for w in ws})) + "']"
    lists = "map {" + ", ".join(f"'{k}': ['" + "', '".join(v) + "']" for k, v in q.COMMON_WORDS.items()) + "}"
    cut = lambda p: f"(n - length(regexp_replace(t, '{p}', '', 'g')))"
    part = "case when {0} > 0 then {0} * log2({0} / (({0} + {1}) / 2)) else 0 end"
    js = lambda p, r: f"sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {part.format(f'{p}[i]', f'{r}[i]')} + {part.format(f'{r}[i]', f'{p}[i]')})) / 2))"
    mean = lambda c, n, least: f"case when count({c}) >= {least} then [" + ", ".join(f"avg({c}[{i + 1}])" for i in range(n)) + "] end"
    common = max(len(v) for v in q.COMMON_WORDS.values()) + 1
    return f"""
with d as (select doc_id, lang, coalesce(text, '') t, length(coalesce(text, '')) n, strlen(coalesce(text, '')) b, {WORDS.format("coalesce(text, '')")} w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls,
  list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+'), lambda x: x <> '') a from documents),
c as (select *, {cut('[A-Z]+')} up, {cut('[0-9]+')} dg, {cut('[!-/:-@\\[-`{-~]+')} mk, b - n fa, {cut('[#*$%&|<>]+')} n_symbols, list_filter(a, lambda x: list_contains({every}, x)) cw, {lists}[lang] l from d),
h as (select *, case when b >= {q.MIN_BYTES} then list_transform([up, dg, mk, fa, b - up - dg - mk - fa], lambda x: x / b) end cl,
  case when len(a) >= {q.MIN_WORDS} and l is not null then list_transform(l, lambda r: len(list_filter(cw, lambda x: x = r))) end k from c),
m as (select *, case when k is not null then list_transform(list_append(k, len(a) - list_sum(k)), lambda x: x / len(a)) end cm from h),
ref as (select lang, {mean("cl", q.CLASSES, q.MIN_REFERENCE)} rc, {mean("cm", common, q.MIN_REFERENCE)} rw from m where lang is not null group by lang),
win as (select doc_id, p, array_to_string(w[p:p + 7], ' ') s from (select doc_id, w, unnest(range(1, len(w) - 6)) p from d where len(w) >= 8)),
dup as (select doc_id, p from (select *, count(*) over (partition by doc_id, s) k from win) where k > 1),
rep as (select doc_id, count(distinct p + g) n_repeat_words from dup, range(8) z(g) group by doc_id),
o as (select m.doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars, cast(n_symbols as bigint) n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines,
  cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words, case when cl is not null and rc is not null then {js("cl", "rc")} end cd, case when cm is not null and rw is not null then {js("cm", "rw")} end wd,
  cm[-1] rest, rw[-1] ref, len(a) na, case when cm is not null and rw is not null then {js("[1 - cm[-1], cm[-1]]", "[1 - rw[-1], rw[-1]]")} end sd
  from m left join ref on ref.lang = m.lang left join rep on rep.doc_id = m.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(cd, 6) class_distance, round(wd, 6) word_distance, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and not (coalesce(cd, 0) > {q.MAX_CLASS_DISTANCE} or coalesce(wd, 0) > {q.MAX_WORD_DISTANCE} or coalesce(rest > ref and sd > {q.MAX_SHARE_DISTANCE} + {q.SHARE_NOISE} / sqrt(na), false)) kept from o"""


OP1 = _op1()
