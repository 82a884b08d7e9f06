"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op11_source_divergence"] = r"""
with docs as (
  select row_number() over () as row_no, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
seen as (
  select lang, source, term, count(*) as n, count(distinct row_no) as df
  from (select row_no, lang, source, unnest(terms) as term from docs) group by all),
kept as (
  select lang, term, sum(n)::hugeint as lang_n from seen group by all having sum(df) >= 10),
held as (select s.lang, s.source, s.term, s.n::hugeint as n from seen s join kept k using (lang, term)),
groups as (
  select g.lang, g.source, coalesce(h.total, 0)::hugeint as total
  from (select distinct lang, source from docs) g
  left join (select lang, source, sum(n) as total from held group by all) h using (lang, source)),
langs as (select lang, sum(lang_n)::hugeint as lang_total, count(*)::hugeint as v from kept group by all),
share as (
  select g.lang, g.source, k.term, coalesce(h.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(h.n, 0) + 2)) // (g.total + 2 * l.v) as p,
         1 + (1000000000::hugeint * (k.lang_n + 2)) // (l.lang_total + 2 * l.v) as q
  from groups g join langs l using (lang) join kept k using (lang) left join held h using (lang, source, term)),
pairs as (
  select g.lang, g.source, o.source as item, coalesce(s.value, 0)::bigint as value
  from groups g join groups o on g.lang = o.lang and g.source <> o.source
  left join (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
    from share a join share b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all) s on s.lang = g.lang and s.source = g.source and s.item = o.source),
tops as (
  select lang, source, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value
  from share where n > 0 and p > q),
ranked as (
  select lang, source, 'term' as part, item, value,
         row_number() over (partition by lang, source order by value desc, item) as rank from tops)
select lang, source, part, item, value, rank::int as rank from ranked where rank <= 10
union all
select lang, source, 'pair', item, value,
       row_number() over (partition by lang, source order by value desc, item)::int from pairs
"""

ORACLE_SQL["op12_filter_interaction"] = r"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
lab as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
flags as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
         (len(ws) < 50)::int as a,
         (100 * len(list_distinct(ws)) < 65 * len(ws))::int as b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int as c,
         regexp_matches(t, '[#$%&*|]')::int as d,
         coalesce((min(d.doc_id) over (partition by t) < d.doc_id)::int, 0) as e
  from docs d left join lab l on d.doc_id = l.doc_id),
counts as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, count(*) as n, sum(good) as good, sum(toxic) as toxic
  from flags group by all),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)),
orders as (
  select p.letter || q.letter || r.letter || s.letter || u.letter as filter_order,
         [p.bit, q.bit, r.bit, s.bit, u.bit] as bits
  from letters p, letters q, letters r, letters s, letters u
  where p.bit | q.bit | r.bit | s.bit | u.bit = 31),
steps as (
  select filter_order, step, bits[step] as bit, list_sum(list_slice(bits, 1, step - 1))::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
whole as (select part, sum(n) as total from counts group by part),
tab as (
  select w.part, s.filter_order, s.step, s.bit,
         (w.total - coalesce(sum(c.n) filter (c.mask & (coalesce(s.before, 0) | s.bit) <> 0), 0))::bigint as kept,
         coalesce(sum(c.n) filter (c.mask & s.bit <> 0 and c.mask & coalesce(s.before, 0) = 0), 0)::bigint as removed,
         coalesce(sum(c.n) filter (c.mask & s.bit <> 0 and c.mask & coalesce(s.before, 0) <> 0), 0)::bigint as redundant,
         coalesce(sum(c.n) filter (c.mask = s.bit), 0)::bigint as unique_fails,
         coalesce(sum(c.good) filter (c.mask & s.bit <> 0 and c.mask & coalesce(s.before, 0) = 0), 0)::bigint as good_lost,
         coalesce(sum(c.toxic) filter (c.mask & s.bit <> 0 and c.mask & coalesce(s.before, 0) = 0), 0)::bigint as toxic_lost
  from whole w join counts c using (part), steps s
  group by w.part, w.total, s.filter_order, s.step, s.bit)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from tab
"""
