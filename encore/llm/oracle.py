"""DuckDB SQL of the queries that SQL can express, written from their
definitions. Every statement reads whole tables and whole texts."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
with d as (select doc_id, coalesce(text, '') as text, {_WORDS} as ws from documents),
w as (select doc_id, generate_subscripts(ws, 1) as i, unnest(ws) as x from d),
runs as (
  select doc_id, i, len(ws) as n, i + k - 1 <= len(ws) as whole, k, md5(array_to_string(ws[i:i + k - 1], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from d),
       (values (3), (10), (101)) as sizes(k)),
again as (select doc_id, k, h from runs where whole group by all having count(*) > 1),
starts as (select distinct r.doc_id, r.k, r.i from runs r join again using (doc_id, k, h) where r.whole),
cov as (
  select doc_id, count(distinct case when k = 3 then j end) as rep, count(distinct case when k = 10 then j end) as long,
         max(k) as longest
  from (select doc_id, k, unnest(range(i, i + k)) as j from starts) group by 1),
lines as (
  select doc_id, sum(n - 1)::bigint as dup from (
    select doc_id, line, count(*) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1, 2) group by 1),
b as (
  select doc_id, len(ws)::bigint as n_words, coalesce(list_sum([length(x) for x in ws]), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(dup, 0)::bigint as n_dup_lines, coalesce(rep, 0)::bigint as n_repeat_words,
         coalesce(long, 0) as long, coalesce(longest, 0) as longest
  from d left join cov using (doc_id) left join lines using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
         and long::double / greatest(n_words, 1) <= 0.3 and longest < 101 as kept
from b
"""

OP6 = rf"""
with d as (select doc_id, {_WORDS} as ws from documents),
windows as (
  select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from d where len(ws) >= 50)),
low as (select h, min(doc_id) as lowest from windows group by 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as j
  from windows join low using (h) where lowest < doc_id),
per as (select doc_id, count(*) as n, list(j) as js from gone group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
       sha256(case when n is null then array_to_string(ws, ' ')
              else coalesce((select string_agg(x, ' ' order by p) from
                (select unnest(d.ws) as x, generate_subscripts(d.ws, 1) as p)
                where not list_contains(per.js, p)), '') end) as kept_sha256
from d left join per using (doc_id)
"""

OP8 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select distinct doc_id, md5(array_to_string(ws[i:i + 4], ' ')) as h
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
both_ as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from links union select b, a from links),
reach as (select doc_id as v, doc_id as r from n union select e.b, reach.r from reach join e on e.a = reach.v),
comp as (select v, min(r) as root from reach group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(root, d.doc_id) as component_id
from d left join n using (doc_id) left join comp on comp.v = d.doc_id
"""

OP10 = """
with recursive v as (
  select vec_id, label, [x::double for x in embedding] as e from embeddings),
ok as (
  select vec_id, label, e from v
  where label is not null and e is not null and len(e) > 0
    and list_bool_and([coalesce(isfinite(x), false) for x in e])
    and list_bool_or([x <> 0 for x in e])),
u as (select vec_id, label, e, sqrt(list_dot_product(e, e)) as n from ok),
links as (
  select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id
    and len(a.e) = len(b.e) and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach as (select vec_id as v, vec_id as r from v union select links.b, reach.r from reach join links on links.a = reach.v),
comp as (select v, min(r) as root from reach group by 1),
cnt as (select a, count(*) as n from links group by 1)
select v.vec_id, coalesce(cnt.n, 0)::bigint as n_links, root as component_id, v.vec_id = root as kept
from v left join cnt on cnt.a = v.vec_id left join comp on comp.v = v.vec_id
"""



def _crc32(raw: str) -> str:
    """Unsigned crc32 of a blob; ``tab`` is a row with the byte table ``t``."""
    return f"""xor(list_reduce([4294967295::bigint]
      || [('0x' || substr(hex({raw}), i, 2))::bigint for i in range(1, 2 * octet_length({raw}), 2)],
      lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295)"""


_TAB = """
tab as (
  select [list_reduce([i] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) for i in range(256)] as t)"""

# One document after another, each to the first shard clockwise that is not full.
OP11 = rf"""
with recursive {_TAB},
nodes as (
  select s, place, row_number() over (order by place, s) - 1 as arc
  from (select s, ('0x' || substr(md5(s || '/' || v), 1, 8))::bigint >> 19 as place
        from range(8) a(s), range(64) b(v))),
around as (
  select x.arc, list(y.s order by (y.arc - x.arc + 512) % 512) as shards from nodes x, nodes y group by 1),
docs as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, {_crc32("encode(coalesce(text, ''))")} as crc,
         md5(coalesce(doc_id::varchar, '')) as h
  from documents, tab),
line as materialized (
  select doc_id, size, crc, coalesce((select min(arc) from nodes where place >= ('0x' || substr(h, 1, 8))::bigint >> 19), 0) as arc,
         row_number() over (order by ('0x' || substr(h, 9, 8))::bigint, doc_id nulls first, crc, size) as num
  from docs),
room as (select [count(*) // 8 + (i < count(*) % 8)::int for i in range(8)] as cap from documents),
walk as (
  select 0::bigint as num, -1::bigint as shard, [0::bigint for i in range(8)] as loads
  union all
  select num, shard, [loads[i] + (i = shard + 1)::int for i in range(1, 9)]
  from (select line.num, loads, [s for s in shards if loads[s + 1] < cap[s + 1]][1] as shard
        from walk join line on line.num = walk.num + 1 join around using (arc), room))
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, shard::int as shard,
       row_number() over (partition by shard order by num) - 1 as slot, null::int as grown_shard
from line join walk using (num)
"""

OP12 = rf"""
with recursive {_TAB},
runs as (
  select doc_id, run, count(*) as k from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run from documents) group by 1, 2),
hashed as (select run, k, {_crc32("encode(coalesce(doc_id::varchar, '') || ':' || run)")} as h from runs, tab),
words as (
  select case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word,
         sum(k)::bigint as n
  from hashed group by 1 having length(word) >= 5 and sum(k) >= 3),
spots as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
holes as (select word, n, left(word, i - 1) || '*' || substr(word, i + 1) as x from spots),
less as (select distinct word, n, left(word, i - 1) || substr(word, i + 1) as x from spots),
pairs as (
  select a.word as a, b.word as b, b.n as n_b from holes a join holes b using (x) where a.word <> b.word
  union select less.word, w.word, w.n from less join words w on less.x = w.word
  union select w.word, less.word, less.n from less join words w on less.x = w.word),
best as (
  select a as word, b, n_b, count(*) over (partition by a) as n_near,
         row_number() over (partition by a order by n_b desc, b) as place
  from pairs),
forms as (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when n_b >= 2 * n then b end as form,
         case when n_b >= 2 * n then n_b end as form_n
  from words left join (select * from best where place = 1) using (word)),
follow as (
  select word, form as top from forms where form is not null
  union all
  select follow.word, forms.form from follow join forms on forms.word = follow.top where forms.form is not null),
ends as (select word, top as root from follow where top in (select word from forms where form is null))
select word, form, coalesce(root, word) as root, n, n_near, form_n from forms left join ends using (word)
"""

OP13 = r"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || coalesce(doc_id::varchar, '')) as h
  from documents),
c as (
  select *, [('0x' || substr(h, 8 * i + 1, 8))::bigint for i in range(4)] as k,
         text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') as plain
  from d),
e as (
  select *, least(k[1] % (len(u) + 1), k[2] % (len(u) + 1)) as low, greatest(k[1] % (len(u) + 1), k[2] % (len(u) + 1)) as high
  from c),
p as (
  select doc_id, len(u) as n, text, case when plain or k[3] % 100 >= 100 then 'plain'
           when k[4] % 100 < 50 then 'spm' else 'psm' end as form,
         array_to_string(u[1:low], '') as a, array_to_string(u[low + 1:high], '') as b,
         array_to_string(u[high + 1:], '') as c
  from e)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(a) end::bigint as prefix_chars,
       case when form <> 'plain' then length(b) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || a || '<S>' || c || '<M>' || b
              else '<S>' || c || '<P>' || a || '<M>' || b end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": OP5, "op6_substring_dedup": OP6, "op8_jaccard_join": OP8,
            "op10_metric_range_join": OP10, "op11_ring_shards": OP11, "op12_spelling_variants": OP12,
            "op13_fill_in_middle": OP13}
