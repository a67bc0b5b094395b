"""DuckDB SQL of the training-data queries that SQL can express.

Not here, because SQL has no tokenizers, fitted trees, EM weights or template alignment:
op1, op3, op5, op6, op9, op13 and the pipeline; tests/llm holds brute-force versions or held-out rates (op5).
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _low(c: str) -> str:
    return f"translate(coalesce({c}, ''), '{_UPPER}', '{_UPPER.lower()}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
with d as (select doc_id, regexp_extract_all({_low('text')}, '{_ALNUM}') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all({_low('text')}, '{_ALNUM}') as w from benchmark where item_id is not null),
bw as (select distinct item, least(len(w), 13) as n, list_slice(w, i, i + least(len(w), 13) - 1) as win
       from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select doc_id, i, n, list_slice(w, i, i + n - 1) as win
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
m as (select dw.doc_id, dw.i, dw.n, bw.item from dw join bw on dw.n = bw.n and dw.win = bw.win),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join its using (doc_id)"""

OP4 = rf"""
with p as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
r(rhost, rpath, rverdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                     ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f as (select page_id, rhost || rpath as rule, rverdict,
             row_number() over (partition by page_id order by length(rhost || rpath) desc, length(rhost) desc) as k
      from h, r where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict
from h left join (select page_id, rule, rverdict from f where k = 1) using (page_id)"""

OP7 = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') as w from documents),
win as (select doc_id, i, list_slice(w, i, i + 34) as s
        from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
twice as (select s from win group by s having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as p from win where s in (select s from twice)),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) as t from words anti join gone using (doc_id, p) group by doc_id),
n as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)"""

OP8 = rf"""
with recursive d as (select doc_id, regexp_extract_all({_low('text')}, '{_BLANK}') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4))
                                          when len(w) > 0 then [w] else [] end) as g from d),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n + nb.n - k)),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (select doc_id, doc_id from d union select reach.doc_id, b from reach join both_ways on a = other)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, min(other) as component_id, d.doc_id = min(other) as kept
from d join reach using (doc_id) left join n using (doc_id) group by d.doc_id, n.n"""

OP11 = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all({_low('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
occ as (select r, lang, source, unnest(w) as term from d),
lt as (select lang, term, count(*) as c from occ group by lang, term having count(distinct r) >= 10),
ls as (select lang, count(*) as v, sum(c) as n from lt group by lang),
gt as (select lang, source, term, count(*) as c from occ join lt using (lang, term) group by lang, source, term),
g as (select d.lang, d.source, coalesce(any_value(t.n), 0) as n from (select distinct lang, source from d) d
      left join (select lang, source, sum(c) as n from gt group by all) t using (lang, source) group by all),
p as (select g.lang, g.source, lt.term, coalesce(gt.c, 0) as c,
             1 + (1000000000::hugeint * (coalesce(gt.c, 0) + 2)) // (g.n + 2 * ls.v)::hugeint as p,
             1 + (1000000000::hugeint * (lt.c + 2)) // (ls.n + 2 * ls.v)::hugeint as q
      from g join ls using (lang) join lt using (lang) left join gt on gt.lang = g.lang and gt.source = g.source and gt.term = lt.term),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
         from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select x.lang, x.source, 'pair' as part, y.source as item, cast(coalesce(s.value, 0) as bigint) as value
          from g x join g y on x.lang = y.lang and x.source <> y.source
          left join sums s on s.lang = x.lang and s.source = x.source and s.item = y.source),
terms as (select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value
          from p where c > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
           from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10"""

OP12 = rf"""
with recursive c as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                            coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
way as (select *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: cast(ascii(substr(k, i, 1)) as bigint)), lambda crc, byte:
               list_reduce(range(0, 8), lambda x, bit: xor(x >> 1, case when x % 2 = 1 then 3988292384 else 0 end), xor(crc, byte)),
               4294967295), 4294967295) % 20 as way from c),
dam as (select conv_id, turn, case when way = 4 then 'user' else role end as role,
               case when way = 1 then '' when way = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from (select *, unnest(range(0, case when way = 3 then 2 else 1 end)) as copy from way where way <> 0)),
r0 as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
              rtrim(text, e' \t\n\x0b\x0c\r') as body, substr(role, 1, 1) as ini from dam),
r1 as (select *, case when body = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
              lag(ini) over (partition by conv_id order by pos) as prev from r0),
ins(i, j, m) as (values (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (2, 3, 1), (3, 2, 1), (0, 3, 2), (1, 3, 2), (2, 2, 2), (3, 3, 2)),
op(letter, cost, ini, i, j) as (values ('K', 0, 's', 0, 1), ('K', 0, 'u', 0, 2), ('K', 0, 'u', 1, 2), ('K', 0, 'u', 3, 2), ('K', 0, 'a', 2, 3),
  ('R', 1, null, 0, 2), ('R', 1, null, 1, 2), ('R', 1, null, 2, 3), ('R', 1, null, 3, 2),
  ('D', 2, null, 0, 0), ('D', 2, null, 1, 1), ('D', 2, null, 2, 2), ('D', 2, null, 3, 3)),
step as (select x.i as i, o.j as j, o.ini, o.letter, 5 * x.m + o.cost as cost, repeat('I', x.m) || o.letter as word from ins x join op o on x.j = o.i),
ids as (select distinct conv_id from conversations),
dp as (select conv_id, 0::bigint as n, 0 as st, 0::bigint as cost, '' as audit from ids
       union all
       select conv_id, n, st, cost, audit from (
         select d.conv_id, r.pos as n, s.j as st, d.cost + s.cost + case when r.fault = 'truncated' and s.letter <> 'D' then 5 else 0 end as cost,
                d.audit || s.word as audit,
                row_number() over (partition by d.conv_id, s.j order by d.cost + s.cost + case when r.fault = 'truncated' and s.letter <> 'D' then 5 else 0 end, d.audit || s.word) as best
         from dp d join r1 r on r.conv_id is not distinct from d.conv_id and r.pos = d.n + 1
         join step s on s.i = d.st and (s.ini is null or s.ini = r.ini) and (s.letter = 'D' or r.fault not in ('blank', 'duplicate'))) where best = 1),
sums as (select conv_id, count(*) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
                count(*) filter (where fault = 'truncated') as truncated,
                count(*) filter (where prev is not null and prev || ini not in ('su', 'ua', 'au')) as illegal from r1 group by conv_id),
fin as (select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(rows, 0) as rows
        from ids left join sums on sums.conv_id is not distinct from ids.conv_id),
e as (select *, row_number() over (partition by conv_id order by cost, audit) as best from (
        select f.*, d.cost + 5 * t.m as cost, d.audit || repeat('I', t.m) as audit
        from fin f join dp d on d.conv_id is not distinct from f.conv_id and d.n = f.rows
        join (values (0, 0), (1, 2), (2, 1), (3, 0)) t(st, m) on t.st = d.st)),
chosen as (select * from e where best = 1),
letters as (select conv_id, i, substr(audit, i, 1) as letter, length(replace(substr(audit, 1, i), 'I', '')) as pos
            from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as i from chosen)),
lines as (select l.conv_id, l.i, l.letter, r.role, r.ini, case when l.letter = 'I' then '' else r.text end as text,
                 row_number() over (partition by l.conv_id order by l.i) as place,
                 first_value(l.letter = 'K' and r.ini = 's') over (partition by l.conv_id order by l.i) as headed
          from letters l left join r1 r on r.conv_id is not distinct from l.conv_id and r.pos = l.pos and l.letter <> 'I' where l.letter <> 'D'),
written as (select conv_id, string_agg(case when letter = 'K' then role when (place - headed::int) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by i) as t
            from lines group by conv_id)
select c.conv_id, cast(gaps as bigint) as gaps, cast(blank as bigint) as blank, cast(duplicate as bigint) as duplicate, cast(truncated as bigint) as truncated,
       cast(illegal as bigint) as illegal, cast(cost as bigint) as cost, audit, sha256(coalesce(t, '')) as repaired_sha256
from chosen c left join written w on w.conv_id is not distinct from c.conv_id"""

OP10 = """
with p as (select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex from pages),
bits as (select *, array_to_string(list_transform(range(1, 41), lambda i:
           lpad(bin(instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') as b from p),
coded as (select page_id, payload, array_to_string(list_transform(range(0, 32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda k:
              cast(substr(b, 5 * i + k + 1, 1) as integer) * (16 >> k)))::integer, 1)), '') as digest from bits),
top as (select digest, max(page_id) as original from coded group by digest)
select page_id, cast(octet_length(payload) as bigint) as payload_bytes, digest as payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id = original then null else original end as refers_to
from coded join top using (digest)"""
