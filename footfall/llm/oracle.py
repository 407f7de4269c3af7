"""DuckDB SQL that registered queries must agree with. Used for checking only."""

from footfall.llm import url_filter

_MIX = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) as size,
    md5(concat_ws('|', coalesce(cast(doc_id as varchar), '-'), md5(text), source)) as entry from documents),
e as (select *, row_number() over (partition by entry) as nth from d),
s as (
  select *, case (sid - 1) % 3 when 0 then 5.0::double when 1 then 2.0 else 1.0 end as weight, 2.0::double * source_size as most
  from (select *, row_number() over (order by source is null, encode(source)) as sid
    from (select source, sum(size)::bigint as source_size from d group by source))),
l as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(most) over (order by most / weight, sid
      rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by most / weight, sid rows between current row and unbounded following) as level from s),
t as (
  select sid, source, source_size, case when level * weight > most then most
    else weight * max(case when level * weight > most then null else level end) over () end as target from l),
q as (
  select e.entry, e.nth, e.size, t.sid, t.target, p.pass, p.pass + ('0x' || left(md5(concat_ws('/', e.entry, e.nth, p.pass, 42)), 13))::bigint
    / 4503599627370496::double as place
  from e join t on e.source is not distinct from t.source join (values (0), (1)) p(pass) on p.pass * t.source_size < t.target
  where e.size > 0),
f as (
  select *, (sum(size) over (partition by sid order by place, entry, nth rows unbounded preceding))::bigint / target as finish from q),
k as (
  select entry, nth, count(*) as copies from (
    select *, sum(size) over (order by finish, sid, entry, nth, pass rows unbounded preceding) as total from f)
  where total <= 1.5 * (select sum(size) from d) group by entry, nth),
m as (select entry, sum(copies) as served, (select count(*) from d where d.entry = k.entry) as rows from k group by entry)
select e.doc_id, e.size, t.source_size, coalesce(t.target, 0) as target,
  cast(coalesce(m.served // m.rows + case when e.nth <= m.served % m.rows then 1 else 0 end, 0) as int) as copies,
  cast(e.size * coalesce(m.served // m.rows + case when e.nth <= m.served % m.rows then 1 else 0 end, 0) as bigint) as taken
from e join t on e.source is not distinct from t.source left join m on e.entry = m.entry"""


def _blocked(terms: list[str]) -> str:
    host = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return " + ".join(f"regexp_matches({host}, '(^|[^0-9a-z]){t}([^0-9a-z]|$)')::int" for t in terms)


_URLS = rf"""
with p as (
  select page_id, url, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages),
q as (
  select page_id, url, regexp_extract(regexp_extract(rest, '^[^/?#]*'), '.*') as h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from p),
r as (
  select *, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from q),
rules as (
  select *, split_part(rule, '/', 1) as rh, rule[strpos(rule, '/'):] as rp from (values ('org/', 'allow'),
    ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')) v(rule, verdict)),
judged as (
  select *, cast({_blocked(url_filter.STRICT_TERMS)} as int) as strict_hits, cast({_blocked(url_filter.SOFT_TERMS)} as int) as soft_hits,
    (select arg_max(struct_pack(rule := rule, verdict := verdict), len(rule)) from rules
      where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)) as fit from r)
select page_id, host, path, fit.rule as rule, strict_hits, soft_hits,
  coalesce(fit.verdict, case when strict_hits > 0 or soft_hits >= {url_filter.SOFT_HITS} then 'block' else 'allow' end) as verdict
from judged"""

_LEAKS = r"""
with w as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
v as (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[i:i + 9], ' ') as phrase
  from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from b where len(words) > 0)),
lengths as (select distinct n from v),
p as (
  select r, i, n, array_to_string(words[i:i + n - 1], ' ') as phrase
  from (select r, words, n, unnest(range(1, len(words) - n + 2)) as i from w, lengths)),
m as (select distinct r, i, n, item_id from p join v using (n, phrase)),
h as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from m) group by r),
k as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct r, item_id from m) group by r)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join h using (r) left join k using (r)"""

_ENDS = r".!?\x0A\x{0589}\x{061F}\x{06D4}\x{0964}\x{0965}\x{1362}\x{203C}\x{3002}\x{FF01}\x{FF0E}\x{FF1F}\x{FF61}"
_SPANS = r"""
with d as (
  select doc_id, text, regexp_extract_all(text, '[^ENDS]+(?:[ENDS][\x09-\x0D\x20ENDS]*)?|[ENDS][\x09-\x0D\x20ENDS]*') as ss from documents),
s as (select doc_id, unnest(ss) as s, unnest(range(len(ss))) as j from d),
v as (
  select doc_id, j, s, flatten(list_transform(regexp_extract_all(s, '[\x09-\x0D\x20]*[^\x09-\x0D\x20]+[\x09-\x0D\x20]*'), lambda w:
    case when len(w) > 32 then list_transform(regexp_extract_all(w, '(?s).'), lambda c: {'u': c, 'r': 12}) else [{'u': w, 'r': 2}] end)) as v
  from s),
u as (select doc_id, j, unnest(v, recursive := true), unnest(range(len(v))) as i, len(v) as n from v where len(v) > 16),
k as (select *, left(md5(trim(u, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')), 8) as k from u),
m as (
  select *, case r when 2 then min(k) over (w rows between 2 preceding and 1 preceding)
      else min(k) over (w rows between 12 preceding and 1 preceding) end as before,
    case r when 2 then min(k) over (w rows between 1 following and 2 following)
      else min(k) over (w rows between 1 following and 12 following) end as after
  from k window w as (partition by doc_id, j order by i)),
c as (
  select *, coalesce(sum(case when coalesce(before > k, true) and coalesce(after >= k, true) then 1 else 0 end)
    over (partition by doc_id, j order by i rows between unbounded preceding and 1 preceding), 0) as part from m),
f as (select *, (row_number() over (partition by doc_id, j, part order by i) - 1) // 64 as sub from c),
a as (
  select doc_id, j, part, sub, string_agg(u, '' order by i) as piece from f group by doc_id, j, part, sub
  union all select doc_id, j, 0, 0, s from v where len(v) <= 16),
l as (select doc_id, list(piece order by j, part, sub) as pieces from a group by doc_id),
t as (select doc_id, list_transform(pieces, lambda x: trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) as t from l),
o as (select doc_id, t, unnest(range(1, len(t) - 1)) as i from t),
p as (select doc_id, i, t[i:i + 2] as words from o where strlen(t[i]) + strlen(t[i + 1]) + strlen(t[i + 2]) >= 60),
r as (select *, row_number() over (partition by words order by doc_id, i) as nth from p),
g as (select doc_id, list(distinct j) as gone from (select doc_id, unnest([i, i + 1, i + 2]) as j from r where nth > 1) group by doc_id)
select d.doc_id, coalesce(len(pieces), 0) as n_sentences, coalesce(len(gone), 0) as n_removed,
  case when gone is null then text else array_to_string(list_filter(pieces, lambda x, k: not list_contains(gone, k)), '') end as text
from d left join l using (doc_id) left join g using (doc_id)""".replace("ENDS", _ENDS)

_LINKS = r"""
with recursive w as (select doc_id, regexp_extract_all(text, '[^\x09-\x0D\x20]+') as w from documents),
g as (select doc_id, list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as g
  from w where len(w) > 0),
sets as (select list_sort(g) as s, min(doc_id) as set_id, count(*) as n from g group by list_sort(g)),
tokens as (select set_id, n, len(s) as size, unnest(s) as t from sets),
shared as (select a.set_id as x, b.set_id as y, any_value(a.size) as sx, any_value(b.size) as sy, any_value(b.n) as n, count(*) as c
  from tokens a join tokens b on a.t = b.t and a.set_id <> b.set_id group by a.set_id, b.set_id),
links as (select x, y, n from shared where c / (sx + sy - c) >= 0.8),
reach as (select set_id as x, set_id as y from sets union select r.x, l.y from reach r join links l on r.y = l.x),
classes as (select x as set_id, min(y) as class_id from reach group by x),
counts as (select x as set_id, sum(n) as links from links group by x)
select w.doc_id, class_id, sets.set_id, cast(case when g.doc_id is null then 0 else coalesce(links, 0) + sets.n - 1 end as bigint) as n_links
from w left join g using (doc_id) left join sets on list_sort(g.g) = sets.s
  left join classes using (set_id) left join counts on counts.set_id = sets.set_id"""

ORACLE: dict[str, str] = {
    "op2_mixing": _MIX,
    "op3_chosen_path_join": _LINKS,
    "op4_sentence_spans": _SPANS,
    "op8_url_filter": _URLS,
    "op9_decontamination": _LEAKS,
}
