"""DuckDB statements for the queries that SQL can express, written from the definitions."""

from __future__ import annotations

from basketlab.llm import decontaminate as D
from basketlab.llm import near_dedup as N
from basketlab.llm import secret_scan as S

WORD = r"[^\x20\x09-\x0D]+"


def near_dedup_sql() -> str:
    """All pairs by shared shingles, exact weighted Jaccard, reachability."""
    n = N.SHINGLE
    return f"""
with recursive w as (select doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') as a from documents),
s as (select doc_id, unnest(list_transform(range(1, greatest(len(a) - {n - 1}, 1) + 1), lambda i: array_to_string(a[i:i + {n - 1}], ' '))) as g from w where len(a) > 0),
c as (select doc_id, g, count(*) as k from s group by all),
t as (select doc_id, sum(k) as k from c group by all),
p as (select x.doc_id as a, y.doc_id as b, sum(least(x.k, y.k)) as k from c x join c y on x.g = y.g and x.doc_id < y.doc_id group by all),
l as (select a, b from p join t ta on ta.doc_id = a join t tb on tb.doc_id = b where p.k >= {N.THRESHOLD} * (ta.k + tb.k - p.k)
      union select x.doc_id, y.doc_id from w x join w y on x.text = y.text and x.doc_id < y.doc_id),
e as (select a, b from l union select b, a from l),
r as (select doc_id, doc_id as m from documents union select r.doc_id, e.b from r join e on e.a = r.m)
select doc_id, min(m) as class_id, min(m) = doc_id as is_representative from r group by doc_id
"""


def warc_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    base32 = f"array_to_string(list_transform(range(0, 32), lambda i: substr('{letters}', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)), '')"
    return f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
m as (select html, max(page_id) as top from p group by html)
select page_id, strlen(p.html)::bigint as payload_bytes, {base32} as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from p join m on p.html = m.html
"""


def decontamination_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
with d as (select doc_id, regexp_extract_all({lower}, '{word}') as a from documents),
b as (select item_id, regexp_extract_all({lower}, '{word}') as a from benchmark),
bw as (select distinct item_id, least(len(a), {D.WINDOW}) as w, unnest(list_transform(range(1, len(a) - least(len(a), {D.WINDOW}) + 2), lambda i: array_to_string(a[i:i + least(len(a), {D.WINDOW}) - 1], ' '))) as g from b where len(a) > 0),
ws as (select distinct w from bw),
dw as (select doc_id, w, unnest(range(1, len(a) - w + 2)) as i, unnest(list_transform(range(1, len(a) - w + 2), lambda i: array_to_string(a[i:i + w - 1], ' '))) as g from d, ws where len(a) >= w),
h as (select doc_id, dw.w, i, item_id from dw join bw on dw.w = bw.w and dw.g = bw.g),
n as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + w)) as x from h) group by doc_id),
t as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from h group by doc_id)
select d.doc_id, len(d.a)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n on n.doc_id = d.doc_id left join t on t.doc_id = d.doc_id
"""


def secret_sql() -> str:
    """Base patterns by position; every window of every candidate has its entropy counted anew."""
    q = lambda p: p.replace("'", "''")
    pieces = lambda p: f"string_split_regex(x, '{q(p)}')"
    hits = lambda p: f"regexp_extract_all(x, '{q(p)}')"
    size = lambda a: f"coalesce(list_sum(list_transform({a}, lambda y: length(y))), 0)::bigint"

    def found(kind: int, p: str, value: str) -> str:
        return f"""select doc_id, {kind} as kind, {size('ps[1:i]')} + {size('hs[1:i - 1]')} as s, {size('ps[1:i]')} + {size('hs[1:i]')} as e, vs[i] as v
  from (select doc_id, ps, hs, vs, unnest(range(1, len(hs) + 1)) as i from (select doc_id, {pieces(p)} as ps, {hits(p)} as hs, {value} as vs from t where regexp_matches(x, '{q(p)}')))"""

    kinds = "case kind when 0 then 'assign' when 1 then 'access' when 2 then 'hex' else 'entropy' end"
    listed = f"string_agg({kinds} || ':' || s || ':' || e, ',' order by s, kind, e)"
    # numbered names and paths, in plain form: DuckDB's expressions have no look-ahead, and do not recurse
    plain = r"^/?([A-Za-z]+[/_-])*[A-Za-z]+([/_-]?[0-9]{1,6})?/?$"
    known = " or ".join(f"regexp_matches(v, '{q(plain if '(?!' in p else p)}')" for p in S.ALLOW)
    table = "[" + ", ".join(str(S.weight(c)) for c in range(S.WIDTH + 1)) + "]"
    digit, low, up = ("regexp_matches(v, '[0-9]')", "regexp_matches(v, '[a-z]')", "regexp_matches(v, '[A-Z]')")
    bits = {name: S.bound(b) for name, _, b in S.CLASSES}
    most = f"""case when {known} then null
  when {digit} and regexp_matches(v, '[a-fA-F]') and regexp_matches(v, '^([0-9a-f]+|[0-9A-F]+)$') then {bits['hex']}
  when {digit} and {up} and regexp_matches(v, '^[A-Z0-9]+$') then {bits['upper_digit']}
  when {digit} and {low} and regexp_matches(v, '^[a-z0-9]+$') then {bits['lower_digit']}
  when {digit} and {low} and {up} then {bits['base64']} end"""
    return f"""
with t as (select doc_id, coalesce(text, '') as x from documents),
base as (select doc_id, kind, s, e from ({found(0, S.ASSIGN, f"regexp_extract_all(x, '{q(S.ASSIGN)}', 2)")}) where length(v) >= {S.LEAST['assign']}
  union all select doc_id, kind, s, e from ({found(1, S.ACCESS, hits(S.ACCESS))}) where length(v) >= {S.LEAST['access']}
  union all select doc_id, kind, s, e from ({found(2, S.HEX, hits(S.HEX))}) where length(v) >= {S.LEAST['hex']}),
cand as (select doc_id, s, e, v, {most} as most from ({found(3, S.CANDIDATE, hits(S.CANDIDATE))})),
win as (select doc_id, s, v, most, unnest(range(0, length(v) - {S.WIDTH} + 1)) as i from cand where most is not null),
chars as (select doc_id, s, most, i, unnest(string_split(substr(v, i::int + 1, {S.WIDTH}), '')) as ch from win),
counts as (select doc_id, s, most, i, ch, count(*) as k from chars group by all),
hot as (select doc_id, s, i from counts group by doc_id, s, most, i having sum(({table})[k + 1]) <= most),
runs as (select doc_id, s, i, sum(new) over (partition by doc_id, s order by i) as run from (select doc_id, s, i, case when i <= lag(i) over (partition by doc_id, s order by i) + {S.WIDTH} then 0 else 1 end as new from hot)),
more as (select doc_id, 3 as kind, s + min(i) as s, s + max(i) + {S.WIDTH} as e from runs group by doc_id, runs.s, run),
spans as (select * from base union all select * from more where not exists (select 1 from base b where b.doc_id = more.doc_id and b.s <= more.s and b.e >= more.e)),
n as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, {listed} as l from base group by doc_id),
a as (select doc_id, {listed} as l from spans group by doc_id)
select t.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(n.l, '')) as base_sha256, coalesce(a.l, '') as spans
from t left join n on n.doc_id = t.doc_id left join a on a.doc_id = t.doc_id
"""


ORACLE_SQL = {
    "op1_near_dedup": near_dedup_sql(),
    "op5_warc": warc_sql(),
    "op6_decontamination": decontamination_sql(),
    "op10_secret_scan": secret_sql(),
}
