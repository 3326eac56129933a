"""DuckDB SQL of the dedup queries, written from their definitions: every window by its content, every pair by its sets.

None of the operators' steps (anchors, sketches, blocks, bits) occurs here.  Rows with a null id come after all others.
"""

from __future__ import annotations

from .decontamination import LOWER, UPPER

_WORD = "'[^\\x20\\x09-\\x0D]+'"

#: Links are counted on shared shingles; components are the closure of the links.
OP2_SQL = f"""
with recursive d as (
  select row_number() over (order by doc_id nulls last) as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {_WORD}) as w from documents),
s as (select rid, doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as sh from d),
x as (select rid, doc_id, len(sh) as n, unnest(sh) as shingle from s),
p as (select a.rid as ra, b.rid as rb, any_value(a.doc_id) as a, any_value(b.doc_id) as b,
             any_value(a.n) as na, any_value(b.n) as nb, count(*) as both_
      from x a join x b on a.shingle = b.shingle and a.rid <> b.rid group by a.rid, b.rid),
l as (select distinct a, b from p where 100 * both_ >= 80 * (na + nb - both_) and a is not null and b is not null),
r as (select distinct doc_id as a, doc_id as b from d where doc_id is not null
      union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as component_id from r group by a)
select s.doc_id, cast(len(s.sh) as bigint) as n_shingles, c.component_id,
       coalesce(s.doc_id = c.component_id, true) as kept
from s left join c on s.doc_id = c.a
"""


def _removal(units: str, length: int) -> str:
    """CTEs on ``u`` (ord, place from 0, piece, win or null): ``e`` with the flags ``gone`` and ``opens`` for every unit.

    A window is a repeat unless its (document, start) is the least of its content; a unit is gone if the last repeat
    that starts at or before it reaches it.
    """
    return f"""
{units},
f as (select win, min(ord * 4294967296 + place) as at from u where win is not null group by win),
m as (select u.ord, u.place, u.piece, case when u.ord * 4294967296 + u.place > f.at then u.place end as start
      from u left join f on u.win = f.win),
g as (select ord, place, piece, max(start) over (partition by ord order by place) as start from m),
k as (select ord, place, piece, coalesce(place - start < {length}, false) as gone from g),
e as (select *, gone and not coalesce(lag(gone) over (partition by ord order by place), false) as opens from k)"""


_DOCS = "select row_number() over (order by doc_id nulls last) as ord, doc_id, coalesce(text, '') as text from documents"

#: Bytes as pairs of hexadecimal digits, read in stretches of 1000 bytes and the 99 after them; windows are compared by
#: their 128-bit md5.
OP3_SQL = f"""
with d as ({_DOCS}),
h as (select ord, hex(text) as x, octet_length(encode(text)) as n from d),{_removal('''
t as (select ord, n, base, substr(x, 2 * base + 1, 2 * (1000 + 99)) as x
      from (select ord, x, n, unnest(range(0, n, 1000)) as base from h)),
q as (select ord, n, base, x, unnest(range(0, least(1000, n - base))) as k from t),
u as (select ord, base + k as place, substr(x, 2 * k + 1, 2) as piece,
             case when base + k + 100 <= n then md5_number(substr(x, 2 * k + 1, 200)) end as win from q)''', 100)},
a as (select ord, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans,
             sha256(unhex(coalesce(string_agg(piece, '' order by place) filter (not gone), ''))) as kept_sha256 from e group by ord)
select d.doc_id, cast(h.n as bigint) as n_bytes, cast(coalesce(a.n_removed, 0) as bigint) as n_removed,
       cast(coalesce(a.n_spans, 0) as bigint) as n_spans, coalesce(a.kept_sha256, sha256('')) as kept_sha256
from d join h using (ord) left join a using (ord)
"""

OP5_SQL = f"""
with d as ({_DOCS}),
h as (select ord, regexp_extract_all(text, {_WORD}) as w from d),{_removal('''
u as (select ord, unnest(range(0, len(w))) as place, unnest(w) as piece,
             unnest(list_transform(range(1, len(w) + 1), lambda i: case when i + 19 <= len(w) then array_to_string(w[i:i + 19], ' ') end)) as win
      from h)''', 20)},
a as (select ord, count(*) filter (gone) as n_removed,
             sha256(coalesce(string_agg(piece, ' ' order by place) filter (not gone), '')) as kept_sha256 from e group by ord)
select d.doc_id, cast(len(h.w) as bigint) as n_words, cast(coalesce(a.n_removed, 0) as bigint) as n_removed,
       coalesce(a.kept_sha256, sha256('')) as kept_sha256
from d join h using (ord) left join a using (ord)
"""
