"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from landfall.llm.licenses import CUE, SENTENCE_END, TERM, THRESHOLD, template_weights


def _op1() -> str:
    rows, idf, other = template_weights()
    values = lambda items: ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in items)
    return f"""
with weights(license, template, term, weight) as (values {values(rows)}),
idfs(term, idf) as (values {values(idf.items())}),
files as (
  select doc_id, text, '/' || source || '/' || case
    when doc_id % 1000 = 0 then concat_ws('/', doc_id // 1000, 'LICENSE-' || doc_id)
    when doc_id % 100 = 0 then concat_ws('/', doc_id // 1000, doc_id % 1000 // 100, 'LICENSE-' || doc_id)
    when doc_id % 10 = 0 then concat_ws('/', doc_id // 1000, doc_id % 1000 // 100, doc_id % 100 // 10, 'LICENSE-' || doc_id)
    else concat_ws('/', doc_id // 1000, doc_id % 1000 // 100, doc_id % 100 // 10, doc_id) end as path
  from documents),
placed as (select doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) as directory, doc_id % 10 = 0 as speaks from files),
cut as (select doc_id, unnest(regexp_split_to_array(text, '{SENTENCE_END}')) as statement from files),
said as (select * from cut where regexp_matches(statement, '{CUE}')),
tf as (select statement, term, count(*) as tf from (
  select statement, unnest(regexp_extract_all(lower(statement), '{TERM}')) as term from (select distinct statement from said))
  group by all),
w as (select statement, tf.term, tf * coalesce(idf, {other!r}) as w from tf left join idfs using (term)),
norms as (select statement, sqrt(sum(w * w)) as norm from w group by 1),
dots as (select statement, license, template, sum(w * weight) as dot from w join weights using (term) group by all),
scored as (select statement, license, round(dot / norm, 6) as score from dots join norms using (statement)
  where round(dot / norm, 6) >= {THRESHOLD}),
own as (select doc_id, license, score from said join scored using (statement)
  qualify row_number() over (partition by doc_id order by score desc, license) = 1),
marked as (select placed.*, license, score from placed left join own using (doc_id)),
speaking as (select directory as ancestor, license as dir_license, score as dir_score from marked
  where speaks and license is not null
  qualify row_number() over (partition by directory order by score desc, doc_id) = 1),
resolved as (select directory, ancestor, dir_license, dir_score
  from (select distinct directory from marked where license is null)
  join speaking on directory = ancestor or starts_with(directory, ancestor || '/')
  qualify row_number() over (partition by directory order by length(ancestor) desc) = 1)
select doc_id, path, coalesce(license, dir_license) as license, coalesce(score, dir_score) as score,
  case when license is not null then 'own' when dir_license is not null then 'inherited' else 'none' end as origin,
  case when license is null then ancestor end as from_directory
from marked left join resolved on license is null and resolved.directory = marked.directory
"""


OP2 = """
with turns as (select distinct conv_id, turn, role, text from conversations),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as pos,
    count(*) over (partition by conv_id) as n_turns from turns),
rolled as (
  select conv_id, pos, n_turns, string_agg(coalesce('r' || role, '') || chr(2) || coalesce('t' || text, '') || chr(3), '')
    over (partition by conv_id order by pos) as prefix from placed),
whole as (select n_turns, prefix, min(conv_id) as conv_id, count(*) as n_copies from rolled where pos = n_turns group by all),
shorter as (select distinct pos as n_turns, prefix from rolled where pos < n_turns),
kept as (select conv_id, n_copies from whole anti join shorter using (n_turns, prefix))
select conv_id, (pos - 1) // 256 as part, n_turns, n_copies,
  string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10),
    '' order by pos) as text
from placed join kept using (conv_id) group by conv_id, part, n_turns, n_copies
"""

OP4 = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
owner as (select payload_digest, max(page_id) as winner from p where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
  case when winner is not null and winner <> page_id and payload_bytes >= 1000 then 'revisit' else 'response' end as record_type,
  case when winner is not null and winner <> page_id and payload_bytes >= 1000 then winner end as refers_to
from p left join owner using (payload_digest)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = f"""
with t as (select doc_id, sha256({LOWER}) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
  doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
from t
"""

OP9 = f"""
with recursive words as (select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end) as shingle from words),
sizes as (select doc_id, count(*) as n from sets group by 1),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 85 * (a.n + b.n - c)),
reach(doc_id, other) as (select doc_id, doc_id from words union select reach.doc_id, links.y from reach join links on links.x = reach.other)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from (select doc_id, min(other) as component_id from reach group by 1) left join sizes using (doc_id)
"""

def _leaf(text: str) -> str:
    values = ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


# DuckDB has no crc32: its polynomial division, bit by bit.
CRC32 = """xor(list_reduce(list_transform(range(length(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, (i + 1)::int, 1))::ubigint),
  lambda c, b: list_reduce(range(8)::ubigint[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::ubigint), 4294967295::ubigint)"""

OP11 = f"""
with recursive leaves as (
  select doc_id, {_leaf("text")} as leaf, coalesce('1' || source, '0') as g,
    case when doc_id is not null and {CRC32} % 2 = 0 then {_leaf("replace(text, chr(10), '')")} end as presented
  from documents),
placed as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by g) as n from leaves),
nodes(level, g, pos, h, n) as (
  select 0, g, pos, leaf, n from placed
  union all select level + 1, g, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3 from nodes where n > 1 group by level, g, pos // 3, n),
subroots as (select g, level as height, h as subroot, row_number() over (order by g) - 1 as pos, count(*) over () as n from nodes where n = 1),
tops(level, pos, h, n) as (
  select 0, pos, subroot, n from subroots
  union all select level + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3 from tops where n > 1 group by level, pos // 3, n),
spots(doc_id, pos, g, level, spot) as (
  select doc_id, pos, g, 0, pos from placed
  union all select s.doc_id, s.pos, s.g, level + 1, spot // 3 from spots s join subroots r using (g) where level + 1 < height),
below as (select s.doc_id, s.pos, s.g, s.level,
    coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos < s.spot), '') as l,
    coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos > s.spot), '') as r
  from spots s join subroots t on t.g = s.g and s.level < t.height join nodes o on o.g = s.g and o.level = s.level and o.pos // 3 = s.spot // 3 group by all),
climbs(g, level, spot) as (
  select g, 0, pos from subroots
  union all select g, level + 1, spot // 3 from climbs where level + 1 < (select max(level) from tops)),
above as (select s.g, s.level, coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos < s.spot), '') as l,
    coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos > s.spot), '') as r
  from climbs s join tops o on o.level = s.level and o.pos // 3 = s.spot // 3
  where s.level < (select max(level) from tops) group by all),
steps as (
  select doc_id, pos, g, level, l, r from below
  union all select p.doc_id, p.pos, p.g, height + a.level, l, r from placed p join subroots using (g) join above a using (g)),
paths as (select doc_id, pos, g, list({{'l': l, 'r': r}} order by level) as path from steps group by all)
select p.doc_id, leaf, subroot, (select h from tops where n = 1) as root,
  sha256(coalesce(list_reduce(list_transform(path, lambda s: s.l || s.r), lambda a, b: a || b, ''), '')) as proof_sha256,
  folded as folded_root, folded = (select h from tops where n = 1) as verified
from (select *, list_reduce([coalesce(presented, leaf)] || coalesce(list_transform(path, lambda s: s.l || '|' || s.r), []),
    lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) as folded
  from placed left join paths using (doc_id, pos, g)) p join subroots using (g)
"""

ORACLE_SQL = {
    "op1_license_scan": _op1(),
    "op2_chat_format": OP2,
    "op4_warc": OP4,
    "op8_exact_dedup": OP8,
    "op9_jaccard_join": OP9,
    "op11_merkle_manifest": OP11,
}
