"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

MIX = rf"""
with labelled as (select doc_id, max(quality) as quality from labels group by doc_id),
docs as (
  select d.doc_id, source, {WORDS}::bigint as size,
    case quality when 1 then 2.0::double when 0 then 0.5::double else 1.0::double end as weight
  from documents d left join labelled l on d.doc_id = l.doc_id
),
keyed as (
  select *, -ln((('0x' || substr(md5('7:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5)
    / 4503599627370496.0::double) / weight as key
  from docs
),
sizes as (
  select source, sum(size)::bigint as source_size,
    (row_number() over (order by source nulls last) - 1)::bigint as rank
  from keyed group by source
),
weighted as (select *, [5, 2, 1][(rank % 3 + 1)::int]::bigint as w from sizes),
filled as (
  select *,
    (sum(source_size) over () - coalesce(sum(source_size * 3) over before, 0))::bigint as rest,
    (sum(w) over () - coalesce(sum(w) over before, 0))::bigint as ws
  from weighted
  window before as (order by source_size::double / w, rank rows between unbounded preceding and 1 preceding)
),
capped as (select *, source_size * 3 * ws <= rest * w as capped from filled),
opened as (
  select rest as open_rest, ws as open_ws from capped
  where not capped order by source_size::double / w, rank limit 1
),
targets as (
  select source, source_size,
    case when capped then (source_size * 3)::double else (w * open_rest)::double / open_ws end as target
  from capped left join opened on true
),
epochs as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from targets
),
placed as (
  select k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size as rest,
    coalesce(sum(size) over (
      partition by k.source order by key, coalesce(doc_id, -9223372036854775808), size
      rows between unbounded preceding and 1 preceding), 0)::bigint as gone
  from keyed k join epochs e on k.source is not distinct from e.source
)
select doc_id, size, source_size::bigint as source_size, target,
  (case when size > 0 then epochs + (gone + size / 2.0 <= rest)::int else 0 end * size)::bigint as taken
from placed
"""

URL_FILTER = r"""
with parsed as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
),
ruled as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
  end as rule
  from parsed
)
select page_id, host, path, rule, case
  when rule in ('net/', 'example.com/de/') then 'block'
  when rule is not null then 'allow'
  when regexp_matches(host, '(^|[.-])(adult|casino|porn|xxx|bet|pills|warez)([.-]|[0-9]|$)') then 'block'
  else 'allow' end as verdict
from ruled
"""

_MARKS = r"'([<\[])(\\*)(/?INST\]|:\]|/?s>)', '\1\\\2\3', 'g'"

CHAT = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(regexp_replace(role, {_MARKS})) + length(regexp_replace(text, {_MARKS}))
    + case role when 'assistant' then length('<s>[:]</s>') else length('[INST][:][/INST]') end)::bigint as formatted_chars
from turns group by conv_id
"""

TRIE = """
with recursive ids as (select distinct conv_id from conversations where conv_id is not null),
crc(conv_id, digits, i, c) as (
  select conv_id, conv_id::varchar, 0, 4294967295::bigint from ids
  union all
  select conv_id, digits, i + 1, xor(y >> 1, (y & 1) * 3988292384)
  from (
    select *, case when i % 8 = 0 then xor(c, ascii(digits[i // 8 + 1])::bigint) else c end as y
    from crc where i < 8 * length(digits)
  )
),
heads as (select conv_id, xor(c, 4294967295) % 9 as h from crc where i = 8 * length(digits)),
numbered as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as n
  from conversations where conv_id is not null
),
turns as (
  select i.conv_id, n, role, text from heads i join numbered b on b.conv_id = i.conv_id - i.conv_id % 5 and n <= h
  union all
  select i.conv_id, n, role, text from heads i join numbered o on o.conv_id = i.conv_id and n > h
),
paths as (
  select i.conv_id, coalesce(list({'role': role, 'text': text} order by n) filter (n is not null), []) as path
  from ids i left join turns t on t.conv_id = i.conv_id group by i.conv_id
),
named as (
  select conv_id, depth, len(path) as length, list_slice(path, 1, depth) as prefix
  from (select *, unnest(range(0, len(path) + 1)) as depth from paths)
),
nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = depth), '')) as ends_sha256
  from named group by depth, prefix
),
children as (
  select depth - 1 as depth, list_slice(prefix, 1, depth - 1) as prefix, count(*) as n
  from nodes where depth > 0 group by all
),
full_nodes as (
  select n.*, coalesce(c.n, 0) as n_children, p.conv_id as parent_conv_id,
    (n.n_convs - 1) * coalesce(strlen(n.prefix[n.depth].text), 0) as saved
  from nodes n left join children c on c.depth = n.depth and c.prefix = n.prefix
  left join nodes p on p.depth = n.depth - 1 and p.prefix = list_slice(n.prefix, 1, n.depth - 1)
),
above as (
  select d as depth, list_slice(prefix, 1, d) as prefix,
    count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved
  from (select *, unnest(range(0, depth + 1)) as d from full_nodes) group by all
)
select n.conv_id, n.depth::bigint as depth, n.parent_conv_id, n.n_convs, n.n_children::bigint as n_children,
  a.n_leaves, a.saved::bigint as saved_tokens, n.ends_sha256
from full_nodes n join above a on a.depth = n.depth and a.prefix = n.prefix
"""

_BASE32 = """array_to_string([
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || substr(h, 5 * (i // 4) + 1, 5))::int >> (15 - 5 * (i % 4))) & 31) + 1]
    for i in range(0, 32)], '')"""

WARC = f"""
with payloads as (select page_id, coalesce(html, '') as html from pages),
hashed as (select *, sha1(html) as h, max(page_id) over (partition by html) as response from payloads)
select page_id, strlen(html)::bigint as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type,
  case when page_id <> response then response end as refers_to
from hashed
"""

JACCARD = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select doc_id, unnest(list_distinct(case
    when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as s
  from words
),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all
),
links as (
  select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * s.n >= 85 * (x.n + y.n - s.n)
),
edges as (select a, b from links union all select b, a from links),
reached(doc_id, root) as (
  select doc_id, doc_id from documents union select r.doc_id, e.b from reached r join edges e on e.a = r.root
)
select r.doc_id, coalesce(max(n), 0)::bigint as n_shingles, min(root) as component_id
from reached r left join sizes z on z.doc_id = r.doc_id group by r.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX,
        "op3_warc": WARC,
        "op4_url_filter": URL_FILTER,
        "op6_jaccard_join": JACCARD,
        "op12_chat_format": CHAT,
        "op13_prefix_trie": TRIE,
    }
