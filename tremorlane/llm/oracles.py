"""The queries that SQL can express, for DuckDB, over the same tables."""

from __future__ import annotations

from tremorlane.llm.url_filter import SOFT, SOFT_HITS, STRICT

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


def _term(terms: str) -> str:
    return f"regexp_matches(plain, '(^|[^a-z0-9])({terms})([^a-z0-9]|$)')"


_URLS = f"""
with rests as (
  select page_id, {_lower("coalesce(url, '')")} as plain,
         case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
),
parts as (
  select page_id, plain,
         {_lower("regexp_extract(rest, '^[^/?#]*')")} as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests
),
ruled as (
  select *,
         case when (host = 'example.net' or ends_with(host, '.example.net'))
                   and starts_with(path, '/en/') then 'example.net/en/'
              when (host = 'example.com' or ends_with(host, '.example.com'))
                   and starts_with(path, '/de/') then 'example.com/de/'
              when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/')
                   then 'org/fr/'
              when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
         end as rule,
         {_term("|".join(STRICT))}
           or {" + ".join(f"{_term(term)}::int" for term in SOFT)} >= {SOFT_HITS} as bad
  from parts
)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block'
            when rule is not null then 'allow'
            when bad then 'block' else 'allow' end as verdict
from ruled"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(sha, {1 + 5 * (i // 4)}, 5))::int >> {15 - 5 * (i % 4)}) & 31) + 1, 1)"
    for i in range(32)
)

_ARCHIVE = f"""
with payloads as (
  select page_id, encode(coalesce(html, '')) as payload from pages
),
grouped as (
  select page_id, octet_length(payload) as payload_bytes, sha1(payload) as sha,
         max(page_id) over (partition by payload) as original
  from payloads
)
select page_id, payload_bytes, {_BASE32} as payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id <> original then original end as refers_to
from grouped"""

_WORDS = f"regexp_extract_all({_lower('text')}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

_CONTAMINATION = f"""
with docs as (select doc_id, coalesce({_WORDS}, []) as ws from documents),
items as (select item_id, coalesce({_WORDS}, []) as ws from benchmark),
patterns as (
  select distinct item_id, least(len(ws), 10) as k,
         unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2),
                               lambda i: array_to_string(ws[i:i + 9], ' '))) as gram
  from items where len(ws) > 0
),
grams as (
  select doc_id, k, unnest(range(1, len(ws) - k + 2)) as i, ws
  from docs, (select distinct k from patterns) where len(ws) >= k
),
found as (
  select g.doc_id, g.i, g.k, p.item_id
  from (select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') as gram from grams) g
  join patterns p on p.gram = g.gram and p.k = g.k
),
hit as (
  select doc_id, count(*) as n_hit
  from (select distinct doc_id, unnest(range(i, i + k)) as w from found) group by doc_id
),
listed as (
  select doc_id, count(*) as n_items,
         sha256(string_agg(item_id::varchar, ',' order by item_id::varchar)) as items_sha256
  from (select distinct doc_id, item_id from found) group by doc_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join listed using (doc_id)"""

def _field(column: str) -> str:
    text = f"{column}::varchar"
    return f"coalesce(strlen({text})::varchar || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    columns = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(map(_field, columns))})"


_CRC = """xor(4294967295, list_reduce(
  list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
  lambda crc, byte: list_reduce(
    range(8), lambda rest, i: xor(rest >> 1, 3988292384 * (rest & 1)), xor(crc, byte)),
  4294967295::bigint))"""

_MANIFEST = f"""
with recursive leaves as (
  select doc_id, tree, leaf, claim, row_number() over (order by tree, doc_id nulls first, leaf) as r,
         row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place
  from (select doc_id, coalesce('=' || lang, '') as tree, {_leaf("n_chars")} as leaf,
               case when {_CRC} % 7 = 0 then {_leaf("(n_chars + 1)")}
                    else {_leaf("n_chars")} end as claim
        from documents)
),
low as (
  select 0 as level, tree, place, leaf as node from leaves
  union all
  select any_value(level) + 1, tree, place // 2, sha256(string_agg(node, '' order by place))
  from (select *, count(*) over (partition by tree) as nodes from low)
  where nodes > 1 group by tree, place // 2
),
trees as (
  select tree, max(level) as height, arg_max(node, level) as subroot,
         row_number() over (order by tree) - 1 as place
  from low group by tree
),
high as (
  select 0 as level, place, subroot as node from trees
  union all
  select any_value(level) + 1, place // 2, sha256(string_agg(node, '' order by place))
  from (select *, count(*) over () as nodes from high)
  where nodes > 1 group by place // 2
),
top as (select max(level) as height, arg_max(node, level) as root from high),
steps as (
  select r, spot.level as step, sibling.node as other, spot.place & 1 as side
  from (select r, tree, level, leaves.place >> level as place
        from leaves join (select tree, unnest(range(height)) as level from trees) using (tree)) as spot
  left join low as sibling
    on sibling.tree = spot.tree and sibling.level = spot.level and sibling.place = xor(spot.place, 1)
  union all
  select r, spot.height + spot.level, sibling.node, spot.place & 1
  from (select r, height, level, trees.place >> level as place
        from leaves join trees using (tree),
             (select unnest(range(height)) as level from top)) as spot
  left join high as sibling
    on sibling.level = spot.level and sibling.place = xor(spot.place, 1)
),
folds as (
  select r, 0 as step, claim as node from leaves
  union all
  select folds.r, folds.step + 1,
         sha256(case when other is null then node when side = 1 then other || node
                     else node || other end)
  from folds join steps on steps.r = folds.r and steps.step = folds.step
)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root,
       folded_root = root as verified
from leaves join trees using (tree)
join (select r, arg_max(node, step) as folded_root from folds group by r) using (r)
left join (select r, string_agg(other, '' order by step) as proof from steps group by r) using (r),
top"""


ORACLES: dict[str, str] = {
    "op3_warc": _ARCHIVE,
    "op5_url_filter": _URLS,
    "op6_decontamination": _CONTAMINATION,
    "op10_exact_dedup": r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t
  from documents
)
select doc_id,
       min(doc_id) over w as keep_id,
       count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept,
       sha256(t) as text_sha256
from texts window w as (partition by t)""",
    "op13_merkle_manifest": _MANIFEST,
}
