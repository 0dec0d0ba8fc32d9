"""SQL of the operators whose modules hold none: archives, repeated passages, Jaccard components."""

from __future__ import annotations

WARC = """
with page as (select page_id, coalesce(html, '') as html from pages),
hashed as (select page_id, strlen(html) as payload_bytes, sha1(html) as hex from page),
first as (select hex, min(page_id) as response from hashed group by hex)
select page_id, payload_bytes::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + ((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::bigint >> (35 - 5 * (k % 8))) & 31))::bigint, 1)), '')
         as payload_digest,
       case when response is null or page_id = response then 'response' else 'revisit' end as record_type,
       case when response is null or page_id = response then null else response end as refers_to
from hashed join first using (hex)
"""

PASSAGES = """
with doc as (
  select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as place,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
span as (
  select r, place, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) as h
  from (select r, place, w, unnest(range(1, len(w) - 48)) as i from doc where len(w) >= 50)),
earliest as (select h, min(place) as first from span group by h),
gone as (
  select distinct r, p from (
    select r, unnest(range(i, i + 50)) as p from span join earliest using (h) where first < place)),
removed as (select r, count(*) as n_removed from gone group by r),
kept as (
  select r, string_agg(word, ' ' order by p) as kept
  from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from doc) anti join gone using (r, p) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from doc left join removed using (r) left join kept using (r)
"""

COMPONENTS = """
with recursive doc as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') as w from documents),
shingle as (
  select distinct r, array_to_string(list_slice(w, i, i + 2), ' ') as s
  from (select r, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from doc where len(w) > 0)),
sized as (select r, count(*) as n from shingle group by r),
shared as (
  select a.r as x, b.r as y, count(*) as common from shingle a join shingle b on a.s = b.s and a.r < b.r group by all),
linked as (
  select x, y from shared join sized p on p.r = x join sized q on q.r = y where 100 * common >= 90 * (p.n + q.n - common)),
edge as (select x, y from linked union all select y, x from linked),
reach as (select r, r as other from doc union select reach.r, edge.y from reach join edge on edge.x = reach.other)
select a.doc_id, coalesce(n, 0)::bigint as n_shingles,
       (select min(b.doc_id) from reach join doc b on b.r = reach.other where reach.r = a.r) as component_id
from doc a left join sized using (r)
"""
