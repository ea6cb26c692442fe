"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
with docs as (
    select row_number() over () as r, doc_id,
           regexp_extract_all({_LOWER}, '{_WORDS}') as ws
    from documents
), items as (
    select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '{_WORDS}') as ws
    from benchmark
), windows as (
    select item, 10 as n, array_to_string(ws[i:i + 9], ' ') as w
    from items, unnest(range(1, len(ws) - 8)) as t(i) where len(ws) >= 10
    union
    select item, len(ws), array_to_string(ws, ' ') from items where len(ws) between 1 and 9
), places as (
    select r, i, n, array_to_string(ws[i:i + n - 1], ' ') as w
    from docs, (select distinct n from windows), unnest(range(1, len(ws) - n + 2)) as t(i)
), hits as (
    select r, i, n, item from places join windows using (n, w)
), covered as (
    select r, count(*) as n_hit
    from (select distinct r, unnest(range(i, i + n)) as at from hits) group by r
), named as (
    select r, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct r, item from hits) group by r
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join named using (r)
"""

MIX = r"""
with docs as (
    select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as key,
           cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
    from documents
), sources as (
    select source, sum(size) as source_size,
           row_number() over (order by source is null, source) - 1 as rank
    from docs group by source
), weighed as (
    select *, [3.0::double, 1.0, 2.0][(rank % 3) + 1] as weight,
           [0.5::double, 0.0, -0.5][(rank % 3) + 1] as slope, source_size * 2.0::double as cap
    from sources
), filled as (
    select *, cap / weight as ratio,
           coalesce(sum(cap) over before, 0) as caps, coalesce(sum(weight) over before, 0) as weights
    from weighed
    window before as (order by cap / weight, source
                      rows between unbounded preceding and 1 preceding)
), levels as (
    select ratio, ((select sum(source_size) * 1.5::double from weighed) - caps)
                  / ((select sum(weight) from weighed) - weights) as level
    from filled
), targets as (
    select source, source_size, slope,
           round(least(cap, (select arg_min(level, ratio) from levels where level <= ratio)
                            * weight), 6) as target
    from weighed
), begun as (
    select d.*, t.source_size, t.slope, t.target,
           coalesce(sum(size) over (partition by d.source order by key, doc_id, size
                    rows between unbounded preceding and 1 preceding), 0) as first_start
    from docs d join targets t on d.source is not distinct from t.source
), parts as (
    select *, greatest(0, least(size, floor(target) - first_start)) as first_words,
           greatest(0, least(size, floor(target) - first_start - source_size)) as second_words
    from begun
), due as (
    select *, (first_start + first_words / 2) / target as y1,
           (first_start + source_size + second_words / 2) / target as y2
    from parts
)
select doc_id, size, cast(source_size as bigint) as source_size, target,
       cast(first_words + second_words as bigint) as taken,
       case when first_words > 0 then
            round(2 * y1 / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * y1)), 9)
            end as first_position,
       case when second_words > 0 then
            round(2 * y2 / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * y2)), 9)
            end as second_position
from due
"""

WARC = """
with records as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
           sha1(coalesce(html, '')) as payload_digest
    from pages
), latest as (
    select *, max(page_id) over (partition by payload_digest) as last_id from records
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id is distinct from last_id
            then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id is distinct from last_id
            then last_id end as refers_to
from latest
"""

TOKENS = r"""
with texts as (
    select source, lang, text, regexp_replace(text, '^[^\n]*\n', '') as untitled from documents
), counted as (
    select source, lang,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as loaded,
           coalesce(len(regexp_extract_all(untitled, '[^\x20\x09-\x0D]+')), 0) as revised,
           coalesce(len(regexp_extract_all(
               untitled, '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')), 0) as moved
    from texts
), kept as (
    select source, lang,
           case when lang is distinct from 'en' then 'pieces-1' else 'words-1' end as tokenizer,
           case when lang is distinct from 'en' then moved else revised end as tokens
    from counted where loaded >= 20
)
select source, lang, tokenizer, count(*) as documents, cast(sum(tokens) as bigint) as tokens
from kept group by source, lang, tokenizer
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": WARC,
    "op5_token_rollup": TOKENS,
    "op6_decontaminate": DECONTAMINATE,
    "op8_mix": MIX,
}
