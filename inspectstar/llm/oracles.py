"""DuckDB SQL twins of the queries that SQL can express."""

from __future__ import annotations

#: Targets by rounds: every source above its limit is fixed there, the rest reshare.
OP1 = r"""
with recursive sized as (
    select doc_id, text, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents
), totals as (
    select source, sum(size)::bigint as source_size,
           [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
    from sized group by source
), rounds as (
    select 0 as n, source, source_size, weight, false as is_full,
           (sum(source_size) over () * 1.5)::double as goal
    from totals
    union all
    select n + 1, source, source_size, weight,
           is_full or left_over * weight / open_weight >= source_size * 2.0, goal
    from (
        select *,
               goal - coalesce(sum(source_size * 2.0) filter (where is_full) over (), 0) as left_over,
               sum(weight) filter (where not is_full) over () as open_weight
        from rounds
    ) as shares
    where n < 40
), last_round as (
    select *, coalesce(sum(source_size * 2.0) filter (where is_full) over (), 0) as full_most,
           sum(weight) filter (where not is_full) over () as open_weight
    from rounds where n = (select max(n) from rounds)
), rates as (
    select source, source_size,
           case when is_full then source_size * 2.0
                else (goal - full_most) * weight / open_weight end::double as target
    from last_round
), drawn as (
    select doc_id, size, source_size, target,
           case when source_size > 0 then target / source_size else 0 end as rate,
           ('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, 13))::bigint
               / 4503599627370496.0 as chance
    from sized join rates on sized.source is not distinct from rates.source
), counted as (
    select *, (floor(rate) + case when chance < rate - floor(rate) then 1 else 0 end)::bigint as copies
    from drawn
)
select doc_id, size, source_size, target, (size * copies)::bigint as taken, copies from counted
"""

OP4 = r"""
with texts as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), windows as (
    select doc_id, unnest(range(1, len(words) - 18)) as pos, words from texts where len(words) >= 20
), hashed as (
    select doc_id, pos, md5_number(array_to_string(words[pos:pos + 19], ' ')) as content
    from windows
), ranked as (
    select doc_id, pos, row_number() over (partition by content order by doc_id, pos) as place
    from hashed
), covered as (
    select distinct doc_id, unnest(range(pos, pos + 20)) as pos from ranked where place > 1
), placed as (
    select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from texts
), kept as (
    select doc_id, count(*)::bigint as n_kept, string_agg(word, ' ' order by pos) as text
    from placed anti join covered using (doc_id, pos) group by doc_id
)
select texts.doc_id, len(words)::bigint as n_words,
       (len(words) - coalesce(n_kept, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from texts left join kept using (doc_id)
"""

ORACLES: dict[str, str] = {"op1_mixing": OP1, "op4_repeats": OP4}
