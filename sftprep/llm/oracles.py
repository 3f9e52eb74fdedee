"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

#: Levels of the trees that the SQL of operator 13 writes out: 2 ** 24 rows of a language.
LANG_LEVELS, TOP_LEVELS = 24, 8

MIXING = r"""
with docs as (
    select doc_id, source, md5(coalesce(text, '')) as h,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
    from documents
), sums as (
    select source, sum(size)::bigint as source_size, count(distinct (doc_id, h)) as n_rows
    from docs group by source
), weighted as (
    select *, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight
    from sums
), levels as (
    select *, (1.5 * sum(source_size) over () - coalesce(sum(2.0 * source_size) over earlier, 0))
              / sum(weight) over later as level
    from weighted
    window earlier as (order by 2.0 * source_size / weight, source nulls last
                       rows between unbounded preceding and 1 preceding),
           later as (order by 2.0 * source_size / weight, source nulls last
                     rows between current row and unbounded following)
), targets as (
    select source, source_size, n_rows, least(2.0 * source_size, weight * coalesce((select max(level) from levels), 0.0))::double as target
    from weighted
), seats as (
    select floor(sum(target) / 16 + 0.5)::bigint as blocks, count(*) as members, sum(target) as everything from targets
), won as (
    select source, count(*) as quota from (
        select source, row_number() over (order by target / (2 * k + 1) desc, source nulls last, k) as r
        from (select source, target, unnest(range((target / nullif(everything, 0) * (blocks + members))::bigint + 3)) as k
              from targets, seats where target > 0)
    ) where r <= (select blocks from seats) group by source
), sources as (
    select t.source, source_size, target, coalesce(quota, 0) as quota,
           greatest(ceil(source_size / 1e6), ceil(n_rows / 2e3), 1)::bigint as n_shards
    from targets t left join won on won.source is not distinct from t.source
), dealt as (
    select doc_id, d.source, h, size, source_size, target, quota, n_shards, number, number % n_shards as shard
    from (select *, ('0x' || substr(md5('11:' || coalesce(doc_id::varchar, '-') || ':' || h), 1, 15))::bigint as number
          from docs) d
    join sources s on s.source is not distinct from d.source
), shard_sums as (
    select source, shard, sum(size) as words, any_value(quota) as quota, count(*) over (partition by source) as members,
           sum(sum(size)) over (partition by source) as everything
    from dealt group by source, shard
), shard_won as (
    select source, shard, count(*) as q from (
        select source, shard, quota,
               row_number() over (partition by source order by words / (2 * k + 1) desc, shard, k) as r
        from (select *, unnest(range((words / nullif(everything, 0) * (quota + members))::bigint + 3)) as k
              from shard_sums where words > 0)
    ) where r <= quota group by source, shard
), shards as (
    select s.source, s.shard, words, blocks, least(coalesce(q, 0), 2 * blocks)::bigint as q,
           ('0x' || substr(md5(concat_ws(':', '11', s.source, s.shard::varchar)), 1, 15))::bigint % blocks as start
    from (select *, greatest(round(words / 16), 1)::bigint as blocks from shard_sums) s
    left join shard_won w on w.source is not distinct from s.source and w.shard = s.shard
), windows as (
    select source, shard, q // blocks as passes, start * words // blocks as a,
           least(start + q % blocks, blocks) * words // blocks as b,
           greatest(start + q % blocks - blocks, 0) * words // blocks as c
    from shards
), streamed as (
    select *, sum(size) over (partition by source, shard order by number, doc_id nulls first, h
                              rows between unbounded preceding and current row) - size as first
    from dealt
)
select doc_id, size, source_size::bigint as source_size, target,
       (passes * size + greatest(least(b, first + size) - greatest(a, first), 0)
        + greatest(least(c, first + size) - first, 0))::bigint as taken
from streamed s join windows w on w.source is not distinct from s.source and w.shard = s.shard
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: crc32 of a short text, bit by bit (the polynomial is a fixed value).
_CRC = """xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda a, c: list_reduce([xor(a, c)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _tree(name: str, group: str, count: int) -> str:
    """CTEs of a tree's levels: ``name``0 (group, i, h) to ``name``count, all one node."""
    parts = []
    for j in range(count):
        parts.append(f"""{name}{j + 1} as materialized (
    select {group}, i // 2 as i, case when any_value(of) = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end as h
    from (select *, count(*) over (partition by {group}) as of from {name}{j}) group by {group}, i // 2
)""")
    return ",\n".join(parts)


def _climb(name: str, group: str, start: str, count: int) -> str:
    """CTEs that climb a tree's levels: ``start``0 (.., i, node, proof) to ``start``count."""
    parts = []
    for j in range(count):
        parts.append(f"""{start}{j + 1} as materialized (
    select f.* exclude (i, node, proof), f.i // 2 as i, proof || coalesce(s.h, '') as proof,
           case when of = 1 then node when f.i % 2 = 1 then sha256(s.h || node) else sha256(node || coalesce(s.h, '')) end as node
    from {start}{j} f
    join (select {group}, count(*) as of from {name}{j} group by {group}) c on c.{group} is not distinct from f.{group}
    left join {name}{j} s on s.{group} is not distinct from f.{group} and s.i = xor(f.i, 1)
)""")
    return ",\n".join(parts)


MERKLE = f"""
with leaves as materialized (
    select *, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as i
    from (select doc_id, lang, {_leaf('n_chars')} as h, {_leaf('(n_chars + 1)')} as other, {_CRC} % 7 = 0 as hit from documents)
),
t0 as materialized (select lang, i, h from leaves),
{_tree('t', 'lang', LANG_LEVELS)},
u0 as materialized (
    select 0 as one, lang, row_number() over (order by lang nulls first) - 1 as i, h from t{LANG_LEVELS}
),
{_tree('u', 'one', TOP_LEVELS)},
f0 as materialized (
    select doc_id, lang, h as leaf, i, case when hit then other else h end as node, '' as proof from leaves
),
{_climb('t', 'lang', 'f', LANG_LEVELS)},
g0 as materialized (
    select f.* exclude (i), 0 as one, u0.i, u0.h as subroot from f{LANG_LEVELS} f join u0 on u0.lang is not distinct from f.lang
),
{_climb('u', 'one', 'g', TOP_LEVELS)}
select doc_id, leaf, subroot, root.h as root, sha256(proof) as proof_sha256, node as folded_root, node = root.h as verified
from g{TOP_LEVELS}, (select h from u{TOP_LEVELS}) root
"""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

JACCARD = f"""
with recursive texts as (
    select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as words
    from documents
), shingles as (
    select distinct doc_id, unnest(case when len(words) = 0 then []::varchar[]
        when len(words) < 3 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
        end) as shingle
    from texts
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n
    having 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reached as (
    select doc_id as a, doc_id as b from documents
    union
    select r.a, l.b from reached r join links l on l.a = r.b
)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(r.b) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id join reached r on r.a = d.doc_id
group by d.doc_id
"""

SUBSTRINGS = f"""
with texts as (
    select doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents
), windows as (
    select doc_id, i, array_to_string(words[i : i + 12], ' ') as w
    from (select *, unnest(range(1, len(words) - 11)) as i from texts)
), repeated as (
    select doc_id, i from windows qualify min(doc_id) over (partition by w) < doc_id
), removed as (
    select distinct doc_id, i + j as i from repeated, range(13) as r(j)
), words as (
    select doc_id, unnest(words) as word, generate_subscripts(words, 1) as i from texts
), kept as (
    select w.doc_id, count(*) as n, string_agg(word, ' ' order by i) as kept
    from words w anti join removed r on r.doc_id = w.doc_id and r.i = w.i group by w.doc_id
)
select t.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""
