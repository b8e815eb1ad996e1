"""DuckDB SQL for the queries that it can express."""

from itertools import permutations

_MEASURES = ["symbol_share", "dup_line_share", "repeat_share", "word_length"]
_CELL = "((value >> greatest(0, length(bin(value)) - 6)) << greatest(0, length(bin(value)) - 6))"
_MARGIN = "case measure when 'symbol_share' then 60 when 'dup_line_share' then 500 when 'repeat_share' then 250 else 400 end"


def _quartiles(name: str, source: str, keys: str) -> str:
    keys_comma = f"{keys}, " if keys else ""
    return f"""
{name}_ranked as (
  select {keys_comma}measure, cell, sum(n) over (partition by {keys_comma}measure order by cell) as upto,
    sum(n) over (partition by {keys_comma}measure) as total
  from (select {keys_comma}measure, cell, sum(n) as n from cells group by all)),
{name} as (
  select {keys_comma}measure, max(total) as total,
    min(case when 4 * upto >= total then cell end) as q1, min(case when 4 * upto >= 3 * total then cell end) as q3
  from {name}_ranked group by all)"""


QUALITY_RULES = f"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    coalesce(text, '') as text
  from documents),
split as (
  select *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from docs),
windows as (
  select rid, i, array_to_string(words[i:i + 7], ' ') as w
  from (select rid, words, unnest(range(1, len(words) - 6)) as i from split where len(words) >= 8)),
twice as (
  select rid, i, lead(i) over (partition by rid order by i) as later
  from (select rid, i, count(*) over (partition by rid, w) as c from windows) where c > 1),
repeats as (
  select rid, sum(least(8, coalesce(later - i, 8))) as n_repeat_words from twice group by rid),
counted as (
  select s.rid, doc_id, lang, source, len(words)::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from split s left join repeats r on s.rid = r.rid),
measured as (
  select *, case when word_chars > 0 then n_symbols * 1000 // word_chars else 0 end as symbol_share,
    case when n_lines > 0 then n_dup_lines * 1000 // n_lines else 0 end as dup_line_share,
    case when n_words > 0 then n_repeat_words * 1000 // n_words else 0 end as repeat_share,
    case when n_words > 0 then word_chars * 100 // n_words else 0 end as word_length,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
  from counted),
long as ({" union all ".join(f"select lang, source, '{m}' as measure, {m} as value from measured" for m in _MEASURES)}),
cells as (select lang, source, measure, {_CELL} as cell, count(*) as n from long group by all),
{_quartiles("fine", "cells", "lang, source")},
{_quartiles("by_lang", "cells", "lang")},
{_quartiles("over_all", "cells", "")},
picked as (
  select f.lang, f.source, f.measure,
    case when f.total >= 100 then f.q1 when l.total >= 100 then l.q1 else a.q1 end as q1,
    case when f.total >= 100 then f.q3 when l.total >= 100 then l.q3 else a.q3 end as q3
  from fine f join by_lang l on f.lang = l.lang and f.measure = l.measure join over_all a on f.measure = a.measure),
cuts as (
  select lang, source, measure, q3 + greatest(4 * (q3 - q1), {_MARGIN}) as hi,
    q1 - greatest(4 * (q3 - q1), {_MARGIN}) as lo
  from picked)
select m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  not m.base_failed and {" and ".join(f"m.{x} <= c_{x}.hi" for x in _MEASURES)} and m.word_length >= c_word_length.lo
    as kept
from measured m
{" ".join(f"join cuts c_{x} on c_{x}.measure = '{x}' and c_{x}.lang = m.lang and c_{x}.source = m.source" for x in _MEASURES)}
"""


def _whole(column: str) -> str:
    return f"list_transform({column}, lambda x: floor(256 * x::double))"


_FINITE = "len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

EXACT_TOP_K = f"""
with whole as (
  select row_number() over () as rid, vec_id, {_whole("embedding")} as v from embeddings
  where embedding is not null and {_FINITE}),
scored as (
  select q.rid, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.rid <> c.rid where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by rid order by score desc, vec_id)::integer as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


def _turn(number: int) -> str:
    """Assignment to the centroids of one turn, and the centroids after it."""
    return f"""
a{number} as materialized (
  select rid, vec_id, v, cluster, d from (
    select w.*, c.cluster, (list_dot_product(v, v) - 2 * list_dot_product(v, centre) + list_dot_product(centre, centre))::bigint as d,
      row_number() over (partition by rid order by
        list_dot_product(v, v) - 2 * list_dot_product(v, centre) + list_dot_product(centre, centre), c.cluster) as place
    from whole w cross join c{number} c) where place = 1),
c{number + 1} as materialized (
  select c.cluster, coalesce(m.centre, c.centre) as centre from c{number} c left join (
    select cluster, list(floor(total / n) order by i) as centre from (
      select cluster, i, sum(v[i]) as total, count(*) as n
      from (select cluster, v, unnest(range(1, 65)) as i from a{number}) group by cluster, i)
    group by cluster) m on m.cluster = c.cluster)"""


HEAP_CLUSTERS = f"""
with whole as materialized (
  select row_number() over () as rid, vec_id, {_whole("embedding")} as v from embeddings
  where len(embedding) = 64 and {_FINITE}),
c0 as materialized (
  select (row_number() over (order by name) - 1)::integer as cluster, v as centre
  from (select sha256('2:' || vec_id) as name, v from whole order by name limit 40)),
{",".join(_turn(i) for i in range(6))}
select vec_id, a.cluster, d as distance, (sum(d) over (partition by a.cluster))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia,
  sha256(array_to_string(list_transform(centre, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a5 a join c5 c on c.cluster = a.cluster
"""


def _steps() -> str:
    """Rows of order, step, bits before, own bit, for all orders of five filters."""
    rows = []
    for order in permutations("ABCDE"):
        for i, letter in enumerate(order):
            before = sum(1 << "ABCDE".index(x) for x in order[:i])
            rows.append(f"('{''.join(order)}', {i + 1}, {before}, {1 << 'ABCDE'.index(letter)})")
    return ", ".join(rows)


FILTER_AUDIT = f"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, min(doc_id) over (partition by coalesce(text, ''))
    as first_id
  from documents),
split as (
  select *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from docs),
marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels
  where doc_id is not null group by doc_id),
masked as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (len(words) < 100)::int + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(first_id < s.doc_id, false)::int as mask
  from split s left join marks m on m.doc_id = s.doc_id),
cells as (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masked group by part, mask),
steps(filter_order, step, before, bit) as (values {_steps()}),
stepped as (
  select part, filter_order, step, bit,
    sum(n) filter (mask & (before | bit) = 0) as kept, sum(n) filter (mask & before = 0 and mask & bit <> 0) as removed,
    sum(n) filter (mask & before <> 0 and mask & bit <> 0) as redundant, sum(n) filter (mask = bit) as unique_fails,
    sum(good) filter (mask & before = 0 and mask & bit <> 0) as good_lost,
    sum(toxic) filter (mask & before = 0 and mask & bit <> 0) as toxic_lost
  from cells cross join steps group by all)
select part, filter_order, step::integer as step, coalesce(kept, 0)::bigint as kept,
  coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
  coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley
from stepped
"""
