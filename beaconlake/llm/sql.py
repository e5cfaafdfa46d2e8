"""DuckDB SQL that some of the queries must agree with."""

TOPK = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as cells
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.cells, c.cells)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.cells) = len(c.cells)
  where q.vec_id % 50 = 0
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 5
"""

REPEATS = """
with docs as (
  select row_number() over () as rid, doc_id, coalesce(doc_id, 9223372036854775807) as id,
    hex(encode(coalesce(text, ''))) as h
  from documents
), blocks as (  -- short overlapping blocks, as cutting a long text anywhere means reading it up to there
  select rid, id, block * 500 as origin, substr(h, block * 1000 + 1, 1098) as b
  from docs, lateral (select unnest(range(0, greatest(len(h) // 2 - 49, 0), 500)) // 500 as block)
), strings as (
  select rid, id, origin + i as pos, substr(b, 2 * i + 1, 100) as s
  from blocks, lateral (select unnest(range(0, least(len(b) // 2 - 49, 500))) as i)
), least as (
  select s, min(id) as first from strings group by s
), hits as (
  select rid, pos from strings join least using (s) where id > first
), islands as (
  select rid, pos, sum(fresh) over (partition by rid order by pos) as island from (
    select rid, pos, case when pos <= lag(pos) over (partition by rid order by pos) + 50 then 0 else 1 end as fresh from hits
  )
), spans as (
  select rid, island, min(pos) as a, max(pos) + 50 as b from islands group by rid, island
), cuts as (
  select rid, a, b, coalesce(lag(b) over (partition by rid order by a), 0) as before from spans
), parts as (
  select rid, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept
  from cuts join docs using (rid) group by rid
)
select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) as kept_sha256
from docs left join parts using (rid)
"""

JACCARD = """
with recursive words as (
  select row_number() over () as rid, doc_id,
    list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents
), shingles as (
  select distinct rid, case when len(w) < 3 then w else w[i:i + 2] end as s
  from words, lateral (select unnest(range(1, greatest(len(w) - 1, 2))) as i) where len(w) > 0
), sizes as (
  select rid, count(*) as n from shingles group by rid
), sets as (
  select rid, n, list(s order by s) as s from shingles join sizes using (rid) group by rid, n
), copies as (
  select rid, min(rid) over (partition by s) as first from sets
), numbered as (
  select rid, n, dense_rank() over (order by s) as s from shingles join sizes using (rid)
  where rid in (select first from copies)
), prefix as (  -- linking sets share one of their first n - ceil(0.9 n) + 1 shingles in any common order
  select rid, n, s from (
    select *, row_number() over (partition by rid order by hash(s)) as r from numbered
  ) where r <= n - (9 * n + 9) // 10 + 1
), pairs as (
  select distinct a.rid as x, b.rid as y from prefix a join prefix b on a.s = b.s and a.rid < b.rid
    and 10 * a.n >= 9 * b.n and 10 * b.n >= 9 * a.n
), common as (
  select x, y, a.n as nx, b.n as ny, count(*) as shared from pairs
  join numbered a on a.rid = x join numbered b on b.rid = y and a.s = b.s group by x, y, a.n, b.n
), edges as (
  select x, y from common where 100 * shared >= 90 * (nx + ny - shared)
  union select rid, first from copies where rid <> first
), both_ways as (
  select x, y from edges union select y, x from edges
), reach(x, y) as (
  select x, x from (select x from both_ways) union select reach.x, e.y from reach join both_ways e on reach.y = e.x
), named as (
  select r.x as rid, min(w.doc_id) as component_id from reach r join words w on w.rid = r.y group by r.x
)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, w.doc_id) as component_id
from words w left join sizes using (rid) left join named using (rid)
"""

NEGATIVES = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as cells,
    case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.cells, c.cells)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.cells) = len(c.cells)
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from (
  select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank
  from positives join scored using (anchor_id)
  where not same and 80 * positive_score <= 100 * score and score <= positive_score
) where rank <= 5
"""

NEAR_DUPLICATES = """
with recursive words as (
  select row_number() over () as rid, doc_id,
    list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents
), shingles as (
  select distinct rid, case when len(w) < 5 then w else w[i:i + 4] end as s
  from words, lateral (select unnest(range(1, greatest(len(w) - 3, 2))) as i) where len(w) > 0
), sizes as (
  select rid, count(*) as n from shingles group by rid
), sets as (
  select rid, n, list(s order by s) as s from shingles join sizes using (rid) group by rid, n
), copies as (
  select rid, min(rid) over (partition by s) as first from sets
), numbered as (
  select rid, n, dense_rank() over (order by s) as s from shingles join sizes using (rid)
  where rid in (select first from copies)
), prefix as (  -- linking sets share one of their first n - ceil(0.85 n) + 1 shingles in any common order
  select rid, n, s from (
    select *, row_number() over (partition by rid order by hash(s)) as r from numbered
  ) where r <= n - (85 * n + 99) // 100 + 1
), pairs as (
  select distinct a.rid as x, b.rid as y from prefix a join prefix b on a.s = b.s and a.rid < b.rid
    and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
), common as (
  select x, y, a.n as nx, b.n as ny, count(*) as shared from pairs
  join numbered a on a.rid = x join numbered b on b.rid = y and a.s = b.s group by x, y, a.n, b.n
), edges as (
  select x, y from common where 100 * shared >= 85 * (nx + ny - shared)
  union select rid, first from copies where rid <> first
), both_ways as (
  select x, y from edges union select y, x from edges
), reach(x, y) as (
  select x, x from (select x from both_ways) union select reach.x, e.y from reach join both_ways e on reach.y = e.x
), named as (
  select r.x as rid, min(w.doc_id) as component_id from reach r join words w on w.rid = r.y group by r.x
)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, w.doc_id) as component_id,
  w.doc_id is not distinct from coalesce(component_id, w.doc_id) as kept
from words w left join sizes using (rid) left join named using (rid)
"""

CONVERSATIONS = """
with recursive keyed as (
  select conv_id, turn, coalesce(conv_id::varchar, ' ') as conv, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
  from conversations
), fates as (  -- crc32, bit by bit
  select *, xor(list_reduce(
      flatten([[4294967295]::bigint[]] || list_transform(range(1, len(k) + 1), lambda i: [ascii(k[i]), -1, -1, -1, -1, -1, -1, -1, -1]::bigint[])),
      lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295) % 20 as fate
  from keyed
), damaged as (
  select conv, turn, case when fate = 4 then 'user' else role end as role, unnest(range(case when fate = 3 then 2 else 1 end)) as copy,
    case when fate = 1 then '' when fate = 2 then translate(text, '.!?', '') else text end as text
  from fates where fate <> 0
), numbered as (
  select *, row_number() over (partition by conv order by turn nulls first, role, md5(text), copy) as i from damaged
), judged as (
  select *, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv order by i) as previous,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv, role, text order by i) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault
  from numbered
), counts as (
  select conv, max(i) as n, coalesce(max(turn)::hugeint - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (i > 1 and previous || initial not in ('su', 'ua', 'au')) as illegal
  from judged group by conv
), inserts(q, r, a, t) as (  -- states: 0 nothing, 1 system, 2 user, 3 assistant
  values (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''), (0, 2, 'I', chr(10) || 'user:'),
    (1, 2, 'I', chr(10) || 'user:'), (3, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'),
    (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edits(r, edit, initial, s, price, target) as (
  values (0, 'D', null, 0, 3, null), (1, 'D', null, 1, 3, null), (2, 'D', null, 2, 3, null), (3, 'D', null, 3, 3, null),
    (0, 'K', 's', 1, 0, null), (0, 'K', 'u', 2, 0, null), (1, 'K', 'u', 2, 0, null), (3, 'K', 'u', 2, 0, null), (2, 'K', 'a', 3, 0, null),
    (0, 'R', null, 2, 2, 'user'), (1, 'R', null, 2, 2, 'user'), (3, 'R', null, 2, 2, 'user'), (2, 'R', null, 3, 2, 'assistant')
), ways(conv, i, q, best) as (
  select conv, 0::bigint, 0, {'c': 0, 'a': '', 't': ''} from counts
  union all
  select w.conv, j.i, e.s, min({'c': w.best.c + 2 * len(n.a)::int + e.price + case when e.edit <> 'D' and j.fault = 'truncated' then 1 else 0 end,
    'a': w.best.a || n.a || e.edit,
    't': w.best.t || n.t || case when e.edit = 'D' then '' else chr(10) || coalesce(e.target, j.role) || ':' || j.text end})
  from ways w join judged j on j.conv = w.conv and j.i = w.i + 1 join inserts n on n.q = w.q join edits e on e.r = n.r
  where (e.initial is null or e.initial = j.initial) and (e.edit = 'D' or j.fault not in ('blank', 'duplicate'))
  group by w.conv, j.i, e.s
), ends as (
  select w.conv, min({'c': w.best.c + 2 * len(n.a)::int, 'a': w.best.a || n.a, 't': w.best.t || n.t}) as best
  from ways w join counts c on c.conv = w.conv and c.n = w.i join inserts n on n.q = w.q
  where n.r in (0, 3) group by w.conv
)
select k.conv_id, least(coalesce(gaps, 0), 9223372036854775807)::bigint as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(best.c, 0)::bigint as cost, coalesce(best.a, '') as audit, sha256(coalesce(best.t[2:], '')) as repaired_sha256
from (select distinct conv_id, conv from keyed) k left join counts using (conv) left join ends using (conv)
"""

SQL = {
    "op1_suffix_dedup": REPEATS,
    "op9_jaccard_join": JACCARD,
    "op10_topk": TOPK,
    "op11_near_duplicates": NEAR_DUPLICATES,
    "op12_hard_negatives": NEGATIVES,
    "op13_conversation_repair": CONVERSATIONS,
}
