"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NGRAM_JACCARD_JOIN = rf"""with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') as words
  from documents),
placed as (
  select doc_id, len(words) as total, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from w),
five as (
  select doc_id, total, i, word || ' ' || lead(word, 1) over p || ' ' || lead(word, 2) over p || ' '
         || lead(word, 3) over p || ' ' || lead(word, 4) over p as gram
  from placed window p as (partition by doc_id order by i)),
g as materialized (
  select distinct doc_id, gram from five where i <= total - 4
  union all
  select doc_id, array_to_string(words, ' ') from w where len(words) between 1 and 4),
sizes as materialized (
  select w.doc_id, count(g.gram) as n from w left join g on g.doc_id = w.doc_id group by w.doc_id),
links as materialized (
  select a.doc_id as u, b.doc_id as v
  from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached(doc_id, node) as (
  select doc_id, doc_id from sizes
  union
  select r.doc_id, l.v from reached r join links l on l.u = r.node)
select s.doc_id, s.n as n_shingles, min(r.node) as component_id
from sizes s join reached r on r.doc_id = s.doc_id group by s.doc_id, s.n"""

NORM_BUCKET_TOPK = """with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id
  where q.vec_id % 100 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as k from scored)
select query_id, cast(k as integer) as rank, vec_id, score from ranked where k <= 10"""

ORACLE_SQL: dict[str, str] = {
    "op6_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
    "op7_norm_bucket_topk": NORM_BUCKET_TOPK,
}
