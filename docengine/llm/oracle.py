"""SQL of operators whose results are exact, over all pairs of the given tables."""

REACH = """
reach as (
  with recursive r as (
    select id, id as to_id from ids
    union
    select r.id, l.b as to_id from r join links l on l.a = r.to_id)
  select id, min(to_id) as component_id from r group by id)"""

# Cosine of all pairs of one label; a vector that can't be compared has no links.
VECTORS = f"""with usable as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b
  from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
ids as (select vec_id as id from embeddings),{REACH},
counts as (select a, count(*) as n from links group by a)
select id as vec_id, coalesce(n, 0) as n_links, component_id, id = component_id as kept
from reach left join counts on a = id"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Common shingles of all pairs of documents that share one.
DOCUMENTS = f"""with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, unnest(list_distinct(case
    when len(w) = 0 then []
    when len(w) = 1 then w
    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)) as s
  from words),
numbered as (select doc_id, dense_rank() over (order by s) as s from sets),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from numbered a join numbered b on a.s = b.s and a.doc_id < b.doc_id group by all),
half as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
links as (select a, b from half union all select b, a from half),
ids as (select doc_id as id from documents),{REACH}
select id as doc_id, coalesce(n, 0) as n_shingles, component_id, id = component_id as kept
from reach left join sizes on doc_id = id"""
