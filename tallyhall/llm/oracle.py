"""SQL twins, for DuckDB, of the operators that SQL can express.

The other operators are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from tallyhall.llm import count_min, cover_tree, resample, secret_scan, topk, treap

_GOOD = (
    "vec_id is not null and embedding is not null and len(embedding) > 0 and "
    "list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"
)


def _links() -> str:
    return f"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where {_GOOD} and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= {cover_tree.THRESHOLD}),
reach(id, other) as (
  select vec_id, vec_id from embeddings
  union
  select reach.id, links.b from reach join links on reach.other = links.a),
component as (select id, min(other) as component_id from reach group by id)
select id as vec_id, (select count(*) from links where a = id) as n_links, component_id,
       id = component_id as kept
from component"""


def _top_k(k: int = 10) -> str:
    return f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * cast(x as double))) as e
  from embeddings where {_GOOD}),
scored as (
  select q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.e, v.e) as bigint) as score
  from v as q join v on q.vec_id % 100 = 0 and q.vec_id <> v.vec_id and len(q.e) = len(v.e)),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= {k}"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _places(pattern: str) -> str:
    """Rows ``doc_id, start, hit`` of every match: lengths between matches give the places."""
    p = _quoted(pattern)
    return f"""(
  select doc_id, hits[i] as hit,
         cast(list_sum(list_transform(gaps[1:i], lambda g: length(g))) as bigint)
         + coalesce(cast(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))) as bigint), 0) as start
  from (select doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) as i from (
    select doc_id, regexp_extract_all(t, {p}) as hits, regexp_split_to_array(t, {p}) as gaps
    from texts where regexp_matches(t, {p}))))"""


def _secrets() -> str:
    names = " ".join(f"when {i} then '{k}'" for i, k in enumerate(secret_scan.KINDS))
    allowed = " or ".join(f"regexp_full_match(hit, {_quoted(p)})" for p in secret_scan.ALLOWED)
    allowed += f" or (regexp_matches(hit, '^{secret_scan.ROW_START}') and not regexp_matches(hit, '{secret_scan.ROW_BREAK}'))"
    w, bars = secret_scan.WINDOW, secret_scan.THRESHOLDS
    spans = "string_agg(name || ':' || start || ':' || \"end\", ',' order by start, kind, \"end\")"
    counts = ", ".join(f"count(*) filter (kind = {i}) as n_{k}" for i, k in enumerate(secret_scan.KINDS))
    columns = ", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in secret_scan.KINDS)
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
base as (
  select doc_id, start, 0 as kind, start + length(hit) as "end" from {_places(secret_scan.ASSIGN)}
  where length(regexp_extract(hit, {_quoted(secret_scan.ASSIGN)}, 2)) >= {secret_scan.ASSIGN_VALUE}
  union all select doc_id, start, 1, start + length(hit) from {_places(secret_scan.ACCESS)}
  union all select doc_id, start, 2, start + length(hit) from {_places(secret_scan.HEX)}),
candidates as (
  select doc_id, start, hit, regexp_full_match(hit, '[0-9A-Fa-f]+') as hex
  from {_places(secret_scan.RUN)} where not ({allowed})),
windows as (
  select doc_id, start, hex, i from (
    select *, unnest(range(0, length(hit) - {w - 1})) as i from candidates)
  where list_aggregate(string_split(substr(hit, cast(i as integer) + 1, {w}), ''), 'entropy')
        >= case when hex then {bars["hex"]} else {bars["base64"]} end),
marked as (
  select *, case when i - lag(i) over (partition by doc_id, start order by i) <= {w} then 0 else 1 end as fresh
  from windows),
joined as (
  select doc_id, start, hex, i, sum(fresh) over (partition by doc_id, start order by i) as island from marked),
high as (
  select doc_id, start + min(i) as start, case when hex then 3 else 4 end as kind,
         start + max(i) + {w} as "end"
  from joined group by doc_id, joined.start, hex, island),
spans as (
  select * from base
  union all
  select * from high where not exists (
    select 1 from base b where b.doc_id = high.doc_id and b.start <= high.start and high."end" <= b."end")),
named as (select *, case kind {names} end as name from spans),
found as (
  select doc_id, {counts}, {spans} as spans, {spans} filter (kind < 3) as base_spans
  from named group by doc_id)
select d.doc_id, {columns}, sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join found using (doc_id)"""


def _repeats() -> str:
    w = count_min.WIDTH
    return rf"""
with texts as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
starts as (
  select rid, i, md5(array_to_string(words[i:i + {w - 1}], ' ')) as h
  from (select rid, words, unnest(range(1, len(words) - {w - 2})) as i from texts)),
often as (select h from starts group by h having count(*) > 1),
hits as (select rid, i from starts semi join often using (h)),
placed as (select rid, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from texts),
marked as (
  select rid, i, word,
         coalesce(max(hits.i) over (partition by rid order by i rows between {w - 1} preceding and current row), 0) > 0
           as gone
  from placed left join hits using (rid, i)),
kept as (
  select rid, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as rest
  from marked group by rid)
select doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from texts left join kept using (rid)"""


#: Lower-cased words of every row of a table; A-Z only are lower-cased.
def _words(table_: str, columns: str, letters: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
  select row_number() over () as rid, {columns},
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{letters}') as words
  from {table_}"""


def _resample() -> str:
    m, letters = resample.BUCKETS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
with docs as ({_words("documents", "doc_id", letters)}),
bench as ({_words("benchmark", "item_id", letters)}),
d as (select rid, unnest(words) as word from docs),
b as (select unnest(words) as word from bench),
crc_table as (
  select list(list_reduce([c, 1, 1, 1, 1, 1, 1, 1, 1],
    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) order by c) as t
  from (select unnest(range(0, 256)) as c)),
spelt as (
  select word, hex(encode(word)) as h from (select word from d union select word from b)),
buckets as (
  select word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2),
    lambda i: cast(('0x' || h[2 * i + 1:2 * i + 2]) as bigint))),
    lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % {m} as bucket
  from spelt, crc_table),
s as (select bucket, count(*) as n from d join buckets using (word) group by bucket),
t as (select bucket, count(*) as n from b join buckets using (word) group by bucket),
gain as (
  select word, cast(floor(1000 * ln(cast((coalesce(t.n, 0) + 1) * ((select count(*) from d) + {m}) as double)
    / cast((coalesce(s.n, 0) + 1) * ((select count(*) from b) + {m}) as double))) as bigint) as gain
  from buckets left join s using (bucket) left join t using (bucket)),
weights as (select rid, cast(sum(gain) as bigint) as weight from d join gain using (word) group by rid),
scored as (
  select rid, doc_id, cast(len(words) as bigint) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast(('0x' || sha256('{resample.SEED}:' || coalesce(cast(doc_id as varchar), ''))[1:8]) as bigint)
           + 0.5::double) / 4294967296::double))) as bigint) as score
  from docs left join weights using (rid)),
eligible as (
  select rid, row_number() over (order by score desc, doc_id nulls last, rid) as rank,
         count(*) over () * {resample.PERCENT} // 100 as draw
  from scored where n_features >= {resample.MIN_WORDS})
select doc_id, n_features, weight, score, case when rank <= draw then rank end as rank
from scored left join eligible using (rid)"""


def _ranked() -> str:
    letters = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    impact = (
        f"({treap.SCALE} * tf) // ({treap.UNIT} * tf + {treap.SATURATION} * "
        f"({100 - treap.B_PERCENT} + ({treap.B_PERCENT} * n * docs) // terms))"
    )
    return rf"""
with docs as ({_words("documents", "doc_id", letters)}),
bench as ({_words("benchmark", "item_id", letters)}),
asked as (select distinct rid as item, item_id, unnest(words) as term from bench),
sums as (select count(*) filter (len(words) > 0) as docs, cast(sum(len(words)) as bigint) as terms from docs),
postings as (
  select rid, doc_id, n, term, count(*) as tf
  from (select rid, doc_id, len(words) as n, unnest(words) as term from docs)
  where term in (select term from asked) group by all),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * (select docs from sums) + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from postings group by term),
scored as (
  select item, item_id, rid, doc_id, cast(sum(w * ({impact})) as bigint) as score
  from asked join postings using (term) join weights using (term), sums group by all),
ranked as (
  select *, cast(row_number() over (partition by item order by score desc, doc_id nulls last, rid) as integer) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {treap.K}"""


SQL: dict[str, str] = {
    "op13_lexical_search": _ranked(),
    "op12_importance_resampling": _resample(),
    "op11_substring_dedup": _repeats(),
    "op3_embedding_near_dedup": _links(),
    "op4_exact_top_k": _top_k(),
    "op7_secret_scan": _secrets(),
}
