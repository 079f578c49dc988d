"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from . import licenses

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = """
with p as (
  select page_id, concat('pages-', cast(page_id // 500 as varchar)) as archive, coalesce(html, '') as html,
    strlen('WARC/1.1 ') + strlen(coalesce(url, '')) + 1 + strlen(cast(strlen(coalesce(html, '')) as varchar)) + 2
      + strlen(coalesce(html, '')) + 4 as len
  from pages
), o as (
  select *, cast(coalesce(sum(len) over (partition by archive order by page_id
    rows between unbounded preceding and 1 preceding), 0) as bigint) as byte_offset from p
)
select archive, page_id, byte_offset,
  case when page_id % 101 = 5 then 'missing' else 'changed' end as status
from o where page_id % 101 = 5 or (page_id % 97 = 3 and contains(html, 'e'))
"""

OP4 = rf"""
with p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages
), r(h, q, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m as (
  select page_id, h || q as rule, v, row_number() over (partition by page_id order by length(h) desc, length(q) desc) as k
  from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, q)
)
select p.page_id, host, path, rule, coalesce(v, 'allow') as verdict
from p left join m on p.page_id = m.page_id and k = 1
"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{licenses.COPYRIGHT_LINE}', '', 'g')"
    out = rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for spelling, standard in licenses.SPELLINGS.items():
        out = f"replace({out}, '{spelling}', '{standard}')"
    return out


def _flat(lines: str) -> str:
    return rf"trim(regexp_replace({lines}, '[ \n]+', ' ', 'g'))"


def _op6() -> str:
    rows = ", ".join(
        "('{}', '{}')".format(name, body.replace("'", "''")) for name, body in licenses.KNOWN.items()
    )
    return f"""
with known as (
  select id, sha256({_flat(_canonical('body'))}) as digest from (values {rows}) k(id, body)
), d as (select doc_id, {_canonical('text')} as lines from documents),
e as (
  select doc_id, sha256({_flat('lines')}) as digest,
    list_transform(string_split(lines, chr(10)), lambda x: sha256({_flat('x')})) as of_lines from d
)
select doc_id, e.digest, (select min(id) from known where known.digest = e.digest) as license_id,
  case when of_lines is null then '' else
    coalesce((select string_agg(id, ',' order by id) from known where list_contains(of_lines, known.digest)), '') end as notices
from e
"""


OP7 = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') as w from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') as w from benchmark
), bl as (select item_id, w, least(13, len(w)) as n from b where len(w) > 0),
bw as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as t
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from bl)
), dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as t
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d cross join (select distinct n from bl))
), hit as (select doc_id, i, bw.n, item_id from dw join bw on dw.n = bw.n and dw.t = bw.t),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
items as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
  from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by 1
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

OP8 = rf"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACED}') as w from documents
), s as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as t
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from d where len(w) > 0)
), n as (select doc_id, count(*) as n from s group by 1),
links as (
  select a.doc_id as x, b.doc_id as y from s a join s b on a.t = b.t and a.doc_id <> b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach(x, y) as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x),
c as (select x as doc_id, min(y) as least from reach group by 1)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(c.least, doc_id)) as component_id,
  doc_id = least(doc_id, coalesce(c.least, doc_id)) as kept
from d left join n using (doc_id) left join c using (doc_id)
"""

OP9 = rf"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '{_SPACED}')), 0) as bigint) as size,
    md5(concat('mix:', coalesce(cast(doc_id as varchar), ''))) as key from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size, sum(size) * 2.0::double as cap,
    [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source is null, source) - 1) % 3 + 1] as weight
  from d group by source
), l as (
  select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by cap / weight, source is null, source
      rows between unbounded preceding and 1 preceding), 0.0::double))
    / sum(weight) over (order by cap / weight, source is null, source rows between current row and unbounded following) as level
  from s
), t as (
  select source, source_size, least(cap, greatest(max(level) over (), 0.0::double) * weight) as target from l
), p as (
  select source as of, source_size, target, coalesce(cast(floor(target / nullif(source_size, 0)) as bigint), 0) as whole from t
), r as (
  select d.*, source_size, target, whole, target - whole * source_size as rest,
    coalesce(sum(size) over (partition by source order by key, size rows between unbounded preceding and 1 preceding), 0) as before
  from d join p on d.source is not distinct from p.of
)
select doc_id, size, source_size, target,
  cast((whole + case when before + size / 2.0::double <= rest and rest > 0 then 1 else 0 end) * size as bigint) as taken
from r
"""

OP12 = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positive as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
from positive join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 5
"""

OP13 = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') as w from documents
), sized as (select doc_id, w, cast(len(w) as bigint) as n from d where len(w) > 0),
total as (select count(*) as docs, sum(n)::bigint as terms from sized),
b as (
  select item_id, t, count(*) as c from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}')) as t from benchmark
  ) group by item_id, t
), tf as (
  select doc_id, n, t, count(*) as tf from (select doc_id, n, unnest(w) as t from sized)
  where t in (select t from b) group by doc_id, n, t
), df as (select t, count(*) as df from tf group by t),
impact as (
  select doc_id, t, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint)
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) as x
  from tf join df using (t) cross join total
), scored as (
  select item_id, doc_id, cast(sum(c * x) as bigint) as score from b join impact using (t) group by item_id, doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 20
"""

ORACLES = {
    "op3_warc_fixity": OP3,
    "op4_url_filters": OP4,
    "op6_license_scan": _op6(),
    "op7_benchmark_decontamination": OP7,
    "op8_minhash_dedup": OP8,
    "op9_source_mixing": OP9,
    "op12_hard_negatives": OP12,
    "op13_ranked_search": OP13,
}
