"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from fleetlens.llm.licenses import PERCENT, SEPARATOR, SIZE, TEMPLATES

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

EXACT = """
with t as (select doc_id, coalesce(text, '') as x from documents),
     g as (select x, max(doc_id) as keep_id, count(*) as group_size from t group by x)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.x) as text_sha256
from t join g on t.x = g.x
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _shingled(words: str) -> str:
    return f"list_transform(range(1, len({words}) - {SIZE - 2}), lambda i: array_to_string({words}[i:i + {SIZE - 1}], ' '))"


LICENSES = f"""
with templates(template, license, words) as (
  select template, license, list_filter(string_split_regex(lower(text), '{SEPARATOR}'), lambda w: w <> '')
  from (values {", ".join(f"({i}, {_text(name)}, {_text(text)})" for i, (name, text) in enumerate(TEMPLATES))})
    v(template, license, text)),
asked as (select distinct template, license, unnest({_shingled("words")}) as shingle from templates),
sizes as (select template, license, count(*) as n, cast(pow(2, ceil(log2(count(*)))) as bigint) as step
          from asked group by all),
texts as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{SEPARATOR}'), lambda w: w <> '')
          as words from documents),
long as (select doc_id, words from texts where len(words) >= {SIZE}),
held as (select doc_id, unnest({_shingled("words")}) as shingle, unnest(range(0, len(words) - {SIZE - 1})) as pos from long),
hits as (select h.doc_id, h.pos, h.shingle, s.template, s.license, s.n, s.step
         from held h join asked a on h.shingle = a.shingle join sizes s on s.template = a.template),
spread as (select *, (pos // step) * step as begins from hits
           union all select *, (pos // step - 1) * step from hits where pos >= step),
counted as (select doc_id, template, license, n, begins, count(distinct shingle) as n_found from spread group by all)
select doc_id, license, n as n_shingles, n_found, n_found / n as containment, begins as word_at
from counted where n_found * 100 >= n * {PERCENT}
qualify row_number() over (partition by doc_id, license order by n_found / n desc, n desc, begins) = 1
"""

MIX = rf"""
with sized as (
  select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sized group by source),
filled as (
  select *,
    1.5 * sum(source_size) over () as pool,
    coalesce(sum(source_size) over lower_ones, 0) as used,
    sum(weight) over (order by source_size / weight, source rows between current row and unbounded following) as open
  from sources
  window lower_ones as (order by source_size / weight, source rows between unbounded preceding and 1 preceding)),
stopped as (select *, (pool - 2 * used) / open * weight >= 2 * source_size as full_up from filled),
level as (select coalesce(sum(source_size) filter (full_up), 0) as used,
                 coalesce(sum(weight) filter (not full_up), 0) as open, max(pool) as pool from stopped),
targets as (
  select source, source_size, case when full_up then cast(2 * source_size as double)
    else cast(l.pool - 2 * l.used as double) * weight / cast(l.open as double) end as target
  from stopped, level l),
ranked as (
  select s.*, t.source_size, t.target, floor(case when t.source_size > 0 then t.target / t.source_size else 0 end) as whole,
    case when t.source_size > 0 then t.target / t.source_size else 0 end
      - floor(case when t.source_size > 0 then t.target / t.source_size else 0 end) as rest,
    (cast('0x' || substr(sha256('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5)
      / 4503599627370496.0 as u
  from sized s join targets t on s.source is not distinct from t.source),
run as (
  select *, target - whole * source_size as remaining,
    sum(case when rest > 0 then size else 0 end) over
      (partition by source order by case when rest > 0 then (u / (1 - u)) / (rest / (1 - rest)) end nulls last, doc_id)
      as upto
  from ranked)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(size * (whole + case when rest > 0 and remaining > 0 and upto - size / 2 <= remaining then 1 else 0 end) as bigint)
    as taken
from run
"""

NEAR = f"""
with recursive w as (select doc_id, {_WORDS} as w from documents),
s as (select distinct doc_id, unnest(case
        when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b on a.s = b.s and a.doc_id <> b.doc_id
      group by 1, 2),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * i >= 85 * (a.n + b.n - i)),
r(d, c) as (select doc_id, doc_id from w union select r.d, l.y from r join l on l.x = r.c)
select r.d as doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(c) as component_id,
  min(c) = r.d as kept
from r left join n on n.doc_id = r.d group by r.d
"""

WARC = """
with t as (select page_id, coalesce(html, '') as x from pages),
     g as (select x, min(page_id) as first_id from t where strlen(x) >= 100 group by x)
select t.page_id, strlen(t.x) as payload_bytes, sha256(t.x) as payload_digest,
  case when g.first_id < t.page_id then 'revisit' else 'response' end as record_type,
  case when g.first_id < t.page_id then g.first_id end as refers_to
from t left join g on t.x = g.x
"""

# The checksum of a document's number, bit by bit, as DuckDB has no function for it.
_CRC32 = """xor(list_reduce([cast(4294967295 as bigint)] || list_transform(range(1, length(cast(doc_id as varchar)) + 1),
  lambda i: cast(ascii(cast(doc_id as varchar)[i]) as bigint)), lambda c, b:
  list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)
  ), 4294967295)"""

RUNS = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, {_CRC32} as h from documents),
e as (select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as bent, (h // 10) % greatest(len(w), 1) as a, (h // 10) % 8 as k from d),
f as (select doc_id, n, list_transform(range(0, n), lambda i: w[1 + case when bent and i >= a
        then a + (i - a) % (1 + (n - a) // (3 + k)) else i end]) as w from e),
t as (select doc_id, n, unnest(w) as t, unnest(range(0, n)) as i from f),
m as (select x.doc_id, y.i - x.i as q, x.i, x.n from t x join t y
      on x.doc_id = y.doc_id and x.t = y.t and y.i > x.i and 3 * (y.i - x.i) <= x.n),
g as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from m),
r as (select doc_id, min(i) as start, count(*) + q as length, q from g group by doc_id, q, island
      having count(*) + q >= greatest(24, 3 * q)),
s as (select doc_id, start, length, min(q) as period from r group by doc_id, start, length),
o as (select doc_id, count(*) as n_runs,
        first(struct_pack(s := start, l := length, p := period) order by cast(length as double) / period desc, start, period) as best,
        sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256
      from s group by doc_id),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from s),
left_over as (select t.doc_id, sha256(string_agg(t.t, ' ' order by t.i)) as collapsed_sha256
         from t left join gone on gone.doc_id = t.doc_id and gone.i = t.i where gone.i is null group by t.doc_id)
select f.doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, best.s as start, best.l as length, best.p as period,
  1000 * best.l // best.p as exponent_milli, coalesce(runs_sha256, sha256('')) as runs_sha256,
  coalesce(collapsed_sha256, sha256('')) as collapsed_sha256
from f left join o on o.doc_id = f.doc_id left join left_over c on c.doc_id = f.doc_id
"""


def _terms(table: str, key: str) -> str:
    return rf"""select {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from {table} where text is not null"""


SEARCH = rf"""
with d as ({_terms("documents", "doc_id")}),
b as ({_terms("benchmark", "item_id")}),
total as (select count(*) filter (len(w) > 0) as n, cast(sum(len(w)) as bigint) as l from d),
asked as (select item_id, unnest(w) as t from b),
query as (select item_id, t, count(*) as times from asked group by all),
held as (select doc_id, len(w) as n, unnest(w) as t from d),
counted as (select doc_id, n, t, count(*) as tf from held where t in (select t from query) group by all),
weights as (select t, cast(floor(1000 * ln((2 * max(total.n) + 2) / (2 * count(*) + 1))) as bigint) as w from counted, total group by t),
scored as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * c.n * total.n) // total.l)))) as bigint) as score
  from query q join counted c on q.t = c.t join weights on weights.t = q.t, total group by item_id, doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id) <= 20
"""

JOIN = NEAR.replace("len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])",
                    "len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))").replace(
                    "min(c) as component_id,\n  min(c) = r.d as kept\n", "min(c) as component_id\n")

SQL = {
    "op1_exact_dedup": EXACT,
    "op2_license_scan": LICENSES,
    "op3_source_mix": MIX,
    "op7_near_dedup": NEAR,
    "op10_warc": WARC,
    "op11_periodic_runs": RUNS,
    "op12_ranked_search": SEARCH,
    "op13_shingle_join": JOIN,
}
