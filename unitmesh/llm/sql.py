"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP2_LINE_DEDUP = r"""
with lines as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
        from documents)),
repeated as (
  select key, max(doc_id) as keeper from lines where length(key) >= 40
  group by key having count(distinct doc_id) >= 5)
select doc_id, count(*)::bigint as n_lines,
       (count(*) filter (where keeper is not null and keeper <> doc_id))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where keeper is null or keeper = doc_id), '')) as kept_sha256
from lines left join repeated using (key)
group by doc_id
"""

OP6_DECONTAMINATION = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select item_id, w, least(len(w), 10) as n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i
        from item_words where len(w) > 0)),
grams as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i
        from words, (select distinct n from windows) where len(w) >= n)),
found as (select g.doc_id, g.i, g.n, v.item_id from grams g join windows v on g.n = v.n and g.s = v.s),
hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from (select distinct doc_id, i, n from found))
  group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join items using (doc_id)
"""

OP5_TOPK = r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
ranked as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0)
select query_id, rank, vec_id, score
from (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from ranked)
where rank <= 10
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
OP3_SECRET_SCAN = rf"""
with t as (select doc_id, source, coalesce(text, '') as t from documents),
m as (
  select doc_id, source, 0 as kind, regexp_extract_all(t, '{_ASSIGN}') as f, regexp_extract_all(t, '{_ASSIGN}', 1) as v,
         regexp_split_to_array(t, '{_ASSIGN}') as p from t
  union all
  select doc_id, source, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
         regexp_split_to_array(t, 'AKIA[A-Z0-9]+') from t
  union all
  select doc_id, source, 2, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
         regexp_split_to_array(t, '[0-9a-f]+') from t
  union all
  select doc_id, source, 5, regexp_extract_all(t, '[A-Za-z0-9_+/=-]{{20,}}'), regexp_extract_all(t, '[A-Za-z0-9_+/=-]{{20,}}'),
         regexp_split_to_array(t, '[A-Za-z0-9_+/=-]{{20,}}') from t),
places as (
  select doc_id, source, kind, f[i] as found, v[i] as value,
         list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) as b
  from (select *, unnest(generate_series(1, len(f))) as i from m where len(f) > 0)),
spans as (
  select doc_id, source, kind, value, b::bigint as b, (b + length(found))::bigint as e from places
  where case kind when 0 then length(value) >= 6 when 1 then length(value) >= 20 when 2 then length(value) >= 24 else true end),
cand as (
  select distinct doc_id, source, value, case when kind = 0 then e - length(value) else b end as b, e from spans),
seen as (
  select value, count(distinct coalesce(source, chr(0))) as owners, count(distinct (coalesce(source, chr(0)), coalesce(doc_id, -1))) as repos,
         length(value) >= 16 and regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
         and len(list_distinct(string_split(value, ''))) >= 8
         and not regexp_matches(value, '(?i)example|sample|dummy|change_?me|placeholder|your_|xxxx|0000|1234567') as live
  from cand group by value),
added as (
  select doc_id, case when owners >= 3 or repos >= 10 then 4 else 3 end as kind, b, e
  from cand join seen using (value) where owners >= 3 or repos >= 10 or (owners = 1 and live)),
everything as (
  select doc_id, kind, b, e from spans where kind < 3 union all select doc_id, kind, b, e from added),
named as (
  select *, (['assign', 'access', 'hex', 'owned', 'copied'])[kind + 1] || ':' || b || ':' || e as s from everything)
select t.doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access,
       count(*) filter (where kind = 2) as n_hex,
       sha256(coalesce(string_agg(s, ',' order by b, kind, e) filter (where kind < 3), '')) as base_sha256,
       coalesce(string_agg(s, ',' order by b, kind, e), '') as spans,
       count(*) filter (where kind = 3) as n_owned, count(*) filter (where kind = 4) as n_copied
from t left join named using (doc_id)
group by t.doc_id
"""

# The base32 digits of a SHA-1 are five bits each of its 40 hex digits.
OP8_WARC = r"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
d as (
  select page_id, payload_bytes, h, max(page_id) over (partition by h) as keeper,
         list_aggregate(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, (5 * i) // 4 + 1, 2))::int >> (3 - (5 * i) % 4)) & 31), 1)), 'string_agg', '') as payload_digest
  from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when page_id = keeper then 'response' else 'revisit' end as record_type,
       case when page_id = keeper then null else keeper end as refers_to
from d
"""

# CRC-32 of ASCII bytes, by its polynomial, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], generate_series(1, 8)),
      lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def _merkle(tree_levels: int = 6, top_levels: int = 4) -> str:
    """Level by level, for up to 16 ** levels leaves a source and sources."""
    def part(v):
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(part(v) for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    def level(name, src):  # siblings of each node, and the nodes above
        over = "over (partition by s, i // 16 order by i rows between {} and {})"
        return f"""
{name} as (select *, coalesce(string_agg(h, '') {over.format('unbounded preceding', '1 preceding')}, '') as l,
  coalesce(string_agg(h, '') {over.format('1 following', 'unbounded following')}, '') as r,
  count(*) over (partition by s) as n from {src})"""

    def above(name):
        return f"(select s, i // 16 as i, sha256(string_agg(h, '' order by i)) as h from {name} where n > 1 group by s, i // 16)"

    out = [f"""with docs as (select doc_id, coalesce(source, '') as source_, source is null as no_source,
  {leaf('text')} as leaf, {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as other,
  coalesce({_CRC32.format('doc_id::varchar')} % 5 = 0, false) as hit from documents),
placed as (select *, dense_rank() over (order by not no_source, source_) - 1 as s,
  row_number() over (partition by no_source, source_ order by doc_id nulls first, leaf) - 1 as i from docs)"""]
    names = [f"n{k}" for k in range(tree_levels + 1)]
    out.append(level("n0", "(select s, i, leaf as h from placed)"))
    out += [level(b, above(a)) for a, b in zip(names, names[1:])]
    subroots = " union all ".join(f"select s, h from {n} where n = 1" for n in names)
    tops = [f"t{k}" for k in range(top_levels + 1)]
    out.append(f"sub as ({subroots})")
    out.append(level("t0", "(select 0 as s, s as i, h from sub)"))
    out += [level(b, above(a)) for a, b in zip(tops, tops[1:])]
    out.append("root as (" + " union all ".join(f"select h from {t} where n = 1" for t in tops) + ")")
    out.append("f0 as (select doc_id, s, i as at, s as top, leaf, case when hit then other else leaf end as f, '' as sib from placed)")
    step = """f{b} as (select f.doc_id, f.s, f.leaf, f.top{up_t} as top, f.at{up} as at,
  case when x.n > 1 then sha256(x.l || f.f || x.r) else f.f end as f, f.sib || case when x.n > 1 then x.l || x.r else '' end as sib
  from f{a} f left join {t} x on {on})"""
    for k, n in enumerate(names):
        out.append(step.format(a=k, b=k + 1, t=n, on="x.s = f.s and x.i = f.at", up=" // 16", up_t=""))
    for k, t in enumerate(tops):
        out.append(step.format(a=len(names) + k, b=len(names) + k + 1, t=t, on="x.i = f.top", up="", up_t=" // 16"))
    return ",\n".join(out) + f"""
select doc_id, leaf, sub.h as subroot, root.h as root, sha256(sib) as proof_sha256, f as folded_root, f = root.h as verified
from f{len(names) + len(tops)} f join sub using (s), root"""


OP12_MERKLE = _merkle()

OP13_NEGATIVES = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as anchor_id, c.vec_id, q.label = c.label as same, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
pos as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from scored where same) where n <= 5),
neg as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
         (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id))::int as rank
  from pos p join scored s using (anchor_id)
  where not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from neg where rank <= 10
"""
