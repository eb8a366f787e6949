"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from larder.llm.license_rules import BASE, CONFIDENCE, rules
from larder.llm.sharding import SEED, SHARDS


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _spaced(pattern: str) -> str:
    """A rule over words with a space on both sides of each: no lookaround is needed."""
    spaced = pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?")
    return f"(?i) (?:{spaced}) "


def license_scan_sql() -> str:
    """Every rule on every text; a match lies where as many spaces stand before it."""
    table = [(-1, label, 0, phrase) for label, _, phrase in BASE] + [(i, label, tier, p) for i, (label, tier, _, p) in enumerate(rules())]
    values = ", ".join(f"({i}, {_quoted(label)}, {tier}, {_quoted(_spaced(p))})" for i, label, tier, p in table)
    weights = " ".join(f"when {i} then {c}::double" for i, c in enumerate(CONFIDENCE))
    separators = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    spaces = "(length({0}) - length(replace({0}, ' ', '')))"
    return f"""
with rules(rule, label, tier, pattern) as (values {values}),
d as (select doc_id, trim(regexp_replace(coalesce(text, ''), '{separators}', ' ', 'g'), ' ') as t from documents),
w as (select doc_id, t, ' ' || replace(t, ' ', '  ') || ' ' as s, case when t = '' then 0 else {spaces.format('t')} + 1 end as n_words from d),
matched as (select w.doc_id, r.rule, r.label, r.tier, string_split_regex(w.s, r.pattern) as pieces, regexp_extract_all(w.s, r.pattern) as found
  from w join rules r on regexp_matches(w.s, r.pattern)),
each as (select *, unnest(range(1, len(found) + 1)) as i from matched),
hits as (select doc_id, rule, label, tier,
  cast((list_sum(list_transform(pieces[1:i], lambda x: {spaces.format('x')})) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: {spaces.format('x')})), 0)) // 2 as bigint) as first,
  cast((list_sum(list_transform(pieces[1:i], lambda x: {spaces.format('x')})) + list_sum(list_transform(found[1:i], lambda x: {spaces.format('x')}))) // 2 as bigint) as past from each),
kept as (select * from hits h where rule >= 0 and not exists (select 1 from hits e where e.doc_id = h.doc_id and e.rule >= 0 and e.rule <> h.rule
  and e.first <= h.first and e.past >= h.past and e.tier <= h.tier
  and (e.first < h.first or e.past > h.past or e.tier < h.tier or e.rule < h.rule))),
base as (select doc_id, count(*) as n_base, min(first) as first_word, max(first) as last_word, string_agg(distinct label, ',' order by label) as base_labels
  from hits where rule < 0 group by doc_id),
own as (select doc_id, max(case tier {weights} end) as score, count(*) as n_detections from kept group by doc_id),
names as (select doc_id, string_agg(distinct label, ',' order by label) as labels from (select doc_id, label from kept union all select doc_id, label from hits where rule < 0) x group by doc_id)
select w.doc_id, cast(w.n_words as bigint) as n_words, coalesce(b.n_base, 0) as n_base, b.first_word, b.last_word, coalesce(b.base_labels, '') as base_labels,
  coalesce(n.labels, '') as labels, coalesce(o.score, 0.0) as score, coalesce(o.n_detections, 0) as n_detections
from w left join base b using (doc_id) left join own o using (doc_id) left join names n using (doc_id)"""


def suffix_dedup_sql(window: int = 100) -> str:
    """All windows of all texts; one goes if the same bytes start earlier.  Texts are handled as hex digits."""
    return f"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
places as (select doc_id, h, unnest(range(0, n - {window} + 1)) as p from d where n >= {window}),
windows as (select doc_id, p, md5_number(substr(h, 2 * p + 1, {2 * window})) as w from places),
ranked as (select doc_id, p, row_number() over (partition by w order by doc_id, p) as r from windows),
late as (select doc_id, p, p - lag(p) over (partition by doc_id order by p) as gap from ranked where r > 1),
runs as (select doc_id, p, sum(case when gap <= {window} then 0 else 1 end) over (partition by doc_id order by p) as run from late),
spans as (select doc_id, run, min(p) as s, max(p) + {window} as e from runs group by doc_id, run),
cuts as (select doc_id, count(*) as n_spans, sum(e - s) as n_removed from spans group by doc_id),
edges as (select doc_id, run, s, e, lag(e, 1, 0) over (partition by doc_id order by s) as before from spans),
pieces as (select x.doc_id, x.before as pos, substr(d.h, cast(2 * x.before + 1 as bigint), cast(2 * (x.s - x.before) as bigint)) as part from edges x join d using (doc_id)
  union all select x.doc_id, max(x.e), substr(any_value(d.h), cast(2 * max(x.e) + 1 as bigint)) from spans x join d using (doc_id) group by x.doc_id),
rest as (select doc_id, string_agg(part, '' order by pos) as h from pieces group by doc_id)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(coalesce(c.n_removed, 0) as bigint) as n_removed, cast(coalesce(c.n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(r.h, d.h))) as kept_sha256
from d left join cuts c using (doc_id) left join rest r using (doc_id)"""


def _crc32_table() -> list[int]:
    """The 256 remainders of the reflected polynomial."""
    out = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


def sharding_sql() -> str:
    """Ranks in sources by hash, fractional ranks, cuts of equal counts; crc32 byte by byte."""
    table = "[" + ", ".join(map(str, _crc32_table())) + "]::bigint[]"
    key = f"sha256(coalesce(cast(doc_id as varchar), '') || '::{SEED}')"
    return f"""
with d as (select doc_id, source, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n, {key} as k from documents),
r as (select *, (row_number() over (partition by source order by k) - 1 + 0.5::double) / count(*) over (partition by source) as share from d),
g as (select *, row_number() over (order by share, k) - 1 as g, count(*) over () as total from r),
s as (select *, g * {SHARDS} // total as shard from g)
select doc_id, cast(n + 16 as bigint) as size,
  xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(n), lambda i: cast('0x' || substr(h, 2 * i + 1, 2) as bigint))),
    lambda acc, b: xor(acc >> 8, ({table})[xor(acc & 255, b) + 1])), 4294967295::bigint) as text_crc32,
  'rows' as law, cast(shard as int) as shard, cast(g - (shard * total + {SHARDS - 1}) // {SHARDS} as bigint) as slot, cast(null as int) as grown_shard, source from s"""


#: Vectors that take part, in whole numbers.
_VECTORS = """select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


def topk_sql(k: int = 5) -> str:
    """All products of the queries."""
    return f"""
with v as ({_VECTORS}),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= {k}"""


def hard_negatives_sql(positives: int = 5, negatives: int = 5) -> str:
    """All products of the anchors, then the windows of their positives."""
    return f"""
with v as (select * replace (case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label) from ({_VECTORS}) x where label is not null),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.e, c.e) as bigint) as score
  from v a join v c on c.vec_id <> a.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {positives}),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score,
  row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= {negatives}"""


def trie_sql() -> str:
    """Every prefix of every rebuilt conversation, its ancestors, and sums over them; crc32 digit by digit."""
    table = "[" + ", ".join(map(str, _crc32_table())) + "]::bigint[]"
    return f"""
with own as (select conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) order by turn nulls first) as t
  from conversations where conv_id is not null group by conv_id),
h as (select *, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(length(conv_id::varchar)), lambda i: ascii(substr(conv_id::varchar, i + 1, 1))::bigint)),
  lambda acc, b: xor(acc >> 8, ({table})[xor(acc & 255, b) + 1])), 4294967295::bigint) % 9 as h from own),
r as (select h.conv_id, list_concat(coalesce(b.t[1:h.h], []), h.t[h.h + 1:]) as t from h left join own b on b.conv_id = h.conv_id - h.conv_id % 5),
m as (select conv_id, d, md5(to_json(t[1:d])::varchar) || d as k, case when d > 0 then md5(to_json(t[1:d - 1])::varchar) || (d - 1) end as pk,
  case when d > 0 then strlen(t[d].text) else 0 end as bytes, d = len(t) as ends
  from (select conv_id, t, unnest(range(0, len(t) + 1)) as d from r) x),
n as (select k, any_value(d) as depth, any_value(pk) as pk, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256 from m group by k),
c as (select pk, count(*) as n_children from n where pk is not null group by pk),
a as (select distinct x.k as top, y.k from m x join m y on x.conv_id = y.conv_id and x.d <= y.d),
s as (select a.top, count(*) filter (c.pk is null) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens from a join n using (k) left join c on c.pk = n.k group by a.top)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from n join s on s.top = n.k left join c on c.pk = n.k left join n p on p.k = n.pk"""
