"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from marquee.llm.chat_format import CONTROL, END, ENTITIES, START
from marquee.llm.line_dedup import MIN_SITES, MIN_WORDS
from marquee.llm.quality_rules import HOST_LIMIT, MAX_DUP_LINE_RATIO, MAX_SYMBOL_RATIO, RULES
from marquee.llm.queries import JUNK_LEAST, JUNK_RUNS, URL_RULES
from marquee.llm.url_filter import MIRRORS, TRACKING, rule_order

_WORD = r"[^\x20\x09-\x0D]+"


def _rates() -> str:
    out = []
    for r in RULES:
        strength = (f"case when {r}_var > 0 then greatest(1.0, least(1e6, {r}_mu * (1 - {r}_mu) / {r}_var - 1)) "
                    "else 1e6 end")
        out.append(f"(f_{r} + {strength} * {r}_mu) / (n + {strength}) > {HOST_LIMIT}")
    return " or ".join(out)


OP7 = rf"""
with w as materialized (
  select doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents),
texts as materialized (select row_number() over () as rid, t, words from (select distinct t, words from w)),
g3 as (select rid, k, words[k] || chr(10) || words[k+1] || chr(10) || words[k+2] as g
       from (select rid, words, unnest(range(1, len(words) - 1)) as k from texts)),
twice as (select rid, k from (select rid, k, count(*) over (partition by rid, g) as c from g3) where c > 1),
cov as (select rid, count(distinct k + d) as n_repeat_words from twice, (values (0), (1), (2)) x(d) group by rid),
m as materialized (
  select w.doc_id, w.source, len(w.words)::bigint as n_words,
    coalesce(list_sum(list_transform(w.words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    list_filter(string_split(w.t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls,
    coalesce(cov.n_repeat_words, 0)::bigint as n_repeat_words
  from w join texts on texts.t = w.t left join cov on cov.rid = texts.rid),
f as materialized (
  select *, len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines from m),
r as materialized (
  select *, n_words < 50 as few_words, 100 * n_repeat_words > 50 * n_words as repeats,
    n_symbols > n_words * {MAX_SYMBOL_RATIO}::double as symbols,
    n_dup_lines > n_lines * {MAX_DUP_LINE_RATIO}::double as dup_lines from f),
hosts as (select source as host, count(*) as n, {", ".join(f"sum({r}::int)::double as f_{r}" for r in RULES)}
          from r where source is not null group by 1),
prior as (select {", ".join(f"sum(f_{r}) / sum(n) as {r}_mu, var_pop(f_{r} / n) as {r}_var" for r in RULES)} from hosts),
bad as (select host from hosts, prior where {_rates()})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words or repeats as base_failed,
  not (few_words or repeats) and not symbols and host is null as kept
from r left join bad on r.source = bad.host
"""


def _escaped(x: str) -> str:
    out = f"replace({x}, '&', '&amp;')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{ENTITIES[c[0]] + c[1:]}')"
    return out


OP9 = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g as (
  select conv_id, count(*)::bigint as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as loss,
    sum({len(START) + 1 + len(END) + 1} + length(replace({_escaped('role')}, chr(10), '&nl;')) + length({_escaped('text')}))::bigint
      as formatted_chars
  from t group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss)::bigint as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars from g
"""

_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

OP8 = rf"""
with ls as (
  select doc_id, source, string_split(text, chr(10)) as l from documents),
ln as materialized (
  select doc_id, source, pos, trim(l[pos], {_BLANKS}) as line from (select *, unnest(range(1, len(l) + 1)) as pos from ls)),
ok as (select * from ln where len(regexp_extract_all(line, '{_WORD}')) >= {MIN_WORDS}),
spread as (select line, arg_min(pos, (doc_id, pos)) as pos1, min(doc_id) as doc1 from ok
           group by line having count(distinct source) >= {MIN_SITES}),
gone as (select ok.doc_id, ok.pos from ok join spread using (line) where not (ok.doc_id = doc1 and ok.pos = pos1)),
kept as (
  select doc_id, string_agg(l1, chr(10) order by pos) as t, count(*)::bigint as n
  from (select x.doc_id, x.pos, x.l[x.pos] as l1
        from (select doc_id, l, unnest(range(1, len(l) + 1)) as pos from ls) x
        left join gone on x.doc_id = gone.doc_id and x.pos = gone.pos where gone.pos is null) group by doc_id),
cnt as (select doc_id, count(*)::bigint as n_removed from gone group by doc_id)
select ls.doc_id, case when ls.l is null then null else coalesce(kept.n, 1) end as n_lines,
  coalesce(n_removed, 0) as n_removed, case when ls.l is null then null else sha256(coalesce(kept.t, '')) end as kept_sha256
from ls left join kept on ls.doc_id = kept.doc_id left join cnt on ls.doc_id = cnt.doc_id
"""

_TRACKS = " or ".join(f"starts_with(split_part(q, '=', 1), '{t[:-1]}')" if t.endswith("*") else f"split_part(q, '=', 1) = '{t}'"
                      for t in TRACKING)


def _case(value: int) -> str:
    return "case " + " ".join(
        f"when (host = '{r[1]}' or ends_with(host, '.{r[1]}')) and starts_with(path, '{r[2]}') then '{r[value]}'"
        for r in rule_order(URL_RULES)) + " end"


OP11 = rf"""
with a as (select page_id, html, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, html,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
      lambda q: not (q = '' or {_TRACKS}))), '&') as query from a),
c as materialized (
  select page_id, html, host, path, {_case(0)} as rule, {_case(3)} as says,
    case when host <> '' then
      regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^({"|".join(m.replace(".", "[.]") for m in MIRRORS)})', '')
      || regexp_replace(regexp_replace(regexp_replace(path, '/index[.]html$', '/'), '[.]html$', ''), '/+$', '')
      || case when query <> '' then '?' || query else '' end end as canonical from p),
bad as (select distinct canonical from c where canonical is not null and len(regexp_extract_all(html, '{JUNK_RUNS}')) >= {JUNK_LEAST})
select page_id, host, path, rule, coalesce(says, case when b.canonical is not null then 'block' else 'allow' end) as verdict,
  c.canonical, rule is null and b.canonical is not null as listed
from c left join bad b on c.canonical = b.canonical
"""

def _leaf(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(
        f"case when {c} is null then '-' else concat(strlen({c}::varchar), ':', {c}::varchar) end"
        for c in ("doc_id", "source", "lang", n_chars, "text")) + "))"


# crc32 bit by bit: 0xEDB88320 is its reversed polynomial
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))),
  lambda a, b: case when xor(a, b) & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295::bigint)"""

OP12 = f"""
with recursive d as materialized (
  select lang, doc_id, {_leaf("n_chars")} as leaf,
    case when {_CRC} % 7 = 0 then {_leaf("(n_chars::hugeint + 1)")} else {_leaf("n_chars")} end as claimed from documents),
l as materialized (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n from d),
t as (
  select 0 as lv, lang, idx, leaf as h, n as w from l
  union all
  select lv + 1, lang, idx // 2, sha256(string_agg(h, '' order by idx)), any_value((w + 1) // 2) from t where w > 1 group by lv, lang, idx // 2),
subs as materialized (
  select lang, h as subroot, lv as top, row_number() over (order by encode(lang) nulls first) - 1 as place, count(*) over () as n
  from t where w = 1),
u as (
  select 0 as lv, place as idx, subroot as h, n as w from subs
  union all
  select lv + 1, idx // 2, sha256(string_agg(h, '' order by idx)), any_value((w + 1) // 2) from u where w > 1 group by lv, idx // 2),
p as (
  select l.doc_id, l.lang, l.idx as seat, l.claimed, l.leaf, 0 as lv, l.idx, l.claimed as h, '' as proof, subs.top, subs.subroot, subs.place
  from l join subs on l.lang is not distinct from subs.lang
  union all
  select p.doc_id, p.lang, p.seat, p.claimed, p.leaf, p.lv + 1, p.idx // 2,
    sha256(case when p.idx % 2 = 1 then concat(s.h, p.h) else concat(p.h, s.h) end), concat(p.proof, s.h), p.top, p.subroot, p.place
  from p left join t s on s.lang is not distinct from p.lang and s.lv = p.lv and s.idx = xor(p.idx, 1) where p.lv < p.top),
q as (
  select doc_id, lang, seat, leaf, subroot, 0 as lv, place as idx, h, proof from p where lv = top
  union all
  select q.doc_id, q.lang, q.seat, q.leaf, q.subroot, q.lv + 1, q.idx // 2,
    sha256(case when q.idx % 2 = 1 then concat(s.h, q.h) else concat(q.h, s.h) end), concat(q.proof, s.h)
  from q left join u s on s.lv = q.lv and s.idx = xor(q.idx, 1) where q.lv < (select max(lv) from u))
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, q.h as folded_root, q.h = root as verified
from q, (select h as root, lv as peak from u where w = 1) r where q.lv = r.peak
"""

OP13 = """
with r as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.q, c.q)::bigint as score
  from r a join r c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id),
pos as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over w::int as rank, s.vec_id as negative_id, positive_score, s.score as negative_score
from pos join s using (anchor_id)
where not same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by s.score desc, s.vec_id) qualify row_number() over w <= 3
"""

ORACLE = {"op12_merkle_manifest": OP12, "op13_hard_negatives": OP13, "op11_url_filter": OP11, "op7_quality_rules": OP7, "op8_line_dedup": OP8, "op9_chat_format": OP9}
