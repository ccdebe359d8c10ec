"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = "regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')"


def _quality() -> str:
    words, lines = "greatest(n_words, 1)", "greatest(n_lines, 1)"
    value = {
        "symbols": f"1000.0::double * n_symbols / {words}", "dup_lines": f"1000.0::double * n_dup_lines / {lines}",
        "repeats": f"1000000.0::double * n_repeat_words / greatest(n_words * n_words, 1)", "word_length": f"100.0::double * word_chars / {words}",
    }
    error = {
        "symbols": f"1000.0::double * sqrt(symbol_squares) / {words}", "dup_lines": f"1000.0::double * sqrt(n_dup_lines) / {lines}",
        "repeats": f"1000000.0::double * sqrt(repeat_squares) / greatest(n_words * n_words, 1)",
        "word_length": f"100.0::double * sqrt(greatest(0, word_squares / {words} - (word_chars / {words}) * (word_chars / {words})) / {words})",
    }
    width = lambda v: f"(1::bigint << greatest(0, length(bin({v})) - 8)::bigint)"
    each = " union all ".join(f"select lang, source, '{m}' as measure, floor({x})::bigint as v from measured where not base_failed" for m, x in value.items())

    def level(name: str, by: str) -> str:
        """Quantiles of a sketch: the lowest bin up to which a share of the documents lies, and how far into it."""
        keys = f"{by}measure"
        first = lambda q, c: f"arg_min({c}, bin) filter (upto >= ({q} - 1e-9::double) * docs)"
        into = lambda q: f"{first(q, 'bin')} + {width(first(q, 'bin'))} * ({q}::double * max(docs) - ({first(q, 'upto')} - {first(q, 'n')})) / {first(q, 'n')}"
        return f"""{name} as (select {keys}, max(docs) as docs, {into('0.25')} as q25, {into('0.75')} as q75 from
 (select *, (sum(n) over (partition by {keys} order by bin))::bigint as upto, (sum(n) over (partition by {keys}))::bigint as docs from (select {keys}, bin, sum(n)::bigint as n from sketch group by all)) group by {keys.rstrip(', ')})"""

    pulled = lambda q, a, b: f"({a}.docs * {a}.{q} + 100.0::double * {b}.{q}) / ({a}.docs + 100.0::double) as {q}"
    tops = ", ".join([*(f"max(q75 + 3.0::double * (q75 - q25)) filter (measure = '{m}') as max_{m}" for m in value), "max(q25 - 3.0::double * (q75 - q25)) filter (measure = 'word_length') as min_word_length"])
    within = " and ".join([*(f"{value[m]} - 3.0::double * ({error[m]}) <= max_{m}" for m in value), f"{value['word_length']} + 3.0::double * ({error['word_length']}) >= min_word_length"])
    squares = lambda parts: f"coalesce(list_sum(list_transform({parts}, lambda x: length(x) * length(x))), 0)::bigint"
    return f"""with d as (select row_number() over () as rn, doc_id, lang, source, coalesce(text, '') as text, {WORDS} as w from documents),
windows as (select rn, i, count(*) over (partition by rn, a, b, c) as times from (select rn, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from (select rn, w, unnest(range(1, len(w) - 1)) as i from d))),
covered as (select distinct rn, i + k as i from windows, (select unnest([0, 1, 2]) as k) where times > 1),
runs as (select rn, count(*) as n from (select rn, i - row_number() over (partition by rn order by i) as run from covered) group by rn, run),
repeated as (select rn, sum(n)::bigint as n_repeat_words, sum(n * n)::bigint as repeat_squares from runs group by rn),
lines as (select rn, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) as l, regexp_extract_all(text, '[#*$%&|<>]+') as s from d),
counted as (select d.rn, doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, {squares('w')} as word_squares, coalesce(list_sum(list_transform(s, lambda x: length(x))), 0)::bigint as n_symbols, {squares('s')} as symbol_squares,
  len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(repeat_squares, 0)::bigint as repeat_squares from d join lines using (rn) left join repeated using (rn)),
measured as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted),
sketch as (select lang, source, measure, v - v % {width('v')} as bin, count(*) as n from ({each}) group by all),
{level('fine', 'lang, source, ')}, {level('mid', 'lang, ')}, {level('top_', '')},
langs as (select m.lang, m.measure, {pulled('q25', 'm', 't')}, {pulled('q75', 'm', 't')} from mid m join top_ t using (measure)),
groups_ as (select f.lang, f.source, f.measure, {pulled('q25', 'f', 'l')}, {pulled('q75', 'f', 'l')} from fine f join langs l on f.lang is not distinct from l.lang and f.measure = l.measure),
limits as (select lang, source, {tops} from groups_ group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce({within}, false) as kept from measured b left join limits l on b.lang is not distinct from l.lang and b.source is not distinct from l.source"""


def _chat() -> str:
    extra = lambda x: f"(length(regexp_replace({x}, '[^\\\\]', '', 'g')) + len(regexp_extract_all({x}, '</?s>|\\[/?INST\\]')) + len(regexp_extract_all({x}, '</?SYS>>')) + len(regexp_extract_all({x}, '<</?SYS>>')))"
    order = "order by turn nulls first, role, text"
    return f"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, i, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(i, r)),
x as (select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) as turns_sha256, coalesce(string_agg(text, '' {order}) filter (role = 'assistant'), '') as loss,
  (3 + sum(17 + length(role) + length(text) + {extra('role')} + {extra('text')}))::bigint as formatted_chars, count(*) filter (role = 'assistant') as n_examples from c group by conv_id)
select conv_id, n_turns, turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, formatted_chars, n_examples from x"""


WARC = """with p as (select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
g as (select h, max(page_id) as first from p group by h)
select p.page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substring(p.h, (5 * (k // 4) + 1)::int, 5))::int >> (15 - 5 * (k % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest,
  case when p.page_id = g.first then 'response' else 'revisit' end as record_type, case when p.page_id <> g.first then g.first end as refers_to,
  replace(replace(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), chr(9), '%09'), ' ', '%20') as url
from p join g using (h)"""

SUBSTRING = f"""with d as (select row_number() over () as rn, doc_id, {WORDS} as w from documents),
windows as (select rn, i, count(*) over (partition by s) as times from (select rn, i, array_to_string(w[i:i + 34], ' ') as s from (select rn, w, unnest(range(1, len(w) - 33)) as i from d))),
gone as (select distinct rn, i + k as i from windows, (select unnest(range(35)) as k) where times > 1),
kept as (select x.rn, string_agg(x.word, ' ' order by x.i) as text, count(*) as n from (select rn, i, w[i] as word from (select rn, w, unnest(range(1, len(w) + 1)) as i from d)) x left join gone g on g.rn = x.rn and g.i = x.i where g.i is null group by x.rn)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256 from d left join kept using (rn)"""

VECTORS = """with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and len(embedding) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
n as (select a, count(*) as n from links group by a), c as (select a, min(b) as component_id from reach group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from embeddings left join n on n.a = vec_id join c on c.a = vec_id"""

SQL = {"op2_warc": WARC, "op3_chat_formatting": _chat(), "op4_substring_dedup": SUBSTRING, "op9_embedding_dedup": VECTORS, "op10_quality_rules": _quality()}
