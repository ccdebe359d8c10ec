"""Registered queries of the graph operators, and the same in SQL.

Queries run over whole tables.  The SQL is a chain of common table
expressions; each query selects from the ones it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import replies
from .functions import text as T
from .operators import chunking, completion, evaluation, extraction, graph, resolution, validation
from .plans import asking, graph_plan
from .sources import documents
from .sources.shared import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def rx(x: str, pattern: str, by: str = "") -> str:
    pattern = pattern.replace("'", "''")
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def sql_strip(x: str) -> str:
    return rx(x, f"^{S}+|{S}+$")


def sql_entity(x: str) -> str:
    return sql_strip(rx(rx(rx(f"lower({sql_strip(x)})", "\u00ad"), f"{S}+", " "), "[“”\"']"))


def sql_eval(x: str) -> str:
    return rx(rx(rx(f"lower({sql_strip(x)})", "\u00ad"), f"{S}+", " "), "[“”\"'`]")


def sql_match(x: str) -> str:
    return sql_strip(rx(x, f"{S}+", " "))


def sql_folded(x: str) -> str:
    return f"replace(lower({sql_match(x)}), 'ß', 'ss')"


def sql_slug(x: str) -> str:
    kept = rx(rx(rx(rx(rx(f"lower({sql_strip(x)})", f"{S}+", " "), "[^a-z0-9 _.-]"), " ", "_"), "_+", "_"), "^_+|_+$")
    return f"coalesce(nullif({kept}, ''), 'x')"


def sql_rel_type(x: str) -> str:
    kept = rx(rx(rx(f"upper({sql_strip(x)})", "[^A-Z0-9_]", "_"), "_+", "_"), "^_+|_+$")
    return f"(case when {kept} = '' then 'REL' when regexp_matches({kept}, '^[0-9]') then 'R_' || {kept} else {kept} end)"


def sql_file(x: str) -> str:
    return f"coalesce(nullif(substring({rx(rx(rx(rx(sql_strip(x), f'{S}+', ' '), '[^A-Za-z0-9 _.-]', '_'), ' ', '_'), '_+', '_')}, 1, 120), ''), 'doc')"


DOCS = f"docs as (select * from (select doc_id as base, {sql_strip(rx('text', chr(13) + chr(10) + '?', chr(10)))} as text from documents) where length(text) > 0)"
CHUNKS = f"""chunks as (select base, i::int as chunk_id, (i * 3700)::int as char_start, least(length(text), i * 3700 + 4000)::int as char_end,
  {sql_strip("substring(text, (i * 3700 + 1)::int, (least(length(text), i * 3700 + 4000) - i * 3700)::int)")} as text
  from (select base, text, unnest(range(case when length(text) <= 4000 then 1 else 1 + ceil((length(text) - 4000) / 3700.0)::bigint end)) as i from docs))"""
MENTIONS = """found as (select base, chunk_id, regexp_extract_all(text, '[A-Z][a-z]{4,}') as m from chunks),
spots as (select base, chunk_id, m, unnest(range(len(m))) as i from found),
mentions as (select base, chunk_id as row_pos, i::int as ent_pos, 'e' || i as id, ['Person', 'Group', 'Place', 'Other'][length(m[i + 1]) % 4 + 1] as type, m[i + 1] as name, '{"length": ' || length(m[i + 1]) || '}' as attributes, m[i + 1] as evidence from spots),
pairs as (select base, chunk_id as row_pos, i::int as rel_pos, 'e' || i as source_id, ['knows', 'located in', 'unlisted'][(length(m[i + 1]) + length(m[i + 2])) % 3 + 1] as type, 'e' || (i + 1) as target_id, case (length(m[i + 1]) + length(m[i + 2])) % 3 when 0 then m[i + 1] else m[i + 1] || ' ' || m[i + 2] end as evidence from spots where i + 2 <= len(m))"""
KEPT = """ents as (select * from mentions where type in ('Person', 'Group', 'Place')),
rels as (select p.* from pairs p where type in ('knows', 'located in')
  and exists (select 1 from ents e where e.base = p.base and e.row_pos = p.row_pos and e.id = p.source_id)
  and exists (select 1 from ents e where e.base = p.base and e.row_pos = p.row_pos and e.id = p.target_id))"""
RESOLVED = f"""normed as (select *, {sql_entity("name")} as norm, row_pos * 1000000::bigint + ent_pos as ord from ents),
firsts as (select base, type, norm, type || ':' || {sql_slug("arg_min(name, ord)")} as global_id from normed group by base, type, norm),
filed as (select n.*, f.global_id from normed n join firsts f using (base, type, norm)),
entities as (select base, global_id, type, norm, arg_max(name, length(name) * 1000000000000::bigint - ord) as name, arg_min(attributes, ord) as attributes, count(*) as mention_count, min(ord) as first_ord from filed group by base, global_id, type, norm),
ends as (select base, row_pos, id, arg_max(global_id, ent_pos) as gid from filed group by base, row_pos, id),
located as (select r.base, r.row_pos, r.rel_pos, s.gid as source, r.type, t.gid as target, r.evidence from rels r join ends s on (s.base, s.row_pos, s.id) = (r.base, r.row_pos, r.source_id) join ends t on (t.base, t.row_pos, t.id) = (r.base, r.row_pos, r.target_id)),
relations as (select base, source, type, target, list({{'chunk_id': row_pos, 'evidence': evidence}} order by row_pos, rel_pos) as provenance, min(row_pos * 1000000::bigint + rel_pos) as first_ord from located group by base, source, type, target)"""
CHECKED = f"""statuses as (select l.*, row_number() over (partition by l.base, source, type, target order by row_pos, rel_pos) - 1 as prov_pos,
  case when c.text is null or {sql_folded("l.evidence")} = '' then 'UNKNOWN' when contains({sql_folded("c.text")}, {sql_folded("l.evidence")}) then 'SUPPORTED' else 'UNSUPPORTED' end as support_status
  from located l left join chunks c on c.base = l.base and c.chunk_id = l.row_pos),
validated as (select base, source, type, target, count(*) filter (support_status = 'SUPPORTED') as supported, count(*) filter (support_status = 'UNSUPPORTED') as unsupported, count(*) filter (support_status = 'UNKNOWN') as unknown,
  round(count(*) filter (support_status = 'SUPPORTED') / greatest(1, count(*))::double, 4) as support_ratio, min(row_pos * 1000000::bigint + rel_pos) as first_ord, count(*) as provenance_count, list(evidence order by row_pos, rel_pos) as all_evidence from statuses group by base, source, type, target)"""
GRAPH = f"""nodes as (select global_id, arg_max(type, o) as type, arg_max(name, o) as name, arg_max(attributes, o) as attributes_json, arg_max(mention_count, o) as mention_count from (select *, (base * 1000000000000::hugeint + first_ord) as o from entities) group by global_id),
passing as (select *, support_ratio >= 0.6 or supported > 0 as passes, supported > 0 as is_supported, {sql_rel_type("type")} as rel_type, base * 1000000000000::hugeint + first_ord as o from validated),
last_edges as (select source as src, rel_type, target as dst, arg_max(type, (o, type)) as type, arg_max(support_ratio, (o, type)) as support_ratio, arg_max(is_supported, (o, type)) as supported, array_to_string(arg_max(all_evidence[1:5], (o, type)), '|') as evidence_samples, arg_max(provenance_count, (o, type)) as provenance_count from passing where passes group by 1, 2, 3),
first_edges as (select source as src, rel_type, target as dst, arg_min(type, (o, type)) as type, arg_min(support_ratio, (o, type)) as support_ratio, arg_min(is_supported, (o, type)) as supported, array_to_string(arg_min(all_evidence[1:5], (o, type)), '|') as evidence_samples, arg_min(provenance_count, (o, type)) as provenance_count from passing where passes group by 1, 2, 3)"""
CHAIN = ["", DOCS, CHUNKS, MENTIONS, KEPT, RESOLVED, CHECKED, GRAPH]


def chain(upto: int, select: str) -> str:
    return f"with {', '.join(CHAIN[1 : upto + 1])} {select}"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("base"), "text")


def spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with blank lines between lines."""
    return docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))


def plan(spark: SparkSession, sf_dir: str) -> graph_plan.Graph:
    """The plan with exact resolution, which SQL can follow."""
    return graph_plan.build(docs(spark, sf_dir), fuzzy=False)


@query(f"select doc_id, {sql_strip(rx('text', chr(13) + chr(10) + '?', chr(10)))} as text from documents")
def norm_newlines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.newlines(F.col("text")).alias("text"))


@query(f"select doc_id, {sql_match('text')} as match_text, {sql_folded('text')} as folded from documents")
def norm_match(spark, sf_dir):
    m = T.match_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", m.alias("match_text"), T.folded(m).alias("folded"))


NAMES = "names as (select 'part' as kind, p_partkey as key, '  ' || p_name || ' \"' || p_brand || '\"' as name from part union all select 'customer', c_custkey, c_name || ' ''`x' from customer union all select 'page', page_id, url from pages)"


def names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"), F.concat(F.lit("  "), "p_name", F.lit(' "'), "p_brand", F.lit('"')).alias("name"))
    customer = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.concat("c_name", F.lit(" '`x")).alias("name"))
    return part.unionByName(customer).unionByName(table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("key"), F.col("url").alias("name")))


def named(name: str, sql: Callable[[str], str], column: Callable) -> None:
    def run(spark, sf_dir):
        return names(spark, sf_dir).select("kind", "key", column(F.col("name")).alias("value"))

    run.__name__ = name
    query(f"with {NAMES} select kind, key, {sql('name')} as value from names")(run)


named("norm_entity_name", sql_entity, T.entity_name)
named("norm_eval_name", sql_eval, T.eval_name)
named("slug", sql_slug, T.slug)
named("rel_type_sanitize", sql_rel_type, T.relation_type)
named("safe_filename", sql_file, T.file_name)
named("doc_id_prefix", lambda x: f"split_part({x}, '.', 1)", T.before_dot)
named("file_stem", lambda x: f"replace({sql_strip(rx(x, '[^\\p{L}\\p{N}\\-_. ]', '_'))}, '  ', ' ')", T.file_stem)
named("domain_name", lambda x: rx(x, "[^\\p{L}\\p{N}_-]", "_"), T.domain_name)


@query(f"select doc_id, substring({sql_strip(rx('text', chr(10), ' '))}, 1, 160) as preview, case when contains(text, chr(10)) then length(text) - strpos(reverse(text), chr(10)) else -1 end::int as last_line, strpos(text, 'er')::int - 1 as first_er, substring(text, 11, 20) as part from documents")
def text_places(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.preview(t, 160).alias("preview"), T.last_place(t, "\n").alias("last_line"), T.place_from(F.lit("er"), t, F.lit(0)).alias("first_er"), T.part(t, F.lit(10), F.lit(30)).alias("part"))


@query("select doc_id, sha256(text) as sha256 from documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


@query(chain(2, "select base, chunk_id, char_start, char_end, text from chunks"))
def rule_chunks_closed_form(spark, sf_dir):
    return chunking.rule_chunks(chunking.clean(docs(spark, sf_dir))).select("base", "chunk_id", "char_start", "char_end", "text")


def recursive(size: int, overlap: int, source: str) -> str:
    """Spans of rows (base, text, lo, hi) of a source, one step at a time."""

    def cut(lo: str) -> str:
        end = f"least({lo} + {size}, hi)"
        window = f"substring(text, (greatest({lo}, {end} - 800) + 1)::int, ({end} - greatest({lo}, {end} - 800))::int)"
        mark = f"(greatest({lo}, {end} - 800) + length({window}) - strpos(reverse({window}), chr(10) || chr(10)) - 1)"
        return f"(case when strpos(reverse({window}), chr(10) || chr(10)) > 0 and {mark} > {lo} + 200 then {mark} else {end} end)::bigint"

    after = f"(case when e - {overlap} > s then e - {overlap} else e end)"
    return f"spans as (select base, text, hi, 0::bigint as i, lo::bigint as s, {cut('lo')} as e from {source} where hi > lo union all select base, text, hi, i + 1, {after}, {cut(after)} from spans where e < hi)"


@query(f"with recursive src as (select doc_id as base, replace(text, chr(10), chr(10) || chr(10)) as text, 0 as lo, length(replace(text, chr(10), chr(10) || chr(10))) as hi from documents), {recursive(1000, 100, 'src')} select base, i::int as chunk_id, s::int as char_start, e::int as char_end, {sql_strip('substring(text, (s + 1)::int, (e - s)::int)')} as text from spans")
def rule_chunks_para(spark, sf_dir):
    return chunking.rule_chunks(spaced(spark, sf_dir), 1000, 100).select("base", "chunk_id", "char_start", "char_end", "text")


@query("select doc_id, greatest(1, ceil(length(text) / 3700.0))::bigint as expected from documents")
def chunk_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", chunking.expected_chunks(F.length("text"), 4000, 300).alias("expected"))


PARAS = f"""lines as (select doc_id as base, replace(text, chr(10), chr(10) || chr(10)) as text, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) as l from documents),
placed as (select base, k, l[k] as raw, {sql_strip("l[k]")} as t, (coalesce(list_sum(list_transform(l[1:k-1], lambda x: length(x) + 2)), 0))::bigint as here from (select base, l, unnest(range(1, len(l) + 1)) as k from lines)),
paras as (select base, (row_number() over (partition by base order by k) - 1)::int as idx, (here + length(raw) - length({rx("raw", f"^{S}+")}))::int as char_start, (here + length(raw) - length({rx("raw", f"^{S}+")}) + length(t))::int as char_end, t as text from placed where t <> '')"""


@query(f"with {PARAS} select base, idx, char_start, char_end, text from paras")
def paragraphs(spark, sf_dir):
    return chunking.paragraphs(spaced(spark, sf_dir))


def fixed_segments(spark, sf_dir):
    """Segments of five paragraphs; those of some numbers of paragraphs leave a gap, as a reply may."""
    p = chunking.paragraphs(spaced(spark, sf_dir)).groupBy("base").agg(F.count("*").cast("int").alias("n"))
    x = p.select("base", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / 5).cast("int") - 1)).alias("segment_id"))
    return x.select("base", "n", "segment_id", (5 * F.col("segment_id") + F.when((F.col("n") % 7 == 0) & (F.col("segment_id") == 1), 1).otherwise(0)).alias("para_start"), F.least(F.col("n"), 5 * F.col("segment_id") + 5).alias("para_end"), F.concat(F.lit("t"), "segment_id").alias("topic"))


SEGMENTS = f"{PARAS}, sizes as (select base, count(*)::int as n from paras group by base), segs as (select base, n, k::int as segment_id, (5 * k + case when n % 7 = 0 and k = 1 then 1 else 0 end)::int as para_start, least(n, 5 * k + 5)::int as para_end from (select base, n, unnest(range(ceil(n / 5.0)::bigint)) as k from sizes)), valid as (select base, bool_and(para_start = before and para_end > para_start) and max(para_end) = any_value(n) as valid from (select *, coalesce(lag(para_end) over (partition by base order by para_start), 0) as before from segs) group by base)"


@query(f"with {SEGMENTS} select base, valid from valid")
def segment_cover_valid(spark, sf_dir):
    s = fixed_segments(spark, sf_dir)
    return chunking.segments_valid(s.select("base", F.col("para_start").alias("start"), F.col("para_end").alias("end")), s.select("base", F.col("n").alias("n_paragraphs")).distinct())


#: Segments of documents with a usable reply, and whole texts of all others as segment 99999.
ROUTED = f"""{SEGMENTS}, ok as (select v.base from valid v join sizes z using (base) where v.valid and z.n <= 120),
src as (select s.base * 100000::bigint + s.segment_id as base, l.text as text, a.char_start as lo, b.char_end as hi from segs s join ok on ok.base = s.base join lines l on l.base = s.base join paras a on a.base = s.base and a.idx = s.para_start join paras b on b.base = s.base and b.idx = s.para_end - 1
  union all select base * 100000::bigint + 99999, text, 0, length(text) from lines where base not in (select base from ok))"""


@query(f"""with recursive {ROUTED}, {recursive(400, 50, 'src')}
select base // 100000 as base, (row_number() over (partition by base // 100000 order by base % 100000, i) - 1)::int as chunk_id, case when base % 100000 < 99999 then (base % 100000)::int end as segment_id, s::int as char_start, e::int as char_end, {sql_strip('substring(text, (s + 1)::int, (e - s)::int)')} as text, case when base % 100000 < 99999 then 'llm' else 'llm_fallback_rule' end as variant from spans""")
def hybrid_chunks(spark, sf_dir):
    """Chunks by segments where the segments are valid and paragraphs are not too many, by rule everywhere else."""
    d, s = spaced(spark, sf_dir), fixed_segments(spark, sf_dir)
    return chunking.routed(d, s.drop("n"), size=400, overlap=50).select("base", "chunk_id", "segment_id", "char_start", "char_end", "text", "variant")


@query(f"select doc_id as base, substring({sql_strip('text')}, 1, 12000) as text from documents order by doc_id limit 3")
def doc_sample(spark, sf_dir):
    return documents.sample(docs(spark, sf_dir), 3, 12000)


@query(f"select conv_id as base, {sql_strip('coalesce(string_agg(text, chr(10) || chr(10) order by turn) filter (turn < 5 and length({}) >= 100), {})'.format(sql_strip('text'), chr(39) * 2))} as text, count(*) as pages_total, count(*) filter (turn < 5 and length({sql_strip('text')}) >= 100) as pages_used from conversations group by conv_id")
def page_concat(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("base"), F.col("turn").alias("page_no"), "text")
    return documents.page_texts(pages, 5, 100)


@query(chain(3, "select base, row_pos, ent_pos, id, type, name, evidence from mentions"))
def mentions(spark, sf_dir):
    chunks = chunking.rule_chunks(chunking.clean(docs(spark, sf_dir)))
    return extraction.entities(extraction.mentions_by_rule(chunks)).select("base", "row_pos", "ent_pos", "id", "type", "name", "evidence")


@query(f"select distinct {sql_strip('p_brand')} as name from part where {sql_strip('p_brand')} <> ''")
def allowed_types(spark, sf_dir):
    return extraction.allowed_types(table(spark, sf_dir, "part").select(F.concat(F.lit(" "), "p_brand", F.lit("\t")).alias("name")))


@query(chain(4, "select base, row_pos, id, type, name, attributes from ents"))
def schema_filter_entities(spark, sf_dir):
    return extraction.entities(plan(spark, sf_dir).extractions).select("base", "row_pos", "id", "type", "name", "attributes")


@query(chain(4, "select base, row_pos, source_id, type, target_id, evidence from rels"))
def schema_filter_relations(spark, sf_dir):
    return extraction.relations(plan(spark, sf_dir).extractions).select("base", "row_pos", "source_id", "type", "target_id", "evidence")


@query(chain(2, "select base, chunk_id from chunks where chunk_id < 2"))
def extract_limit(spark, sf_dir):
    return extraction.first_rows(chunking.rule_chunks(chunking.clean(docs(spark, sf_dir))), 2, "chunk_id").select("base", "chunk_id")


@query(chain(5, "select base, global_id, type, name, attributes, mention_count from entities"))
def resolve_exact_entities(spark, sf_dir):
    return plan(spark, sf_dir).entities.select("base", "global_id", "type", "name", "attributes", F.size("mentions").cast("long").alias("mention_count"))


@query(chain(5, "select base, source, type, target, len(provenance) as provenance_count, provenance[1].chunk_id as first_chunk, provenance[-1].evidence as last_evidence from relations"))
def resolve_relations(spark, sf_dir):
    r = plan(spark, sf_dir).relations
    return r.select("base", "source", "type", "target", F.size("provenance").cast("long").alias("provenance_count"), F.col("provenance")[0]["chunk_id"].alias("first_chunk"), F.element_at("provenance", -1)["evidence_relation"].alias("last_evidence"))


def as_mentions(names: DataFrame) -> DataFrame:
    """Mentions of one type from rows (base, row_pos, name)."""
    return names.select("base", "row_pos", F.lit(0).alias("ent_pos"), F.col("row_pos").alias("chunk_id"), F.lit("e0").alias("id"), F.lit("Thing").alias("type"), "name", F.lit("{}").alias("attributes"), F.col("name").alias("evidence"))


@query()
def resolve_fuzzy(spark, sf_dir):
    """Customers and parts as mentions: names that differ little become one entity."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("base"), F.col("c_custkey").cast("int").alias("row_pos"), F.col("c_name").alias("name"))
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_size").cast("string")).alias("base"), F.col("p_partkey").cast("int").alias("row_pos"), F.col("p_name").alias("name"))
    x = resolution.resolved(resolution.fuzzy(as_mentions(c.unionByName(p))))
    return x.groupBy("base", "type", "leader", "global_id").agg(F.count("*").alias("mention_count"), resolution.best_name(F.col("name"), F.col("ord")).alias("name"))


def planted_name(key: str) -> str:
    """Names of 33 characters; those of six neighbouring keys differ in the last one only, any others nearly everywhere."""
    return f"md5(cast(floor({key} / 6) as string)) || substr('abc', cast({key} % 3 as int) + 1, 1)"


PLANTED = "mentions_ as (select 'c' || c_nationkey as base, c_custkey as key, md5((c_custkey // 6)::varchar) || substr('abc', (c_custkey % 3)::int + 1, 1) as name from customer union all select 'p' || p_size, p_partkey, md5((p_partkey // 6)::varchar) || substr('abc', (p_partkey % 3)::int + 1, 1) from part)"


@query(f"with {PLANTED} select base, min_by(name, key) as leader, 'Thing:' || min_by(name, key) as global_id, count(*) as mention_count, min_by(name, key) as name from mentions_ group by base, substr(name, 1, 32)")
def resolve_fuzzy_planted(spark, sf_dir):
    """Fuzzy resolution of names whose leaders are known from how they are made: the first of each group."""
    c = table(spark, sf_dir, "customer").select(F.expr("'c' || c_nationkey").alias("base"), F.col("c_custkey").cast("int").alias("row_pos"), F.expr(planted_name("c_custkey")).alias("name"))
    p = table(spark, sf_dir, "part").select(F.expr("'p' || p_size").alias("base"), F.col("p_partkey").cast("int").alias("row_pos"), F.expr(planted_name("p_partkey")).alias("name"))
    x = resolution.resolved(resolution.fuzzy(as_mentions(c.unionByName(p))))
    return x.groupBy("base", "leader", "global_id").agg(F.count("*").alias("mention_count"), resolution.best_name(F.col("name"), F.col("ord")).alias("name"))


STARS = "marks as (select o_custkey as grp, o_orderkey as ord, o_orderpriority as name, '{\"status\": \"' || case o_orderstatus when 'F' then '' else o_orderstatus end || '\", \"n\": ' || (o_orderkey % 3) || '}' as attributes from orders)"


def marks(spark, sf_dir):
    attributes = F.concat(F.lit('{"status": "'), F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")), F.lit('", "n": '), F.col("o_orderkey") % 3, F.lit("}"))
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("base"), F.lit("T").alias("type"), F.lit("x").alias("leader"), F.struct(F.col("o_orderkey").alias("row_pos"), F.lit(0).alias("ent_pos")).alias("ord"), F.col("o_orderpriority").alias("name"), attributes.alias("attributes"))


@query(f"with {STARS} select grp as base, arg_max(name, length(name) * 1000000000000 - ord) as name from marks group by grp")
def best_name(spark, sf_dir):
    return marks(spark, sf_dir).groupBy("base").agg(resolution.best_name(F.col("name"), F.col("ord")).alias("name"))


@query(f"with {STARS}, x as (select grp, arg_min(attributes->>'n', ord) as n, coalesce(arg_min(attributes->>'status', ord) filter (attributes->>'status' <> ''), '') as s from marks group by grp) select grp as base, '{{\"n\": ' || n || ', \"status\": \"' || s || '\"}}' as attributes from x")
def merge_attributes(spark, sf_dir):
    return resolution.merged_attributes(marks(spark, sf_dir)).select("base", "attributes")


@query("select o_custkey as base, (o_orderkey % 10)::int as chunk_id, arg_max(o_orderpriority, o_orderkey) as text from orders group by 1, 2")
def chunk_text_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("base"), (F.col("o_orderkey") % 10).cast("string").alias("chunk_id"), F.col("o_orderpriority").alias("text"), F.col("o_orderkey").alias("row_pos"))
    bad = o.withColumn("chunk_id", F.lit("none"))
    return validation.chunk_texts(o.unionByName(bad))


def checked(spark, sf_dir, **limits):
    g = plan(spark, sf_dir)
    return validation.statuses(g.relations, validation.chunk_texts(g.chunks.withColumn("row_pos", F.col("chunk_id"))), **limits)


@query(chain(6, "select base, source, type, target, prov_pos::int as prov_pos, evidence, support_status from statuses"))
def evidence_status(spark, sf_dir):
    return checked(spark, sf_dir).select("base", "source", "type", "target", "prov_pos", F.col("evidence_relation").alias("evidence"), "support_status")


@query(chain(6, "select base, source, type, target, supported, unsupported, unknown, support_ratio from validated"))
def support_ratio(spark, sf_dir):
    return plan(spark, sf_dir).validated.select("base", "source", "type", "target", "validation.*")


@query(chain(6, "select base, source, type, target, count(*) as entries from statuses where prov_pos < 1 group by all"))
def provenance_limit(spark, sf_dir):
    return checked(spark, sf_dir, max_provenances=1).groupBy("base", "source", "type", "target").agg(F.count("*").alias("entries"))


@query(chain(5, "select base, source, type, target from (select *, row_number() over (partition by base order by first_ord, source, type, target) as n from relations) where n <= 2"))
def relation_limit(spark, sf_dir):
    return checked(spark, sf_dir, max_relations=2).select("base", "source", "type", "target").distinct()


@query(chain(7, "select base, source, type, target, support_ratio, is_supported, passes from passing"))
def support_filter(spark, sf_dir):
    return graph.with_support(plan(spark, sf_dir).validated).select("base", "source", "type", "target", "support_ratio", "is_supported", "passes")


@query(chain(7, "select global_id, type, name, attributes_json, mention_count from nodes"))
def graph_nodes_upsert(spark, sf_dir):
    return plan(spark, sf_dir).nodes.select("global_id", "type", "name", "attributes_json", "mention_count")


def flat(edges: DataFrame) -> DataFrame:
    return edges.withColumn("evidence_samples", F.array_join("evidence_samples", "|"))


@query(chain(7, "select * from last_edges"))
def graph_edges_upsert_last(spark, sf_dir):
    return flat(plan(spark, sf_dir).edges)


@query(chain(7, "select * from first_edges"))
def graph_edges_upsert_first(spark, sf_dir):
    g = plan(spark, sf_dir)
    ids = g.checked and g.node_ids
    return flat(graph.edges(graph.with_support(g.validated), ids, overwrite=False))


#: A graph that lacks the nodes that were mentioned only once.
SOME = "picked as (select global_id from nodes where mention_count > 1)"


@query(chain(7, f", {SOME} select base, source, type, target from passing where source not in (select global_id from picked) or target not in (select global_id from picked)").replace(" , picked", ", picked"))
def graph_dangling(spark, sf_dir):
    g = plan(spark, sf_dir)
    return graph.dangling(g.relations.select("base", "source", "type", "target"), g.nodes.where("mention_count > 1"))


@query(chain(7, f", {SOME}, x as (select passes, source in (select global_id from picked) and target in (select global_id from picked) as ends_known from passing) select count(*) filter (passes and ends_known) as imported, count(*) filter (not passes) as skipped_support, count(*) filter (passes and not ends_known) as skipped_missing_nodes from x").replace(" , picked", ", picked"))
def graph_counters(spark, sf_dir):
    g = plan(spark, sf_dir)
    nodes = g.checked and g.nodes
    return graph.counters(graph.with_support(g.validated), nodes.where("mention_count > 1"))


VERTICES = "marked as (select o_custkey as doc, o_orderkey % 4 as vertex, o_orderkey as pos, case when o_orderkey % 4 = 2 then ' ' else ' ' || o_orderpriority end as name from orders), canon as (select doc, vertex, arg_max(trim(name), n * 1000000000000::bigint - first) as name from (select doc, vertex, trim(name) as name, count(*) as n, min(pos) as first from marked where trim(name) <> '' group by all) group by doc, vertex)"


def canon(spark, sf_dir):
    o = F.col("o_orderkey")
    m = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), (o % 4).alias("vertex"), o.alias("pos"), F.when(o % 4 == 2, " ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("name"))
    return evaluation.canonical_names(m)


@query(f"with {VERTICES} select doc, vertex, name from canon")
def gold_canonical_name(spark, sf_dir):
    return canon(spark, sf_dir)


LABELS = "labels_ as (select o_custkey as doc, o_orderkey as pos, ' ' || o_orderstatus as r, o_orderkey % 3 as h, (o_orderkey // 3) % 4 as t from orders), golden as (select l.doc, l.pos, s.name as source_name, trim(l.r) as type, t.name as target_name from labels_ l join (select *, row_number() over (partition by doc order by vertex) - 1 as i from canon) s on s.doc = l.doc and s.i = l.h join (select *, row_number() over (partition by doc order by vertex) - 1 as i from canon) t on t.doc = l.doc and t.i = l.t)"


def golden(spark, sf_dir):
    o = F.col("o_orderkey")
    labels = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), o.alias("pos"), F.concat(F.lit(" "), "o_orderstatus").alias("r"), (o % 3).alias("h"), (F.floor(o / 3) % 4).alias("t"))
    return evaluation.gold_relations(labels, canon(spark, sf_dir))


@query(f"with {VERTICES}, {LABELS} select * from golden")
def gold_relations(spark, sf_dir):
    return golden(spark, sf_dir)


@query(f"with {VERTICES}, {LABELS} select distinct type as name from golden")
def gold_vocab(spark, sf_dir):
    return evaluation.vocabulary(golden(spark, sf_dir))


@query(f"select conv_id, string_agg({sql_strip('text')}, chr(10) order by turn) filter ({sql_strip('text')} <> '') as text from conversations group by conv_id")
def gold_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.split("text", " ").alias("tokens")))).alias("s"))
    return c.select("conv_id", evaluation.sentences_text(F.transform("s", lambda x: x["tokens"])).alias("text"))


#: Predictions are the plan's entities and relations; gold is what capitalised words of six letters or more, and neighbours among them, are in the whole text.
EVAL = f"""long_words as (select base, regexp_extract_all(text, '[A-Z][a-z]{{5,}}') as m from docs),
p as (select distinct base as doc, {sql_eval("name")} as item from entities), g as (select distinct base as doc, {sql_eval("name")} as item from (select base, unnest(m) as name from long_words)),
named_ as (select base, global_id, arg_max(name, first_ord) as name from entities group by base, global_id),
p3 as (select distinct r.base as doc, {sql_eval("s.name")} as s, r.type as r, {sql_eval("t.name")} as t from relations r join named_ s on s.base = r.base and s.global_id = r.source join named_ t on t.base = r.base and t.global_id = r.target),
g3 as (select distinct base as doc, {sql_eval("a")} as s, ['knows', 'located in'][(length(a) + length(b)) % 3 + 1] as r, {sql_eval("b")} as t from (select base, m[i] as a, m[i + 1] as b from (select base, m, unnest(range(1, len(m))) as i from long_words)) where (length(a) + length(b)) % 3 < 2),
both_ as (select doc from p intersect select doc from g),
tally as (select count(*) filter (p.doc is not null and g.doc is not null) as tp, count(*) filter (g.doc is null) as fp, count(*) filter (p.doc is null) as fn from (select * from p where doc in (select doc from both_)) p full join (select * from g where doc in (select doc from both_)) g on p.doc = g.doc and p.item = g.item),
tally3 as (select count(*) filter (p.doc is not null and g.doc is not null) as tp, count(*) filter (g.doc is null) as fp, count(*) filter (p.doc is null) as fn from (select * from p3 where doc in (select doc from both_)) p full join (select * from g3 where doc in (select doc from both_)) g on p.doc = g.doc and p.s = g.s and p.r = g.r and p.t = g.t)"""


def predicted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The plan's names (doc, name) and triples (doc, source_name, type, target_name)."""
    g = plan(spark, sf_dir)
    entities = resolution.entity_names(g.mentions).select(F.col("base").alias("doc"), "global_id", "name", F.col("first_ord").alias("pos"))
    return entities.select("doc", "name"), evaluation.predicted_triples(g.relations.select(F.col("base").alias("doc"), "source", "type", "target"), entities)


def gold(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Names (doc, name) and triples (doc, source_name, type, target_name) of whole texts, whose words are found once."""
    words = stored(chunking.clean(docs(spark, sf_dir)).select(F.col("base").alias("doc"), F.regexp_extract_all("text", F.lit("[A-Z][a-z]{5,}"), F.lit(0)).alias("m")), "words")
    pairs = words.where(F.size("m") > 1).select("doc", F.explode(F.transform(F.sequence(F.lit(0), F.size("m") - 2), lambda i: F.struct(F.get("m", i).alias("source_name"), F.get("m", i + 1).alias("target_name")))).alias("x")).select("doc", "x.*")
    rest = (F.length("source_name") + F.length("target_name")) % 3
    return words.select("doc", F.explode("m").alias("name")), pairs.where(rest < 2).withColumn("type", F.when(rest == 0, "knows").otherwise("located in"))


def named_docs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Names that were predicted, and those of gold, as (doc, item)."""
    return evaluation.name_items(predicted(spark, sf_dir)[0]), evaluation.name_items(gold(spark, sf_dir)[0])


def tallied(spark, sf_dir, triples: bool = False) -> DataFrame:
    (names, found), (gold_names, gold_triples) = predicted(spark, sf_dir), gold(spark, sf_dir)
    counted = evaluation.evaluated(evaluation.name_items(names), evaluation.name_items(gold_names))[0]
    if triples:
        return evaluation.counts(evaluation.triple_set(found), evaluation.triple_set(gold_triples), counted)
    return evaluation.counts(evaluation.name_set(names), evaluation.name_set(gold_names), counted)


def scores_of(tally: str) -> str:
    return f"x as (select *, coalesce(tp / nullif(tp + fp, 0)::double, 0) as p_, coalesce(tp / nullif(tp + fn, 0)::double, 0) as r_ from {tally}) select tp, fp, fn, round(p_, 4) as precision, round(r_, 4) as recall, round(coalesce(2 * p_ * r_ / nullif(p_ + r_, 0), 0), 4) as f1 from x"


def eval_chain(select: str) -> str:
    return f"with {', '.join([*CHAIN[1:6], EVAL])}{select}"


@query(eval_chain(" select * from tally"))
def tp_fp_fn(spark, sf_dir):
    return tallied(spark, sf_dir)


@query(eval_chain(f", {scores_of('tally')}"))
def prf(spark, sf_dir):
    return evaluation.scores(tallied(spark, sf_dir))


@query(eval_chain(" select * from tally3"))
def tp_fp_fn_triples(spark, sf_dir):
    return tallied(spark, sf_dir, triples=True)


@query(eval_chain(f", {scores_of('tally3')}"))
def prf_triples(spark, sf_dir):
    return evaluation.scores(tallied(spark, sf_dir, triples=True))


@query(eval_chain(" select doc, s as source_name, r as type, t as target_name from p3"))
def predicted_triples(spark, sf_dir):
    return evaluation.triple_set(predicted(spark, sf_dir)[1]).select("doc", F.col("item.s").alias("source_name"), F.col("item.r").alias("type"), F.col("item.t").alias("target_name"))


@query(eval_chain(" select distinct doc from p where doc not in (select doc from g)"))
def missing_gold(spark, sf_dir):
    return evaluation.evaluated(*named_docs(spark, sf_dir))[1]


@query(eval_chain(" select (select count(*) from both_) as evaluated_docs, (select count(*) from (select doc from p except select doc from g)) as missing_gold_docs"))
def evaluation_docs(spark, sf_dir):
    return evaluation.doc_counts(*evaluation.evaluated(*named_docs(spark, sf_dir)))


REPLIES = r"""replies as (select event_id, case event_id % 4 when 0 then 'Reply: {"entities": [{"id": " e1", "type": "T", "name": "' || event_type || '", "attributes": ' || props || ', "evidence": null}, 5], "relations": []} end'
  when 1 then 'Note [1]: {"entities": [], "relations": []}' when 2 then 'I say {"verdict": " supported"} of ' || props else props || ' and then {' end as reply from events),
cut as (select event_id, nullif(regexp_extract(reply, '(\{.*\}|\[.*\])', 1, 's'), '') as json, nullif(regexp_extract(reply, '(\{.*\})', 1, 's'), '') as braces from replies),
read_ as (select *, case when json_valid(json) then json::json end as j, case when json_valid(braces) then braces::json end as b from cut)"""


@query(f"with {REPLIES} select event_id, json, coalesce(json_type(j, '$.entities') = 'ARRAY' and json_type(j, '$.relations') = 'ARRAY', false) as ok, trim(j->'$.entities[0]'->>'id') as first_id, j->'$.entities[0]'->>'name' as first_name, case when upper(trim(b->>'verdict')) in ('SUPPORTED', 'UNSUPPORTED') then upper(trim(b->>'verdict')) else 'UNSURE' end as verdict from read_")
def json_first(spark, sf_dir):
    """Replies of four forms around events' properties, read for extractions and verdicts."""
    kind = F.col("event_id") % 4
    reply = (
        F.when(kind == 0, F.concat(F.lit('Reply: {"entities": [{"id": " e1", "type": "T", "name": "'), "event_type", F.lit('", "attributes": '), "props", F.lit(', "evidence": null}, 5], "relations": []} end')))
        .when(kind == 1, F.lit('Note [1]: {"entities": [], "relations": []}')).when(kind == 2, F.concat(F.lit('I say {"verdict": " supported"} of '), "props")).otherwise(F.concat("props", F.lit(" and then {")))
    )
    e = table(spark, sf_dir, "events").select("event_id", reply.alias("reply"))
    e = e.select("event_id", T.greedy_json(F.col("reply")).alias("json"), replies.parse_extraction(F.col("reply")).alias("x"), replies.verdict(F.col("reply")).alias("verdict"))
    return e.select("event_id", "json", F.col("x.ok").alias("ok"), F.get("x.entities", F.lit(0))["id"].alias("first_id"), F.get("x.entities", F.lit(0))["name"].alias("first_name"), "verdict")


def recorded(requests: DataFrame, reply: Column) -> completion.Recorded:
    """Replies kept by their requests' hashes, as a service would have given them."""
    return completion.Recorded(requests.select(F.sha2(F.col("prompt").cast("binary"), 256).alias("prompt_sha256"), reply.alias("reply")).dropDuplicates(["prompt_sha256"]))


@query(chain(2, """, first_ as (select base, chunk_id, nullif(regexp_extract(text, '[A-Z][a-z]{4,}'), '') as name from chunks)
select base, chunk_id, name, case when name is null then 'no recorded reply' end as error from first_""").replace(" , first_", ", first_"))
def replayed_extractions(spark, sf_dir):
    """Extraction by recorded replies: one entity for chunks that have a capitalised word, a dead letter for any other."""
    chunks = chunking.rule_chunks(chunking.clean(docs(spark, sf_dir))).withColumn("topic", F.lit(None).cast("string"))
    schema = spark.createDataFrame([("{}",)], "text string")
    word = F.regexp_extract("text", "[A-Z][a-z]{4,}", 0)
    asked = asking.extraction_requests(chunks, schema).where(word != "")
    kept = recorded(asked, F.concat(F.lit('Here: {"entities": [{"id": "e1", "type": "T", "name": "'), word, F.lit('"}], "relations": []}')))
    good, dead = asking.extractions(chunks, schema, kept, None, graph_plan.Settings())
    return good.select("base", "chunk_id", F.get("entities", F.lit(0))["name"].alias("name"), F.lit(None).cast("string").alias("error")).unionByName(dead.select("base", "chunk_id", F.lit(None).cast("string").alias("name"), "error"))


@query(f"with {SEGMENTS} select base, k::int as segment_id, (5 * k)::int as para_start, least(n, 5 * k + 5)::int as para_end, 't' || k as topic from (select base, n, unnest(range(ceil(n / 5.0)::bigint)) as k from sizes where n <= 120)")
def replayed_segments(spark, sf_dir):
    """Segments of five paragraphs from recorded replies, for documents that are asked about."""
    d, s = spaced(spark, sf_dir), graph_plan.Settings()
    one = lambda k: F.concat(F.lit('{"start_paragraph": '), 5 * k, F.lit(', "end_paragraph": "'), F.least(F.col("n_paragraphs"), 5 * k + 5), F.lit('", "topic": " t'), k, F.lit('"}'))
    numbers = F.sequence(F.lit(0), F.ceil(F.col("n_paragraphs") / 5).cast("int") - 1)
    reply = F.concat(F.lit("Segments: ["), F.array_join(F.transform(numbers, one), ", "), F.lit("]"))
    return asking.segments(d, recorded(asking.segment_requests(d, s), reply), s)


@query(chain(6, "select base, source, type, target, prov_pos::int as prov_pos, support_status, case when support_status = 'UNSUPPORTED' then case length(source) % 3 when 0 then 'SUPPORTED' when 1 then 'UNSUPPORTED' else 'UNSURE' end end as llm_support_status from statuses"))
def replayed_verdicts(spark, sf_dir):
    """Entries that the rule doesn't support, with verdicts from recorded replies; replies that say nothing are UNSURE."""
    rows = stored(asking.hashed(checked(spark, sf_dir)), "statuses")
    rest = F.length("source") % 3
    reply = F.when(rest == 0, '{"verdict": "supported"}').when(rest == 1, 'So: {"verdict": " UNSUPPORTED "}').otherwise("can't say")
    kept = completion.Recorded(rows.where("prompt_sha256 is not null").select("prompt_sha256", reply.alias("reply")).dropDuplicates(["prompt_sha256"]))
    out = asking.verdicts(rows, kept, graph_plan.Settings())
    return out.select("base", "source", "type", "target", "prov_pos", "support_status", "llm_support_status")


LOOSE = "mentions_ as (select 'c' || c_nationkey as base, c_custkey as key, md5((c_custkey // 6)::varchar)[1:28] || repeat(substr('ghi', (c_custkey % 3)::int + 1, 1), 5) as name from customer union all select 'p' || p_size, p_partkey, md5((p_partkey // 6)::varchar)[1:28] || repeat(substr('ghi', (p_partkey % 3)::int + 1, 1), 5) from part)"


@query(f"with {LOOSE} select base, min_by(name, key) as leader, count(*) as mention_count from mentions_ group by base, substr(name, 1, 28)")
def resolve_adjudicated(spark, sf_dir):
    """Names that are alike but not alike enough, which a service is asked about, and takes for one entity."""
    name = lambda key: F.expr(f"substr(md5(cast(floor({key} / 6) as string)), 1, 28) || repeat(substr('ghi', cast({key} % 3 as int) + 1, 1), 5)")
    c = table(spark, sf_dir, "customer").select(F.expr("'c' || c_nationkey").alias("base"), F.col("c_custkey").cast("int").alias("row_pos"), name("c_custkey").alias("name"))
    p = table(spark, sf_dir, "part").select(F.expr("'p' || p_size").alias("base"), F.col("p_partkey").cast("int").alias("row_pos"), name("p_partkey").alias("name"))
    yes = completion.Rules(lambda prompt: 'I think {"same": true}')
    return resolution.adjudicated(as_mentions(c.unionByName(p)), asking.judge(yes)).groupBy("base", "leader").agg(F.count("*").alias("mention_count"))


@query(chain(7, "select src, rel_type, dst, support_ratio, supported, provenance_count from last_edges"))
def graph_from_documents_exact(spark, sf_dir):
    """Documents to supported edges, with exact resolution."""
    return plan(spark, sf_dir).edges.select("src", "rel_type", "dst", "support_ratio", "supported", "provenance_count")


@query()
def graph_from_documents(spark, sf_dir):
    """The whole plan as it runs: documents to supported edges, names that differ little being one entity."""
    return graph_plan.build(docs(spark, sf_dir)).edges.select("src", "rel_type", "dst", "support_ratio", "supported", "provenance_count")
