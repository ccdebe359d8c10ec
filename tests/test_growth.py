"""What steps do once, so that their work grows no faster than the input."""

import difflib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave import queries
from docweave.functions import text as T
from docweave.operators import chunking, completion, extraction, resolution, validation
from docweave.plans import asking, graph_plan
from docweave.sources.settings import Settings


def test_match_text_takes_all_white_space(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = [x for w in spaces for x in (f"a{w}b", f"{w}a{w}\n{w}b {w}c{w}", w * 2, f"é{w}ß\n", f"“x”{w} y")] + ["", "’a  b", "a\r\nb"]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    out = rows.select("text", T.match_text(F.col("text")).alias("m"), T.newlines(F.col("text")).alias("n")).collect()
    assert [r.m for r in out] == [" ".join(r.text.split()) for r in out]
    assert [r.n for r in out] == [r.text.replace("\r\n", "\n").replace("\r", "\n").strip() for r in out]


def test_lengths_are_counted_once_a_text(spark):
    docs = spark.createDataFrame([("a", "x" * 9000)], "base string, text string")
    chunks = chunking.rule_chunks(docs)
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "posexplode" in line and "length(text" in line]
    assert [(r.char_start, r.char_end) for r in chunks.orderBy("chunk_id").collect()] == [(0, 4000), (3700, 7700), (7400, 9000)]


def test_recorded_verdicts_take_one_pass(spark):
    """Recorded replies meet statuses in one join; entries that nothing is asked about are spread."""
    entries = [("b", f"s{i}", "t", "o", i, "SUPPORTED" if i % 4 else "UNSUPPORTED", "text") for i in range(400)]
    rows = spark.createDataFrame(entries, "base string, source string, type string, target string, prov_pos int, support_status string, chunk_text string").withColumn("evidence_relation", F.lit("e"))
    kept = asking.verdict_requests(rows).where("prov_pos < 200").select(F.sha2(F.col("prompt").cast("binary"), 256).alias("prompt_sha256"), F.lit('{"verdict": "supported"}').alias("reply"))
    counted = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: counted.add(1) or x, "string").asNondeterministic()
    out = asking.verdicts(rows.withColumn("evidence_relation", seen("evidence_relation")), completion.Recorded(kept.localCheckpoint()), Settings())
    got = {(r.prov_pos, r.support_status, r.llm_support_status) for r in out.collect()}
    assert got == {(i, s, "SUPPORTED" if i % 4 == 0 and i < 200 else None) for _, _, _, _, i, s, _ in entries}
    assert counted.value == 400


def test_replayed_verdicts_check_evidence_once(spark, sf_dir):
    plan = queries.QUERIES["replayed_verdicts"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "contains(" not in plan.lower()


@given(st.sets(st.text(alphabet="abc", max_size=14), min_size=1, max_size=40), st.sampled_from([0.8, 0.9, 0.92, 1.0]))
@settings(max_examples=200, deadline=None)
def test_short_leaders_are_those_of_all_pairs(names, least):
    """Whatever the keys leave out isn't similar enough."""
    fitting = [n for n in sorted(names, key=hash) if resolution._ShortLeaders.fit([n], least)]
    leaders = resolution._ShortLeaders(least)
    for name in fitting:
        keys = leaders.count(name)
        want = {(i, score) for i, x in enumerate(leaders.norms) for score in [difflib.SequenceMatcher(None, name, x).ratio()] if score >= least}
        assert set(leaders.close(name, keys)) == want
        leaders.add(name, keys)


def test_documents_names_need_no_letter_counts(spark, monkeypatch):
    """Groups of short names, as documents have them, are resolved without the tables that large groups need."""
    rows = [(f"d{i}", k, 0, k, f"e{k}", "T", name, "{}", name) for i in range(3) for k, name in enumerate(["Marken", "Markens", "Strand", "Abcdefghijkl", "Abcdefghijk"])]
    m = spark.createDataFrame(rows, "base string, row_pos int, ent_pos int, chunk_id int, id string, type string, name string, attributes string, evidence string")
    names = resolution.named(m).groupBy("base", "type", "norm").agg(F.min("ord").alias("ord"))
    monkeypatch.setattr(resolution, "_Leaders", None)  # travels with the function to the workers' copies
    got = {(r.base, r.norm, r.leader) for r in resolution.scored(names, 0.92).collect()}
    pairs = [("marken", "marken"), ("markens", "marken"), ("strand", "strand"), ("abcdefghijkl", "abcdefghijkl"), ("abcdefghijk", "abcdefghijkl")]
    assert got == {(f"d{i}", *p) for i in range(3) for p in pairs}


def test_mentions_take_their_leaders_without_another_exchange(spark):
    rows = [("d", k, 0, k, f"e{k}", "T", name, "{}", name) for k, name in enumerate(["Northern Line", "Northern Lines", "Northern Line", "C"])]
    m = spark.createDataFrame(rows, "base string, row_pos int, ent_pos int, chunk_id int, id string, type string, name string, attributes string, evidence string")
    x = resolution.fuzzy(m, 0.92)
    assert [r.leader for r in x.orderBy("row_pos").collect()] == ["northern line"] * 3 + ["c"]
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_edges_need_no_attributes(spark):
    """Edges are held against ids alone; entities with their attributes are made for nodes only."""
    g = graph_plan.build(spark.createDataFrame([("a", "Alpha knows Gamma. Alpha met Delta, then Gammas.")], "base string, text string"))
    assert {r.global_id for r in g.node_ids.collect()} == {r.global_id for r in g.nodes.collect()} != set()
    parsed = lambda df: "variant" in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert parsed(g.nodes) and not parsed(g.edges)


def test_triples_are_scored_without_attributes_or_texts(spark, sf_dir):
    """Names are all that scoring needs of entities; words of gold are found once and kept."""
    plan = queries.QUERIES["tp_fp_fn_triples"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower() and "regexp_extract_all" not in plan


def test_entity_names_are_those_of_entities(spark, sf_dir):
    g = queries.plan(spark, sf_dir)
    want = g.entities.select("base", "global_id", "type", "name", "first_ord")
    assert resolution.entity_names(g.mentions).exceptAll(want).isEmpty() and want.exceptAll(resolution.entity_names(g.mentions)).isEmpty()


def test_routed_documents_are_one_row_each(spark, sf_dir):
    """Texts are neither sorted nor joined with each of their segments, and results are passed on before they are many."""
    plan = queries.QUERIES["hybrid_chunks"](spark, sf_dir)._jdf.queryExecution()
    assert "Window" not in plan.optimizedPlan().toString() and plan.executedPlan().toString().count("Join") == 1
    assert "ShuffledHashJoin" in plan.executedPlan().toString()


def test_results_are_passed_on_before_they_are_many(monkeypatch):
    monkeypatch.setattr(chunking, "KEPT_CHARS", 1000)
    batch = pa.RecordBatch.from_pydict({"base": [1, 2, 3], "text": ["x" * 900, None, "y" * 2500]})
    run = chunking._by_row(["text"], ["base"], lambda r: ((c,) for c in (r["text"] or "")), {"text": pa.string()})
    made = list(run(iter([batch])))
    assert [b.num_rows for b in made] == [1001, 1001, 1001, 397]
    assert "".join(x for b in made for x in b["text"].to_pylist()) == "x" * 900 + "y" * 2500
    assert [x for b in made for x in b["base"].to_pylist()] == [1] * 900 + [3] * 2500


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=4), st.integers(0, 6))
@settings(max_examples=200, deadline=None)
def test_tiled(segments, n):
    want = bool(segments) and sorted(x for a, b in segments for x in range(a, b)) == list(range(n)) and all(a < b for a, b in segments)
    assert not segments or chunking.tiled(segments, n) == want


def test_support_is_counted_without_joins(spark, sf_dir):
    """Evidence is looked for while a chunk's text is at hand; a document's rows meet in one exchange."""
    plan = queries.QUERIES["support_ratio"](spark, sf_dir)._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString() and plan.toString().count("RepartitionByExpression") == 1


ENTITY, RELATION = "struct<id:string,type:string,name:string,attributes:string,evidence:string>", "struct<source_id:string,type:string,target_id:string,evidence:string>"


def odd_extractions(chunks):
    """Equal and blank local ids, unknown ends, rows without either, evidence that is blank, null, spread over lines or missing."""
    entity = lambda id_, name: F.struct(F.lit(id_).alias("id"), F.lit("T").alias("type"), F.lit(name).alias("name"), F.lit("{}").alias("attributes"), F.lit(None).cast("string").alias("evidence"))
    relation = lambda s, t, o, e: F.struct(F.lit(s).alias("source_id"), F.lit(t).alias("type"), F.lit(o).alias("target_id"), F.lit(e).cast("string").alias("evidence"))
    some = F.array(entity("", "Nobody"), entity("a", "Alpha"), entity(" b", "beta\tx"), entity("b", "Gamma"), entity("c", "ALPHA "), entity("d", "Alpha-"), entity("e", "alpha."))
    pairs = F.array(*[relation(*r) for r in (("a", " r ", "b", "ALPHA  met"), ("c", "r", "b", None), ("a", "r", "b", " \n"), ("d", "r", "e", "no such"), ("e", "r", "d", "met\xa0Gamma"), ("a", " ", "b", "x"), ("a", "r", "z", "x"), (None, "r", "b", "x"))])
    few = F.col("chunk_id") % 3
    x = chunks.select("base", F.col("chunk_id").alias("row_pos"), F.when(few == 2, "none").otherwise(F.col("chunk_id").cast("string")).alias("chunk_id"))
    return x.select("*", F.when(F.col("row_pos") % 5 == 4, F.array().cast(f"array<{ENTITY}>")).otherwise(some).alias("entities"), F.when(F.col("row_pos") % 7 == 6, F.array().cast(f"array<{RELATION}>")).otherwise(pairs).alias("relations"))


@pytest.mark.parametrize(("fuzzy", "limits"), [(True, {}), (False, {"validate_case_insensitive": False, "validate_max_relations": 2, "validate_max_provenances": 1})])
def test_support_found_on_the_way_is_that_of_statuses(spark, fuzzy, limits):
    docs = spark.createDataFrame([("a", "Alpha \n met Gamma. " * 900), ("b", "Alpha met\n\nGamma"), (None, "Alpha met"), ("c", " "), ("d", None)], "base string, text string")
    s = Settings(extract_strict=False, **limits)
    for extract in (odd_extractions, extraction.mentions_by_rule):
        g = graph_plan.build(docs, s, extract, fuzzy=fuzzy)
        texts = validation.chunk_texts(g.chunks.withColumn("row_pos", F.col("chunk_id")))
        want = validation.validated(validation.statuses(g.relations, texts, s.validate_case_insensitive, s.validate_max_relations, s.validate_max_provenances)).collect()
        for now in (g.validated, graph_plan.build(docs, s, extract, fuzzy=fuzzy).validated):
            assert sorted(now.collect(), key=str) == sorted(want, key=str) != []
            assert now.columns == ["base", "source", "type", "target", "first_ord", "provenance", "validation"]
