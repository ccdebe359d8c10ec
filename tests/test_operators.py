"""Operators against sequential versions, and pieces that have no SQL."""

import difflib
import json
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.operators import chunking, completion, evaluation, extraction, graph, resolution, validation
from docweave.plans import graph_plan
from docweave.sources import documents, tables
from docweave.sources.settings import Settings, one_of

CUT = "a" * 900 + "\n\n" + "b" * 98


@pytest.mark.parametrize("text,want", [(CUT, [(0, 900), (600, 900), (900, 1000)]), ("a" * 1000, [(0, 1000)]), ("a" * 10000, [(0, 4000), (3700, 7700), (7400, 10000)]), ("", [])])
def test_rule_spans(spark, text, want):
    assert [s[1:] for s in chunking.spans(text, 0, len(text), 4000, 300)] == want
    rows = chunking.rule_chunks(spark.createDataFrame([("d", text)], "base string, text string")).orderBy("chunk_id").collect()
    assert [(r.char_start, r.char_end) for r in rows] == want and all(r.text == text[r.char_start : r.char_end].strip() for r in rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n", max_size=400), st.integers(1, 300), st.data())
def test_spans_cover(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    found = list(chunking.spans(text, 0, len(text), size, overlap))
    at = 0
    for i, lo, hi in found:
        assert lo <= at and lo < hi <= lo + size
        at = max(at, hi)
    assert at == len(text) and all(a[1] < b[1] for a, b in zip(found, found[1:]))


def test_chunk_limits(spark):
    docs = spark.createDataFrame([("d", "a" * 100)], "base string, text string")
    with pytest.raises(ValueError):
        chunking.rule_chunks(docs, 10, 10)
    with pytest.raises(Exception, match="too many chunks"):
        chunking.rule_chunks(docs, 10, 0, 5).collect()
    assert chunking.rule_chunks(docs, 10, 0, 0).count() == 10


def test_paragraphs(spark):
    rows = chunking.paragraphs(spark.createDataFrame([("d", "a\n \n b\n\n\nc"), ("e", None)], "base string, text string")).orderBy("idx").collect()
    assert [(r.idx, r.char_start, r.char_end, r.text) for r in rows] == [(0, 0, 1, "a"), (1, 5, 6, "b"), (2, 9, 10, "c")]


@pytest.mark.parametrize("segments,want", [([(0, 2), (2, 3)], True), ([(2, 3), (0, 2)], True), ([(0, 1), (2, 3)], False), ([(0, 4)], False), ([], False)])
def test_segment_cover(spark, segments, want):
    s = spark.createDataFrame([("d", a, b) for a, b in segments], "base string, start int, end int")
    (r,) = chunking.segments_valid(s, spark.createDataFrame([("d", 3)], "base string, n_paragraphs int")).collect()
    assert r.valid is want


def test_routing(spark):
    docs = spark.createDataFrame([("good", "a\n\nb\n\nc"), ("bad", "a\n\nb"), ("none", "x")], "base string, text string")
    segs = spark.createDataFrame([("good", 0, 1, 3, "t"), ("good", 1, 0, 1, None), ("bad", 0, 0, 1, "t")], "base string, segment_id int, para_start int, para_end int, topic string")
    rows = {(r.base, r.chunk_id): (r.variant, r.text, r.char_start) for r in chunking.routed(docs, segs).collect()}
    assert rows == {("good", 0): ("llm", "b\n\nc", 3), ("good", 1): ("llm", "a", 0), ("bad", 0): ("llm_fallback_rule", "a\n\nb", 0), ("none", 0): ("llm_fallback_rule", "x", 0)}
    whole = chunking.routed(docs, segs, subchunks=False).where("variant = 'llm'")
    assert {r.text for r in whole.collect()} == {"b\n\nc", "a"}


MENTION = "base string, row_pos int, ent_pos int, chunk_id int, id string, type string, name string, attributes string, evidence string"


def sequential(rows, least):
    """One pass in order: equal name, else most similar leader so far, else a new leader."""
    leaders = defaultdict(list)
    out = {}
    for base, row, ent, name in rows:
        known = leaders[base]
        if name in known:
            out[base, row, ent] = name
            continue
        scored = [(difflib.SequenceMatcher(None, name, k).ratio(), -i) for i, k in enumerate(known)]
        if scored and max(scored)[0] >= least:
            out[base, row, ent] = known[-max(scored)[1]]
        else:
            known.append(name)
            out[base, row, ent] = name
    return out


@pytest.mark.parametrize("least", [0.5, 0.8, 0.92])
def test_fuzzy_resolution(spark, least):
    r = random.Random(int(100 * least))
    rows = [(b, i, k, "".join(r.choice("abc") for _ in range(r.randrange(1, 7)))) for b in "xyz" for i in range(25) for k in range(2)]
    m = spark.createDataFrame([(b, i, k, i, f"e{k}", "T", n, "{}", None) for b, i, k, n in rows], MENTION).repartition(3)
    want = sequential(rows, least)
    assert {(x.base, x.row_pos, x.ent_pos): x.leader for x in resolution.fuzzy(m, least).collect()} == want
    assert {(x.base, x.row_pos, x.ent_pos): x.leader for x in resolution.adjudicated(m, lambda *a: False, least, least).collect()} == want


@pytest.mark.parametrize("least", [0.55, 0.8, 0.92])
def test_leaders_are_found_by_keys(least):
    """Keys lose none of the leaders that are similar enough, and few others are looked at."""
    r = random.Random(7)
    names = ["".join(r.choice("0123456789abcdef") for _ in range(r.choice((12, 18, 33)))) for _ in range(150)]
    for name in names[:75]:
        x = list(name)
        for _ in range(r.choice((1, 1, 2, 4, 6))):
            i = r.randrange(len(x))
            x[i : i + r.choice((0, 1))] = r.choice(("", "0", "f", "a1"))
        names.append("".join(x))
    names = list(dict.fromkeys([*names, *(f"customer#{k:06}" for k in range(0, 800, 11)), "", "a"]))
    leaders = resolution._Leaders(names, least)
    for i, name in enumerate(names):
        want = {k: s for k, lead in enumerate(leaders.norms) if (s := resolution.difflib.SequenceMatcher(None, name, lead).ratio()) >= least} if i % 4 == 0 else None
        assert want is None or dict(leaders.close(name, leaders.count(name))) == want
        if i % 5:
            leaders.add(name, leaders.count(name))
    looked_at = sum(1 if x is None else 0 for x in leaders.matchers)
    assert least < 0.8 or looked_at > 100  # leaders that no name came near


def test_mentions_are_no_broadcast(spark):
    """Mentions are joined with their leaders by sorting, however small Spark takes either side for."""
    m = spark.createDataFrame([("b", i, 0, i, "e", "T", n, "{}", None) for i, n in enumerate(["Northern Line", "Northern Lines", "C"])], MENTION)
    x = resolution.fuzzy(m, 0.92)
    assert {r.name: r.leader for r in x.collect()} == {"Northern Line": "northern line", "Northern Lines": "northern line", "C": "c"}
    assert "Broadcast" not in x._jdf.queryExecution().executedPlan().toString()


def test_adjudication(spark):
    rows = [("b", 0, 0, 0, "e", "T", "Example Company", "{}", "one"), ("b", 1, 0, 1, "e", "T", "Example Companies", "{}", "two")]
    m = spark.createDataFrame(rows, MENTION)
    for answer in (True, False):
        found = resolution.adjudicated(m, lambda type, name, ev, other, other_ev: answer and (ev, other_ev) == ("two", "one"), 0.95, 0.8).collect()
        assert len({x.leader for x in found}) == (1 if answer else 2)


def test_resolution_is_idempotent(spark):
    m = resolution.resolved(resolution.exact(spark.createDataFrame([("b", i, 0, i, "e", "T", n, "{}", None) for i, n in enumerate(["A b", "a  B", "C"])], MENTION)))
    e = resolution.entities(m)
    assert {(r.global_id, r.name, len(r.mentions)) for r in e.collect()} == {("T:a_b", "a  B", 2), ("T:c", "C", 1)}
    again = resolution.entities(resolution.resolved(resolution.exact(e.select("base", F.col("first_ord.row_pos").alias("row_pos"), F.lit(0).alias("ent_pos"), F.lit(0).alias("chunk_id"), F.lit("e").alias("id"), "type", "name", "attributes", F.lit(None).cast("string").alias("evidence")))))
    assert again.count() == e.count()
    with pytest.raises(Exception, match="without type or name"):
        resolution.exact(spark.createDataFrame([("b", 0, 0, 0, "e", "T", " ", "{}", None)], MENTION)).collect()


def test_entities_send_nothing_through_the_driver(spark):
    """Sizes are estimated too small across an explode, so a join of entities with their attributes would be a broadcast of all of them."""
    rows = [("b", i, 0, i, f"e{i}", "T", n, a, None) for i, (n, a) in enumerate([("A b", '{"k": "", "m": 1}'), ("a  B", '{"k": 2}'), ("C", "none")])]
    e = resolution.entities(resolution.resolved(resolution.exact(spark.createDataFrame(rows, MENTION))))
    assert {(r.global_id, r.attributes, len(r.mentions), r.first_ord.row_pos) for r in e.collect()} == {("T:a_b", '{"k": 2, "m": 1}', 2, 0), ("T:c", "{}", 1, 2)}
    assert "Join" not in e._jdf.queryExecution().executedPlan().toString()


def test_attributes(spark):
    key = "base string, type string, leader string, n int, attributes string"
    rows = [("a", "T", "x", 0, '{"k": "", "f": 1.0}'), ("a", "T", "x", 1, '{"k": 0, "q\\"": {}}'), ("a", "T", "x", 2, '{"k": 5}'), ("b", "T", "x", 0, '{"k": ""}'), ("b", "T", "x", 1, '{"k": null}')]
    df = spark.createDataFrame(rows, key).withColumn("ord", F.struct(F.col("n").alias("row_pos"), F.lit(0).alias("ent_pos")))
    got = {r.base: json.loads(r.attributes) for r in resolution.merged_attributes(df).collect()}
    assert got == {"a": {"k": 0, "f": 1.0, 'q"': {}}, "b": {"k": None}}


def test_evidence(spark):
    rel = "base string, source string, type string, target string, first_ord int, provenance array<struct<chunk_id:string,evidence_relation:string>>"
    prov = [("1", "Foo  BAR"), ("1", "nowhere"), ("1", " "), ("9", "x"), ("bad", "x"), ("1", None)]
    r = spark.createDataFrame([("b", "s", "t", "o", 0, prov), ("b", "s", "t", "p", 1, [])], rel)
    chunks = validation.chunk_texts(spark.createDataFrame([("b", "1", "old", 0), ("b", "1", "x foo\nbar y", 1), ("b", "bad", "x", 2)], "base string, chunk_id string, text string, row_pos int"))
    rows = validation.statuses(r, chunks)
    v = {x.target: x for x in validation.validated(rows).collect()}
    assert [p.support_status for p in v["o"].provenance] == ["SUPPORTED", "UNSUPPORTED", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert v["o"].validation.support_ratio == 0.1667 and v["p"].validation.support_ratio == 0 and v["p"].provenance == []
    strict = {x.prov_pos: x.support_status for x in validation.statuses(r, chunks, ignore_case=False).where("target = 'o'").collect()}
    assert strict[0] == "UNSUPPORTED" and validation.to_escalate(rows).count() == 3
    assert validation.unmatched(r.withColumn("base", F.lit("q")), chunks).count() == 1


def test_support(spark):
    p = "array<struct<evidence_relation:string,support_status:string,llm_support_status:string>>"
    df = spark.createDataFrame([("b", "s", "t", "o1", 0, [(None, "supported", None), ("e1", "UNKNOWN", None), ("e2", None, None)], (0.25,)), ("b", "s", "t", "o2", 1, [("e", "UNSUPPORTED", "SUPPORTED")], (0.0,)), ("b", "s", "t", "o3", 2, [], (0.6,))], f"base string, source string, type string, target string, first_ord int, provenance {p}, validation struct<support_ratio:double>")
    assert [r.passes for r in graph.with_support(df).orderBy("target").collect()] == [True, True, True]
    assert [r.passes for r in graph.with_support(df, accept_llm=False).orderBy("target").collect()] == [True, False, True]
    ids = spark.createDataFrame([("s",), ("o1",)], "global_id string")
    (e,) = graph.edges(graph.with_support(df), ids, samples=2).collect()
    assert e.evidence_samples == ["e1"] and e.provenance_count == 3 and e.rel_type == "T"


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, v int, w string")
    new = spark.createDataFrame([("a", None, "n"), ("c", 3, "y")], "k string, v int, w string")
    assert {tuple(r) for r in graph.upserted(old, new, ["k"]).collect()} == {("a", None, "n"), ("b", 2, "x"), ("c", 3, "y")}
    assert {tuple(r) for r in graph.upserted(old, new, ["k"], overwrite=False).collect()} == {("a", 1, "n"), ("b", 2, "x"), ("c", 3, "y")}
    assert graph.upserted(None, new, ["k"]) is new and graph.duplicate_ids(old.withColumnRenamed("k", "global_id")).count() == 0


def test_scores(spark):
    rows = evaluation.scores(spark.createDataFrame([(1, 1, 2), (0, 0, 0)], "tp long, fp long, fn long")).collect()
    assert [(r.precision, r.recall, r.f1) for r in rows] == [(0.5, 0.3333, 0.4), (0.0, 0.0, 0.0)]


def test_gold(spark):
    m = spark.createDataFrame([("d", 0, 0, " "), ("d", 1, 0, "X"), ("d", 2, 0, "A"), ("d", 2, 1, "Y"), ("d", 2, 2, "Y ")], "doc string, vertex long, pos long, name string")
    names = evaluation.canonical_names(m)
    labels = spark.createDataFrame([("d", 0, "r", 0, 1), ("d", 1, "r", 1, 2), ("d", 2, " ", 0, 1)], "doc string, pos long, r string, h long, t long")
    assert [(r.source_name, r.target_name) for r in evaluation.gold_relations(labels, names).collect()] == [("X", "Y")]
    assert [(r.source_name, r.target_name) for r in evaluation.gold_relations(labels, names, shift=False).collect()] == [("X", "Y")]
    ents = spark.createDataFrame([("d", "g1", "Old", 0), ("d", "g1", "X", 1), ("d", "g2", "y", 2), ("d", "g3", " ", 3)], "doc string, global_id string, name string, pos int")
    rels = spark.createDataFrame([("d", "g1", "r", "g2"), ("d", "g1", "r", "g3"), ("d", "g1", "q", "g2")], "doc string, source string, type string, target string")
    p = evaluation.triple_set(evaluation.predicted_triples(rels, ents))
    g = evaluation.triple_set(evaluation.gold_relations(labels, names).select("doc", "source_name", "type", "target_name"))
    docs, missing = evaluation.evaluated(p, g)
    assert tuple(evaluation.counts(p, g, docs).first()) == (1, 1, 0) and missing.count() == 0
    assert evaluation.evaluated(p.limit(0), g, strict=True)[0].count() == 1


def test_completion(spark):
    class Flaky:
        name, model = "flaky", "none"

        def __init__(self, failures):
            self.failures = failures

        def open(self):
            state = {}

            def call(system, prompt, temperature, tokens):
                state[prompt] = state.get(prompt, 0) + 1
                if state[prompt] <= self.failures.get(prompt, 0):
                    raise OSError("down")
                return f"re:{prompt}"

            return call

    prompts = spark.createDataFrame([(1, "ok"), (2, "once"), (3, "always"), (4, "mended")], "i int, prompt string").coalesce(1)
    backend = Flaky({"once": 1, "always": 99, "mended": 99})
    rows = {r.i: r for r in completion.complete(prompts, backend, attempts=2, wait=(0.0, 0.0), repair=lambda p, e: "fixed" if p == "mended" else p).collect()}
    assert (rows[1].reply, rows[2].reply, rows[3].reply, rows[4].reply) == ("re:ok", "re:once", None, "re:fixed")
    assert rows[4].repaired and "down" in rows[3].error
    good, dead = extraction.split_failures(completion.complete(prompts, completion.Rules(str.upper), usable=lambda r: r != "ALWAYS", attempts=1))
    assert good.count() == 3 and [r.i for r in dead.collect()] == [3]
    recorded = spark.createDataFrame([("ok", "yes")], "p string, reply string").select(F.sha2("p", 256).alias("prompt_sha256"), "reply")
    assert {r.i: r.reply for r in completion.replayed(prompts, recorded).collect()} == {1: "yes", 2: None, 3: None, 4: None}
    for bad in (dict(name="x", model="m", url="u"), dict(name="openrouter", model="m", url="u"), dict(name="ollama", model="", url="u")):
        with pytest.raises(ValueError):
            completion.Http(**bad)
    assert completion.Http("ollama", "m", "u").open()


def test_prompts(spark):
    (r,) = spark.createDataFrame([("s", None)], "a string, b string").select(extraction.prompt("extract", F.col("a"), F.col("b"), F.col("b"), F.col("a")).alias("p")).collect()
    assert "Schema:\ns\n" in r.p


def test_schema_filter(spark):
    rows = [("b", 0, 0, [(" e1 ", "T", "n", None, "x"), ("e2", "T", " ", "{}", None), ("e3", "U", "m", "{}", None)], [("e1", "r", "e1", None), ("e1", "r", "e2", None), ("e1", "q", "e1", None)])]
    x = spark.createDataFrame(rows, "base string, row_pos int, chunk_id int, entities array<struct<id:string,type:string,name:string,attributes:string,evidence:string>>, relations array<struct<source_id:string,type:string,target_id:string,evidence:string>>")
    names = lambda *v: spark.createDataFrame([(i,) for i in v], "name string")
    (r,) = extraction.filter_to_schema(x, names(" T ", ""), names("r")).collect()
    assert [(e.id, e.attributes) for e in r.entities] == [("e1", "{}")] and [(q.source_id, q.type, q.target_id) for q in r.relations] == [("e1", "r", "e1")]


def test_pdf_sources(spark, tmp_path):
    for name, body in (("a.pdf", b"one|two|x"), ("b.PDF", b"bad"), ("c.txt", b"no"), ("sub/a.pdf", b"|y")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)

    def pages(content, limit):
        if content == b"bad":
            raise ValueError("broken")
        all_pages = content.decode().split("|")
        return all_pages[: limit or None], len(all_pages)

    def never(content, limit):
        raise ImportError("not here")

    files = documents.pdf_files(spark, f"file://{tmp_path}")
    assert files.count() == 3
    rows = {r.path.split("/", 2)[-1].removeprefix(str(tmp_path))[-7:]: r for r in documents.pdf_texts(files, "first", engines={"first": never, "second": pages}).collect()}
    a = next(r for k, r in rows.items() if r.text == "one\n\ntwo\n\nx")
    assert (a.engine, a.pages_total, a.pages_used) == ("second", 3, 3)
    assert sum(r.text is None and "broken" in r.error for r in rows.values()) == 1
    with pytest.raises(ValueError):
        documents.pdf_texts(files, "other")
    assert documents.joined_pages(["one", "two", "x"], 2, 0) == ("one\n\ntwo", 2) and documents.joined_pages(["one", "x", ""], 0, 2) == ("one", 1)
    assert documents.text_files(spark, f"file://{tmp_path}").first().base == "c"


def test_json_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.rule.chunks.jsonl").write_text('{"_meta": {"x": 1}}\n{"chunk_id": 1, "text": "a"}\n\n')
    rows = tables.read_lines(spark, f"file://{tmp_path}/in", "chunk_id int, text string", ".chunks").collect()
    assert [(r.base, r.chunk_id) for r in rows] == [("d.rule", 1)]
    (tmp_path / "in" / "e.chunks.jsonl").write_text("{broken\n")
    with pytest.raises(Exception):
        tables.read_lines(spark, f"file://{tmp_path}/in", "chunk_id int, text string").collect()
    path = f"file://{tmp_path}/s.json"
    assert tables.write_document(spark, {"a": "ü"}, path) and not tables.write_document(spark, {}, path)
    assert tables.read_document(spark, path).first().a == "ü"
    out = f"file://{tmp_path}/out"
    df = spark.createDataFrame([("a", None), ("b", 2)], "base string, v int")
    b = tables.Batches(spark, out)
    with pytest.raises(FileNotFoundError):
        b.read("step", "t")
    for x in (df.where("base = 'a'"), df):
        left = b.missing(x, "step")
        b.put("step", {"t": left}, left)
    assert sorted(r.base for r in b.read("step", "t").collect()) == ["a", "b"]
    tables.write_lines(df, f"{out}-lines")
    tables.write_lines(df.limit(0), f"{out}-lines")
    assert spark.read.text(f"{out}-lines").where("value like '%null%'").count() == 1
    assert tables.schema_path("x", "A b/c") == "x/A_b_c.schema.json" and tables.output_name("t", "llm") == "t.llm"


def test_settings():
    s = Settings.from_env({"CHUNK_SIZE_CHARS": "500 # small", "RESOLVE_SIM_HIGH": "bad", "GRAPH_CLEAR_DB": "Yes", "EXTRACT_SCHEMA_STRICT": "", "VALIDATE_CASE_INSENSITIVE": "false"})
    assert (s.chunk_size, s.resolve_sim_high, s.graph_clear, s.extract_strict, s.validate_case_insensitive) == (500, 0.92, True, True, False)
    assert one_of("", "f", "x") == "f"
    with pytest.raises(ValueError):
        one_of("", "", "x")


def test_steps():
    assert graph_plan.chosen(None, None, None) == list(graph_plan.STEPS) and graph_plan.chosen("chunk", "extract", None) == ["chunk", "schema", "extract"]
    assert graph_plan.chosen("chunk", "extract", "graph") == ["graph"] and graph_plan.main(["x", "--only", "chunk", "--mode", "llm", "--file", "a", "--dry-run"]) == ["chunk"] and graph_plan.main(["x", "--only", "pdf", "--dry-run"]) == ["pdf"]
    with pytest.raises(ValueError):
        graph_plan.chosen("graph", "pdf", None)


DOCS = [("d1", "Alice Smith met Robert Miller in Boston today. Alice Smith likes Boston. " * 40), ("d2", "Charlie visited London with Robert. " * 10)]


RULES = Settings(extract_backend="rules", schema_backend="rules")


def test_runner_equals_plan(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "base string, text string")
    runner = graph_plan.Runner(spark, f"file://{tmp_path}", RULES)
    runner.add_documents(docs)
    for _ in range(2):  # a second run adds nothing
        runner.run(graph_plan.chosen("chunk", "graph", None))
    want = graph_plan.build(docs)
    for name in ("nodes", "edges"):
        assert sorted(map(str, runner.table(name).collect())) == sorted(map(str, getattr(want, name).select(runner.table(name).columns).collect()))
    assert runner.table("edges").count() > 0
    assert runner.counters.first().imported == runner.table("edges").count()


def test_plan_is_fuzzy(spark):
    """The whole plan makes one entity of names that differ little, as one pass in order does."""
    text = "Konstantinopel and Konstantinopol and Samarkandische and Konstantinopel and Samarkandischa. "
    docs = spark.createDataFrame([("d", text * 3), ("e", "Samarkandischa near Konstantinopol")], "base string, text string")
    g = graph_plan.build(docs)
    found = extraction.entities(g.extractions).collect()
    want = sequential([(r.base + r.type, r.row_pos, r.ent_pos, r.name.lower()) for r in sorted(found, key=lambda r: (r.base, r.row_pos, r.ent_pos))], 0.92)
    assert {(r.base + r.type, r.row_pos, r.ent_pos): r.leader for r in g.mentions.collect()} == want
    assert g.entities.count() == 4 and graph_plan.build(docs, fuzzy=False).entities.count() == 6


def test_broken_off_step(spark, tmp_path):
    """What a step wrote before it broke off is not read, and the next run writes it again, once."""
    runner = graph_plan.Runner(spark, f"file://{tmp_path}", RULES)
    runner.add_documents(spark.createDataFrame(DOCS, "base string, text string"))
    runner.run(["chunk", "schema", "extract"])
    put = runner.batches.put

    def half(step, outputs, bases):
        name, df = next(iter(outputs.items()))
        df.write.mode("overwrite").parquet(f"{runner.folder}/{name}/batch=0")
        raise KeyboardInterrupt

    runner.batches.put = half
    with pytest.raises(KeyboardInterrupt):
        runner.resolve()
    runner.batches.put = put
    with pytest.raises(FileNotFoundError):
        runner.table("relations")
    runner.resolve()
    n = runner.table("relations").count()
    runner.resolve()
    assert runner.table("relations").count() == n > 0 and runner.table("relations").distinct().count() == n
    again = graph_plan.Runner(spark, runner.folder, RULES, overwrite=True)
    again.resolve()
    assert again.table("relations").count() == n


def small_service():
    def reply(prompt):
        """A service that follows rules: what it is asked is told by the prompt's first words."""
        if prompt.startswith("Group the"):
            n = int(prompt.split()[2])
            return "Sure: " + json.dumps([{"start_paragraph": 0, "end_paragraph": 1, "topic": "first"}, {"start_paragraph": 1, "end_paragraph": n, "topic": " "}] if n > 1 else [])
        if prompt.startswith("Propose"):
            return '{"domain": "Small towns", "entity_types": [{"name": "Town"}], "relation_types": [{"name": "near"}]}'
        if prompt.startswith("The answer below"):
            return '{"entities": [{"id": 1, "type": "Town", "name": "Repaired"}], "relations": []}' if "mend me" in prompt else "no"
        if prompt.startswith("Type:"):
            return '[1] {"same": true}'
        if prompt.startswith("Does the text"):
            return '{"verdict": "supported"}'
        text = prompt.rsplit("\n", 1)[1]
        if "broken" in text:
            return "I can't say"
        names = [w for w in text.replace(".", " ").split() if w[0].isupper()]
        entities = [{"id": f"e{i}", "type": "Town" if w != "Xanadu" else "Dream", "name": w, "attributes": {"n": i}, "evidence": w} for i, w in enumerate(names)]
        return json.dumps({"entities": entities, "relations": [{"source_id": "e0", "type": "near", "target_id": f"e{len(names) - 1}", "evidence": "not in the text"}]})

    return reply


def test_steps_with_a_service(spark, tmp_path):
    """Every step that can ask a service does, with replies as they may come."""
    docs = [("good", "Altstadt lies there.\n\nNeuburg is near Altstadt and Xanadu and Neubrug."), ("one", "Altstadt near Neuburg"), ("mend me", "broken mend me"), ("dead", "broken")]
    s = Settings(chunk_mode="llm", resolve_use_llm=True, validate_use_llm=True, resolve_sim_low=0.5, extract_max_retries=1, schema_alias="alias.schema.json")
    service = completion.Rules(small_service(), "rules", "m1")
    runner = graph_plan.Runner(spark, f"file://{tmp_path}/w", s, backends=dict.fromkeys(("chunk", "schema", "extract", "resolve", "validate"), service))
    runner.add_documents(spark.createDataFrame(docs, "base string, text string"))
    runner.run(graph_plan.chosen("chunk", "graph", None))
    chunks = runner.table("chunks").collect()
    assert {(c.base, c.chunk_id, c.variant, c.topic) for c in chunks} == {("good", 0, "llm", "first"), ("good", 1, "llm", None), *((b, 0, "llm_fallback_rule", None) for b in ("one", "mend me", "dead"))}
    assert sorted(p.name for p in (tmp_path / "w" / s.schema_dir).glob("*.json")) == ["Small_towns.schema.json", "alias.schema.json", "current.json"]
    (dead,) = runner.table("errors").collect()
    assert (dead.base, dead.chunk_id, dead.llm_model, dead.repaired_with) == ("dead", 0, "m1", "m1") and dead.error and dead.repair_error
    rows = {(r.base, r.chunk_id): r for r in runner.table("extractions").collect()}
    assert [e.name for e in rows["mend me", 0].entities] == ["Repaired"] and [e.name for e in rows["good", 1].entities] == ["Neuburg", "Altstadt", "Neubrug"]
    entities = {(r.base, r.name): len(r.mentions) for r in runner.table("entities").collect()}
    assert entities == {("good", "Altstadt"): 2, ("good", "Neuburg"): 2, ("one", "Altstadt"): 1, ("one", "Neuburg"): 1, ("mend me", "Repaired"): 1}
    v = {(r.base, r.target): r for r in runner.table("validated").collect()}
    assert {p.llm_support_status for r in v.values() for p in r.provenance} == {"SUPPORTED"} and {p.support_status for r in v.values() for p in r.provenance} == {"UNSUPPORTED"}
    assert {(r.src, r.dst, r.supported) for r in runner.table("edges").collect()} >= {("Town:altstadt", "Town:neuburg", True)}

    runner.export(f"file://{tmp_path}/out")
    names = sorted(p.name for p in (tmp_path / "out").rglob("*.jsonl"))
    assert "good.llm.chunks.jsonl" in names and "dead.llm_fallback_rule.errors.jsonl" in names and "one.llm_fallback_rule.relations.validated.jsonl" in names
    lines = [json.loads(x) for x in (tmp_path / "out" / s.resolve_dir / "good.llm.entities.resolved.jsonl").read_text().splitlines()]
    assert "_meta" in lines[0] and lines[1]["attributes"] == {"n": 0}
    assert runner.export(f"file://{tmp_path}/out") is None  # what is there stays
    back = tables.read_step(spark, f"file://{tmp_path}/out/{s.resolve_dir}", "entities", graph_plan.ENTITY_FILE)
    assert {(r.base, r.name) for r in back.collect()} == {(f"{b}.{'llm' if b == 'good' else 'llm_fallback_rule'}", n) for b, n in entities}
    assert [r.row_pos for r in back.where("base = 'good.llm'").orderBy("row_pos").collect()] == [0, 1]
    assert tables.step_names(spark, f"file://{tmp_path}/out/{s.resolve_dir}", "entities").count() == 3

    # Steps that take the files up from where others left them end alike.
    for step, kind in (("extract", "extractions"), ("resolve", "entities"), ("validate", "validated")):
        taken = graph_plan.Runner(spark, f"file://{tmp_path}/out", s, backends=runner.backends)
        taken.batches.folder = taken.folder = f"file://{tmp_path}/take-{step}"
        taken.at = lambda path: f"file://{tmp_path}/out/{path}"
        taken.schema_file = runner.schema_file
        taken.take_files(step)
        taken.run(["extract", "resolve", "validate"][("extract", "resolve", "validate").index(step) :])
        assert taken.table("validated").count() == runner.table("validated").count()
        assert taken.table(kind).count() == runner.table(kind).count()
    assert (tmp_path / "out" / s.data_processed / "one.txt").read_text().strip() == "Altstadt near Neuburg"

    # A graph from step files is the graph from tables.
    from dataclasses import replace

    files = replace(s, graph_entities_dir=f"file://{tmp_path}/out/{s.resolve_dir}", graph_relations_dir=f"file://{tmp_path}/out/{s.validate_dir}")
    other = graph_plan.Runner(spark, f"file://{tmp_path}/g", files)
    other.graph()
    for name, keys in (("nodes", ["global_id", "type", "mention_count"]), ("edges", ["src", "rel_type", "dst", "support_ratio", "supported"])):
        assert sorted(map(str, other.table(name).select(keys).collect())) == sorted(map(str, runner.table(name).select(keys).collect()))
    # The graph stays and grows, or is cleared.
    extra = spark.createDataFrame([("new", "Nowhere at all. Somewhere else.")], "base string, text string")
    runner.batches.put("pdf", {"documents": extra, "pdf_errors": extra.limit(0)}, extra)
    before = runner.table("nodes").count()
    runner.run(graph_plan.chosen("chunk", "graph", None))
    assert runner.table("nodes").count() == before + 1  # the two names are one entity, says the service


def test_backends():
    env = {"OPENROUTER_API_KEY": "k # secret", "OPENROUTER_MODEL": "m", "OPENROUTER_APP_NAME": "app"}
    b = completion.from_env("openrouter", "", env)
    assert (b.model, b.key, b.headers) == ("m", "k", {"X-Title": "app"}) and b.url.endswith("/chat/completions")
    assert completion.from_env("openrouter", "other", env).model == "other" and completion.from_env("ollama", "m", {}).key is None
    for name, model in (("openrouter", "m"), ("ollama", ""), ("else", "m")):
        with pytest.raises(ValueError):
            completion.from_env(name, model, {})
    runner = graph_plan.Runner(None, "x", Settings(extract_backend="ollama", extract_model="m", schema_backend="rules"), env={})
    assert runner.backend("extract").model == "m" and runner.backend("extract", "repair").model == "repair" and runner.backend("schema") is None
    with pytest.raises(ValueError):
        runner.backend("validate")


def test_recorded_replies(spark):
    """Replies from a table go the same way as those of a service; one that is missing is a dead letter."""
    from docweave.plans import asking

    chunks = spark.createDataFrame([("a", 0, "Altstadt near Neuburg", None), ("b", 0, "broken", "t"), ("c", 0, "not recorded", None)], "base string, chunk_id int, text string, topic string")
    schema = spark.createDataFrame([("{}",)], "text string")
    asked = chunks.select("*", extraction.prompt("extract", F.lit(json.dumps(extraction.compact_schema({}))), F.col("base"), F.col("topic"), F.col("text")).alias("prompt")).where("base <> 'c'").collect()
    kept = spark.createDataFrame([(r.prompt, small_service()(r.prompt)) for r in asked], "prompt string, reply string").select(F.sha2("prompt", 256).alias("prompt_sha256"), "reply")
    good, dead = asking.extractions(chunks, schema, completion.Recorded(kept), None, Settings())
    assert [(r.base, len(r.entities)) for r in good.collect()] == [("a", 2)]
    assert {r.base: r.error for r in dead.collect()} == {"b": "the reply doesn't have the shape asked for", "c": "no recorded reply"}


def test_bad_mentions(spark):
    rows = [("b", 0, 0, 0, "e", "T", "Name", "{}", None), ("b", 0, 1, 0, "f", "T", " ", "{}", None), ("b", 0, 2, 0, " ", "T", "No id", "{}", None)]
    m = spark.createDataFrame(rows, MENTION)
    for resolve in (resolution.exact, resolution.fuzzy):
        assert [r.name for r in resolve(m, strict=False).collect()] == ["Name"]
        with pytest.raises(Exception, match="without type or name"):
            resolve(m).collect()
    assert resolution.fuzzy(m, 0.92, 0, strict=False).count() == 1


def test_case_folding(spark):
    rel = "base string, source string, type string, target string, first_ord int, provenance array<struct<chunk_id:string,evidence_relation:string>>"
    r = spark.createDataFrame([("b", "s", "t", "o", 0, [("1", "ΣΟΦΟΣ ﬁnd STRASSE")])], rel)
    chunks = validation.chunk_texts(spark.createDataFrame([("b", "1", "x σοφος  FIND straße y", 0)], "base string, chunk_id string, text string, row_pos int"))
    assert validation.statuses(r, chunks, exact=True).first().support_status == "SUPPORTED"


@pytest.mark.parametrize("overwrite", [True, False])
def test_graph_sink(spark, tmp_path, overwrite):
    from docweave.sources import graph_sink

    class Kept:
        """A database that only keeps what it is sent, in a file, as tasks run elsewhere."""

        def __init__(self, path):
            self.path = path

        def open(self):
            def run(statement, parameters):
                with open(self.path, "a") as f:
                    f.write(json.dumps([statement, parameters]) + "\n")

            return run, lambda: None

    nodes = spark.createDataFrame([(f"T:{i}", "T", f"n{i}") for i in range(2500)], "global_id string, type string, name string").coalesce(1)
    edges = spark.createDataFrame([(f"T:{i}", ["A", "B"][i % 2], f"T:{i + 1}", 0.5, ["x"]) for i in range(30)], "src string, rel_type string, dst string, support_ratio double, evidence_samples array<string>").coalesce(1)
    graph_sink.write(nodes, edges, Kept(tmp_path / "log"), clear=True, overwrite=overwrite)
    log = [json.loads(x) for x in (tmp_path / "log").read_text().splitlines()]
    assert [x[0] for x in log[:2]] == [graph_sink.UNIQUE, graph_sink.CLEAR]
    sent = [r for s, p in log if s == graph_sink.NODES for r in p["rows"]]
    assert len(sent) == 2500 and sent[0]["properties"] == {"type": "T", "name": "n0"} and max(len(p["rows"]) for s, p in log[2:]) <= graph_sink.BATCH
    typed = [(s, p) for s, p in log if "MATCH (s" in s]
    assert [len(p["rows"]) for _, p in typed] == [15, 15] and {s.partition("[r:")[2][0] for s, _ in typed} == {"A", "B"}
    assert all(("coalesce(r.support_ratio" in s) != overwrite for s, _ in typed)
    with pytest.raises(ValueError):
        graph_sink.Bolt("bolt://x", "u", "", "d")


@pytest.mark.parametrize("overwrite", [True, False])
def test_stream(spark, tmp_path, overwrite):
    """Batch by batch the same as all of them as upserts in turn, before and after layers are merged."""
    from docweave.streaming import graph_stream

    s = Settings(graph_overwrite=overwrite)
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/graph"
    want = {}
    for i, d in enumerate([*DOCS, ("d3", "Alice Smith saw Robert. " * 3)]):
        df = spark.createDataFrame([d], "base string, text string").coalesce(1)
        df.write.mode("append").parquet(source)
        graph_stream.into_graph(graph_stream.documents(spark, source), out, f"file://{tmp_path}/checkpoint", s).start().awaitTermination()
        now = graph_plan.build(df, s)
        for name, keys in graph_stream.KEYS.items():
            want[name] = graph.upserted(want.get(name), getattr(now, name), keys, overwrite or name == "nodes")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    for name in graph_stream.KEYS:
        assert same(graph_stream.read(spark, out, name, overwrite), want[name]) and want[name].count() > 0
        graph_stream.compact(spark, out, name, overwrite)
        assert same(graph_stream.read(spark, out, name, overwrite), want[name])
        assert len(list((tmp_path / "graph" / name).glob("layer=*"))) == 1


ANNOTATED = [
    {"title": "St. Louis", "sents": [["Saint", "Louis", "is", "big"], [" "], ["So", "."]], "vertexSet": [[{"name": " "}], [{"name": "St Louis"}, {"name": "Louis"}, {"name": "Louis"}], [{"name": "Missouri"}]], "labels": [{"r": "in", "h": 0, "t": 1}, {"r": "in", "h": 1, "t": 2}, {"r": " ", "h": 0, "t": 0}, {"r": "x", "h": None, "t": 0}]},
    {"title": None, "sents": None, "vertexSet": None, "labels": None},
    {"title": "late", "sents": [["No"]], "vertexSet": [], "labels": []},
]


def test_evaluation_plan(spark, tmp_path):
    from docweave.plans import evaluation_plan

    (tmp_path / "dev.json").write_text(json.dumps(ANNOTATED, indent=1))
    at = lambda name: f"file://{tmp_path}/{name}"
    evaluation_plan.main(["prepare", "--input", at("dev.json"), "--n", "2", "--processed-dir", at("texts"), "--gold-out", at("gold/g.jsonl"), "--schema-out", at("schema.json")])
    assert {p.name: p.read_text().strip() for p in (tmp_path / "texts").glob("*.txt")} == {"docred_0000_St._Louis.txt": "Saint Louis is big\nSo .", "docred_0001_doc_1.txt": ""}
    rows = [json.loads(x) for x in (tmp_path / "gold" / "g.jsonl").read_text().splitlines()]
    assert [r["doc_id"] for r in rows] == ["docred_0000_St._Louis", "docred_0001_doc_1"]
    assert rows[0]["entities"] == [{"eid": "E1", "name": "Louis", "type": "Entity"}, {"eid": "E2", "name": "Missouri", "type": "Entity"}]
    assert rows[0]["relations"] == [{"source_name": "Louis", "type": "in", "target_name": "Missouri"}] and rows[1]["entities"] == []
    assert [r["name"] for r in json.loads((tmp_path / "schema.json").read_text())["relation_types"]] == ["in"]

    # Outputs are found by what their names have before the first dot, so a title with a dot has no gold.
    gold_rows = [{"doc_id": "a", "title": "", "entities": [{"eid": "E0", "name": "Old", "type": ""}], "relations": []}, {"doc_id": "a", "title": "", "entities": [{"eid": "E0", "name": "X  y", "type": ""}, {"eid": "E1", "name": "Z", "type": ""}], "relations": [{"source_name": "x y", "type": "r", "target_name": "z"}]}]
    (tmp_path / "gold2.jsonl").write_text("\n".join(map(json.dumps, gold_rows)))
    head = json.dumps({"_meta": {}})

    def put(base, entities, relations):
        (tmp_path / "r").mkdir(exist_ok=True)
        (tmp_path / "r" / f"{base}.entities.resolved.jsonl").write_text("\n".join([head, *map(json.dumps, entities)]) + "\n")
        (tmp_path / "r" / f"{base}.relations.resolved.jsonl").write_text("\n".join([head, *map(json.dumps, relations)]) + "\n")

    put("a.rule", [{"global_id": "1", "name": "first"}, {"global_id": " 1", "name": "X 'y'"}, {"global_id": "2", "name": "W"}], [{"source": "1", "type": "r", "target": "2"}, {"source": "1", "type": "r", "target": "9"}])
    put("a.llm", [], [])
    put("b.rule", [{"global_id": "1", "name": "q"}], [])
    (tmp_path / "r" / "c.relations.resolved.jsonl").write_text(head + "\n")  # without entities it doesn't count
    got = evaluation_plan.evaluate(spark, at("gold2.jsonl"), at("r"), at("out/metrics.json"))
    assert (got["meta"]["evaluated_docs"], got["meta"]["missing_gold_docs"]) == (2, 1)
    assert got["ner_counts"] == {"tp": 1, "fp": 1, "fn": 3} and got["re_counts"] == {"tp": 0, "fp": 1, "fn": 2}
    assert got["ner"] == {"precision": 0.5, "recall": 0.25, "f1": 0.3333} and json.loads((tmp_path / "out" / "metrics.json").read_text()) == got
    with pytest.raises(Exception):
        evaluation_plan.evaluate(spark, at("gold2.jsonl"), at("nothing"), at("m.json"))
    (tmp_path / "gold3.jsonl").write_text('{"title": "no id"}')
    with pytest.raises(Exception, match="without doc_id"):
        evaluation_plan.read_gold(spark, at("gold3.jsonl")).collect()


def test_shared_folder(spark, tmp_path):
    """Tables of a block go at its end, others stay; without a shared folder only a local session gets one of its own."""
    import os
    from urllib.parse import urlparse

    from docweave.sources import shared

    there = lambda df: os.path.exists(urlparse(df._docweave_path).path)
    a = shared.stored(spark.range(3), "a")
    with shared.temporaries(spark):
        b = shared.stored(spark.range(4), "b")
        with shared.temporaries(spark):
            c = shared.stored(spark.range(5), "c")
        assert there(b) and not there(c) and b.count() == 4
    assert there(a) and not there(b)
    shared.discard(a)
    assert not there(a)

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared.shared_folder(Elsewhere)
