"""Documents to a validated graph, as one plan, and its steps over stored tables."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, completion, extraction, graph, resolution, validation
from ..sources import documents, graph_sink, tables
from ..sources.settings import Settings, one_of
from ..sources.shared import stored
from . import asking

#: Types of the rule backend that its schema allows.
ENTITY_TYPES, RELATION_TYPES = ("Person", "Group", "Place"), ("knows", "located in")


def names(spark: SparkSession, values: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "name string")


class Graph:
    """The whole plan over docs (base, text), each part made when it is first asked for.

    Extractions and mentions, which several branches read, are stored then, so
    that texts are scanned for them once; all else is as lazy as DataFrames
    are.  Asking for checked before extractions, and for mentions before
    validated, spares another scan where both are asked for.  extract turns
    chunks into extraction rows.  fuzzy: names that differ little are one
    entity, as in the steps; without it only equal ones.
    """

    def __init__(self, docs: DataFrame, settings: Settings, extract: Callable[[DataFrame], DataFrame], entity_types: DataFrame | None, relation_types: DataFrame | None, fuzzy: bool):
        self.docs, self.settings, self.extract, self.entity_types, self.relation_types, self.fuzzy = docs, settings, extract, entity_types, relation_types, fuzzy

    @cached_property
    def chunks(self) -> DataFrame:
        s = self.settings
        return chunking.rule_chunks(chunking.clean(self.docs, s.chunk_max_doc_chars), s.chunk_size, s.chunk_overlap, s.chunk_max_chunks)

    def _found(self, checked: bool = False) -> DataFrame:
        """Extractions; checked: their relations have support_status."""
        spark, s = self.docs.sparkSession, self.settings
        chunks = extraction.first_rows(self.chunks, s.extract_max_chunks, "chunk_id")
        if not checked:
            found = self.extract(chunks)
        elif self.extract is extraction.mentions_by_rule:
            found = self.extract(chunks, carried=("text",))
        else:
            texts = validation.chunk_texts(self.chunks.withColumn("row_pos", F.col("chunk_id"))).withColumnRenamed("chunk_id", "_chunk")
            found = self.extract(chunks).withColumn("_chunk", F.col("chunk_id").try_cast("int")).join(texts, ["base", "_chunk"], "left").drop("_chunk")
        if s.extract_strict:
            pick = lambda given, values: given if given is not None else names(spark, values)
            found = extraction.filter_to_schema(found, pick(self.entity_types, ENTITY_TYPES), pick(self.relation_types, RELATION_TYPES))
        return validation.with_status(found, s.validate_case_insensitive) if checked else found

    @cached_property
    def extractions(self) -> DataFrame:
        return stored(self._found(), "extractions")

    @cached_property
    def checked(self) -> DataFrame:
        """Extractions whose relations have support_status; they do for extractions that weren't asked for before."""
        found = stored(self._found(checked=True), "extractions")
        self.__dict__.setdefault("extractions", found)
        return found

    @cached_property
    def mentions(self) -> DataFrame:
        s, all_ = self.settings, extraction.entities(self.extractions)
        return stored(resolution.resolved(resolution.fuzzy(all_, s.resolve_sim_high, s.resolve_max_candidates) if self.fuzzy else resolution.exact(all_)), "mentions")

    @cached_property
    def entities(self) -> DataFrame:
        return resolution.entities(self.mentions)

    @cached_property
    def relations(self) -> DataFrame:
        return resolution.relations(extraction.relations(self.extractions), self.mentions)

    @cached_property
    def located(self) -> DataFrame:
        """Relations with their ends and support_status, before equal ones become one; nothing is stored for them alone."""
        if self.fuzzy or "mentions" in self.__dict__:
            return resolution.located(self.checked, self.mentions)
        return resolution.located(self._found(checked=True))

    @cached_property
    def validated(self) -> DataFrame:
        return validation.validated_rows(self.located, self.settings.validate_max_relations, self.settings.validate_max_provenances)

    @cached_property
    def nodes(self) -> DataFrame:
        return graph.nodes(self.entities, self.settings.graph_max_mention_samples)

    @cached_property
    def node_ids(self) -> DataFrame:
        """Ids of nodes: those of all mentions, as each has a type and a name."""
        return self.mentions.select("global_id").distinct()

    @cached_property
    def edges(self) -> DataFrame:
        s, ids = self.settings, self.checked and self.node_ids
        return graph.edges(graph.with_support(self.validated, s.graph_min_support_ratio, s.graph_accept_llm_supported), ids, s.graph_overwrite, s.graph_max_provenance)


def build(docs: DataFrame, settings: Settings = Settings(), extract: Callable[[DataFrame], DataFrame] = extraction.mentions_by_rule, entity_types: DataFrame | None = None, relation_types: DataFrame | None = None, fuzzy: bool = True) -> Graph:
    return Graph(docs, settings, extract, entity_types, relation_types, fuzzy)


STEPS = ("pdf", "chunk", "schema", "extract", "resolve", "validate", "graph")
#: Tables of a step's batches.
TABLES = {"pdf": ("documents", "pdf_errors"), "chunk": ("chunks",), "extract": ("extractions", "errors"), "resolve": ("relations", "entities"), "validate": ("validated",)}
CHUNK = ["base", "chunk_id", "char_start", "char_end", "text", "chunk_method", "variant", "segment_id", "para_start", "para_end", "topic"]


def chosen(first: str | None, last: str | None, only: str | None) -> list[str]:
    """Steps to run; ``only`` wins over the range."""
    if only:
        return [STEPS[STEPS.index(only)]]
    a, b = STEPS.index(first or STEPS[0]), STEPS.index(last or STEPS[-1])
    if a > b:
        raise ValueError("the first step comes after the last one")
    return list(STEPS[a : b + 1])


class Runner:
    """Runs steps over Parquet tables in a folder; what a step has done already it leaves alone, unless overwritten.

    backends: what to ask in a step, by its name, in place of the service that
    the settings name; ``rules`` there means no service.  only: bases to
    which a run is limited, all if empty.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: Settings, overwrite: bool = False, backends: Mapping[str, completion.Backend] | None = None, env: Mapping[str, str] | None = None, only: tuple[str, ...] = (), sink: graph_sink.Sink | None = None):
        self.spark, self.folder, self.settings, self.overwrite, self.backends, self.env, self.only, self.sink = spark, folder, settings, overwrite, backends or {}, env, only, sink
        self.batches = tables.Batches(spark, folder)

    def backend(self, step: str, model: str | None = None) -> completion.Backend | None:
        """What a step asks; None for rules."""
        if step in self.backends:
            return self.backends[step]
        name = getattr(self.settings, f"{step}_backend")
        return None if name == "rules" else completion.from_env(name, model if model is not None else getattr(self.settings, f"{step}_model", ""), self.env)

    def table(self, name: str) -> DataFrame:
        """A step's table; for nodes and edges the graph as it is."""
        step = next((k for k, names_ in TABLES.items() if name in names_), None)
        return self.batches.read(step, name) if step else self.spark.read.parquet(f"{self.folder}/{name}")

    def add_documents(self, docs: DataFrame) -> None:
        """Documents (base, text) from elsewhere, as if read from PDF files."""
        none = docs.limit(0).select("base", F.lit("").alias("path"), F.lit("").alias("error"))
        self.batches.put("pdf", {"documents": docs, "pdf_errors": none}, docs)

    def todo(self, df: DataFrame, step: str) -> DataFrame:
        if self.overwrite or getattr(self.settings, f"{step}_overwrite", False):
            self.batches.reset(step, TABLES[step])
        left = self.batches.missing(df, step)
        return left.where(F.col("base").isin(list(self.only))) if self.only else left

    def pdf(self) -> None:
        s = self.settings
        read = documents.pdf_texts(documents.pdf_files(self.spark, s.data_raw), s.pdf_engine, s.pdf_max_pages, s.pdf_min_chars)
        # Files of one stem in different folders stay apart by a hash of their path.
        stem = documents.stem(F.col("path"))
        base = F.concat_ws("-", stem, F.substring(F.sha2(F.col("path").cast("binary"), 256), 1, 8))
        found = stored(self.todo(read.withColumn("base", base), "pdf"), "pdf")
        good = found.where("text is not null").drop("error").withColumns({"extracted_at": asking.T.utc_now(), "max_pages": F.lit(s.pdf_max_pages), "min_chars": F.lit(s.pdf_min_chars)})
        # A file that failed isn't done: the next run tries it again.
        self.batches.put("pdf", {"documents": good, "pdf_errors": found.where("text is null").select("base", "path", "error")}, good)

    def chunk(self) -> None:
        s = self.settings
        docs = self.todo(self.table("documents").select("base", "text"), "chunk")
        if s.chunk_mode not in ("rule", "llm"):
            raise ValueError(f"unknown chunk mode: {s.chunk_mode}")
        clean = chunking.clean(docs, s.chunk_max_doc_chars)
        if s.chunk_mode == "llm":
            backend = self.backend("chunk", "")
            if backend is None:
                raise ValueError("chunk mode llm needs a backend")
            clean = stored(clean, "clean")
            found = chunking.routed(clean, asking.segments(clean, backend, s), s.chunk_max_paragraphs, s.chunk_subchunk_size, s.chunk_subchunk_overlap, s.chunk_subchunks, (s.chunk_size, s.chunk_overlap), s.chunk_max_chunks)
        else:
            none = {c: F.lit(None).cast(t) for c, t in (("segment_id", "int"), ("para_start", "int"), ("para_end", "int"), ("topic", "string"))}
            found = chunking.rule_chunks(clean, s.chunk_size, s.chunk_overlap, s.chunk_max_chunks).withColumns({"variant": F.lit("rule"), **none})
        self.batches.put("chunk", {"chunks": found.select(*CHUNK)}, docs)

    def at(self, path: str) -> str:
        """A path of the settings, within the folder unless it is a whole one."""
        return path if "://" in path or path.startswith("/") else f"{self.folder}/{path}"

    def schema_file(self) -> str:
        return self.settings.extract_schema or f"{self.at(self.settings.schema_dir)}/current.json"

    def schema(self) -> None:
        """Writes the domain's schema, a copy under the alias, and one under the name that extraction looks for."""
        s = self.settings
        again = self.overwrite or s.schema_overwrite
        if tables.exists(self.spark, f"{self.at(s.schema_dir)}/current.json") and not again:
            return
        sample = documents.sample(self.table("documents").select("base", "text"), s.schema_sample_docs, s.schema_max_chars)
        backend = self.backend("schema")
        value = asking.schema(sample, backend, s) if backend else {"domain": "Rules", "entity_types": [{"name": n} for n in ENTITY_TYPES], "relation_types": [{"name": n} for n in RELATION_TYPES]}
        path = tables.schema_path(self.at(s.schema_dir), str(value.get("domain", "schema")))
        tables.write_document(self.spark, value, path, again)
        for name in filter(None, (s.schema_alias, "current.json")):
            tables.copy_file(self.spark, path, name)

    def types(self, field: str) -> DataFrame:
        kind = "array<struct<name:string>>"
        x = tables.read_document(self.spark, self.schema_file(), f"domain string, entity_types {kind}, relation_types {kind}")
        return x.select(F.explode(field).alias("t")).select("t.name")

    def extract_(self) -> None:
        s = self.settings
        chunks = self.todo(self.table("chunks"), "extract")
        some = extraction.first_rows(chunks, s.extract_max_chunks, "chunk_id")
        backend = self.backend("extract")
        if backend:
            document = self.spark.read.text(self.schema_file(), wholetext=True).select(F.col("value").alias("text"))
            repairer = (self.backend("extract", s.extract_repair_model or None)) if s.extract_repair and not isinstance(backend, completion.Recorded) else None
            found, dead = asking.extractions(some, document, backend, repairer, s)
        else:
            found = extraction.mentions_by_rule(some).withColumns({"llm_backend": F.lit("rules"), "llm_model": F.lit("none"), "llm_temperature": F.lit(0.0), "extracted_at": asking.T.utc_now()})
            dead = found.limit(0).select("base", "chunk_id", F.lit("").alias("error"))
        kept = extraction.filter_to_schema(found, self.types("entity_types"), self.types("relation_types")) if s.extract_strict else found
        self.batches.put("extract", {"extractions": kept, "errors": dead}, chunks)

    def resolve(self) -> None:
        s = self.settings
        found = self.todo(self.table("extractions"), "resolve")
        mentions = extraction.entities(found)
        if s.resolve_use_llm:
            backend = self.backend("resolve")
            mentions = resolution.adjudicated(mentions, asking.judge(backend, s.resolve_temperature, s.resolve_sleep_sec), s.resolve_sim_high, s.resolve_sim_low)
        else:
            mentions = resolution.fuzzy(mentions, s.resolve_sim_high, s.resolve_max_candidates)
        mentions = stored(resolution.resolved(mentions), "mentions")
        self.batches.put("resolve", {"relations": resolution.relations(extraction.relations(found), mentions), "entities": resolution.entities(mentions)}, found)

    def validate(self) -> None:
        s = self.settings
        rows = self.todo(self.table("relations"), "validate")
        chunks = self.table("chunks")
        lost = [r.base for r in validation.unmatched(rows, chunks).limit(5).collect()]
        if lost:
            raise FileNotFoundError(f"relations without any chunk: {lost}")
        texts = validation.chunk_texts(chunks.withColumn("row_pos", F.col("chunk_id")))
        found = validation.statuses(rows, texts, s.validate_case_insensitive, s.validate_max_relations, s.validate_max_provenances, exact=True)
        if s.validate_use_llm:
            found = asking.verdicts(stored(found, "statuses"), self.backend("validate"), s)
        self.batches.put("validate", {"validated": validation.validated(found)}, rows)

    def graph_sources(self) -> tuple[DataFrame, DataFrame]:
        """Entities and validated relations: from step files if settings name any, from the steps' tables if not."""
        s = self.settings
        if not any((s.graph_entities_dir, s.graph_entities_file, s.graph_relations_dir, s.graph_relations_file)):
            return self.table("entities"), self.table("validated")
        order = F.struct(F.col("row_pos"), F.lit(0).alias("rel_pos"))
        read = lambda folder, file, kind, schema: tables.read_step(self.spark, one_of(folder, file, kind), kind, schema).withColumn("first_ord", order)
        return read(s.graph_entities_dir, s.graph_entities_file, "entities", ENTITY_FILE), read(s.graph_relations_dir, s.graph_relations_file, "validated", VALIDATED_FILE)

    def graph(self) -> None:
        """Upserts all entities and relations into the graph's tables, cleared before if so set, and into a sink if there is one."""
        s = self.settings
        entities, relations = self.graph_sources()
        found = stored(graph.nodes(entities, s.graph_max_mention_samples), "nodes")
        passed = graph.with_support(relations, s.graph_min_support_ratio, s.graph_accept_llm_supported)
        for name, keys, make, wins in (("nodes", ["global_id"], lambda: found, True), ("edges", ["src", "rel_type", "dst"], lambda: graph.edges(passed, self.table("nodes"), s.graph_overwrite, s.graph_max_provenance), s.graph_overwrite)):
            path = f"{self.folder}/{name}"
            old = self.spark.read.parquet(path) if tables.exists(self.spark, path) and not s.graph_clear else None
            tables.replace(graph.upserted(old, make(), keys, wins), path)
        if not graph.duplicate_ids(self.table("nodes")).isEmpty():
            raise RuntimeError("the graph has nodes of one id")
        self.counters = graph.counters(passed, self.table("nodes"))
        if self.sink:
            graph_sink.write(self.table("nodes"), self.table("edges"), self.sink, s.graph_clear, s.graph_overwrite)

    def export(self, folder: str) -> None:
        """Step files of all that the steps have done: one a document and kind, named as settings say.

        A document's files bear its chunks' variant, so that rule and semantic
        chunks of one document stay apart.
        """
        s, spark, again = self.settings, self.spark, self.overwrite
        suffix = F.when(F.col("variant") == "rule", s.chunk_suffix_rule).when(F.col("variant") == "llm", s.chunk_suffix_llm).when(F.col("variant").isNotNull(), s.chunk_suffix_fallback)
        chunks = self.table("chunks")
        name = F.concat_ws(".", "base", suffix)
        called = chunks.groupBy("base").agg(F.first("variant").alias("variant")).select("base", name.alias("called"))
        under = lambda df: df.join(called, "base").withColumn("document_title", F.col("base").cast("string")).withColumn("base", F.col("called")).drop("called")
        attributes = F.expr("try_parse_json(attributes)").alias("attributes")
        done = self.batches.committed
        if done("pdf"):
            docs = self.table("documents").withColumn("file", F.col("base").cast("string"))
            tables.write_files(docs.select("file", F.col("text").alias("line")), f"{folder}/{s.data_processed}", ".txt", [], again)
            meta = F.to_json(F.struct(*[c for c in docs.columns if c not in ("file", "text")]), {"ignoreNullFields": "false"})
            tables.write_files(docs.select("file", meta.alias("line")), f"{folder}/{s.data_processed}", ".meta.json", [], again)
        tables.write_step(under(chunks.drop("variant")), f"{folder}/{s.chunk_dir}", "chunks", ["chunk_id"], overwrite=again)
        if done("extract"):
            e = self.table("extractions").withColumn("entities", F.transform("entities", lambda x: F.struct(x["id"].alias("id"), x["type"].alias("type"), x["name"].alias("name"), F.call_function("try_parse_json", x["attributes"]).alias("attributes"), x["evidence"].alias("evidence"))))
            tables.write_step(under(e.drop("row_pos")), f"{folder}/{s.extract_dir}", "extractions", ["chunk_id"], overwrite=again)
            tables.write_step(under(self.table("errors")), f"{folder}/{s.extract_errors}", "errors", ["chunk_id"], overwrite=again)
        header = {"sim_high": s.resolve_sim_high, "sim_low": s.resolve_sim_low, "use_llm": s.resolve_use_llm}
        if done("resolve"):
            x = self.table("entities").select("base", "global_id", "type", "name", attributes, "mentions", "first_ord")
            tables.write_step(under(x), f"{folder}/{s.resolve_dir}", "entities", ["first_ord"], header, again)
            tables.write_step(under(self.table("relations")), f"{folder}/{s.resolve_dir}", "relations", ["first_ord"], header, again)
        if done("validate"):
            tables.write_step(under(self.table("validated")), f"{folder}/{s.validate_dir}", "validated", ["first_ord"], header, again)

    def take_files(self, step: str) -> None:
        """Step files in the folders that settings name, as what the steps before ``step`` have done."""
        s, spark = self.settings, self.spark
        read = lambda folder, kind, schema: tables.read_step(spark, self.at(folder), kind, schema)
        folder = s.extract_input if step == "extract" else s.validate_chunks
        if step != "resolve" or tables.exists(spark, self.at(folder)):  # resolution itself needs none
            chunks = read(folder, "chunks", CHUNK_FILE).withColumn("variant", F.lit(None).cast("string"))
            self.batches.put("chunk", {"chunks": chunks.select(*CHUNK)}, chunks)
        if step == "resolve":
            found = read(s.resolve_input, "extractions", EXTRACTION_FILE)
            self.batches.put("extract", {"extractions": found, "errors": found.limit(0).select("base", "chunk_id", F.lit("").alias("error"))}, found)
        if step == "validate":
            order = F.struct(F.col("row_pos"), F.lit(0).alias("rel_pos"))
            relations = read(s.validate_input, "relations", RELATION_FILE).withColumn("first_ord", order).drop("row_pos")
            entities = read(s.validate_input, "entities", ENTITY_FILE).withColumn("first_ord", order).drop("row_pos")
            self.batches.put("resolve", {"relations": relations, "entities": entities}, relations.select("base").unionByName(entities.select("base")))

    def run(self, steps: list[str]) -> None:
        for step in steps:
            getattr(self, "extract_" if step == "extract" else step)()


#: What step files hold, of what the steps read.
CHUNK_FILE = "chunk_id int, char_start int, char_end int, text string, chunk_method string, segment_id int, para_start int, para_end int, topic string"
EXTRACTION_FILE = f"chunk_id int, entities {asking.replies.ENTITIES}, relations {asking.replies.RELATIONS}"
RELATION_FILE = "source string, type string, target string, provenance array<struct<chunk_id:int,evidence_relation:string>>"
ENTITY_FILE = "global_id string, type string, name string, attributes string, mentions array<struct<chunk_id:int,local_entity_id:string,evidence_entity:string>>"
VALIDATED_FILE = "source string, type string, target string, provenance array<struct<chunk_id:int,evidence_relation:string,support_status:string,llm_support_status:string>>, validation struct<supported:bigint,unsupported:bigint,unknown:bigint,support_ratio:double>"


def main(args: list[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(description="Documents to a validated graph")
    parser.add_argument("folder")
    for name in ("from-step", "to-step", "only"):
        parser.add_argument(f"--{name}", choices=STEPS)
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--mode", choices=("rule", "llm"), help="how to chunk, in place of CHUNK_MODE")
    parser.add_argument("--file", action="append", default=[], help="base of a document to limit the steps to; may be given again")
    parser.add_argument("--clear-db", action="store_true", help="start with an empty graph")
    parser.add_argument("--export", metavar="FOLDER", help="write step files there when the steps are done")
    parser.add_argument("--texts", metavar="FOLDER", help="take the .txt files there as documents, in place of PDF files")
    parser.add_argument("--take-files", action="store_true", help="take step files in the folders that the settings name as input of the first step")
    parser.add_argument("--sink", action="store_true", help="write the graph to the graph database that the settings name, too")
    a = parser.parse_args(args)
    steps = chosen(a.from_step, a.to_step, a.only)
    if not a.dry_run:
        s = Settings.from_env()
        s = replace(s, chunk_mode=a.mode or s.chunk_mode, graph_clear=a.clear_db or s.graph_clear)
        sink = graph_sink.Bolt(s.graph_uri, s.graph_user, s.graph_password, s.graph_database) if a.sink else None
        runner = Runner(SparkSession.builder.appName("docweave").getOrCreate(), a.folder, s, a.overwrite, env=os.environ, only=tuple(a.file), sink=sink)
        logging.basicConfig(level=s.log_level.upper())
        if a.texts:
            runner.add_documents(documents.text_files(runner.spark, a.texts))
        if a.take_files:
            runner.take_files(steps[0])
        runner.run([x for x in steps if not (a.texts and x == "pdf")])
        if a.export:
            runner.export(a.export)
    return steps


if __name__ == "__main__":
    print("\n".join(main()))
