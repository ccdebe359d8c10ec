"""Evaluation as a user runs it: an annotated collection made ready, and step outputs scored against its gold standard."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation
from ..sources import tables

#: Annotated documents: tokens of sentences, mentions of each vertex, labelled relations between vertices.
ANNOTATED = "array<struct<title:string,sents:array<array<string>>,vertexSet:array<array<struct<name:string>>>,labels:array<struct<r:string,h:int,t:int>>>>"
#: How ids of documents and the domain of a prepared collection begin and are called, and what a gold row holds.
ID_START, DOMAIN = "docred_", "DocRED_Subset"
GOLD = "doc_id string, title string, entities array<struct<eid:string,name:string,type:string>>, relations array<struct<source_name:string,type:string,target_name:string>>"


def annotated(spark: SparkSession, path: str, n: int = 0) -> DataFrame:
    """(pos, doc_id, title, sents, vertexSet, labels) of a file that is one list of annotated documents, the first n if positive."""
    x = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", ANNOTATED, {"mode": "FAILFAST"})).alias("pos", "d")).select("pos", "d.*")
    title = F.coalesce("title", F.concat(F.lit("doc_"), "pos"))
    number = F.when(F.col("pos") < 10_000, F.lpad(F.col("pos").cast("string"), 4, "0")).otherwise(F.col("pos").cast("string"))
    x = x.withColumn("title", title).withColumn("doc_id", F.concat(F.lit(ID_START), number, F.lit("_"), T.file_name(F.col("title"))))
    return evaluation.subset(x, n) if n else x


def gold(docs: DataFrame) -> DataFrame:
    """(doc_id, title, entities, relations, pos) of annotated(): vertices with their canonical names, and labels between those that have one.

    A label's numbers count the vertices that have a name, in order.
    """
    vertices = docs.select(F.col("doc_id").alias("doc"), F.posexplode("vertexSet").alias("vertex", "mentions"))
    mentions = vertices.select("doc", "vertex", F.posexplode("mentions").alias("pos", "m")).select("doc", "vertex", "pos", F.col("m.name").alias("name"))
    names = evaluation.canonical_names(mentions)
    entity = F.struct("vertex", F.struct(F.concat(F.lit("E"), "vertex").alias("eid"), "name", F.lit("Entity").alias("type")).alias("e"))
    entities = names.groupBy("doc").agg(F.array_sort(F.collect_list(entity)).alias("e")).select("doc", F.transform("e", lambda x: x["e"]).alias("entities"))
    labels = docs.select(F.col("doc_id").alias("doc"), F.posexplode("labels").alias("pos", "l")).select("doc", "pos", "l.*")
    found = evaluation.gold_relations(labels, names).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("source_name", "type", "target_name").alias("r")))).alias("r"))
    relations = found.select("doc", F.transform("r", lambda x: x["r"]).alias("relations"))
    out = docs.select(F.col("doc_id").alias("doc"), "title", "pos").join(entities, "doc", "left").join(relations, "doc", "left")
    kinds = dict(zip(("entities", "relations"), ("array<struct<eid:string,name:string,type:string>>", "array<struct<source_name:string,type:string,target_name:string>>")))
    return out.select(F.col("doc").alias("doc_id"), "title", *[F.coalesce(c, F.array().cast(k)).alias(c) for c, k in kinds.items()], "pos")


def prepare(spark: SparkSession, source: str, n: int, texts: str, gold_out: str, schema_out: str, overwrite: bool = True) -> None:
    """Writes the first n documents' texts, their gold standard as one file of JSON lines, and a schema of their relations."""
    docs = annotated(spark, source, max(1, n))
    tables.write_files(docs.select(F.col("doc_id").alias("file"), evaluation.sentences_text(F.coalesce("sents", F.array().cast("array<array<string>>"))).alias("line")), texts, ".txt", [], overwrite)
    standard = gold(docs)
    folder, _, name = gold_out.rpartition("/")
    line = F.to_json(F.struct("doc_id", "title", "entities", "relations"), {"ignoreNullFields": "false"})
    tables.write_files(standard.select(F.lit(name).alias("file"), line.alias("line"), "pos"), folder, "", ["pos"], overwrite)
    names = evaluation.vocabulary(standard.select(F.explode("relations").alias("r")).select("r.type"))
    kinds = [{"name": r.name, "description": "", "source_type": "Entity", "target_type": "Entity", "examples": []} for r in names.collect()]  # relation types of a schema
    value = {"domain": DOMAIN, "entity_types": [{"name": "Entity", "description": "", "attributes": [], "examples": []}], "relation_types": kinds}
    tables.write_document(spark, value, schema_out, overwrite)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, entities, relations): of rows with one doc_id the last; a row without one is an error."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    x = spark.read.schema(GOLD).option("mode", "FAILFAST").json(path).select("*", place.alias("place"))
    x = x.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("doc_id")).otherwise(F.raise_error(F.lit("gold row without doc_id")).cast("string")))
    return x.groupBy("doc_id").agg(F.max_by(F.struct("entities", "relations"), "place").alias("last")).select("doc_id", "last.*")


def scored(names: DataFrame, entities: DataFrame, relations: DataFrame, standard: DataFrame) -> DataFrame:
    """One row (evaluated_docs, missing_gold_docs, ner struct, relation_extraction struct) of step outputs against a gold standard.

    names (base) are the outputs that count, whether they have rows or not;
    entities (base, global_id, name, row_pos) and relations (base, source,
    type, target) are theirs; standard is read_gold().  Several outputs for
    one document are scored each.
    """
    of = names.select(F.col("base").alias("doc"), T.before_dot(F.col("base")).alias("doc_id"))
    counted = of.join(standard.select("doc_id"), "doc_id", "left_semi").select("doc")
    missing = of.join(standard.select("doc_id"), "doc_id", "left_anti").select("doc")
    wanted = of.join(standard, "doc_id")
    e = entities.select(F.col("base").alias("doc"), "global_id", "name", F.col("row_pos").alias("pos"))
    r = relations.select(F.col("base").alias("doc"), *[T.strip(F.col(c)).alias(c) for c in ("source", "type", "target")])
    # Of rows with one id the last counts, for names as for triples.
    kept = e.where("trim(coalesce(global_id, '')) <> '' and trim(coalesce(name, '')) <> ''").groupBy("doc", T.strip(F.col("global_id")).alias("gid")).agg(F.max_by("name", "pos").alias("name"))
    g_names = wanted.select("doc", F.explode("entities").alias("x")).select("doc", "x.name")
    g_triples = wanted.select("doc", F.explode("relations").alias("x")).select("doc", "x.*")
    tallies = (
        ("ner", evaluation.counts(evaluation.name_set(kept), evaluation.name_set(g_names), counted)),
        ("relation_extraction", evaluation.counts(evaluation.triple_set(evaluation.predicted_triples(r, e)), evaluation.triple_set(g_triples), counted)),
    )
    out = evaluation.doc_counts(counted, missing).withColumn("one", F.lit(1))
    for kind, tally in tallies:
        scores = evaluation.scores(tally)
        out = out.join(scores.select(F.lit(1).alias("one"), F.struct(*scores.columns).alias(kind)), "one")
    return out.drop("one")


def evaluate(spark: SparkSession, gold_path: str, resolved: str, out: str) -> dict:
    """Scores the resolved step files of a folder and writes the figures as one JSON document."""
    entities = tables.read_step(spark, resolved, "entities", "global_id string, name string")
    relations = tables.read_step(spark, resolved, "relations", "source string, type string, target string")
    names = tables.step_names(spark, resolved, "relations")
    if names.isEmpty():
        raise FileNotFoundError(f"no resolved relations in {resolved}")
    names = names.join(tables.step_names(spark, resolved, "entities"), "base", "left_semi")
    (row,) = scored(names, entities, relations, read_gold(spark, gold_path)).collect()
    pick = lambda r, *keys: {k: r[k] for k in keys}
    value = {
        "meta": {"gold": gold_path, "resolved_dir": resolved, "evaluated_docs": row.evaluated_docs, "missing_gold_docs": row.missing_gold_docs},
        "ner_counts": pick(row.ner, "tp", "fp", "fn"), "re_counts": pick(row.relation_extraction, "tp", "fp", "fn"),
        "ner": pick(row.ner, "precision", "recall", "f1"), "relation_extraction": pick(row.relation_extraction, "precision", "recall", "f1"),
    }
    tables.write_document(spark, value, out, True)
    return value


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Prepare an annotated collection, or evaluate step outputs against it")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("prepare")
    p.add_argument("--input", required=True)
    p.add_argument("--n", type=int, default=100)
    p.add_argument("--processed-dir", default="data/processed/docred")
    p.add_argument("--gold-out", default="data/docred/subset/docred_100.gold.jsonl")
    p.add_argument("--schema-out", default="data/schemas/docred_100.schema.json")
    e = commands.add_parser("evaluate")
    for name in ("gold", "resolved-dir", "out"):
        e.add_argument(f"--{name}", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("docweave").getOrCreate()
    if a.command == "prepare":
        prepare(spark, a.input, a.n, a.processed_dir, a.gold_out, a.schema_out)
    else:
        print(json.dumps(evaluate(spark, a.gold, a.resolved_dir, a.out), indent=2))


if __name__ == "__main__":
    main()
