"""Evaluation: gold standard from annotated documents, and micro-averaged precision, recall and F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def sentences_text(sents: Column) -> Column:
    """array<array<string>> as text: tokens joined by spaces, blank lines dropped, lines joined by line ends."""
    lines = F.transform(sents, lambda s: T.strip(F.array_join(s, " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def canonical_names(mentions: DataFrame) -> DataFrame:
    """(doc, vertex, name): the most frequent stripped name of mentions (doc, vertex, pos, name), the earliest on ties; blank ones don't count."""
    x = mentions.withColumn("name", T.strip(F.col("name"))).where("name <> ''")
    x = x.groupBy("doc", "vertex", "name").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    return x.groupBy("doc", "vertex").agg(F.max_by("name", F.struct("n", -F.col("first"))).alias("name"))


def gold_relations(labels: DataFrame, names: DataFrame, shift: bool = True) -> DataFrame:
    """(doc, source_name, type, target_name) of labels (doc, pos, r, h, t).

    names are canonical_names().  With shift, indices count the vertices that
    have a name, in order; without, they are vertex numbers as annotated.
    """
    place = F.row_number().over(Window.partitionBy("doc").orderBy("vertex")) - 1 if shift else F.col("vertex")
    at = names.select("doc", place.cast("long").alias("at"), "name")
    x = labels.select("doc", "pos", T.strip(F.col("r")).alias("type"), "h", "t").where("type <> '' and h is not null and t is not null")
    x = x.join(at.select("doc", F.col("at").alias("h"), F.col("name").alias("source_name")), ["doc", "h"]).join(at.select("doc", F.col("at").alias("t"), F.col("name").alias("target_name")), ["doc", "t"])
    return x.select("doc", "pos", "source_name", "type", "target_name")


def vocabulary(labels: DataFrame) -> DataFrame:
    """Distinct relation names (name), in order."""
    return labels.select(T.strip(F.col("type")).alias("name")).where("name <> ''").distinct().orderBy("name")


def subset(docs: DataFrame, n: int) -> DataFrame:
    return docs.where(F.col("pos") < max(1, n))


def name_items(rows: DataFrame, key: str = "name") -> DataFrame:
    """(doc, item) of rows (doc, name), in the form of comparison, without blank ones."""
    return rows.select("doc", T.eval_name(F.col(key)).alias("item")).where("item <> ''")


def name_set(rows: DataFrame, key: str = "name") -> DataFrame:
    """Distinct name_items()."""
    return name_items(rows, key).distinct()


def triple_set(rows: DataFrame) -> DataFrame:
    """Distinct (doc, item) of rows (doc, source_name, type, target_name); item is a struct; blank parts don't count."""
    s, t = T.eval_name(F.col("source_name")), T.eval_name(F.col("target_name"))
    x = rows.select("doc", F.struct(s.alias("s"), T.strip(F.col("type")).alias("r"), t.alias("t")).alias("item"))
    return x.where("item.s <> '' and item.r <> '' and item.t <> ''").distinct()


def predicted_triples(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """(doc, source_name, type, target_name) of relations (doc, source, type, target) by entities (doc, global_id, name, pos); the last name of an id counts."""
    names = entities.withColumn("name", T.strip(F.col("name"))).where("coalesce(trim(global_id), '') <> '' and name <> ''")
    names = names.groupBy("doc", T.strip(F.col("global_id")).alias("gid")).agg(F.max_by("name", "pos").alias("name"))
    end = lambda c, out: names.select("doc", F.col("gid").alias(c), F.col("name").alias(out))
    return relations.join(end("source", "source_name"), ["doc", "source"]).join(end("target", "target_name"), ["doc", "target"]).select("doc", "source_name", "type", "target_name")


def counts(predicted: DataFrame, gold: DataFrame, docs: DataFrame) -> DataFrame:
    """One row (tp, fp, fn) of two (doc, item) sets over docs (doc) that have both a prediction and gold."""
    p = predicted.join(docs, "doc", "left_semi").withColumn("_p", F.lit(True))
    g = gold.join(docs, "doc", "left_semi").withColumn("_g", F.lit(True))
    x = p.join(g, ["doc", "item"], "full")
    return x.agg(F.count(F.when(F.col("_p") & F.col("_g"), 1)).alias("tp"), F.count(F.when(F.col("_p") & F.col("_g").isNull(), 1)).alias("fp"), F.count(F.when(F.col("_g") & F.col("_p").isNull(), 1)).alias("fn"))


def scores(table: DataFrame) -> DataFrame:
    """tp, fp, fn with precision, recall and f1 to four places; 0 where a denominator is; f1 from unrounded values."""
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    p, r = over(tp, tp + fp), over(tp, tp + fn)
    return table.withColumn("precision", F.round(p, 4)).withColumn("recall", F.round(r, 4)).withColumn("f1", F.round(over(2 * p * r, p + r), 4))


def evaluated(predictions: DataFrame, gold_docs: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents that count, and those predicted without gold.

    predictions and gold_docs are (doc).  With strict, gold documents without
    a prediction count too, so that they lower recall.
    """
    p, g = predictions.select("doc").distinct(), gold_docs.select("doc").distinct()
    return (g if strict else p.join(g, "doc", "left_semi")), p.join(g, "doc", "left_anti")


def doc_counts(evaluated: DataFrame, missing: DataFrame) -> DataFrame:
    """One row (evaluated_docs, missing_gold_docs) of evaluated()."""
    n = lambda x, kind: x.select(F.lit(kind).alias("kind"))
    of = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    return n(evaluated, "e").unionByName(n(missing, "m")).agg(of("e").alias("evaluated_docs"), of("m").alias("missing_gold_docs"))
