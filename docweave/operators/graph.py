"""The property graph as two tables, upserted as sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def supported(provenance: Column, accept_llm: bool = True) -> Column:
    """Whether any entry is SUPPORTED by rule or, if accepted, by a completion backend."""
    says = lambda c: F.coalesce(F.upper(c) == "SUPPORTED", F.lit(False))
    return F.coalesce(F.exists(provenance, lambda p: says(p["support_status"]) | (says(p["llm_support_status"]) if accept_llm else F.lit(False))), F.lit(False))


def nodes(entities: DataFrame, samples: int = 3) -> DataFrame:
    """(global_id, type, name, attributes_json, mention_count, mention_samples_json): of rows with one id the last, by (base, first_ord), stays."""
    x = entities.where("coalesce(global_id, '') <> '' and coalesce(type, '') <> '' and coalesce(name, '') <> ''")
    some = F.slice("mentions", 1, samples) if samples > 0 else F.slice("mentions", 1, 0)
    row = F.struct("type", "name", F.coalesce("attributes", F.lit("{}")).alias("attributes_json"), F.size(F.coalesce("mentions", F.array().cast(entities.schema["mentions"].dataType))).cast("long").alias("mention_count"), F.to_json(some, {"ignoreNullFields": "false"}).alias("mention_samples_json"))
    return x.groupBy("global_id").agg(F.max_by(row, F.struct("base", "first_ord", "type")).alias("r")).select("global_id", "r.*")


def with_support(relations: DataFrame, least: float = 0.6, accept_llm: bool = True) -> DataFrame:
    """relations of validated() with is_supported and passes: a high enough ratio, or support by P17's rule."""
    x = relations.where("coalesce(source, '') <> '' and coalesce(type, '') <> '' and coalesce(target, '') <> ''")
    x = x.withColumn("support_ratio", F.coalesce("validation.support_ratio", F.lit(0.0))).withColumn("is_supported", supported(F.col("provenance"), accept_llm))
    return x.withColumn("passes", (F.col("support_ratio") >= least) | F.col("is_supported"))


def edges(relations: DataFrame, node_ids: DataFrame, overwrite: bool = True, samples: int = 5) -> DataFrame:
    """(src, rel_type, dst, type, support_ratio, supported, evidence_samples, provenance_count) of with_support() rows that pass.

    Both ends must be among node_ids (global_id).  Rows of one (src, rel_type,
    dst) come in the order (base, first_ord): the last one's values stay, or
    with overwrite off each column's first value that isn't null.
    """
    x = relations.where("passes").withColumn("rel_type", T.relation_type(F.col("type"))).withColumn("ord", F.struct("base", "first_ord", "type"))
    taken = F.transform(F.filter(F.slice("provenance", 1, samples), lambda p: p["evidence_relation"].isNotNull()), lambda p: p["evidence_relation"])
    x = x.select(F.col("source").alias("src"), "rel_type", F.col("target").alias("dst"), "type", "support_ratio", F.col("is_supported").alias("supported"), taken.alias("evidence_samples"), F.size("provenance").cast("long").alias("provenance_count"), "ord")
    ids = node_ids.select("global_id")
    x = x.join(ids.withColumnRenamed("global_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("global_id", "dst"), "dst", "left_semi")
    values = ["type", "support_ratio", "supported", "evidence_samples", "provenance_count"]
    by = x.groupBy("src", "rel_type", "dst")
    if overwrite:
        return by.agg(F.max_by(F.struct(*values), "ord").alias("r")).select("src", "rel_type", "dst", "r.*")
    return by.agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c) for c in values])


def upserted(table: DataFrame | None, new: DataFrame, keys: list[str], overwrite: bool = True) -> DataFrame:
    """A table after an upsert of new rows: theirs win, or with overwrite off only fill in what is null."""
    if table is None:
        return new
    old = table.select(*keys, F.struct(*[c for c in table.columns if c not in keys]).alias("old"))
    add = new.select(*keys, F.struct(*[c for c in table.columns if c not in keys]).alias("new"))
    x = old.join(add, keys, "full")
    values = [c for c in table.columns if c not in keys]
    if overwrite:
        merged = [F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values]
    else:
        merged = [F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c) for c in values]
    return x.select(*keys, *merged)


def counters(relations: DataFrame, node_ids: DataFrame) -> DataFrame:
    """One row (imported, skipped_support, skipped_missing_nodes) of with_support() rows."""
    ids = node_ids.select("global_id").distinct()
    x = relations.join(ids.select(F.col("global_id").alias("source"), F.lit(True).alias("_s")), "source", "left").join(ids.select(F.col("global_id").alias("target"), F.lit(True).alias("_t")), "target", "left")
    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    return x.agg(F.count(F.when(F.col("passes") & both, 1)).alias("imported"), F.count(F.when(~F.col("passes"), 1)).alias("skipped_support"), F.count(F.when(F.col("passes") & ~both, 1)).alias("skipped_missing_nodes"))


def duplicate_ids(table: DataFrame) -> DataFrame:
    """Ids that break the unique key; empty for any nodes()."""
    return table.groupBy("global_id").agg(F.count("*").alias("n")).where("n > 1")


def dangling(relations: DataFrame, node_ids: DataFrame) -> DataFrame:
    """Relations of which an end is not a node."""
    ids = node_ids.select("global_id").distinct()
    missing = lambda c: relations.join(ids.withColumnRenamed("global_id", c), c, "left_anti")
    return missing("source").unionByName(missing("target")).distinct()
