"""Validation of relations against the chunks that they come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import held


def chunk_texts(chunks: DataFrame) -> DataFrame:
    """(base, chunk_id, text) of chunks (base, chunk_id, text, row_pos): unusable rows go, the last of equal keys stays."""
    x = chunks.select("base", F.col("chunk_id").try_cast("int").alias("chunk_id"), "text", "row_pos").where("chunk_id is not null and text is not null")
    return x.groupBy("base", "chunk_id").agg(F.max_by("text", "row_pos").alias("text"))


def _form(ignore_case: bool, exact: bool) -> Callable[[Column], Column]:
    fold = T.folded_exact if exact else T.folded
    return (lambda c: fold(T.match_text(c))) if ignore_case else T.match_text


def _status(formed: Column, evidence: Column) -> Column:
    """Of evidence and a chunk's text, both in their form; null if there is no chunk."""
    return F.when(formed.isNull() | F.coalesce(evidence == "", F.lit(True)), "UNKNOWN").when(formed.contains(evidence), "SUPPORTED").otherwise("UNSUPPORTED")


def with_status(extractions: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Extractions with their chunk's text, which goes: relations have the support_status that statuses() would give them.

    Evidence is looked for where the text is at hand, so that texts are neither
    read again nor dealt out, sorted and joined for it.
    """
    x = extractions.withColumn("text", held(_form(ignore_case, exact=False)(F.col("text"))))
    # match_text() as it is for a few characters.
    short = lambda c: T.strip(T.one_spaced(c))
    form = (lambda c: T.folded(short(c))) if ignore_case else short
    checked = F.transform("relations", lambda r: r.withField("support_status", _status(F.col("text"), form(r["evidence"]))))
    return x.withColumn("relations", checked).drop("text")


def statuses(relations: DataFrame, chunks: DataFrame, ignore_case: bool = True, max_relations: int = 0, max_provenances: int = 0, exact: bool = False) -> DataFrame:
    """One row per provenance entry: relation's columns, prov_pos, chunk_id, evidence_relation, support_status, chunk_text.

    chunks are chunk_texts().  UNKNOWN without chunk or evidence, else
    SUPPORTED or UNSUPPORTED by whether the chunk has the evidence, white space
    (and case) apart.  Relations beyond max_relations of a base, in order, and
    entries beyond max_provenances go; 0 is no limit.  exact: texts beyond
    ASCII are folded by all of Unicode's rules, in Arrow batches; without it
    lower case and sharp s are all there is.
    """
    x = relations
    if max_relations > 0:
        x = x.withColumn("_place", F.row_number().over(Window.partitionBy("base").orderBy("first_ord", "source", "type", "target"))).where(F.col("_place") <= max_relations).drop("_place")
    if max_provenances > 0:
        x = x.withColumn("provenance", F.slice("provenance", 1, max_provenances))
    x = x.select("base", "source", "type", "target", "first_ord", F.posexplode_outer("provenance").alias("prov_pos", "p"))
    x = x.select("base", "source", "type", "target", "first_ord", "prov_pos", F.col("p.chunk_id").try_cast("int").alias("chunk_id"), F.col("p.evidence_relation").alias("evidence_relation"))
    form = _form(ignore_case, exact)
    # A chunk is brought into its form once, not once for each entry.
    formed = chunks.select("base", "chunk_id", F.col("text").alias("chunk_text"), form(F.col("text")).alias("_formed"))
    x = x.join(formed, ["base", "chunk_id"], "left")
    status = F.when(F.col("prov_pos").isNull(), None).otherwise(_status(F.col("_formed"), form(F.col("evidence_relation"))))
    return x.withColumn("support_status", status).drop("_formed")


def escalates() -> Column:
    """Whether a completion backend is asked about an entry of statuses()."""
    return F.col("chunk_text").isNotNull() & F.col("support_status").isin("UNSUPPORTED", "UNKNOWN")


def to_escalate(rows: DataFrame) -> DataFrame:
    """Entries of statuses() that a completion backend is asked about."""
    return rows.where(escalates())


def _counted() -> Column:
    total = F.greatest(F.lit(1), F.col("supported") + F.col("unsupported") + F.col("unknown"))
    return F.struct("supported", "unsupported", "unknown", F.round(F.col("supported") / total, 4).alias("support_ratio")).alias("validation")


def validated(rows: DataFrame) -> DataFrame:
    """One row per relation of statuses(), which may have llm_support_status: provenance with statuses, and validation counts."""
    llm = F.col("llm_support_status") if "llm_support_status" in rows.columns else F.lit(None).cast("string")
    entry = F.struct("prov_pos", F.struct("chunk_id", "evidence_relation", "support_status", llm.alias("llm_support_status")).alias("p"))
    count = lambda s: F.count(F.when(F.col("support_status") == s, 1))
    x = rows.groupBy("base", "source", "type", "target").agg(
        F.min("first_ord").alias("first_ord"), F.array_sort(F.collect_list(F.when(F.col("prov_pos").isNotNull(), entry))).alias("all"),
        count("SUPPORTED").alias("supported"), count("UNSUPPORTED").alias("unsupported"), count("UNKNOWN").alias("unknown"),
    )
    return x.select("base", "source", "type", "target", "first_ord", F.transform("all", lambda e: e["p"]).alias("provenance"), _counted())


def validated_rows(rows: DataFrame, max_relations: int = 0, max_provenances: int = 0) -> DataFrame:
    """validated() of relations' entries, resolution.located() rows with support_status, in one aggregation; limits are those of statuses()."""
    entry = F.struct(F.struct("row_pos", "rel_pos").alias("ord"), F.struct(F.col("chunk_id").try_cast("int").alias("chunk_id"), F.col("evidence").alias("evidence_relation"), "support_status", F.lit(None).cast("string").alias("llm_support_status")).alias("p"))
    kinds = ("supported", "unsupported", "unknown")
    key = ["base", "source", "type", "target"]
    counts = [F.count(F.when(F.col("support_status") == k.upper(), 1)).alias(k) for k in kinds]
    x = rows.groupBy(*key).agg(F.min(F.struct("row_pos", "rel_pos")).alias("first_ord"), F.array_sort(F.collect_list(entry)).alias("all"), *counts)
    x = x.withColumn("provenance", F.transform("all", lambda e: e["p"]))
    if max_relations > 0:
        x = x.withColumn("_place", F.row_number().over(Window.partitionBy("base").orderBy("first_ord", "source", "type", "target"))).where(F.col("_place") <= max_relations)
    if max_provenances > 0:
        x = x.withColumn("provenance", F.slice("provenance", 1, max_provenances))
        x = x.withColumns({k: F.size(F.filter("provenance", lambda p: p["support_status"] == k.upper())).cast("long") for k in kinds})
    return x.select(*key, "first_ord", "provenance", _counted())


def unmatched(relations: DataFrame, chunks: DataFrame) -> DataFrame:
    """Bases with relations but without any chunk, to be reported."""
    return relations.select("base").distinct().join(chunks.select("base").distinct(), "base", "left_anti")
