"""Extractions: prompts, schema filter, limits, dead letters.

An extraction row is (base, row_pos, chunk_id, entities, relations); arrays
keep the order of the reply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import held


def allowed_types(types: DataFrame) -> DataFrame:
    """Distinct stripped names, without blank ones, of types (name)."""
    return types.select(T.strip(F.col("name")).alias("name")).where("name <> ''").distinct()


#: Types that a schema may have; it is one document, written or proposed as a whole.
MOST_TYPES = 10_000


def _names(types: DataFrame) -> Column:
    """All names as one array, by a scalar subquery; more than MOST_TYPES are an error, so that what travels to all tasks is bounded."""
    some = allowed_types(types).limit(MOST_TYPES + 1).agg(F.collect_set("name").alias("names"))
    fine = F.when(F.size("names") <= MOST_TYPES, F.col("names")).otherwise(F.raise_error(F.lit(f"a schema of more than {MOST_TYPES} types")).cast("array<string>"))
    return some.select(fine).scalar()


def filter_to_schema(extractions: DataFrame, entity_types: DataFrame, relation_types: DataFrame) -> DataFrame:
    """Extractions whose entities have an id, a name and an allowed type, and whose relations have an allowed type and two kept ends.

    The domain schema is one document, so its names travel as one row; arrays
    are filtered in place and rows neither explode nor shuffle.
    """
    named = extractions.withColumn("_entity_types", _names(entity_types)).withColumn("_relation_types", _names(relation_types))
    strip3 = lambda e: F.struct(T.strip(F.coalesce(e["id"], F.lit(""))).alias("id"), T.strip(F.coalesce(e["type"], F.lit(""))).alias("type"), T.strip(F.coalesce(e["name"], F.lit(""))).alias("name"), F.coalesce(e["attributes"], F.lit("{}")).alias("attributes"), e["evidence"].alias("evidence"))
    entities = F.filter(F.transform("entities", strip3), lambda e: (e["id"] != "") & (e["name"] != "") & F.array_contains("_entity_types", e["type"]))
    x = named.withColumn("entities", entities).withColumn("_ids", F.transform("entities", lambda e: e["id"]))
    strip_r = lambda r: F.struct(T.strip(F.coalesce(r["source_id"], F.lit(""))).alias("source_id"), T.strip(F.coalesce(r["type"], F.lit(""))).alias("type"), T.strip(F.coalesce(r["target_id"], F.lit(""))).alias("target_id"), r["evidence"].alias("evidence"))
    relations = F.filter(F.transform("relations", strip_r), lambda r: F.array_contains("_relation_types", r["type"]) & F.array_contains("_ids", r["source_id"]) & F.array_contains("_ids", r["target_id"]))
    return x.withColumn("relations", relations).select(*extractions.columns)


def entities(extractions: DataFrame) -> DataFrame:
    """(base, row_pos, ent_pos, chunk_id, id, type, name, attributes, evidence)."""
    return extractions.select("base", "row_pos", "chunk_id", F.posexplode("entities").alias("ent_pos", "e")).select("base", "row_pos", "ent_pos", "chunk_id", "e.*")


def relations(extractions: DataFrame) -> DataFrame:
    """(base, row_pos, rel_pos, chunk_id, source_id, type, target_id, evidence)."""
    return extractions.select("base", "row_pos", "chunk_id", F.posexplode("relations").alias("rel_pos", "r")).select("base", "row_pos", "rel_pos", "chunk_id", "r.*")


def first_rows(rows: DataFrame, most: int, order: str = "row_pos") -> DataFrame:
    """The first ``most`` rows of each base; all if most is not positive."""
    if most <= 0:
        return rows
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy("base").orderBy(order))).where(F.col("_place") <= most).drop("_place")


def compact_schema(schema: dict) -> dict:
    """What of a domain schema goes into prompts."""
    return {"domain": schema.get("domain", "Domain"), "entity_types": schema.get("entity_types", []), "relation_types": schema.get("relation_types", [])}


def mentions_by_rule(chunks: DataFrame, pattern: str = "[A-Z][a-z]{4,}", carried: tuple[str, ...] = ()) -> DataFrame:
    """Extractions without a service: capitalised words as entities, neighbours as relations; carried columns of chunks come last.

    Types follow from lengths, so that every part of a schema is met.  Evidence
    is the first word, which the text has, or both, which it may not have.
    """
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    x = chunks.select("base", F.col("chunk_id").alias("row_pos"), "chunk_id", held(found).alias("_m"), *carried)
    kind = lambda n, *names: F.element_at(F.array(*[F.lit(v) for v in names]), (F.pmod(n, F.lit(len(names))) + 1).cast("int"))
    entity = lambda m, i: F.struct(F.concat(F.lit("e"), i).alias("id"), kind(F.length(m), "Person", "Group", "Place", "Other").alias("type"), m.alias("name"), F.concat(F.lit('{"length": '), F.length(m), F.lit("}")).alias("attributes"), m.alias("evidence"))
    both = lambda i: F.length(F.get("_m", i)) + F.length(F.get("_m", i + 1))
    quote = lambda i: F.when(both(i) % 3 == 0, F.get("_m", i)).otherwise(F.concat_ws(" ", F.get("_m", i), F.get("_m", i + 1)))
    pair = lambda i: F.struct(F.concat(F.lit("e"), i).alias("source_id"), kind(both(i), "knows", "located in", "unlisted").alias("type"), F.concat(F.lit("e"), i + 1).alias("target_id"), quote(i).alias("evidence"))
    pairs = F.when(F.size("_m") > 1, F.transform(F.sequence(F.lit(0), F.size("_m") - 2), pair)).otherwise(F.array().cast("array<struct<source_id:string,type:string,target_id:string,evidence:string>>"))
    return x.select("base", "row_pos", "chunk_id", F.transform("_m", entity).alias("entities"), pairs.alias("relations"), *carried)


#: Wording of our own; placeholders are filled by format_string.
PROMPTS = {
    "segments": "Group the %s numbered paragraphs below into topics. Answer with a JSON list of objects with start_paragraph, end_paragraph (exclusive) and topic that covers all paragraphs in order.\n%s",
    "schema": "Propose a domain schema for documents like these. Answer with a JSON object with domain, entity_types (name, description, attributes, examples) and relation_types (name, description, source_type, target_type, examples).\n%s",
    "extract": "Schema:\n%s\nDocument: %s\nTopic: %s\nList entities (id, type, name, attributes, evidence) and relations (source_id, type, target_id, evidence) of the text below that fit this schema, as a JSON object with entities and relations. Quote evidence word for word.\n%s",
    "repair": "The answer below can't be used: {error}\nSchema:\n%s\nText:\n%s\nAnswer again, with a JSON object only.",
    "same": "Type: %s\nA: %s (%s)\nB: %s (%s)\nDo A and B name one entity? Answer with a JSON object with the field same, true or false.",
    "verdict": "Does the text say that %s - %s - %s? Evidence given: %s\nText:\n%s\nAnswer with a JSON object with the field verdict: SUPPORTED, UNSUPPORTED or UNSURE.",
}


def prompt(kind: str, *parts: Column) -> Column:
    return F.format_string(PROMPTS[kind], *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def split_failures(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that came out well, and the dead letters (error not null)."""
    return replies.where("error is null"), replies.where("error is not null")
