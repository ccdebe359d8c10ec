"""A corpus pipeline: quality rules, SimHash near-dedup, personal data, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept, written as Parquet and read again.  All but the last return the columns
of documents, and any others that docs has, whatever their names.  All take
empty tables, nulls in any column and texts of any length; what they make of
nulls, ties and repeated rows is said below, and in full by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import common, mixing, packing, pii, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source; a null or empty text fails, repeated rows fare alike."""
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, a Jaccard similarity of 0.8 or more), the document with the least id, a null one last; texts without words are one group."""
    return simhash.one_of_each(docs, shingle=5, similarity=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which personal data is replaced by its kind; a null text stays null, n_chars follows the text."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a null source is a source, and of equal rows it doesn't matter which are taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: (doc_id, piece, start, length, ids_crc32, sequence_id, offset); a null text is its end id alone."""
    return packing.packed(docs)


STAGES = [("quality rules", quality_rules), ("near-dedup", near_dedup), ("personal data", personal_data), ("mixing", mix_sources), ("packing", pack)]

#: Fingerprints, sampling and tokens are beyond SQL; tests hold each stage against brute force or, for quality rules, SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn.  What a stage stores for itself is deleted when its result is written, and a result when the next one is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        before, path = docs, common.new_path(spark, f"pipeline-{i}")
        with common.temporaries(spark):
            docs = common.written(stage(spark, docs, sf_dir), path)
        common.discard(before)
    return docs
