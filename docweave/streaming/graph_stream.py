"""Documents as a stream: chunks and extractions are stateless; the graph's tables take each batch as one more layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql import functions as F

from ..plans import graph_plan
from ..sources import tables
from ..sources.settings import Settings

KEYS = {"nodes": ["global_id"], "edges": ["src", "rel_type", "dst"]}


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(base, text) of Parquet files that appear in a folder."""
    return spark.readStream.schema("base string, text string").parquet(folder)


def into_graph(docs: DataFrame, folder: str, checkpoint: str, settings: Settings = Settings(), extract: Callable[[DataFrame], DataFrame] = graph_plan.extraction.mentions_by_rule) -> DataStreamWriter:
    """Writes nodes and edges of each batch as a layer: folder/nodes/layer=<batch> and folder/edges/layer=<batch>.

    A batch costs what its own documents cost, however large the graph is.  One
    that runs again writes the same layer again, so replays after a failure
    change nothing.  A document must come whole in one batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        now = graph_plan.build(batch, settings, extract)
        for name in KEYS:
            getattr(now, name).write.mode("overwrite").parquet(f"{folder}/{name}/layer={number}")

    return docs.where(F.col("base").isNotNull()).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def merged(layers: DataFrame, keys: list[str], overwrite: bool = True) -> DataFrame:
    """One row for each key of rows with their layer: the last layer's values, or without overwrite each column's first that isn't null."""
    values = [c for c in layers.columns if c not in (*keys, "layer")]
    if overwrite:
        return layers.groupBy(*keys).agg(F.max_by(F.struct(*values), "layer").alias("r")).select(*keys, "r.*")
    return layers.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("layer"))).alias(c) for c in values])


def read(spark: SparkSession, folder: str, name: str, overwrite: bool = True) -> DataFrame:
    """The graph's nodes or edges as they are after all batches."""
    return merged(spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}"), KEYS[name], overwrite or name == "nodes")


def compact(spark: SparkSession, folder: str, name: str, overwrite: bool = True) -> None:
    """Merges all layers into the last one, so that reading costs less; not while a stream is writing."""
    layers = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
    (row,) = layers.agg(F.max("layer").alias("last")).collect()
    if row.last is not None:
        out = merged(layers, KEYS[name], overwrite or name == "nodes").withColumn("layer", F.lit(row.last))
        tables.replace(out, f"{folder}/{name}", "layer")
