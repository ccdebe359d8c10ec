"""JSON lines in and out, whole JSON documents, step files, and step outputs in batches."""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from .shared import new_path, remove


def file_name() -> Column:
    """The name of the file that a row comes from; Spark gives it with some characters written as in addresses."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, path: str, schema: StructType | str, suffix: str = "", glob: str = "*.jsonl") -> DataFrame:
    """Rows of JSON-lines files, with ``base`` from the file's name less suffix; header rows (_meta) are left out.

    A line that isn't JSON is an error, as half a file is worse than none.
    """
    own = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    x = spark.read.schema(StructType(own.fields).add("_meta", "string")).option("mode", "FAILFAST").option("pathGlobFilter", glob).json(path)
    name = F.regexp_replace(file_name(), r"\.jsonl$", "")
    base = T.without_suffix(name, suffix) if suffix else name
    return x.withColumn("base", base).where("_meta is null").drop("_meta")


def read_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A file that is one JSON value; a list gives a row for each element."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def write_lines(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; without overwrite an output that is there stays as it is."""
    df.write.mode("overwrite" if overwrite else "ignore").option("ignoreNullFields", False).json(path)


def write_document(spark: SparkSession, value: dict | list, path: str, overwrite: bool = False) -> bool:
    """One JSON value as one file, through Spark's file systems; False if it was there and stays."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where) and not overwrite:
        return False
    stream = fs.create(where, True)
    stream.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2).encode()))
    stream.close()
    return True


def schema_path(folder: str, domain: str) -> str:
    """Where a domain's schema goes: its name with letters, digits, - and _ only."""
    return f"{folder}/{''.join(c if c.isalnum() or c in '-_' else '_' for c in domain.strip() or 'schema')}.schema.json"


def copy_file(spark: SparkSession, path: str, name: str) -> str:
    """A copy of a file under another name in the same folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs, target = source.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(source.getParent(), name)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, target, False, True, conf)
    return target.toString()


def output_name(title: str, variant: str, suffixes: dict[str, str] | None = None) -> str:
    return f"{title}.{(suffixes or {}).get(variant, variant)}"


#: Step files by kind: what a name ends in (fixed values).
SUFFIXES = {"chunks": ".chunks", "extractions": ".extractions", "errors": ".errors", "entities": ".entities.resolved", "relations": ".relations.resolved", "validated": ".relations.validated"}


def read_step(spark: SparkSession, where: str, kind: str, schema: StructType | str) -> DataFrame:
    """Rows of the step files of a kind in a folder, or of one file: ``base`` is the name less its ending, ``row_pos`` the place in the file.

    Header rows are left out.  A folder without such files is an error, as is
    a line that isn't JSON.
    """
    suffix = SUFFIXES[kind]
    own = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    x = spark.read.schema(StructType(own.fields).add("_meta", "string")).option("mode", "FAILFAST").option("pathGlobFilter", f"*{suffix}.jsonl").json(where)
    x = x.select("*", F.regexp_replace(file_name(), re.escape(suffix) + r"\.jsonl$", "").alias("base"), place.alias("place")).where("_meta is null")
    return x.withColumn("row_pos", (F.row_number().over(Window.partitionBy("base").orderBy("place")) - 1).cast("int")).drop("_meta", "place")


def step_names(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(base) of the step files of a kind, whether they have rows or only a header."""
    suffix = SUFFIXES[kind]
    x = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}.jsonl").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return x.select(F.regexp_replace(name, re.escape(suffix) + r"\.jsonl$", "").alias("base"))


def write_files(rows: DataFrame, folder: str, ending: str, order: list[str], overwrite: bool = False) -> int:
    """One text file for each ``file`` of rows (file, line, order...), its lines in order; a file that is there stays unless overwritten.

    Tasks write the files; the driver gives them their names, so this is for
    as many files as one wants to handle as such.
    """
    spark = rows.sparkSession
    path = new_path(spark, "files")
    dealt = rows.repartition("file").sortWithinPartitions("file", *order).select("file", F.col("line").alias("value"))
    dealt.write.partitionBy("file").text(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(folder)
    fs, to = source.getFileSystem(conf), target.getFileSystem(conf)
    to.mkdirs(target)
    written = 0
    for group in fs.listStatus(source):
        key = group.getPath().getName()
        if not key.startswith("file="):
            continue
        end = jvm.org.apache.hadoop.fs.Path(target, unquote(key[5:]) + ending)
        if to.exists(end) and not overwrite:
            continue
        (part,) = [f.getPath() for f in fs.listStatus(group.getPath()) if f.getPath().getName().startswith("part-")]
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, part, to, end, True, True, conf)
        written += 1
    remove(spark, path)
    return written


def write_step(rows: DataFrame, folder: str, kind: str, order: list[str], header: dict | None = None, overwrite: bool = False) -> int:
    """Step files of rows (base, ...), one for each base, with a header line if given."""
    fields = [c for c in rows.columns if c != "base"]
    text = rows.select(F.col("base").alias("file"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"), F.lit(1).alias("after"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)])
    if header is not None:
        line = json.dumps({"_meta": header}, ensure_ascii=False)
        text = text.unionByName(rows.select(F.col("base").alias("file")).distinct().withColumn("line", F.lit(line)).withColumn("after", F.lit(0)), allowMissingColumns=True)
    return write_files(text, folder, f"{SUFFIXES[kind]}.jsonl", ["after", *(f"order_{i}" for i in range(len(order)))], overwrite)


def _children(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Batches:
    """Step outputs in a folder, in numbered batches.

    A run of a step writes all its tables as one more batch and then the bases
    it has done.  A batch counts only once these are there, so a run that
    breaks off anywhere leaves nothing behind that is read: the next one
    writes the same batch again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def marks(self, step: str) -> str:
        return f"{self.folder}/_done/{step}"

    def committed(self, step: str) -> int:
        marks = self.marks(step)
        return sum("_SUCCESS" in _children(self.spark, f"{marks}/{c}") for c in _children(self.spark, marks) if c.startswith("batch="))

    def done(self, step: str) -> DataFrame | None:
        n = self.committed(step)
        return self.spark.read.parquet(*[f"{self.marks(step)}/batch={i}" for i in range(n)]) if n else None

    def missing(self, df: DataFrame, step: str) -> DataFrame:
        """Rows whose base the step hasn't done yet."""
        have = self.done(step)
        return df if have is None else df.join(have, "base", "left_anti")

    def put(self, step: str, outputs: dict[str, DataFrame], bases: DataFrame) -> None:
        n = self.committed(step)
        for name, df in outputs.items():
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={n}")
        bases.select("base").distinct().write.mode("overwrite").parquet(f"{self.marks(step)}/batch={n}")

    def read(self, step: str, name: str) -> DataFrame:
        n = self.committed(step)
        if not n:
            raise FileNotFoundError(f"step {step} has not been run in {self.folder}")
        return self.spark.read.parquet(*[f"{self.folder}/{name}/batch={i}" for i in range(n)])

    def reset(self, step: str, names: tuple[str, ...]) -> None:
        """Forgets what a step has done: first that it is done, then the tables."""
        for path in (self.marks(step), *(f"{self.folder}/{n}" for n in names)):
            remove(self.spark, path)


def replace(df: DataFrame, path: str, *partitions: str) -> None:
    """A whole table in place of what is there: written beside it first, so that one of the two is always whole."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    old, new, gone = (jvm.org.apache.hadoop.fs.Path(path + x) for x in ("", ".new", ".old"))
    fs = old.getFileSystem(conf)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path + ".new")
    fs.delete(gone, True)
    if fs.exists(old):
        fs.rename(old, gone)
    fs.rename(new, old)
    fs.delete(gone, True)
