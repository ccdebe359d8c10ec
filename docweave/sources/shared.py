"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths of stored tables, for each open temporaries().
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset a local session gets a temporary folder; on a cluster
    it is an error, as executors don't see the driver's folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for what goes at the end of an open temporaries()."""
    path = f"{shared_folder(spark)}/docweave/{name}-{uuid.uuid4().hex}"
    for paths in _open:
        paths.append(path)
    return path


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _place(spark, path)
    fs.delete(where, True)
    fs.cancelDeleteOnExit(where)


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a Parquet table at path, read back; it is deleted when the driver's file systems close, if not before."""
    spark = df.sparkSession
    df.write.parquet(path)
    fs, where = _place(spark, path)
    fs.deleteOnExit(where)  # takes only what is there
    out = spark.read.schema(df.schema).parquet(path)
    out._docweave_path = path
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back.

    What several branches of a plan read is then computed once.  This cuts the
    lineage: a lost executor costs the tasks it ran, and later plans start from
    the files.
    """
    return written(df, new_path(df.sparkSession, name))


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by stored(); nothing may read it any more."""
    path = getattr(df, "_docweave_path", None)
    if path:
        remove(df.sparkSession, path)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Deletes what is stored within the block at its end, so results must have been written elsewhere by then."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open[:] = [x for x in _open if x is not paths]
        for path in paths:
            remove(spark, path)


def held(value: Column) -> Column:
    """value, as an expression that isn't deterministic in the optimizer's eyes.

    The optimizer then neither copies it into the filters and lambdas that use
    its column nor pushes those filters below it, so it is computed once a row.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)
