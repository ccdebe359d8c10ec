"""Documents: PDF files, text folders, tables; hashes, pages, samples."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .tables import file_name

#: engine name -> function from a PDF's bytes and a page limit to its pages' texts.
Pages = Callable[[bytes, int], tuple[list[str], int]]


def plumber_pages(content: bytes, limit: int) -> tuple[list[str], int]:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [p.extract_text() or "" for p in pdf.pages[: limit or None]], len(pdf.pages)


def pypdf_pages(content: bytes, limit: int) -> tuple[list[str], int]:
    import pypdf

    pages = pypdf.PdfReader(io.BytesIO(content)).pages
    return [p.extract_text() or "" for p in list(pages)[: limit or None]], len(pages)


ENGINES: dict[str, Pages] = {"pdfplumber": plumber_pages, "pypdf": pypdf_pages}


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, sha256) of .pdf and .PDF files below a folder; a missing folder is an error."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{pdf,PDF}").load(folder)
    # One scan lists a path once, so there are no duplicates to look for.
    return x.select("path", "content", F.sha2("content", 256).alias("sha256"))


def stem(path: Column) -> Column:
    """A file's name without its ending, as the name of its document."""
    return T.file_stem(F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1))


def joined_pages(pages: list[str], limit: int, least: int) -> tuple[str, int]:
    """Text of pages and how many were used: the first ``limit`` if positive, without those shorter than ``least`` when stripped."""
    kept = [p for p in (pages[:limit] if limit > 0 else pages) if not (least > 0 and len(p.strip()) < least)]
    return "\n\n".join(kept).strip(), len(kept)


def pdf_texts(files: DataFrame, engine: str = "pdfplumber", max_pages: int = 0, min_chars: int = 0, engines: dict[str, Pages] | None = None) -> DataFrame:
    """(path, sha256, text, engine, pages_total, pages_used, text_chars, error) of pdf_files().

    The named engine is tried first and the others in turn; a file that none
    reads keeps the errors and a null text, so one bad file stops nothing.
    """
    known = ENGINES if engines is None else engines
    if engine not in known:
        raise ValueError(f"unknown PDF engine: {engine}")
    order = [engine, *(e for e in known if e != engine)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                errors = []
                for name in order:
                    try:
                        pages, total = known[name](bytes(r.content), max(0, max_pages))
                        text, used = joined_pages(pages, max_pages, min_chars)
                        out.append((r.path, r.sha256, text, name, total, used, len(text), None))
                        break
                    except Exception as e:  # an engine may fail in any way
                        errors.append(f"{name}: {e}")
                else:
                    out.append((r.path, r.sha256, None, None, None, None, None, "; ".join(errors)))
            yield pd.DataFrame(out, columns=["path", "sha256", "text", "engine", "pages_total", "pages_used", "text_chars", "error"]).astype({c: "Int64" for c in ("pages_total", "pages_used", "text_chars")})

    return files.mapInPandas(run, "path string, sha256 string, text string, engine string, pages_total long, pages_used long, text_chars long, error string")


def page_texts(pages: DataFrame, max_pages: int = 0, min_chars: int = 0) -> DataFrame:
    """(base, text, pages_total, pages_used) of pages (base, page_no from 0, text), joined by blank lines."""
    use = F.lit(True)
    if max_pages > 0:
        use = use & (F.col("page_no") < max_pages)
    if min_chars > 0:
        use = use & (F.length(T.strip(F.col("text"))) >= min_chars)
    entry = F.when(use, F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))
    x = pages.groupBy("base").agg(F.array_sort(F.collect_list(entry)).alias("all"), F.count("*").alias("pages_total"))
    return x.select("base", T.strip(F.array_join(F.transform("all", lambda p: p["text"]), "\n\n")).alias("text"), "pages_total", F.size("all").cast("long").alias("pages_used"))


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(base, text) of the .txt files in a folder, by name without suffix."""
    x = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return x.select(F.regexp_replace(file_name(), r"\.txt$", "").alias("base"), F.col("value").alias("text"))


def sample(docs: DataFrame, k: int, max_chars: int) -> DataFrame:
    """The first max(1, k) documents by base, stripped, cut to max_chars."""
    return docs.orderBy("base").limit(max(1, k)).select("base", F.substring(T.strip(F.col("text")), 1, max_chars).alias("text"))
