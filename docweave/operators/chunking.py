"""Chunks of documents with offsets: by size and overlap, by paragraphs, by segments of a reply."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import held

LOOK_BACK, LEAST_CUT, MARK = 800, 200, "\n\n"


def check_sizes(size: int, overlap: int) -> None:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"size must be positive and overlap in [0, size); got {size} and {overlap}")


def spans(text: str, lo: int, hi: int, size: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """(index, start, end) of overlapping spans of text[lo:hi].

    A span is ``size`` characters, or ends before the last blank line of its
    last 800 if that leaves more than 200.  The next one starts ``overlap``
    earlier than it ends, or where it ends if that is no progress.
    """
    lo, hi = max(0, lo), min(hi, len(text))
    index = 0
    while lo < hi:
        end = min(lo + size, hi)
        mark = text.rfind(MARK, max(lo, end - LOOK_BACK), end)
        if mark > lo + LEAST_CUT:
            end = mark
        yield index, lo, end
        if end >= hi:
            return
        lo = end - overlap if end - overlap > lo else end
        index += 1


def even_spans(length: Column, size: int, overlap: int) -> Column:
    """array<struct<start, end>> of a text without blank lines, in closed form."""
    step = size - overlap
    count = F.when(length <= 0, 0).when(length <= size, 1).otherwise(1 + F.ceil((length - size) / F.lit(step))).cast("int")
    each = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i * step).alias("start"), F.least(length, i * step + size).alias("end")))
    return F.when(count > 0, each).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def clean(docs: DataFrame, max_chars: int = 0) -> DataFrame:
    """docs (base, text) with normal line ends, cut to max_chars if that is positive, without empty ones."""
    text = T.newlines(F.col("text"))
    text = F.substring(text, 1, max_chars) if max_chars > 0 else text
    return docs.withColumn("text", held(text)).where(F.length("text") > 0)


def rule_chunks(docs: DataFrame, size: int = 4000, overlap: int = 300, max_chunks: int = 5000) -> DataFrame:
    """(base, chunk_id, char_start, char_end, text, chunk_method) of docs (base, text).

    Texts without blank lines take the closed form and never leave the JVM;
    the others are cut in Arrow batches.
    """
    check_sizes(size, overlap)
    docs = docs.select("base", "text")
    # A length is counted from a text's first character, so once a text, not once a chunk.
    plain = docs.where(~F.col("text").contains(MARK)).withColumn("n", held(F.length("text")))
    plain = plain.select("base", "text", F.posexplode(even_spans(F.col("n"), size, overlap)).alias("chunk_id", "s"))
    plain = plain.select("base", "chunk_id", F.col("s.start").alias("char_start"), F.col("s.end").alias("char_end"), T.strip(T.part(F.col("text"), F.col("s.start"), F.col("s.end"))).alias("text"))
    whole = docs.where(F.col("text").contains(MARK)).withColumn("lo", F.lit(0)).withColumn("hi", F.length("text"))
    cut = cut_ranges(whole, size, overlap).select("base", F.col("index").alias("chunk_id"), "char_start", "char_end", "text")
    return capped(plain.unionByName(cut), max_chunks, size, overlap).withColumn("chunk_method", F.lit("rule"))


#: Characters of results that a task keeps before it passes them on.
KEPT_CHARS = 4_000_000


def _by_row(taken: list[str], carried: list[str], cut: Callable[[dict], Iterator[tuple]], kinds: dict[str, pa.DataType], order: list[str] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: carried columns with those of kinds, of which cut(row of taken columns) gives the values, the text first.

    Rows are read one by one and results passed on before they are many, so a
    task's memory is that of a batch, however long its texts are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in carried]
            made = pa.RecordBatch.from_arrays([*own, *(pa.array(v, kind) for v, kind in zip(out, kinds.values()))], names=[*carried, *kinds])
            return made.select(order) if order else made

        for batch in batches:
            rows, out, chars = [], [[] for _ in kinds], 0
            columns = {c: batch.column(c) for c in taken}
            for i in range(batch.num_rows):
                for found in cut({c: column[i].as_py() for c, column in columns.items()}):
                    rows.append(i)
                    for values, v in zip(out, found):
                        values.append(v)
                    chars += len(found[0])
                    if chars > KEPT_CHARS:
                        yield made()
                        rows, out, chars = [], [[] for _ in kinds], 0
            yield made()

    return run


def cut_ranges(ranges: DataFrame, size: int, overlap: int) -> DataFrame:
    """Rows of ranges (..., text, lo, hi) for each span in [lo, hi): text becomes the stripped span; adds index, char_start, char_end."""
    carried = [f for f in ranges.schema if f.name not in ("text", "lo", "hi")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), "text string, index int, char_start int, char_end int"])

    def cut(row: dict) -> Iterator[tuple]:
        text = row["text"] or ""
        for index, lo, hi in spans(text, row["lo"], row["hi"], size, overlap):
            yield text[lo:hi].strip(), index, lo, hi

    run = _by_row(["text", "lo", "hi"], [f.name for f in carried], cut, {"text": pa.string(), "index": pa.int32(), "char_start": pa.int32(), "char_end": pa.int32()})
    return ranges.select(*(f.name for f in carried), "text", "lo", "hi").mapInArrow(run, schema)


def capped(chunks: DataFrame, max_chunks: int, size: int, overlap: int) -> DataFrame:
    """chunks, failing where a chunk's number reaches the limit: max_chunks, or ten times what is expected, 2000 at least."""
    if max_chunks > 0:
        return chunks.withColumn("chunk_id", F.when(F.col("chunk_id") < max_chunks, F.col("chunk_id")).otherwise(F.raise_error(F.concat(F.lit("too many chunks: "), F.col("base").cast("string"))).cast("int")))
    # A document's length is at least where its last chunk ends.
    limit = F.greatest(F.lit(2000), 10 * expected_chunks(F.max("char_end").over(Window.partitionBy("base")), size, overlap))
    chunks = chunks.withColumn("_limit", limit)
    return chunks.withColumn("chunk_id", F.when(F.col("chunk_id") < F.col("_limit"), F.col("chunk_id")).otherwise(F.raise_error(F.lit("too many chunks")).cast("int"))).drop("_limit")


def expected_chunks(length: Column, size: int, overlap: int) -> Column:
    step = size - overlap
    return F.greatest(F.lit(1), F.ceil(length / F.lit(step))).cast("long") if step > 0 else F.lit(1_000_000_000).cast("long")


def paragraph_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of paragraphs: what blank lines separate, stripped, none empty."""
    at, out = 0, []
    for piece in re.split(r"\n\s*\n+", text):
        piece = piece.strip()
        if piece:
            found = text.find(piece, at)
            start = found if found >= 0 else at
            at = start + len(piece)
            out.append((start, at))
    return out


def paragraphs(docs: DataFrame) -> DataFrame:
    """(base, idx, char_start, char_end, text): blank-line-separated paragraphs, stripped, none empty, where they stand."""

    def cut(row: dict) -> Iterator[tuple]:
        text = row["text"] or ""
        for n, (lo, hi) in enumerate(paragraph_spans(text)):
            yield text[lo:hi], n, lo, hi

    run = _by_row(["text"], ["base"], cut, {"text": pa.string(), "idx": pa.int32(), "char_start": pa.int32(), "char_end": pa.int32()}, ["base", "idx", "char_start", "char_end", "text"])
    return docs.select("base", "text").mapInArrow(run, f"base {docs.schema['base'].dataType.simpleString()}, idx int, char_start int, char_end int, text string")


def segments_valid(segments: DataFrame, counts: DataFrame) -> DataFrame:
    """(base, valid) for each base of counts (base, n_paragraphs): whether segments (base, start, end) tile [0, n)."""
    order = Window.partitionBy("base").orderBy("start")
    x = segments.select("base", "start", "end", F.coalesce(F.lag("end").over(order), F.lit(0)).alias("before"))
    x = x.groupBy("base").agg(F.bool_and((F.col("start") == F.col("before")) & (F.col("end") > F.col("start"))).alias("joined"), F.max_by("end", "start").alias("last"))
    return counts.join(x, "base", "left").select("base", F.coalesce(F.col("joined") & (F.col("last") == F.col("n_paragraphs")), F.lit(False)).alias("valid"))


def tiled(segments: list[tuple[int, int]], n: int) -> bool:
    """segments_valid() of one document's segments (start, end)."""
    before = 0
    if any(start is None or end is None for start, end in segments):
        return False
    for start, end in sorted(segments):
        if start != before or end <= start:
            return False
        before = end
    return before == n


def hybrid_chunks(docs: DataFrame, paras: DataFrame, segments: DataFrame, size: int = 4000, overlap: int = 300, subchunks: bool = True) -> DataFrame:
    """Chunks of segments (base, segment_id, para_start, para_end, topic), paragraphs [para_start, para_end).

    chunk_id runs over a document's segments in the order of segment_id.
    """
    check_sizes(size, overlap)
    first = paras.select("base", F.col("idx").alias("para_start"), F.col("char_start").alias("lo"))
    last = paras.select("base", (F.col("idx") + 1).alias("para_end"), F.col("char_end").alias("hi"))
    x = segments.join(first, ["base", "para_start"]).join(last, ["base", "para_end"]).join(docs.select("base", "text"), "base")
    if subchunks:
        x = cut_ranges(x, size, overlap).withColumnRenamed("index", "subchunk_index").withColumn("chunk_granularity", F.lit("subchunk"))
    else:
        x = x.withColumn("char_start", F.col("lo")).withColumn("char_end", F.col("hi")).withColumn("text", T.strip(T.part(F.col("text"), F.col("lo"), F.col("hi")))).withColumn("subchunk_index", F.lit(0)).withColumn("chunk_granularity", F.lit("segment")).drop("lo", "hi")
    order = Window.partitionBy("base").orderBy("segment_id", "subchunk_index")
    return x.withColumn("chunk_id", F.row_number().over(order) - 1).withColumn("chunk_method", F.lit("llm_semantic"))


def routed(docs: DataFrame, segments: DataFrame, max_paragraphs: int = 120, size: int = 4000, overlap: int = 300, subchunks: bool = True, rule: tuple[int, int] | None = None, max_chunks: int = 5000) -> DataFrame:
    """Hybrid chunks of documents whose segments are valid, rule chunks of all others; ``variant`` says which.

    size and overlap are those of sub-chunks, rule those of rule chunks, the
    same if not given.

    segments (base, segment_id, para_start, para_end, topic) has no rows for a
    document without a usable reply; documents with no paragraphs or more than
    max_paragraphs fall back too.

    A document is one row with all its segments, and is cut in one go: its
    text travels once, and neither texts nor paragraphs are sorted or joined.
    """
    sizes = {"llm": (size, overlap), "llm_fallback_rule": rule or (size, overlap)}
    for pair in sizes.values():
        check_sizes(*pair)

    def cut(row: dict) -> Iterator[tuple]:
        text, found = row["text"] or "", row["segments"] or []
        paras = paragraph_spans(text) if found else []
        ok = 1 <= len(paras) <= max_paragraphs and tiled([(x["para_start"], x["para_end"]) for x in found], len(paras))
        variant = "llm" if ok else "llm_fallback_rule"
        step = sizes[variant][0] - sizes[variant][1]
        limit = max_chunks if max_chunks > 0 else max(2000, 10 * max(1, -(-len(text) // step)))
        wholes = [(x, paras[x["para_start"]][0], paras[x["para_end"] - 1][1]) for x in sorted(found, key=lambda x: x["segment_id"])] if ok else [({}, 0, len(text))]
        chunk_id = 0
        for x, start, end in wholes:
            for _, lo, hi in spans(text, start, end, *sizes[variant]) if subchunks or not ok else [(0, start, end)]:
                if chunk_id >= limit:
                    raise ValueError(f"too many chunks: {row['base']}")
                yield text[lo:hi].strip(), chunk_id, lo, hi, "llm_semantic" if ok else "rule", *(x.get(c) for c in own), variant
                chunk_id += 1

    own = ["segment_id", "para_start", "para_end", "topic"]
    listed = segments.groupBy("base").agg(F.collect_list(F.struct(*own)).alias("segments"))
    # Only segments, which are small, are held; texts pass by.
    x = docs.select("base", "text").join(listed.hint("shuffle_hash"), "base", "left").select("base", "text", "segments")
    whole, word = pa.int32(), pa.string()
    kinds = {"text": word, "chunk_id": whole, "char_start": whole, "char_end": whole, "chunk_method": word, "segment_id": whole, "para_start": whole, "para_end": whole, "topic": word, "variant": word}
    order = ["base", "chunk_id", "char_start", "char_end", "text", "chunk_method", *own, "variant"]
    schema = f"base {docs.schema['base'].dataType.simpleString()}, chunk_id int, char_start int, char_end int, text string, chunk_method string, segment_id int, para_start int, para_end int, topic string, variant string"
    return x.mapInArrow(_by_row(["base", "text", "segments"], ["base"], cut, kinds, order), schema)
