"""WARC archives: writing pages as transactions, reading records back, assembling captures.

A page is three records: its request, its response (or, if another page has
the same payload, a revisit that refers to that page's response) and its
metadata, tied by WARC-Concurrent-To.  Spark's text writer and reader move the
bytes, so archives can be wherever Spark can write; the record terminator is
the writer's line separator, and the version line the reader's.

A payload may hold what looks like the start of a record.  Every record's
length is held against its Content-Length; a file in which one doesn't fit is
read again and cut by lengths alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import remove
from .common import discard, held, materialise, new_path

#: Fixed values of the format.
VERSION, EOL, TERMINATOR = "WARC/1.1", "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def base32(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: each five hex digits are four base32 digits."""
    digits = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.lpad(F.conv(F.substring(digest, 5 * i + 1, F.lit(5)), 16, 32), 4, "0")), "")
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)), F.lit(">"))


def _record(kind: Column | str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its terminator; fields whose value is null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *fields, ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(EOL, F.lit(VERSION), *[F.concat(F.lit(f"{n}: "), v) for n, v in head]), F.lit(TERMINATOR), block)


def transactions(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(record): request, response or revisit, and metadata of each row, in that order.

    Of rows whose payloads are equal and have at least ``least_bytes`` bytes,
    one with the largest id is the response.  Rows are numbered where they are
    read, so pages should be a table of files or otherwise come in fixed order.
    """
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("digest", held(F.sha1(F.col("html").cast("binary")))).withColumn("bytes", F.octet_length("html").cast("long"))
    groups = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max(F.struct("page", "row")).alias("first"), F.count("*").alias("n"))
    # Most payloads are met once; only the others are looked up.
    x = rows.join(groups.where("n > 1").select("digest", F.col("first.row").alias("first_row")), "digest", "left")
    again = F.coalesce((F.col("first_row") != F.col("row")) & (F.col("bytes") >= least_bytes), F.lit(False))
    shared = F.col("bytes") >= least_bytes
    x = x.withColumn("again", held(again)).withColumn("original", _urn(F.lit("response"), "digest"))
    x = x.withColumn("id", F.when(F.col("again") | ~shared, _urn(F.lit("capture"), "row", "digest")).otherwise(F.col("original")))
    uri = F.replace(F.replace(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\t"), F.lit("%09")), F.lit(" "), F.lit("%20"))
    x = x.withColumn("uri", held(uri))
    path = F.regexp_replace(F.coalesce("uri", F.lit("")), "^[a-zA-Z]+://[^/?#]*|#.*$", "")
    request = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(" HTTP/1.1\r\nHost: "), F.regexp_extract(F.coalesce("uri", F.lit("")), "^[a-zA-Z]+://([^/?#]*)", 1), F.lit(TERMINATOR))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(TERMINATOR))
    meta = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("page"), F.lit(EOL)), F.lit("")), F.lit("fetched: yes\r\n"))
    target = ("WARC-Target-URI", F.col("uri"))
    capture = _record(
        F.when(F.col("again"), "revisit").otherwise("response"), F.col("id"),
        [target, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))), ("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))), ("WARC-Refers-To", F.when(F.col("again"), F.col("original"))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(F.col("again"), http).otherwise(F.concat(http, F.col("html"))),
    )
    side = lambda kind, content, block: _record(kind, _urn(F.lit(kind), "row", "digest"), [target, ("WARC-Concurrent-To", F.col("id")), ("Content-Type", F.lit(content))], block)
    return x.select(F.explode(F.array(side("request", "application/http; msgtype=request", request), capture, side("metadata", "application/warc-fields", meta))).alias("record"))


def write(records: DataFrame, path: str, compression: str = "gzip", records_per_file: int = 60_000) -> None:
    # Pages are read back once or twice, so the fastest level is the cheapest.
    records.write.option("lineSep", TERMINATOR).option("compression", compression).option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path)


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, place): what lies between version lines, and where; those of a file, joined by them, are the file.

    Lines are cut at the version, not at the blank line before it: a block may
    end in blank lines itself, and the reader can miss a separator whose
    beginning it has just met at the end of its buffer.
    """
    x = spark.read.option("lineSep", VERSION + EOL).text(path)
    return x.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def _by_length(raw: DataFrame) -> DataFrame:
    """(head, block) of the records of _raw() rows, cut by their lengths alone.

    A file is one task's work, sorted by Spark and read batch by batch; memory
    holds a batch and a record.  A file whose lengths don't add up is an error.
    """

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        start, end = (VERSION + EOL).encode(), TERMINATOR.encode()
        length = re.compile(rb"(?i)(?:^|\r\n)Content-Length: *([0-9]+)")
        now, data = None, bytearray()
        for batch in batches:
            heads, blocks = [], []
            for file, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file != now:
                    if data:
                        raise ValueError(f"{now} ends within a record")
                    now = file
                else:
                    data += start
                data += value.as_py().encode()
                at = 0
                while at < len(data):
                    body = data.find(end, at)
                    if body < 0:
                        break
                    head = bytes(data[at:body])
                    if not head.startswith(start):
                        raise ValueError(f"{file} has no record where one should start")
                    body, size = body + len(end), int(length.search(head)[1])
                    if len(data) < body + size + len(end):
                        break
                    heads.append(head[len(start) :].decode())
                    blocks.append(data[body : body + size].decode())
                    at = body + size + len(end)
                del data[:at]
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(blocks, pa.string())], names=["head", "block"])
        if data:
            raise ValueError(f"{now} ends within a record")

    return raw.repartition("file").sortWithinPartitions("file", "block", "place").select("file", "value").mapInArrow(mend, "head string, block string")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.concat(F.lit(EOL), F.col("head")), f"(?i)\\r\\n{name}: *([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(head, block, file, fits) of what lies between version lines; fits: its length is what it says."""
    # From here on bytes are cut, not characters: lengths are at hand and nothing is decoded.
    x = _raw(spark, path).where("value <> ''").select("file", F.col("value").cast("binary").alias("data"))
    x = x.withColumn("head", F.substring_index(F.col("data").cast("string"), TERMINATOR, 1))
    x = x.select("head", "file", held(_after(F.col("data"), F.col("head"))).alias("block"))
    size = F.octet_length("block") - len(TERMINATOR)
    stated = F.regexp_extract(F.concat(F.lit(EOL), F.col("head")), r"(?i)\r\nContent-Length: *([0-9]+)", 1).try_cast("int")
    ends = F.substring("block", size + 1, F.lit(len(TERMINATOR))) == F.lit(TERMINATOR).cast("binary")
    return x.select("file", "head", F.substring("block", F.lit(1), size).cast("string").alias("block"), F.coalesce((size == stated) & ends, F.lit(False)).alias("fits"))


def _after(data: Column, head: Column) -> Column:
    """The bytes after a head and its blank line."""
    return F.substring(data, F.octet_length(head) + 1 + len(TERMINATOR), F.octet_length(data))


def _records(lines: DataFrame) -> DataFrame:
    return lines.select(_field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("record_id"), _field("WARC-Concurrent-To").alias("concurrent_to"), _field("WARC-Refers-To").alias("refers_to"), _field("WARC-Target-URI").alias("uri"), _field("WARC-Payload-Digest").alias("digest"), "block")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records (type, record_id, concurrent_to, refers_to, uri, digest, block) of all archives under path."""
    lines = _lines(spark, path)
    odd = materialise(lines.where(~F.col("fits")).select("file").distinct(), "warc-odd")
    if odd.isEmpty():
        return _records(lines)
    good = lines.join(odd, "file", "left_anti").select("head", "block")
    return _records(good.unionByName(_by_length(_raw(spark, path).join(odd, "file", "left_semi"))))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, type, uri, refers_to, payload_bytes, payload_digest, payload, request, metadata).

    Requests and metadata records come to the response or revisit that they
    are concurrent to; request and metadata are structs (record_id, block,
    n), of the least record_id if there are several (n), and null without any.
    A response's length and digest are those of the payload that was read; a
    revisit's are those that its headers state.  Satellites without a capture
    make no row.  All three kinds meet at the capture's id in one shuffle, and
    columns that aren't asked for don't travel.
    """
    kind = F.col("type")
    capture, again, satellite = kind.isin("response", "revisit"), kind == "revisit", kind.isin("request", "metadata") & F.col("concurrent_to").isNotNull()
    http = F.substring_index("block", TERMINATOR, 1)
    x = records.where(capture | satellite).withColumn("at", F.when(capture, F.col("record_id")).otherwise(F.col("concurrent_to")))
    x = x.withColumn("payload", F.when(kind == "response", _after(F.col("block").cast("binary"), http)))
    stated = F.regexp_extract(F.concat(F.lit(EOL), http), r"(?i)\r\nContent-Length: *([0-9]+)", 1).try_cast("bigint")
    x = x.withColumn("payload_bytes", F.when(again, stated).otherwise(F.octet_length("payload").cast("long")))
    x = x.withColumn("payload_digest", F.when(again, F.regexp_replace("digest", "^sha1:", "")).when(capture, F.sha1("payload")))
    own = [F.max(F.when(capture, F.col(c))).alias(c) for c in ("type", "uri", "refers_to", "payload_bytes", "payload_digest", "payload")]
    sides = [F.min(F.when(kind == k, F.struct("record_id", "block"))).alias(k) for k in ("request", "metadata")] + [F.count(F.when(kind == k, 1)).alias(f"n_{k}") for k in ("request", "metadata")]
    x = x.groupBy(F.col("at").alias("record_id")).agg(*own, *sides).where("type is not null")
    nested = [F.when(F.col(k).isNotNull(), F.struct(f"{k}.record_id", f"{k}.block", F.col(f"n_{k}").alias("n"))).alias(k) for k in ("request", "metadata")]
    digest = F.when(F.col("type") == "revisit", F.col("payload_digest")).otherwise(base32(F.col("payload_digest"))).alias("payload_digest")
    return x.select("record_id", "type", "uri", "refers_to", "payload_bytes", digest, F.col("payload").cast("string").alias("payload"), *nested)


def round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes pages as archives, reads them and returns one row per page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, url).
    Archives stay if a path is given.  A
    null html is an empty payload, a null url or id stays null.  Rows that
    repeat are captures of their own, one of them the response.  An empty
    table gives an empty one; other columns are ignored.
    """
    spark = pages.sparkSession
    own, path = path is None, path or new_path(spark, "warc")
    write(transactions(pages, id_col, url_col, html_col, least_bytes), path)
    page = F.regexp_extract(F.concat(F.lit(EOL), F.col("metadata.block")), r"\r\npageId: (-?[0-9]+)", 1).try_cast("bigint")
    thin = lambda records: materialise(captures(records).select("record_id", "type", "uri", "refers_to", "payload_bytes", "payload_digest", page.alias("page_id")), "warc-captures")
    # Lengths are checked in the same pass; only if one doesn't fit are archives read once more, by length.
    fit = Observation()
    found = thin(_records(_lines(spark, path).observe(fit, F.count(F.when(~F.col("fits"), 1)).alias("odd"))))
    if fit.get["odd"]:
        discard(found)
        found = thin(read(spark, path))
    if own:
        remove(spark, path)
    originals = found.where("type = 'response'").select(F.col("record_id").alias("original"), F.col("page_id").alias("original_page"))
    again = found.where("type = 'revisit'").join(originals, F.col("refers_to") == F.col("original"), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    return found.where("type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to"), F.col("uri").alias("url")).unionByName(again.select(*columns, F.col("original_page").alias("refers_to"), F.col("uri").alias("url")))
