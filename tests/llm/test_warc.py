import base64
import gzip
import glob
import hashlib
from collections import Counter, defaultdict

import pytest

from docweave.llm import warc

END = "\r\n\r\n"
NASTY = [None, "", "x", "\r\n", END, "a" + END + "WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3" + END + "abc" + END, END + "WARC/1.1\r\n", "WARC/1.1\r\n", "é中😀\n" * 50, "tail\r\n\r", "big " * 50000, "same", "same", "same"]


def expected(rows):
    groups = defaultdict(list)
    for page, html in rows:
        groups[(html or "").encode()].append(page)
    out = Counter()
    for data, pages in groups.items():
        first = max(pages, key=lambda p: (p is not None, p or 0))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[first, len(data), digest, "response", None] += 1
        pages.remove(first)
        for p in pages:
            out[p, len(data), digest, "revisit", first] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h.example/{i}?a b\n", t, "x") for i, t in enumerate(NASTY)] + [(4, "u", "same", None), (13, "http://h.example/13?a b\n", "same", "x"), (None, None, "same", None), (None, None, None, None), (-5, "no scheme", "lonely", None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string").coalesce(3)


@pytest.mark.parametrize("odd", [True, False])
def test_round_trip(spark, pages, odd, sf_dir):
    pages = pages if odd else spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = Counter(tuple(r)[:5] for r in warc.round_trip(pages).collect())
    assert got == expected([(r.page_id, r.html) for r in pages.collect()])


def test_empty(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives(spark, pages, tmp_path):
    """The files are records one after the other, read here by nothing but their lengths."""
    warc.write(warc.transactions(pages), f"file://{tmp_path}/a")
    kinds, ids, ties = Counter(), [], []
    for f in glob.glob(f"{tmp_path}/a/*.gz"):
        data = gzip.open(f).read()
        while data:
            head, _, data = data.partition(END.encode())
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(fields["Content-Length"])
            assert data[n : n + 4] == END.encode()
            data = data[n + 4 :]
            kinds[fields["WARC-Type"]] += 1
            ids.append(fields["WARC-Record-ID"])
            ties.append(fields.get("WARC-Concurrent-To"))
    n = pages.count()
    assert kinds["request"] == kinds["metadata"] == n == kinds["response"] + kinds["revisit"]
    assert len(set(ids)) == len(ids) and {t for t in ties if t} <= set(ids)


def test_captures(spark):
    rows = [("response", "r1", None, None, "u", "sha1:X", "HTTP/1.1 200 OK" + END + "hi"), ("request", "q2", "r1", None, "u", None, "b"), ("request", "q1", "r1", None, "u", None, "a"), ("metadata", "m", "gone", None, "u", None, "a"), ("warcinfo", "w", None, None, None, None, "")]
    (got,) = warc.captures(spark.createDataFrame(rows, "type string, record_id string, concurrent_to string, refers_to string, uri string, digest string, block string")).collect()
    assert (got.record_id, got.payload, got.payload_bytes, got.request.record_id, got.request.n, got.metadata) == ("r1", "hi", 2, "q1", 2, None)


def test_small_payloads_stay(pages):
    got = [r for r in warc.round_trip(pages, least_bytes=5).collect() if r.payload_bytes < 5]
    assert {r.record_type for r in got} == {"response"}
