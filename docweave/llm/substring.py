"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is
the least of the hashes of its runs of ``run`` words; equal windows have equal
minimisers.  Consecutive windows with one minimiser, a super-k-mer, go to that
minimiser's bucket, in two rounds.  First only their places go: a super-k-mer
whose minimiser nobody else has can't hold a repeated window.  Then those that
are left travel as one packed string of words each.  In a bucket windows are
sorted by hash, and windows of equal hash compared word by word, which counts
them exactly.

Hot groups.  Runs that make up more than one in ``heavy`` of all runs are found
first, with mergeable summaries of bounded size (what survives has at least a
fourth of that, so at most 4 * ``heavy`` do, 2 MB, and these go to all tasks).  They
come last in the order of minimisers: a window that holds any other run goes by
that one, so the windows around a very common passage spread by what differs in
them.  What is left of a common passage is the same string everywhere: a batch
sends it once.  Documents in which it occurs needn't go to its bucket once the
batch alone has it twice; they go to buckets of their own, marked as repeated.
The first round does the same with minimisers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, materialise

WINDOW, RUN, HEAVY = 35, 8, 1 << 16
#: Bytes of text that a batch holds, and that a bucket is planned for.
BATCH_BYTES, BUCKET_BYTES = 8 << 20, 24 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """64-bit hash of each word, known ones kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


#: One for all tasks of a worker process.
KNOWN = _Hashes()


def _hashes() -> _Hashes:
    return KNOWN


def _run_hashes(words: np.ndarray, run: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - run + 1), np.uint64)
    for k in range(run):
        out = out * MULTIPLIER + words[k : len(words) - run + 1 + k]
    return _mix(out)


class _Batch:
    """Words of several documents, one after the other."""

    def __init__(self, hashes: _Hashes):
        self.hashes, self.parts, self.sizes, self.keys, self.bytes = hashes, [], [], [], 0

    def add(self, text: str | None, key: tuple = ()) -> int:
        data = (text or "").encode("utf-8", "surrogatepass")
        words = data.split()
        self.parts.append(np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words)))
        self.sizes.append(len(words))
        self.keys.append(key)
        self.bytes += len(data)
        return len(data)

    def runs(self, run: int) -> np.ndarray:
        """Hashes of the runs within documents."""
        words, sizes = np.concatenate(self.parts), np.array(self.sizes)
        out = _run_hashes(words, run)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes)[: len(out)] - np.arange(len(out))
        return out[left >= run]

    def super_kmers(self, window: int, run: int, heavy: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, minimiser, first window, number of windows) of each super-k-mer."""
        words, sizes = np.concatenate(self.parts), np.array(self.sizes)
        if len(words) < window:
            return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        runs = _run_hashes(words, run)
        order = runs >> np.uint64(1)
        if len(heavy):
            at = np.minimum(np.searchsorted(heavy, runs), len(heavy) - 1)
            order |= (heavy[at] == runs).astype(np.uint64) << np.uint64(63)
        # The low bits hold the place, so that a super-k-mer ends where its minimiser is met again further on: two
        # equal windows are then never in one super-k-mer.
        place = np.uint64((1 << 20) - 1)
        least = _least((order & ~place) | (np.arange(len(order), dtype=np.uint64) & place), window - run + 1)
        doc = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
        ends = np.cumsum(sizes)
        inside = ends[doc] - np.arange(len(least)) >= window
        first = np.ones(len(least), bool)
        first[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(first)
        n = np.diff(np.append(starts, len(least)))
        use = inside[starts]
        starts, n = starts[use], n[use]
        doc = doc[starts]
        return doc, _mix(least[starts] & ~place), starts - (ends - sizes)[doc], n


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def heavy_runs(docs: DataFrame, window: int, run: int, heavy: int, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Hashes of runs that may be over one in ``heavy`` of all (sorted), and the bytes of all texts.

    Each task keeps at most 2 * heavy counters: when there are more, the count
    at that place is taken from all and what is left at zero goes, so counts
    are too low by at most the task's total / (2 * heavy).  Of these a task
    reports those of at least its total / (4 * heavy).  A run of over
    total / heavy therefore keeps total / (4 * heavy) in the sum over tasks,
    and at most 4 * heavy runs can have that.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, size, total = _hashes(), 0, 0
        keys, counts, now = np.zeros(0, np.uint64), np.zeros(0, np.int64), _Batch(hashes)

        def merge() -> None:
            nonlocal keys, counts, now, total
            if not now.sizes:
                return
            runs = now.runs(run)
            k, n = np.unique(runs, return_counts=True)
            total += len(runs)
            now = _Batch(hashes)
            allk = np.concatenate([keys, k])
            keys, where = np.unique(allk, return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            if len(keys) > 2 * heavy:
                cut = np.partition(counts, len(counts) - 2 * heavy - 1)[len(counts) - 2 * heavy - 1]
                keys, counts = keys[counts > cut], counts[counts > cut] - cut

        for batch in batches:
            for text in batch.column(0):
                size += now.add(text.as_py())
                if now.bytes > BATCH_BYTES:
                    merge()
        merge()
        large = counts >= max(2, total // (4 * heavy))
        keys, counts = keys[large], counts[large]
        yield pa.RecordBatch.from_arrays([pa.array([None, None, *keys.view(np.int64).tolist()], pa.int64()), pa.array([0, 1, *[2] * len(keys)], pa.int32()), pa.array([size, total, *counts.tolist()], pa.int64())], names=["run", "kind", "n"])

    found = materialise(docs.select(text_col).mapInArrow(count, "run long, kind int, n long").groupBy("kind", "run").agg(F.sum("n").alias("n")), "substring-heavy")
    whole = {r.kind: r.n for r in found.where("kind < 2").collect()}
    total = whole.get(1, 0)
    top = found.where((F.col("kind") == 2) & (F.col("n") >= max(2, total // (4 * heavy)))).select("run").collect()
    return np.sort(np.array([r.run for r in top], np.int64).view(np.uint64)), whole.get(0, 0)


#: First round: super-k-mers of a batch for one bucket, as arrays of PLACE; those marked known have company already.
PLACE = np.dtype([("minimiser", "<u8"), ("doc_id", "<i8"), ("text_hash", "<i8"), ("start", "<i4"), ("n", "<i4"), ("no_id", "u1"), ("known", "u1")])
KEY = ["no_id", "doc_id", "text_hash"]


def _places(docs: DataFrame, window: int, run: int, heavy: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, places) of docs (doc_id, no_id, text_hash, text)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        now = _Batch(hashes)

        def flush() -> Iterator[pa.RecordBatch]:
            doc, minimiser, start, n = now.super_kmers(window, run, heavy) if now.sizes else [np.zeros(0, int)] * 4
            out = np.zeros(len(doc), PLACE)
            keys = np.array(now.keys, [("doc_id", "<i8"), ("no_id", "u1"), ("text_hash", "<i8")])[doc]
            for c in KEY:
                out[c] = keys[c]
            out["minimiser"], out["start"], out["n"] = minimiser, start, n
            _, which, count = np.unique(minimiser, return_inverse=True, return_counts=True)
            bucket = (out["minimiser"] % np.uint64(buckets)).astype(np.int64)
            several = count[which] > 1
            # One of several stands for them in the bucket; all of them go elsewhere, by document.
            _, one = np.unique(which[several], return_index=True)
            lead = out[several][one]
            lead["no_id"] = 2
            out["known"] = several
            bucket[several] = ((out["text_hash"][several] ^ out["doc_id"][several]).view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            out, bucket = np.concatenate([out, lead]), np.concatenate([bucket, (lead["minimiser"] % np.uint64(buckets)).astype(np.int64)])
            order = np.argsort(bucket, kind="stable")
            out, bucket = out[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            parts = np.split(out, cuts) if len(out) else []
            at = bucket[np.concatenate([[0], cuts])] if len(out) else []
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["bucket", "places"])

        for batch in batches:
            for doc_id, no_id, text_hash, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                now.add(text.as_py(), (doc_id or 0, no_id, text_hash))
                if now.bytes > BATCH_BYTES:
                    yield from flush()
                    now = _Batch(hashes)
        yield from flush()

    return docs.select("doc_id", "no_id", "text_hash", "text").mapInArrow(send, "bucket int, places binary")


def _by_document(found: np.ndarray) -> pa.Table:
    """Rows (no_id, doc_id, text_hash, places) of PLACE entries, one for each document."""
    found = found[np.lexsort([found["start"], *(found[c] for c in reversed(KEY))])]
    cut = np.flatnonzero(np.any([found[c][1:] != found[c][:-1] for c in KEY], axis=0)) + 1 if len(found) else np.zeros(0, int)
    first = np.concatenate([[0], cut]).astype(int) if len(found) else []
    head = found[first]
    parts = np.split(found, cut) if len(found) else []
    return pa.table({"no_id": pa.array(head["no_id"] == 1), "doc_id": pa.array(head["doc_id"]), "text_hash": pa.array(head["text_hash"]), "places": pa.array([x[["minimiser", "start", "n"]].copy().astype(SPAN).tobytes() for x in parts], pa.binary())})


SPAN = np.dtype([("minimiser", "<u8"), ("start", "<i4"), ("n", "<i4")])


def _in_company(table: pa.Table) -> pa.Table:
    """Super-k-mers of a bucket whose minimiser another one has too."""
    all_ = np.frombuffer(b"".join(table.column("places").to_pylist()), PLACE)
    known, rest = all_[all_["known"] == 1], all_[all_["known"] == 0]
    _, which, count = np.unique(rest["minimiser"], return_inverse=True, return_counts=True)
    crowd = np.zeros(len(count), np.int64)
    np.add.at(crowd, which, np.where(rest["no_id"] == 2, 2, 1))
    rest = rest[(crowd[which] > 1) & (rest["no_id"] != 2)]
    return _by_document(np.concatenate([known, rest]))


#: Second round: a string of words to its bucket (where it starts in its document, unless the batch has it several times), or ranges known to be repeated.
PARCEL = "bucket int, words binary, doc_id long, no_id boolean, text_hash long, start int, n int"


def _parcels(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """docs (doc_id, no_id, text_hash, text, places) as packed strings."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[bytes, list] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for s, (bucket, places) in strings.items():
                if len(places) == 1:
                    rows.append((bucket, s, *places[0]))
                else:
                    n = places[0][4]
                    rows.append((bucket, s, None, None, None, None, n))
                    rows += [(hash(p[:3]) % buckets, None, *p) for p in places]
            strings.clear()
            cols = list(zip(*rows)) if rows else [[]] * 7
            types = (pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["bucket", "words", "doc_id", "no_id", "text_hash", "start", "n"])

        for batch in batches:
            for doc_id, no_id, text_hash, text, places in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), batch.column(4)):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                spans = np.frombuffer(b"".join(places.as_py()), SPAN)
                for minimiser, a, n in spans.tolist():
                    s = b" ".join(words[a : a + n + window - 1])
                    held += len(s)
                    place = (doc_id, no_id, text_hash, a, n)
                    if s in strings:
                        strings[s][1].append(place)
                    else:
                        strings[s] = (minimiser % buckets, [place])
                if held > BATCH_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    # held() keeps the filter above the join that docs comes from, whose shuffle of texts then serves the last join as well.
    some = docs.withColumn("places", held(F.col("places"))).where("places is not null")
    return some.select("doc_id", "no_id", "text_hash", "text", "places").mapInArrow(send, PARCEL)


RANGES = "doc_id long, no_id boolean, text_hash long, ranges binary"


def _ranges(doc: list, no_id: list, text_hash: list, starts: np.ndarray, ends: np.ndarray) -> dict[tuple, list]:
    out: dict[tuple, list] = {}
    for k, a, b in zip(zip(doc, no_id, text_hash), starts.tolist(), ends.tolist()):
        out.setdefault(k, []).append((a, b))
    return out


def _bucket(table: pa.Table, window: int) -> pa.Table:
    """Ranges of words [start, end) that a repeated window of this bucket covers, by document."""
    names = ("doc_id", "no_id", "text_hash", "start", "n")
    sent = table.column("words").is_valid().to_numpy(zero_copy_only=False)
    known, parcels = table.filter(pa.array(~sent)), table.filter(pa.array(sent))
    k = {n: known.column(n).to_pylist() for n in names}
    starts = np.array(k["start"], np.int64)
    found = _ranges(k["doc_id"], k["no_id"], k["text_hash"], starts, starts + np.array(k["n"], np.int64) + window - 1)

    p = {n: parcels.column(n).to_pylist() for n in names}
    ids: dict[bytes, int] = {}
    sizes, parts = [], []
    for s in parcels.column("words"):
        w = s.as_py().split(b" ")
        sizes.append(len(w))
        parts.append(np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int32, len(w)))
    if parts:
        words = np.concatenate(parts)
        del parts
        sizes = np.array(sizes, np.int64)
        n = sizes - window + 1
        firsts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + firsts[owner]
        # Rolling hash of windows: prefix sums of word * multiplier ** place, brought to a common place by the inverse.
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), MULTIPLIER, np.uint64)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(words.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        back = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), back, np.uint64)]))
        key = (sums[at + window] - sums[at]) * inverse[at]
        del powers, sums, inverse
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        lead = np.concatenate([[True], ~same])
        head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        # Word by word against the first window of that hash; should two differ, windows of that hash are told apart by their words.
        repeated = np.zeros(len(order), bool)
        weight = np.array([2 if x is None else 1 for x in p["start"]], np.int64)[owner]
        tail = np.flatnonzero(~lead)
        differ = np.zeros(len(tail), bool)
        for i in range(0, len(tail), 1 << 16):
            t = tail[i : i + (1 << 16)]
            differ[i : i + len(t)] = (words[at[order[t]][:, None] + np.arange(window)] != words[at[head[t]][:, None] + np.arange(window)]).any(axis=1)
        group = np.cumsum(lead) - 1
        count = np.bincount(group, weight[order])
        repeated[order] = count[group] > 1
        for g in np.unique(group[tail[differ]]).tolist():
            members = order[group == g]
            texts = [words[at[m] : at[m] + window].tobytes() for m in members]
            tally: dict[bytes, int] = {}
            for m, x in zip(members, texts):
                tally[x] = tally.get(x, 0) + int(weight[m])
            repeated[members] = [tally[x] > 1 for x in texts]
        hit = np.flatnonzero(repeated)
        hit = hit[weight[hit] == 1]
        if len(hit):
            # Neighbouring windows of a parcel make one range.
            cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)) + 1
            a, b = hit[np.concatenate([[0], cut])], hit[np.concatenate([cut - 1, [len(hit) - 1]])]
            own = owner[a]
            offset = np.array([x or 0 for x in p["start"]], np.int64)[own] - firsts[own]
            more = _ranges(*([p[c][o] for o in own] for c in ("doc_id", "no_id", "text_hash")), at[a] + offset, at[b] + offset + window)
            for key_, r in more.items():
                found.setdefault(key_, []).extend(r)
    rows = list(found)
    cols = list(zip(*rows)) if rows else [[]] * 3
    return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "no_id": pa.array(cols[1], pa.bool_()), "text_hash": pa.array(cols[2], pa.int64()), "ranges": pa.array([np.array(found[r], np.int32).tobytes() for r in rows], pa.binary())})


def _kept(text: str | None, ranges: list[bytes] | None) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    keep = np.ones(len(words), bool)
    if ranges:
        steps = np.zeros(len(words) + 1, np.int64)
        spans = np.frombuffer(b"".join(ranges), np.int32).reshape(-1, 2)
        np.add.at(steps, spans[:, 0], 1)
        np.add.at(steps, spans[:, 1], -1)
        keep = np.cumsum(steps[:-1]) == 0
    return words, keep


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, run: int = RUN, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, text, ranges): rows of docs with the ranges of words to remove, packed as pairs of 32-bit integers.

    A document is known by its id, a whole number or null, and a hash of its
    text, so rows that repeat both are repetitions of each other and share their
    ranges.  A null or empty text has no words.  A text is one row's work,
    however long; what travels of it are its super-k-mers.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = own.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("text_hash"), "text")
    heavies, size = heavy_runs(own, window, run, heavy)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, -(-size // BUCKET_BYTES))
    # More buckets than shuffle partitions are dealt over as many tasks, so that a task has a bucket's text whatever the input.
    by_bucket = lambda rows: (rows.repartition(buckets, "bucket") if buckets > partitions else rows).groupBy("bucket")
    per_document = lambda rows, name: rows.groupBy(*KEY).agg(F.collect_list(name).alias(name))
    places = by_bucket(_places(keyed, window, run, heavies, buckets)).applyInArrow(_in_company, "no_id boolean, doc_id long, text_hash long, places binary")
    # Both joins deal the same columns by the same key, so texts are shuffled once.
    placed = keyed.join(per_document(places, "places"), KEY, "left")
    ranges = by_bucket(_parcels(placed, window, buckets)).applyInArrow(lambda table: _bucket(table, window), RANGES)
    out = keyed.join(per_document(ranges, "ranges"), KEY, "left")
    return out.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "text", "ranges")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): what is left of each text, words joined by single spaces.

    One row per row of docs; nulls, repeated rows, empty tables and other
    columns are as in digests().
    """

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                words, keep = _kept(text.as_py(), ranges.as_py())
                out.append((len(words), int((~keep).sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode("utf-8", "surrogatepass")))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return marked(docs, id_col, text_col, **options).mapInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: (doc_id, n_words, n_removed, kept_sha256).

    A null or empty text has no words.  Repeated rows stay repeated, and
    repeat each other.  Null ids are kept.  An empty table gives an empty one.
    Other columns are ignored, whatever their names.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, sha = [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                words, keep = _kept(text.as_py(), ranges.as_py())
                n.append(len(words))
                removed.append(int((~keep).sum()))
                if removed[-1]:
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked(docs, id_col, text_col, **options).mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
