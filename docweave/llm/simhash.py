"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; bit b is 1 where over half of the document's
shingle hashes have it.  Two fingerprints within ``max_distance`` bits link.
Fingerprints are cut into segments; if two differ in at most d bits, then in
one of m segments they differ in at most d // m.  Every distinct fingerprint is
put into a table once for each segment, and looks up all values within that
small Hamming ball around its own segment (one bit less in the segments that
can do with that); what it meets is verified by the distance of the whole
fingerprints.

Copies: equal fingerprints are one entry however many documents have them.
Crowded table entries: where more than ``crowd`` distinct fingerprints share a
segment, listing their pairs would grow with the square of the crowd.  Those
fingerprints and the ones that look them up take an exact way instead: each is
put under every value within ``max_distance`` / 2 bits (rounded up) of it, two
linked ones meet at a value between them, and a value's members form a chain
through its least member where their distances allow it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, materialise

BITS = 64
SEED = 42


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many rows of words (n x k, 64-bit) have each bit, by carry-save adders: three rows become a sum and a carry."""
    total, weight = np.zeros(words.shape[1] * 64, np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            m = len(words) // 3
            a, b, c = words[:m], words[m : 2 * m], words[2 * m : 3 * m]
            x = a ^ b
            carries.append((a & b) | (c & x))
            words = np.concatenate([x ^ c, words[3 * m :]])
        total += weight * np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return total


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, lower-cased in ASCII and joined by spaces; of all words if there are fewer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes both know ASCII only
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = xxhash.xxh64_intdigest
    return np.array([h(line[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of one text; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    bits = 2 * bit_counts(hashes[:, None]) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def wide_fingerprint(hashes: np.ndarray, bits: int) -> bytes:
    """A fingerprint of more than 64 bits of distinct shingle hashes: each hash goes on as a sequence of mixed ones."""
    more = [hashes]
    for _ in range(bits // 64 - 1):
        x = more[-1] + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        more.append(x ^ (x >> np.uint64(31)))
    return np.packbits(2 * bit_counts(np.stack(more, axis=1)) > len(hashes), bitorder="little").tobytes()


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of whole texts, computed in Arrow batches."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _segments(m: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of m segments that differ in width by at most 1."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _ball(lo: int, width: int, radius: int) -> list[int]:
    """Signed masks that change at most ``radius`` of ``width`` bits from bit ``lo`` on."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(lo, lo + width), r)]
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in masks]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _keyed(fps: DataFrame, m: int, radii: list[int]) -> DataFrame:
    """(key, fp): for each segment, its own value and those that up to radii[segment] bits set in place of 0 make of it.

    Bits are only set, never cleared: of two segments that differ in one bit,
    the one that has 0 there finds the other.  (From two bits on, all masks
    are taken, as bits may differ either way.)
    """
    parts = []
    for no, (lo, width) in enumerate(_segments(m)):
        own = F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1).cast("long"))
        tag = F.lit(no << width).cast("long") if width < 62 else F.lit(0).cast("long")
        masks = _longs(_ball(0, width, radii[no]))
        if radii[no] == 1:
            masks = F.filter(masks, lambda x: own.bitwiseAND(x) == 0)
        key = F.transform(masks, lambda x: own.bitwiseXOR(x) + tag)
        parts.append(fps.select(F.explode(key).alias("key"), "fp"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def near_pairs(fps: DataFrame, max_distance: int = 2, segments: int = 2, crowd: int = 64) -> DataFrame:
    """Edges (a, b), a < b, between distinct fingerprints ``fp``; every linked pair is joined by a path of edges.

    Pairs met through table entries of at most ``crowd`` fingerprints are all
    returned; among crowds a pair may be joined through other links instead.
    """
    # If max_distance = q * segments + r, then some of the first r + 1 segments differ in at most q bits or some other one in at most q - 1.
    q, r = divmod(max_distance, segments)
    radii = [q if no <= r else q - 1 for no in range(segments)]
    table = _keyed(fps, segments, [0] * segments)
    counts = table.groupBy("key").agg(F.count("*").alias("n"))
    entries = table.join(counts, "key")
    entries = entries.where(F.col("n") <= crowd).select("key", F.col("fp").alias("other")).unionByName(
        counts.where(F.col("n") > crowd).select("key", F.lit(None).cast("long").alias("other"))
    )
    met = _keyed(fps, segments, [max(0, x) for x in radii]).join(entries, "key")
    near = (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_distance)
    met = met.where(F.col("other").isNull() | near).select(F.least("fp", "other").alias("fp"), F.when(F.col("other").isNotNull(), F.greatest("fp", "other")).alias("other"))
    met = materialise(met.distinct(), "simhash-met")
    pairs = met.where("other is not null").select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = met.where("other is null").select("fp")
    return pairs.unionByName(_crowd_edges(crowded, max_distance))


def _crowd_edges(fps: DataFrame, max_distance: int) -> DataFrame:
    """Edges that connect all linked pairs among fps, whatever their number.

    Two fingerprints at distance d <= max_distance share a value within
    ceil(max_distance / 2) bits of both.  With an even limit all members of a
    value are linked to each other; with an odd one its least member may be
    one bit too far, so the members (at most one for each mask) are compared.
    """
    half = (max_distance + 1) // 2
    masks = _longs(_ball(0, BITS, half))
    at = fps.select(F.explode(F.transform(masks, lambda x: F.col("fp").bitwiseXOR(x))).alias("value"), "fp")
    if max_distance % 2 == 0:
        least = at.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        return at.join(least, "value").where("a < fp").select("a", F.col("fp").alias("b")).distinct()
    members = at.groupBy("value").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    one = members.select("value", "all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b"))
    return one.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)).distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int, segments: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, text_hash, fp) of docs, and (fp, root, least) of fingerprints: their component's least fingerprint, their least id."""
    text = F.col(text_col)
    thin = materialise(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), fingerprint_column(text, shingle).alias("fp")), "simhash-fp")
    fps = thin.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(near_pairs(fps.select("fp"), max_distance, segments, crowd), "simhash-cc")
    return thin, fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2, segments: int = 2, crowd: int = 64) -> DataFrame:
    """One row per row of docs: (id, fingerprint as 16 hex digits, component_id).

    component_id is the least id of all documents that can be reached over
    links, a document's own included.  Null or empty texts, and texts without
    words, have fingerprint 0 and link like any other.  Repeated rows stay
    repeated; null ids are carried but never are a component's least id unless
    all of its ids are null.  No rows in, no rows out.  Other columns are
    ignored, so clashing names do no harm.
    """
    thin, rooted = _grouped(docs, id_col, text_col, shingle, max_distance, segments, crowd)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(least, "root").select("fp", "component_id")
    return thin.join(of_fp, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Wide fingerprints: bits; tables, minima of a table's key, members that a block compares, rows of a task.
WIDE, TABLES, MINIMA, BLOCK, TASK_ROWS = 512, 32, 5, 512, 16384
_FACTORS, _SHIFTS = (np.random.default_rng(SEED + k).integers(0, 1 << 64, TABLES * MINIMA, dtype=np.uint64) for k in (0, 1))


def table_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each table: of so many orders of all shingles, each set's least ones.

    Two sets of Jaccard similarity s have a table's key in common with
    probability s ** MINIMA.
    """
    import xxhash

    least = np.full(TABLES * MINIMA, np.iinfo(np.uint64).max, "<u8")
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[i : i + 2048, None] * (_FACTORS | np.uint64(1)) + _SHIFTS).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), t) for t, x in enumerate(least.astype("<u8").reshape(TABLES, MINIMA))], dtype="<u8")


def distances(similarity: float) -> tuple[int, int]:
    """(expected distance at that similarity, one that hardly any pair at it exceeds) of wide fingerprints.

    The similarity is a cosine of 2 s / (1 + s) at least, and the angle's share
    of a half turn is the share of differing bits.  Among few shingles ties add
    to it (four of five: 0.1875 in place of 0.1516), hence a quarter more, and
    then five standard deviations.
    """
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    most = min(1.0, 1.25 * share)
    return int(WIDE * share), int(np.ceil(WIDE * most + 5 * np.sqrt(WIDE * most * (1 - most))))


def _blocks(table: pa.Table, far: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(columns, near) of each bucket's block of members: which pairs are within ``far`` bits and not joined by links so far (``root`` differs)."""
    names = ("key", "i", "j")
    cols = {n: table.column(n).to_numpy() for n in table.column_names}
    order = np.lexsort([cols["fp"], *(cols[n] for n in reversed(names))])
    cols = {n: c[order] for n, c in cols.items()}
    changes = np.any([cols[n][1:] != cols[n][:-1] for n in names], axis=0) if len(order) else np.zeros(0, bool)
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(order)]
    for lo, hi in zip(cuts, cuts[1:]):
        x = {n: c[lo:hi] for n, c in cols.items()}
        if (x["root"] == x["root"][:1]).all():
            continue
        w = np.frombuffer(b"".join(x["wide"]), "<u8").reshape(hi - lo, -1)
        distance = np.zeros((hi - lo, hi - lo), np.int32)
        for k in range(w.shape[1]):
            distance += np.bitwise_count(w[:, None, k] ^ w[None, :, k])
        near = (distance <= far) & (x["root"][:, None] != x["root"][None, :])
        if x["i"][0] != x["j"][0]:
            near &= x["block"][:, None] != x["block"][None, :]
        yield x, near


def _stars(table: pa.Table, far: int) -> pa.Table:
    """(a, b, degree): each member a with that of its neighbours that has most neighbours (``degree``) itself, then the least."""
    out = [np.zeros((0, 3), np.int64)]
    for x, near in _blocks(table, far):
        degree = near.sum(axis=1)
        a = np.flatnonzero(degree)
        b = np.where(near[a], degree[None, :], -1).argmax(axis=1)
        out.append(np.stack([x["fp"][a], x["fp"][b], degree[b]], axis=1))
    rows = np.unique(np.concatenate(out), axis=0)
    return pa.table({n: pa.array(rows[:, k], pa.int64()) for k, n in enumerate(("a", "b", "degree"))})


def _doubtful(table: pa.Table, far: int) -> pa.Table:
    """(key, i, j, block, fp) of members with a neighbour that no links join them with."""
    out = [(x, near.any(axis=1)) for x, near in _blocks(table, far)]
    types = {"key": pa.int64(), "i": pa.int32(), "j": pa.int32(), "block": pa.int32(), "fp": pa.int64()}
    return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *(x[n][hit] for x, hit in out)]), t) for n, t in types.items()})


def alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sets of shingles, sorted, have a Jaccard similarity of ``least`` or more."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def _verified(table: pa.Table, far: int, least: float) -> pa.Table:
    """Links (a, b) that join all alike members of a block; a pair is looked at in the first table only in which it shares a key."""
    out = []
    for x, near in _blocks(table, far):
        keys = np.frombuffer(b"".join(x["keys"]), "<i8").reshape(len(near), -1)
        first = np.zeros(near.shape, bool)
        for t in range(keys.shape[1] - 1, -1, -1):
            first = np.where(keys[:, None, t] == keys[None, :, t], keys[0, t] == x["key"][0], first)
        sets = [np.frombuffer(v, "<u8") for v in x["shingles"]]
        root = x["root"].copy()
        for a, b in zip(*np.nonzero(np.triu(near & first, 1))):
            if root[a] != root[b] and alike(sets[a], sets[b], least):
                root[root == root[b]] = root[a]
                out.append((x["fp"][a], x["fp"][b]))
    return pa.table({n: pa.array([pair[k] for pair in out], pa.int64()) for k, n in enumerate(("a", "b"))})


def _grouped_wide(docs: DataFrame, id_col: str, text_col: str, shingle: int, least: float) -> tuple[DataFrame, DataFrame]:
    """As _grouped(), for documents whose sets of shingles have a Jaccard similarity of ``least`` or more.

    Candidates share the key of one of 32 tables (a key is five minima: at
    0.8 all but 3 pairs in a million do), and their fingerprints are within a
    distance that hardly any such pair exceeds.  What links them is the exact
    similarity of their sets.  It's computed for one candidate of each member a
    round, for two rounds, then for all candidates that the links found don't
    join.  Equal sets are one entry.
    """
    mean, far = distances(least)

    @F.pandas_udf("fp long, wide binary, keys binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        for texts in batches:
            sets = [np.unique(shingle_hashes(t, shingle)) for t in texts]
            yield pd.DataFrame({"fp": pd.Series([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype="uint64").astype("int64"), "wide": [wide_fingerprint(s, WIDE) for s in sets], "keys": [table_keys(s).tobytes() for s in sets]})

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, len(batch), 1024)):
                key = np.frombuffer(b"".join(part.column(1).to_pylist()), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), TABLES)), pa.array(key)], names=["fp", "key"])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                sets = [np.unique(shingle_hashes(t.as_py(), shingle)).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["fp", "shingles"])

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), least) for x, y in zip(a, b)], dtype=bool)

    text = F.col(text_col)
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = materialise(own.withColumn("s", sketch("text")).select("id", "text_hash", "s.fp", "s.wide", "s.keys"), "simhash-wide")
    fps = rows.groupBy("fp").agg(F.min("id").alias("least"), F.min("text_hash").alias("text_hash"), F.first("wide").alias("wide"), F.first("keys").alias("keys"))
    index = materialise(fps, "simhash-index")
    entries = index.select("fp", "keys").mapInArrow(keys, "fp long, key long")
    full = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = entries.join(full, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    members = materialise(members.select("key", "i", "j", "block", "fp"), "simhash-members")
    tasks = max(1, -(-members.count() // TASK_ROWS))
    dealt = members.join(index.select("fp", "wide"), "fp").withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))

    # Sets of all that share a key with another one, once each: copies of a text hash are one text.
    met = index.join(members.select("fp").distinct(), "fp", "left_semi").select("fp", "text_hash")
    texts = own.select("text_hash", "text").join(met, "text_hash").dropDuplicates(["fp"]).select("fp", "text")
    sets = materialise(texts.mapInArrow(shingles, "fp long, shingles binary"), "simhash-sets")

    def labelled(x: DataFrame, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return x.withColumn("root", F.col("fp"))
        return x.join(labels.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))

    def relabelled(labels: DataFrame | None, more: DataFrame) -> DataFrame:
        """(fp, root) of all that links join with one of less number, after more links: only the classes that these join are looked at."""
        if labels is None:
            return materialise(components(more, "simhash-cc").withColumnRenamed("node", "fp"), "simhash-labels")
        end = lambda c: labels.select(F.col("fp").alias(c), F.col("root").alias(f"root_{c}")).hint("merge")
        edges = more.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        joined = materialise(components(edges, "simhash-cc"), "simhash-joined")
        moved = labels.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")).hint("merge"), "root", "left").select("fp", F.coalesce("to", "root").alias("root"))
        # A class's least member has no row until its class joins another one.
        return materialise(moved.unionByName(joined.withColumnRenamed("node", "fp")), "simhash-labels")

    def stars(distance: int):
        return lambda table: _stars(table, distance)

    labels = None
    # A round at each distance joins nearly all; what they leave is compared exactly.
    for distance in (mean, far):
        found = labelled(dealt, labels).groupBy("task").applyInArrow(stars(distance), "a long, b long, degree long")
        pairs = found.groupBy("a").agg(F.max(F.struct("degree", "b")).alias("hub")).select(F.least("a", "hub.b").alias("a"), F.greatest("a", "hub.b").alias("b")).distinct()
        x = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("of_a")), "a").join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("of_b")), "b")
        more = materialise(x.where(linked("of_a", "of_b")).select("a", "b"), "simhash-links")
        if labels is None or not more.isEmpty():
            labels = relabelled(labels, more)
    # What is left is compared block by block, so that no table grows as pairs do.
    doubtful = materialise(labelled(dealt, labels).groupBy("task").applyInArrow(lambda table: _doubtful(table, far), "key long, i int, j int, block int, fp long"), "simhash-left")
    tasks = max(1, -(-doubtful.count() // (TASK_ROWS // 8)))
    left = labelled(doubtful.join(index.select("fp", "wide", "keys"), "fp").join(sets, "fp"), labels).withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))
    more = left.groupBy("task").applyInArrow(lambda table: _verified(table, far, least), "a long, b long")
    labels = relabelled(labels, materialise(more, "simhash-links"))
    for done in (members, sets, doubtful):
        discard(done)
    rooted = index.select("fp", "least").join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    return rows.select("id", "text_hash", "fp"), rooted


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2, segments: int = 2, crowd: int = 64, similarity: float | None = None) -> DataFrame:
    """docs with one row of each component: that of the least id, a null one last.

    With similarity, links are pairs of that Jaccard similarity of shingles or
    more, in place of max_distance bits of 64.

    Rows of one id are told apart by a hash of their texts; of rows that
    repeat id and text one stays.  Null and empty texts, and texts without
    words, are copies of each other.  An empty table gives an empty one.  Other
    columns stay, whatever their names.  A text is one row's work, however long.
    """
    if similarity is None:
        thin, rooted = _grouped(docs, id_col, text_col, shingle, max_distance, segments, crowd)
    else:
        thin, rooted = _grouped_wide(docs, id_col, text_col, shingle, similarity)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first")
    # Copies first come down to one row per fingerprint, then fingerprints to one per component.
    per_fp = thin.groupBy("fp").agg(first)
    keep = per_fp.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    keep = keep.select(F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    own = docs.columns
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)])
    kept = rows.join(keep, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")))
    place = F.row_number().over(Window.partitionBy("id", "text_hash").orderBy("text_hash"))
    return kept.withColumn("place", place).where("place = 1").select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)])
