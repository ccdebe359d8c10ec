"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is padded with zeros and rotated at random; its code is the signs
of what comes out, and its correction factor is the inner product of the
rotated vector with its code (as a unit vector).  The inner product of a code
with another rotated vector, over the correction factor, is an unbiased
estimate of the vectors' cosine, with a confidence bound that the factor gives.
Only pairs whose upper bound reaches the threshold are recomputed exactly, in
double precision, and only those that pass link.

Which pairs are looked at: tables of keys, each of some bits of the codes.  Keys
have two bits more than it takes to number the vectors, so that buckets of
unlike vectors don't grow with their number, and there are as many tables as it
takes for a pair at the threshold to be missed with probability ``MISS``.  (At
cosine 0.98 a bit differs with probability 0.064; 50,000 vectors have 32 tables
of 18 bits, a thousand million have 90 of 32.)  A pair counts
in the first table that it shares, so links are neither listed nor counted
twice.  Members of a bucket are compared in blocks, and a block gives back one
row per member (its links and a root), never a row per pair.  Equal vectors
are one entry, with the number of its copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise

BLOCK, TASK_ROWS = 1024, 16384
#: Probability that a pair at the threshold shares no key; tables at most, beyond which keys are made shorter.
MISS, MOST_TABLES = 1e-5, 256
#: Standard deviations of an estimate's error that its bounds cover.
SURE = 4.0


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    """dim x bits matrix with orthonormal rows: the rotation of a vector padded to 4 * dim (256 at least)."""
    bits = max(256, 4 * dim)
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))[0].T.copy()


def key_plan(vectors: int, least: float) -> tuple[int, int]:
    """(bits of a key, tables) for so many vectors and that cosine."""
    same = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    for bits in range(max(8, math.ceil(math.log2(max(2, vectors))) + 2), 0, -1):
        tables = math.ceil(math.log(MISS) / math.log1p(-(same**bits))) if same < 1 else 1
        if tables <= MOST_TABLES:
            return bits, tables
    return 1, MOST_TABLES


@lru_cache(maxsize=8)
def key_places(bits: int, seed: int, plan: tuple[int, int]) -> np.ndarray:
    r = np.random.default_rng(seed + 1)
    return np.array([r.choice(bits, plan[0], replace=False) for _ in range(plan[1])])


def encode(vectors: np.ndarray, seed: int, plan: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, signs (as booleans), correction factors and keys (rows x tables)."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    turned = unit @ rotation(vectors.shape[1], seed)
    signs = turned > 0
    factors = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    keys = signs[:, key_places(turned.shape[1], seed, plan)] @ (1 << np.arange(plan[0], dtype=np.int64))
    return turned, signs, factors, keys


def _index(distinct: DataFrame, seed: int, plan: tuple[int, int]) -> DataFrame:
    """distinct (gid, label, copies, vec) with dim, code, factor and keys."""
    schema = distinct.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", dim int, code binary, factor double, keys array<bigint>"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table(batch)
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == dim)).combine_chunks()
                vectors = part.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
                _, signs, factors, keys = encode(vectors, seed, plan)
                codes = np.packbits(signs, axis=1)
                cols = (("dim", pa.array(np.full(len(vectors), dim, np.int32))), ("code", pa.array([c.tobytes() for c in codes], pa.binary())), ("factor", pa.array(factors)), ("keys", pa.array(list(keys), pa.list_(pa.int64()))))
                for name, col in cols:
                    part = part.append_column(name, col)
                yield from part.to_batches()

    return distinct.mapInArrow(index, schema)


def _compare(table: pa.Table, least: float, seed: int) -> pa.Table:
    """One row (gid, links, root) for each member with links in its buckets' blocks; rows come sorted by bucket."""
    out: dict[str, list] = {"gid": [], "links": [], "root": []}
    names = ("t", "label", "dim", "key", "i", "j")
    cols = {n: table.column(n).to_numpy(zero_copy_only=False) for n in (*names, "gid", "copies", "block", "factor")}
    order = np.lexsort([cols["gid"], *(cols[n] for n in reversed(names))])
    cols = {n: c[order] for n, c in cols.items()}
    vecs, codes, keys = (table.column(n).combine_chunks().take(pa.array(order)) for n in ("vec", "code", "keys"))
    changes = np.any([cols[n][1:] != cols[n][:-1] for n in names], axis=0) if len(order) else np.array([], bool)
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(order)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi - lo < 2:
            continue
        dim, t = int(cols["dim"][lo]), int(cols["t"][lo])
        v = vecs.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
        norms = np.linalg.norm(v, axis=1)
        turned = (v / norms[:, None]) @ rotation(dim, seed)
        bits = turned.shape[1]
        signs = np.unpackbits(np.frombuffer(b"".join(codes.slice(lo, hi - lo).to_pylist()), np.uint8).reshape(hi - lo, -1), axis=1, count=bits)
        c = cols["factor"][lo:hi]
        estimate = ((2.0 * signs - 1) @ turned.T) / np.sqrt(bits) / c[:, None]
        upper = estimate + (SURE * np.sqrt(np.maximum(1 - c * c, 0)) / c / np.sqrt(bits - 1))[:, None]
        maybe = np.triu((upper >= least) & (upper.T >= least), 1)
        if cols["i"][lo] != cols["j"][lo]:  # two blocks: pairs between them only
            maybe &= cols["block"][lo:hi][:, None] != cols["block"][lo:hi][None, :]
        a, b = np.nonzero(maybe)
        cosine = np.einsum("ij,ij->i", v[a], v[b]) / (norms[a] * norms[b])
        a, b = a[cosine >= least], b[cosine >= least]
        k = keys.slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, -1)
        first = np.argmax(k[a] == k[b], axis=1) == t
        a, b = a[first], b[first]
        if not len(a):
            continue
        copies, gid = cols["copies"][lo:hi], cols["gid"][lo:hi]
        links = np.bincount(a, copies[b], hi - lo) + np.bincount(b, copies[a], hi - lo)
        root, before = np.arange(hi - lo), None
        while before is None or (root != before).any():
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
        hit = links > 0
        out["gid"] += gid[hit].tolist()
        out["links"] += links[hit].astype(np.int64).tolist()
        out["root"] += gid[root[hit]].tolist()
    return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.98, seed: int = 11) -> DataFrame:
    """One row per row: (id, n_links, component_id, kept).

    Vectors are compared where labels are equal and not null, and lengths are
    equal.  A vector that is null, empty, zero, or has null or non-finite
    components, or whose label is null, links with nothing: it is its own
    component and kept.  Repeated rows link with each other (each row counts).
    component_id is the least id reachable; kept says whether that is the
    row's own (two nulls count as equal).  An empty table gives an empty one.
    Entries are told apart by a 64-bit hash of label and components.  Other
    columns are ignored, whatever their names.
    """
    vec, label = F.col(vec_col), F.col(label_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(label.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, F.xxhash64(label, vec)).alias("gid"), label.alias("label"), vec.cast("array<double>").alias("vec"))
    thin = materialise(rows.select("id", "gid"), "vectors-id")
    first = rows.where("gid is not null").groupBy("gid").agg(F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    index = materialise(_index(first.select("gid", F.xxhash64("label").alias("label"), "copies", "vec"), seed, key_plan(thin.where("gid is not null").count(), least)), "vectors-index")

    bucket = ["t", "label", "dim", "key"]
    entries = index.select("gid", "label", "dim", F.posexplode("keys").alias("t", "key"))
    full = entries.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = entries.join(full, bucket).withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = members.withColumn("other", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    members = materialise(members.select(*bucket, "i", "j", "block", "gid"), "vectors-members")
    tasks = max(1, -(-members.count() // TASK_ROWS))
    dealt = members.join(index.select("gid", "copies", "vec", "code", "factor", "keys"), "gid").withColumn("task", F.pmod(F.xxhash64(*bucket, "i", "j"), F.lit(tasks)))
    found = dealt.groupBy("task").applyInArrow(lambda table: _compare(table, least, seed), "gid long, links long, root long")
    found = materialise(found, "vectors-links")

    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("gid").alias("a"), F.col("root").alias("b")), "vectors-cc")
    per = thin.where("gid is not null").groupBy("gid").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    per = per.join(links, "gid", "left").join(roots.withColumnRenamed("node", "gid"), "gid", "left").withColumn("root", F.coalesce("root", "gid"))
    lowest = per.groupBy("root").agg(F.min("least").alias("component_id"))
    per = per.join(lowest, "root").select("gid", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    # Rows without a vector to compare don't take part in the join, so that they aren't one hot key.
    some = thin.where("gid is not null").join(per, "gid").select("id", "n_links", "component_id")
    alone = thin.where("gid is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return some.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
