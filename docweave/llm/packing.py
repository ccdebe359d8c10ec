"""Best-fit packing of tokenised documents with certified bin counts.

Documents are tokenised in Arrow batches; longer ones are cut into full pieces
and a rest.  Full pieces are sequences by themselves.  Rests are dealt into
partitions of a bounded number of pieces, each packed by best-fit decreasing.
A partition's lower bound is the largest over families of dual-feasible
functions; where it equals the bins used, the packing is certified optimal.
Partitions with a gap put the pieces of their bins that aren't full into
exchange, where pieces of several partitions meet and best-fit decreasing runs
again, for a fixed number of rounds; a group's new packing is kept where it
has fewer bins.  Partitions at their bound put their emptiest bin only.
certificate() holds what comes out against the bound for all pieces together.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

CAPACITY = 2048
#: Pieces that are packed at a time.
GROUP = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: What a tokenizers file must say about cutting for words to be looked up one by one.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "post_processor": None, "truncation": None, "padding": None,
}


class WordTokenizer:
    """ids of texts by a tokenizers file whose pre-tokenizer never joins across white space.

    Texts of plain Latin characters (no combining marks, nothing that NFC or
    lower-casing treats by context) are cut by the file's own rule and looked up
    piece by piece; other texts are looked up by white-space-separated word.
    Memory is bounded: the table of known pieces is emptied at ``most`` entries.
    That holds for files with RULES; texts go whole through any other file.
    """

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        own = lambda kind: "".join(re.escape(chr(i)) for i in range(0x21, 0x250) if unicodedata.category(chr(i))[0] == kind)
        letters, numbers = own("L"), own("N")
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+").findall
        self.plain = re.compile("[\t-\r\x20-\x7e\xa1-įı-ɏ]*").fullmatch
        self.encode, self.most = Tokenizer.from_file(path).encode, most
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.by_word = {k: file.get(k) for k in RULES} == RULES and file["model"].get("dropout") is None
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Adds pieces to the table.  Many at a time, joined by spaces, cost half of what one by one does."""
        if len(self.known) + len(pieces) > self.most:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        for i in range(0, len(new), 500):
            part = new[i : i + 500]
            found = self.encode(" ".join(part), add_special_tokens=False)
            ids, owner = np.array(found.ids, dtype="<u4"), np.array([-1 if w is None else w for w in found.word_ids])
            if len(owner) and owner[-1] == len(part) - 1 and (owner >= 0).all():
                cuts = np.searchsorted(owner, np.arange(len(part) + 1)).tolist()
                for p, lo, hi in zip(part, cuts, cuts[1:]):
                    self.known[p] = ids[lo:hi].tobytes()
            else:  # something in it isn't one piece
                for p in part:
                    self.known[p] = np.array(self.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def batch(self, texts: list[str]) -> list[bytes]:
        """ids of texts as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return [np.array(self.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        cut = [self.pieces(t.lower()) if "<|" not in t and self.plain(t) else None for t in texts]
        self.learn(set().union(*filter(None, cut)))
        look = self.known.__getitem__
        return [self.whole(t) if c is None else b"".join(map(look, c)) for t, c in zip(texts, cut)]

    def whole(self, text: str) -> bytes:
        words = [w for w in re.split("[ \t-\r]+", text) if w]
        for w in words:
            if w not in self.words:
                if len(self.words) >= self.most // 4:
                    self.words.clear()
                self.words[w] = np.array(self.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join([self.words[w] if w in self.words else np.array(self.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words])


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> WordTokenizer:
    """One for all tasks of a worker process, so that what one has learnt serves the next."""
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of at most ``capacity`` ids; each document ends with ``end_id``.

    tokenizer: a path, or the name of a file of the installed public_tokenizers.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        path = tokenizer
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        tokens, last = tokenizer_of(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, rows = batch.column(0), {"doc": [], "piece": [], "start": [], "length": [], "crc": []}
            texts, i = batch.column(1), 0
            while i < len(texts):
                group, size = [], 0
                while i + len(group) < len(texts) and (not group or size < 1 << 20):
                    group.append(texts[i + len(group)].as_py() or "")
                    size += len(group[-1])
                for k, data in enumerate(tokens.batch(group), i):
                    data += last
                    for no, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        for c, v in zip(rows, (k, no, at // 4, len(part) // 4, zlib.crc32(part))):
                            rows[c].append(v)
                i += len(group)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows["doc"], pa.int64())), pa.array(rows["piece"], pa.int32()), *[pa.array(rows[k], pa.int64()) for k in ("start", "length", "crc")]], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """lower_bound_of() sizes as they are."""
    return lower_bound_of(dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True)))), capacity)


def lower_bound_of(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Bins that any packing of so many pieces of each size (1 to capacity) needs at least, by dual-feasible functions.

    f_t: sizes over capacity - t count as full, sizes below t as nothing.
    u_k: (k + 1) * size / capacity is rounded down unless it is whole, and
    divided by k.  Sums of either, over the capacity they're mapped to, bound
    the number of bins from below.
    """
    if not counts:
        return 0
    count = np.zeros(capacity + 1, np.int64)
    count[list(counts)] = list(counts.values())
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    many, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    full = many[-1] - many[capacity - t]
    between = total[capacity - t] - total[t - 1]
    best = max(best, int((full + -(-between // capacity)).max()))
    for k in range(1, 65):
        scaled = (k + 1) * size
        u = np.where(scaled % capacity == 0, k * size, (scaled // capacity) * capacity)  # times 1 / (k * capacity)
        best = max(best, -(-int((count * u).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each size and the number of bins.  Open bins are kept by room, with a bit for each room in use."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, n
            n += 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            left = room - size
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, n


def _pack_groups(rows: DataFrame, capacity: int, round_no: int) -> DataFrame:
    """Packs each group of rows (grp, ..., length, old); adds bin, offset and whether the piece stays where it is.

    A piece stays if its bin is full, or its group is certified and its bin
    isn't the one with most room: of those, groups that are each at their bound
    can still save some between them.  In later rounds a group that doesn't come out with fewer bins than it came in with
    (old_seq) is left in its old places, bin being null.
    """
    schema = rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", bin long, offset long, stays boolean"

    def pack(table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_numpy()
        bins, offsets, n = best_fit_decreasing(sizes, capacity)
        filled = np.bincount(bins, weights=sizes, minlength=n)
        stays = filled[bins] == capacity
        if n == lower_bound(sizes, capacity):
            stays |= bins != filled.argmin()
        new = pa.array(bins)
        if round_no and n >= pc.count_distinct(table.column("old_seq")).as_py():
            new, stays = pa.nulls(len(sizes), pa.int64()), np.zeros(len(sizes), bool)
        for name, col in (("bin", new), ("offset", pa.array(offsets)), ("stays", pa.array(stays))):
            table = table.append_column(name, col)
        return table

    return rows.groupBy("grp").applyInArrow(pack, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int = 3) -> DataFrame:
    """pieces with sequence_id and offset; sequences have at most ``capacity`` ids and no gaps.

    sequence_id = (round * groups + group) << 32 | bin; full pieces have ids of their own below zero.
    pieces must be a materialised table with a number ``row`` for each, by
    which they are dealt, so that copies don't come to one group.  Empty tables
    pack to empty ones.
    """
    names = pieces.columns
    if "row" not in names:
        raise ValueError("pieces need a number each, in a column row")
    rest = pieces.where(F.col("length") < capacity)
    n = rest.count()
    groups = max(1, -(-n // group))
    whole = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = F.pmod(F.xxhash64(F.lit(0), "row"), F.lit(groups)).cast("int")
    now = materialise(_pack_groups(rest.withColumn("grp", dealt), capacity, 0), "pack-0")
    place = lambda base: (F.lit(base).cast("long") + F.col("grp").cast("long")) * F.lit(1 << 32) + F.col("bin")
    done = [whole, now.where("stays").withColumn("sequence_id", place(0)).select(*whole.columns)]
    open_rows = now.where("not stays").withColumn("old_seq", place(0)).withColumn("old_offset", F.col("offset")).select(*names, "old_seq", "old_offset")
    base, groups_r = groups, groups
    for r in range(1, rounds + 1):
        left = open_rows.count()
        if not left or groups_r == 1:
            break
        groups_r = max(1, -(-left // group))
        # Whole bins move, so that a group that gains nothing can keep them.
        deal = F.pmod(F.xxhash64(F.lit(r), "old_seq"), F.lit(groups_r)).cast("int")
        now = materialise(_pack_groups(open_rows.withColumn("grp", deal), capacity, r), f"pack-{r}")
        better = now.where("bin is not null")
        done.append(better.where("stays").withColumn("sequence_id", place(base)).select(*whole.columns))
        open_rows = better.where("not stays").withColumn("old_seq", place(base)).withColumn("old_offset", F.col("offset")).select(*names, "old_seq", "old_offset").unionByName(now.where("bin is null").select(*names, "old_seq", "old_offset"))
        base += groups_r
    done.append(open_rows.withColumnRenamed("old_seq", "sequence_id").withColumnRenamed("old_offset", "offset").select(*whole.columns))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("row")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row (pieces, ids, sequences, bound, certified): whether no packing of all pieces together has fewer sequences.

    The bound needs the number of pieces of each length only, at most
    ``capacity`` rows.  A sequence has one piece at offset 0.
    """

    def judge(table: pa.Table) -> pa.Table:
        x = table.to_pydict()
        bound, used = lower_bound_of(dict(zip(x["length"], x["n"])), capacity), sum(x["firsts"])
        out = {"pieces": sum(x["n"]), "ids": sum(a * b for a, b in zip(x["length"], x["n"])), "sequences": used, "bound": bound}
        return pa.table({k: pa.array([v], pa.int64()) for k, v in out.items()}).append_column("certified", pa.array([used == bound]))

    lengths = packed.groupBy("length").agg(F.count("*").alias("n"), F.count(F.when(F.col("offset") == 0, 1)).alias("firsts"))
    return lengths.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(judge, "pieces long, ids long, sequences long, bound long, certified boolean")


def packed(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is one piece of the end id alone.  Repeated rows are
    packed each, null ids are carried, and an empty table gives an empty one.
    A long text is tokenised whole, in memory, by one task.  Other columns are
    ignored, whatever their names.
    """
    pieces = token_pieces(docs, tokenizer, 0, capacity, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return pack(materialise(pieces, "pack-pieces"), capacity, group)
