"""What several operators of this subpackage share: words, tables in the shared folder, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.shared import discard, held, new_path, stored, temporaries, written

__all__ = ["SPACE", "WORD", "components", "discard", "folded", "held", "let", "materialise", "new_path", "temporaries", "word_count", "words_of", "written"]

materialise = stored

#: A word is a run of characters other than these six (ASCII white space).
SPACE = r"[ \t-\r]"
WORD = r"[^ \t-\r]+"


def let(value: Column, body) -> Column:
    """body(value), where value is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks_of(items: Column, size: int) -> Column:
    """items as an array of arrays of at most ``size``."""
    n = F.size(items)
    last = lambda k: F.least(n, (k + 1) * size) - 1
    each = F.transform(F.sequence(F.lit(0), ((n - 1) / size).cast("int")), lambda k: F.transform(F.sequence(k * size, last(k)), lambda i: F.get(items, i)))
    return F.when(n > 0, each)


def folded(items: Column, state: Column, entry_type: str, step: Callable[[Column, Column], tuple[Column, Column, Column]], block: int = 128) -> Column:
    """Entries of one pass over items in order: step(state, item) gives the next state, whether there is an entry, and the entry.

    An array can only grow by being copied.  Entries therefore grow in blocks,
    and blocks in a list of blocks, so that n items cost some n * block copies
    rather than n * n.
    """
    none = F.array().cast(f"array<{entry_type}>")

    def inside(acc: Column, e: Column) -> Column:
        then, some, entry = step(acc["state"], e)
        return F.struct(then.alias("state"), F.when(some, F.concat(acc["out"], F.array(entry))).otherwise(acc["out"]).alias("out"))

    one = lambda start, part: F.aggregate(part, F.struct(start.alias("state"), none.alias("out")), inside)
    add = lambda acc, part: let(one(acc["state"], part), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))
    start = F.struct(state.alias("state"), F.array().cast(f"array<array<{entry_type}>>").alias("out"))
    return let(items, lambda all_: F.when(F.size(all_) > 0, F.aggregate(blocks_of(all_, block), start, add, lambda acc: F.flatten(acc["out"]))).otherwise(none))


def words_of(text: Column) -> Column:
    """Words of a text, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


#: Neighbours beyond which a node's rows may be dealt apart from the others'.
HOT = 10_000


def _with_least(rows: DataFrame, least: DataFrame, most_rows: int) -> DataFrame:
    """rows (u, v) with m of their node from least (u, m, n); n is the number of a node's rows at least, and they sum up to most_rows at most.

    A node with over a thousandth of all rows (and over HOT) would be one
    task's work; there are a thousand such nodes at most, whatever the
    table, so they are broadcast to their rows instead.
    """
    if most_rows <= HOT:
        return rows.join(least.select("u", "m"), "u")
    limit = max(HOT, most_rows // 1000)
    hot = F.broadcast(least.where(F.col("n") > limit))
    rest = rows.join(hot.select("u"), "u", "left_anti").join(least.where(F.col("n") <= limit).select("u", "m"), "u")
    return rows.join(hot.select("u", "m"), "u").unionByName(rest)


def _star(edges: DataFrame, large: bool, n_edges: int) -> DataFrame:
    """One star step over edges (a, b) with a < b, at most n_edges; each node's neighbours move to the smallest one.

    large: neighbours above a node are linked to its smallest neighbour (or
    itself); otherwise those below it, and the node, are.  The smallest
    neighbour is a partial aggregate joined back, so that no neighbourhood is
    gathered into one row.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        out = _with_least(both.where("v > u"), least, 2 * n_edges).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        out = _with_least(down, least, n_edges).select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a < b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b) that isn't its component's smallest node.

    Large-star and small-star steps in turn until nothing changes; each round
    is a table in the shared folder, and only its count and checksum, taken
    while it is written, reach the driver.
    """

    def kept(x: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("checksum")
        out = materialise(x.observe(seen, F.count("*").alias("n"), checksum), name)
        return out, (seen.get["n"], seen.get["checksum"])

    now, mark = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    while mark[0]:
        # A large star has as many edges as it is given at most.
        then, found = kept(_star(_star(now, True, mark[0]), False, mark[0]))
        discard(now)
        now = then
        if found == mark:
            break
        mark = found
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
