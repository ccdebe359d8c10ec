"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words.  target / source size is the number of
times its documents are expected in the mix on average: the whole part is
allocated to every document for certain, the rest, f, is shared out unequally.
A document's weight is the share of its words that are distinct; its inclusion
probability is p = f * (1 + b * s), where s, from -1 to 1, is how far its weight
lies from the mean of its stratum (a source's documents of about equal size)
and b is ``tilt``, or less where p would pass 1.  As s is centred with sizes as
weights, expected words stay at the target.

Documents of a stratum are ranked by their random odds over their inclusion
odds, (u / (1-u)) / (p / (1-p)), and the first n are taken, n being fixed by the
sum of p.  Sizes of strata are rounded cumulatively, so a source's words stay
within about one document of its target.

No stratum is sorted.  Ranks are binned and bins counted with partial
aggregates; the bin in which the sample ends is looked into for the last rank
that is taken.  What comes out is one row for each stratum, and a document
joins it to see whether its rank is among those taken, so texts don't move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, let, materialise, words_of

BINS = 1024
#: A stratum: whether its source is null, the source (a null one empty), and the size in eighths of an octave.
KEY = ["no_source", "source_key", "class"]
ALL = (1 << 63) - 1


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, null last, have the weights in turn.  The mix
    has share * all words.  A target above most * source_size is cut to it and
    the excess goes to the others by weight until none is above: the level
    that a weight of 1 gets follows in closed form when sources are ordered by
    the level at which they are full.  The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by_level = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(1))
    x = ranked.withColumn("most", most * F.col("source_size")).withColumn("all_words", share * F.sum("source_size").over(everything))
    x = x.withColumn("full_before", F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    x = x.withColumn("weight_left", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    x = x.withColumn("full", F.col("most") * F.col("weight_left") <= F.col("weight") * (F.col("all_words") - F.col("full_before")))
    x = x.withColumn("rest", F.col("all_words") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything))
    x = x.withColumn("rest_weight", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything))
    return x.select("source", "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * F.col("rest") / F.col("rest_weight")).alias("target"))


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on seed and cols only."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, mapped to (0, 1) in the same order."""
    odds = u * (1 - p)
    return odds / (odds + (1 - u) * p)


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, own: list[str]) -> DataFrame:
    """(row, id, source, size, weight, text_hash, own_0...): rows of docs, stored, with a number each; weight in thousandths."""
    words = lambda w: F.struct(F.size(w).cast("long").alias("size"), F.size(F.array_distinct(w)).cast("long").alias("distinct"))
    x = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(F.col(text_col)).alias("text_hash"), held(let(words_of(F.col(text_col)), words)).alias("w"), *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)])
    kept = ["row", "id", "source", "text_hash", F.col("w.size").alias("size"), F.expr("1000 * w.distinct div greatest(w.size, 1)").alias("weight")]
    return materialise(x.select(*kept, *[f"own_{i}" for i in range(len(own))]), "mix-rows")


def _keyed(rows: DataFrame) -> DataFrame:
    size = F.when(F.col("size") > 0, F.floor(8 * F.log2(F.col("size").cast("double")))).otherwise(-1).cast("int")
    return rows.withColumn("no_source", F.col("source").isNull()).withColumn("source_key", F.coalesce("source", F.lit(""))).withColumn("class", size)


def strata(rows: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, tilt: float = 0.8) -> DataFrame:
    """One row for each stratum of rows (source, size, weight): KEY, source_size, target, whole, f, b, middle, reach and take.

    whole copies go to each document and one more to ``take`` of them; middle
    and reach are the mean weight and the greatest distance from it.
    """
    x = _keyed(rows).groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.sum("size").alias("words"), F.sum("weight").alias("weights"), F.sum(F.col("weight") * F.col("size")).alias("word_weights"), F.min("weight").alias("least"), F.max("weight").alias("most"))
    sizes = x.groupBy("no_source", "source_key").agg(F.sum("words").alias("source_size")).select(F.when(~F.col("no_source"), F.col("source_key")).alias("source"), "source_size")
    goal = targets(sizes, weights, share, most).select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source_key"), "source_size", "target")
    x = x.join(goal, ["no_source", "source_key"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    x = x.withColumn("whole", F.floor(expected).cast("long")).withColumn("f", expected - F.col("whole"))
    x = x.withColumn("b", F.when(F.col("f") > 0, tilt * F.least(F.lit(1.0), (1 - F.col("f")) / F.col("f"))).otherwise(0.0))
    x = x.withColumn("middle", F.when(F.col("words") > 0, F.col("word_weights") / F.col("words")).otherwise(0.0))
    x = x.withColumn("reach", F.greatest(F.col("most") - F.col("middle"), F.col("middle") - F.col("least")))
    apart = F.when(F.col("reach") > 0, (F.col("weights") - F.col("n_docs") * F.col("middle")) / F.col("reach")).otherwise(0.0)
    longest_first = Window.partitionBy("no_source", "source_key").orderBy(F.desc("class"))
    done = F.round(F.sum(F.col("f") * (F.col("n_docs") + F.col("b") * apart)).over(longest_first)).cast("long")
    x = x.withColumn("done", done).withColumn("take", F.col("done") - F.coalesce(F.lag("done").over(longest_first), F.lit(0)))
    return x.select(*KEY, "n_docs", "source_size", "target", "whole", "f", "b", "middle", "reach", "take")


def _ranked(rows: DataFrame, groups: DataFrame, seed: int) -> DataFrame:
    """rows with their stratum's columns and rank.  A random number depends on id, size and text, so it is the same each time."""
    score = F.when(F.col("reach") > 0, (F.col("weight") - F.col("middle")) / F.col("reach")).otherwise(0.0)
    p = F.col("f") * (1 + F.col("b") * score)
    u = uniform(seed, F.col("id"), F.col("size"), F.col("text_hash"))
    return _keyed(rows).join(groups, KEY).withColumn("rank", F.when(p > 0, pareto_rank(u, p)).otherwise(1.0))


def _reached(counts: DataFrame, by: list[str], order: str, goal: str) -> DataFrame:
    """Of counts (by, order, n, goal) the row of each group up to which, in order, ``goal`` is reached; ``left`` of its n count."""
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(order))
    x = counts.withColumn("left", F.col(goal) - (upto - F.col("n")))
    return x.where((F.col("left") > 0) & (F.col("left") <= F.col("n")))


def cuts(rows: DataFrame, seed: int = 7, **options) -> DataFrame:
    """strata() with last_rank and last_row: rows up to these, in the order of (rank, row), have the one more copy.

    Equal ranks are rows equal in id, size and text; where the sample ends among
    them, the first ones by row number are taken, which are found by counts
    over parts of the table, so that none of it is one task's work.
    """
    rows = rows.select("row", "id", "source", "text_hash", "size", "weight")
    groups = materialise(strata(rows, **options), "mix-strata")
    some = groups.where("take > 0 and take < n_docs")
    ranked = _ranked(rows, some, seed).withColumn("bin", F.least(F.floor(F.col("rank") * BINS), F.lit(BINS - 1)).cast("int"))
    bins = _reached(ranked.groupBy(*KEY, "take", "bin").agg(F.count("*").alias("n")), KEY, "bin", "take").select(*KEY, "bin", F.col("left").alias("goal"))
    in_bin = ranked.join(bins, [*KEY, "bin"]).groupBy(*KEY, "rank", "goal").agg(F.count("*").alias("n"))
    ends = materialise(_reached(in_bin, KEY, "rank", "goal").select(*KEY, F.col("rank").alias("last_rank"), "left", "n"), "mix-ends")
    tied = ends.where("left < n").select(*KEY, "last_rank", F.col("left").alias("goal"))
    last = ends.withColumn("last_row", F.lit(ALL))
    if not tied.isEmpty():
        equal = ranked.join(tied, KEY).where("rank = last_rank").select(*KEY, "goal", F.shiftright("row", 33).alias("part"), "row")
        parts = _reached(equal.groupBy(*KEY, "goal", "part").agg(F.count("*").alias("n")), KEY, "part", "goal").select(*KEY, "part", "left")
        in_part = equal.join(parts, [*KEY, "part"]).select(*KEY, "left", "row", F.lit(1).cast("long").alias("n"))
        rows_of = _reached(in_part, KEY, "row", "left").select(*KEY, F.col("row").alias("cut_row"))
        last = ends.join(rows_of, KEY, "left").withColumn("last_row", F.coalesce("cut_row", F.lit(ALL)))
    last = groups.join(last.select(*KEY, "last_rank", "last_row"), KEY, "left")
    # Without an end inside, a stratum is taken as a whole or not at all; ranks lie from 0 to 1.
    full = F.when(F.col("take") > 0, 2.0).otherwise(-1.0)
    return materialise(last.withColumn("last_rank", F.coalesce("last_rank", full)).withColumn("last_row", F.coalesce("last_row", F.lit(ALL))), "mix-cuts")


def copied(rows: DataFrame, seed: int = 7, **options) -> DataFrame:
    """rows with source_size, target and ``copies`` of each in the mix.

    The strata's table is joined by its measured size: Spark broadcasts it
    below its limit and deals both sides by stratum (splitting skewed ones)
    above.
    """
    x = _ranked(rows, cuts(rows, seed, **options), seed)
    more = (F.col("rank") < F.col("last_rank")) | (F.col("rank") == F.col("last_rank")) & (F.col("row") <= F.col("last_row"))
    return x.withColumn("copies", F.col("whole") + more.cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, **options) -> DataFrame:
    """One row per row of docs: (id, size, source_size, target, taken).

    size is the number of words, 0 for a null or empty text, which takes 0;
    taken is copies * size.  Rows that are equal in id, source and text are told
    apart by their place only, so the result, as a bag of rows, is the same each
    time.  A null source is a source of its own, the last one; null ids are
    carried.  An empty table gives an empty one.  Other columns are ignored.
    options: weights, share, most and tilt of strata().
    """
    rows = _rows(docs, id_col, text_col, source_col, [])
    return copied(rows, seed, **options).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, **options) -> DataFrame:
    """The mix itself: rows of docs, each as often as the mix takes it, with their own columns, whatever their names.

    Documents without words are carried with the copies of their stratum.
    Nulls, repeated rows and empty tables are as in mix().
    """
    own = docs.columns
    rows = _rows(docs, id_col, text_col, source_col, own)
    often = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int"))).otherwise(F.array().cast("array<int>"))
    return copied(rows, seed, **options).select(*[F.col(f"own_{i}") for i in range(len(own))], F.explode(often)).select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)])
