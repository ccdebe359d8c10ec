"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document's measures are computed from its whole text.  Fixed cutoffs are
replaced by thresholds that follow each language and source.  A measure's
values fall in bins that are exact up to 127 and no wider than 1/128 of their
value above; bins are counted with partial aggregates.  That is a mergeable
quantile sketch: sketches of parts add up to that of the whole, in any order,
a quantile is off by at most 1/128 of itself (or by 1, up to 127), and a sketch
has at most 7,400 bins whatever the number of documents.

A group's limit is q75 + ``reach`` * (q75 - q25), and for measures that can be
too low also q25 - ``reach`` * (q75 - q25); quantiles are interpolated within
their bin.  Few documents tell little about their group, so its quantiles are
averaged with those of its language, which count as ``prior`` documents, and
the language's likewise with those of all documents.  There is no size at which
that changes; it fades as a group grows.

A document is rejected where a measure is beyond the limit by more than
``sure`` standard errors of the measure itself: what is counted comes in runs
(a line of asterisks, a repeated passage), so its variance is the sum of the
runs' squared lengths.  Documents and limits are then joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, let, materialise, words_of

SYMBOLS = "[#*$%&|<>]+"


@dataclass(frozen=True)
class Measure:
    """A measure as SQL over the counts: what it is, its standard error, and whether it can be too low."""

    value: str
    error: str
    both: bool = False


MEASURES = {
    # per thousand words
    "symbols": Measure("1000D * n_symbols / greatest(n_words, 1)", "1000D * sqrt(symbol_squares) / greatest(n_words, 1)"),
    # per thousand lines
    "dup_lines": Measure("1000D * n_dup_lines / greatest(n_lines, 1)", "1000D * sqrt(n_dup_lines) / greatest(n_lines, 1)"),
    # per million pairs of words, since windows of a long text meet by chance as often as it has pairs
    "repeats": Measure("1000000D * n_repeat_words / greatest(n_words * n_words, 1)", "1000000D * sqrt(repeat_squares) / greatest(n_words * n_words, 1)"),
    # hundredths of a character
    "word_length": Measure("100D * word_chars / greatest(n_words, 1)", "100D * sqrt(greatest(0, word_squares / greatest(n_words, 1) - (word_chars / greatest(n_words, 1)) * (word_chars / greatest(n_words, 1))) / greatest(n_words, 1))", True),
}


def _repeat_words(words: Column) -> Column:
    """(n, squares): words covered by 3-word windows found at least twice in the text, and the squared lengths of the runs they form.

    Windows are sorted by (hash of the three words, place); equal neighbours
    are repeats.  The places of repeats, sorted, cover 3 words each, less what
    the one before already covers.  (64-bit hashes of windows of one text.)
    """
    long = lambda n: F.lit(n).cast("long")
    none = F.struct(long(0).alias("n"), long(0).alias("squares"))
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    pairs = lambda w: F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, e, i: F.coalesce(F.get(s, i)["h"] == e["h"], F.lit(False))
    twice = lambda s: F.filter(s, lambda e, i: same(s, e, F.when(i > 0, i - 1)) | same(s, e, i + 1))
    places = lambda s: F.array_sort(F.transform(twice(s), lambda e: e["i"]))

    def covered(at: Column) -> Column:
        first = F.struct(F.lit(-3).alias("last"), long(0).alias("run"), long(0).alias("n"), long(0).alias("squares"))

        def step(a: Column, p: Column) -> Column:
            apart, more = p - a["last"] > 3, F.least(F.lit(3), p - a["last"])
            return F.struct(p.alias("last"), F.when(apart, long(3)).otherwise(a["run"] + more).alias("run"), (a["n"] + more).alias("n"), F.when(apart, a["squares"] + a["run"] * a["run"]).otherwise(a["squares"]).alias("squares"))

        return F.aggregate(at, first, step, lambda a: F.struct(a["n"].alias("n"), (a["squares"] + a["run"] * a["run"]).alias("squares")))

    repeats = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(let(let(pairs(w), places), covered))
    return F.when(F.size(words) < 3, none).otherwise(let(windows, repeats))


def _sums(parts: Column, total: str, squares: str) -> Column:
    """(total, squares): the lengths of parts and their squares, summed."""
    zero = F.lit(0).cast("long")
    of = lambda n: F.struct(F.aggregate(n, zero, lambda a, x: a + x).alias(total), F.aggregate(n, zero, lambda a, x: a + x * x).alias(squares))
    return let(F.transform(parts, lambda x: F.length(x).cast("long")), of)


#: Counts of a text, by the part of _measured() that they are in.
PARTS = {"w": ["n_words"], "c": ["word_chars", "word_squares"], "l": ["n_lines", "n_dup_lines"], "s": ["n_symbols", "symbol_squares"]}


def _measured(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t-\r]"))
    of_words = lambda w: F.struct(F.struct(F.size(w).cast("long").alias("n_words")).alias("w"), _sums(w, "word_chars", "word_squares").alias("c"), _repeat_words(w).alias("r"))
    of_lines = lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    return F.struct(let(words_of(text), of_words).alias("words"), let(lines, of_lines).alias("l"), _sums(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0)), "n_symbols", "symbol_squares").alias("s"))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and the squares of runs (long).

    Columns of these names that docs has already are replaced.
    """
    m = "_docweave_measured"
    x = docs.withColumn(m, held(_measured(F.coalesce(F.col(text_col), F.lit("")))))
    at = {c: F.col(f"{m}.{'words.' if part in 'wc' else ''}{part}.{c}") for part, names in PARTS.items() for c in names}
    return x.withColumns(at | {"n_repeat_words": F.col(f"{m}.words.r.n"), "repeat_squares": F.col(f"{m}.words.r.squares")}).drop(m)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _width(low: str) -> str:
    """Width of the bin that starts at low, or holds it: its first eight bits stay."""
    return f"shiftleft(1L, greatest(0, length(bin({low})) - 8))"


def sketches(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, measure, bin, n): counts of bins, by the least value of each; sums of sketches are sketches."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(f"cast(floor({x.value}) as bigint)").alias("v")) for m, x in MEASURES.items()]))
    rows = measured.where(~base_failed()).select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("e")).select("lang", "source", "e.*")
    return rows.withColumn("bin", F.expr(f"v - v % {_width('v')}")).groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, docs, q25, q75) of a sketch with one row for each bin.

    A quantile lies in the lowest bin up to which its share of the documents
    does, as far into it as that share goes.
    """
    w = Window.partitionBy(*by, "measure")
    run = sketch.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("docs", F.sum("n").over(w))
    at = lambda q: F.min(F.when(F.col("upto") >= (q - 1e-9) * F.col("docs"), F.struct("bin", "upto", "n"))).alias(f"at{round(100 * q)}")
    x = run.groupBy(*by, "measure").agg(F.max("docs").alias("docs"), at(0.25), at(0.75))
    into = lambda q: F.expr(f"at{q}.bin + {_width(f'at{q}.bin')} * ({q / 100}D * docs - (at{q}.upto - at{q}.n)) / at{q}.n").alias(f"q{q}")
    return x.select(*by, "measure", "docs", into(25), into(75))


def thresholds(measured: DataFrame, lang_col: str = "lang", source_col: str = "source", reach: float = 3.0, prior: float = 100.0) -> DataFrame:
    """One row (lang, source, max_<measure>..., min_<measure>...) for each group with a document that passes the base rules."""
    # Each sketch is small, but reading it thrice must not measure the corpus thrice.
    sketch = materialise(sketches(measured, lang_col, source_col), "quality-sketch")
    merged = lambda by: sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    called = lambda x, name: x.select(*[F.col(c).alias(f"{name}_{c}") for c in x.columns])
    pulled = lambda q, to: ((F.col("docs") * F.col(q) + prior * F.col(f"{to}_{q}")) / (F.col("docs") + prior)).alias(q)
    all_ = called(_quantiles(merged([]), []), "all")
    langs = _quantiles(merged(["lang"]), ["lang"]).join(all_, F.col("measure") == F.col("all_measure")).select("lang", "measure", pulled("q25", "all"), pulled("q75", "all"))
    langs = called(langs, "of")
    x = _quantiles(sketch, ["lang", "source"]).join(langs, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("measure") == F.col("of_measure")))
    x = x.select("lang", "source", "measure", pulled("q25", "of"), pulled("q75", "of"))
    spread = reach * (F.col("q75") - F.col("q25"))
    ends = [F.max(F.when(F.col("measure") == m, F.col("q75") + spread)).alias(f"max_{m}") for m in MEASURES] + [F.max(F.when(F.col("measure") == m, F.col("q25") - spread)).alias(f"min_{m}") for m, k in MEASURES.items() if k.both]
    # Stored, so that Spark knows its size when it plans the join with documents: it is broadcast below the session's limit only.
    return materialise(x.groupBy("lang", "source").agg(*ends), "quality-limits")


def judged(measured: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source", sure: float = 3.0) -> DataFrame:
    """measured with base_failed and kept: not failed, and no measure surely beyond the limits of its language and source."""
    limits = limits.withColumnRenamed("lang", "_docweave_lang").withColumnRenamed("source", "_docweave_source")
    x = measured.join(limits, F.col(lang_col).eqNullSafe(F.col("_docweave_lang")) & F.col(source_col).eqNullSafe(F.col("_docweave_source")), "left")
    within = F.lit(True)
    for m, k in MEASURES.items():
        value, error = F.expr(k.value), sure * F.expr(k.error)
        within = within & (value - error <= F.col(f"max_{m}"))
        if k.both:
            within = within & (value + error >= F.col(f"min_{m}"))
    x = x.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False)))
    return x.drop(*[c for c in limits.columns])


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **limits) -> DataFrame:
    """One row per row of docs: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    A null or empty text has no words and fails.  Null languages and sources
    are groups like any other.  Repeated rows stay repeated.  An empty table
    gives an empty one.  Other columns are ignored, whatever their names; a
    text is one row's work, so time grows with its length (n log n) and memory
    holds its words.  limits: ``reach`` and ``prior`` of thresholds().
    """
    thin = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    measured = materialise(measures(thin).drop("text"), "quality-measures")
    return judged(measured, thresholds(measured, **limits)).select(F.col("_id").alias(id_col), *COUNTS, "base_failed", "kept")


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **limits) -> DataFrame:
    """The rows of docs that quality() keeps, with their own columns only, whatever their names.

    Rows are stored with their measures once, so that texts are measured once;
    nulls, empty tables, long texts and repeated rows are as in quality().
    """
    own = docs.columns
    thin = docs.select(*[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)], F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    measured = materialise(measures(thin).drop("text"), "quality-measured")
    return judged(measured, thresholds(measured, **limits)).where("kept").select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)])
