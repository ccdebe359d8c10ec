"""Text normalisation as Column -> Column functions; all of it stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that Unicode-aware stripping removes (fixed values).
SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: All of them but the space.
OTHER_SPACES = SPACES.replace(r"\x20", r"\x1f")
#: Bytes of which UTF-8 texts that hold any of those, line ends apart, hold some.
OTHER_SPACE_BYTES = [*(bytes([i]) for i in (*b"\t\x0b\x0c\r", *range(0x1C, 0x20))), b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
QUOTES = "\u201c\u201d\"'"


def _steps(value: Column, *steps: Callable[[Column], Column]) -> Column:
    for step in steps:
        value = step(value)
    return value


def _sub(pattern: str, by: str) -> Callable[[Column], Column]:
    return lambda c: F.regexp_replace(c, pattern, by)


#: The same characters one by one.
EACH_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Ends only are looked at, which a pattern can't do."""
    return F.btrim(c, F.lit(EACH_SPACE))


def one_spaced(c: Column) -> Column:
    """Runs of white space become one space; ends are kept."""
    return F.regexp_replace(c, f"{SPACES}+", " ")


def newlines(c: Column) -> Column:
    """Line ends become \\n and the ends are stripped."""
    return strip(F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c))


def entity_name(c: Column) -> Column:
    """The form in which entity names are compared."""
    return _steps(c, strip, F.lower, _sub("\u00ad", ""), one_spaced, _sub(f"[{QUOTES}]", ""), strip)


def eval_name(c: Column) -> Column:
    """The form in which names are scored: as entity_name, but backticks go too and ends aren't stripped again."""
    return _steps(c, strip, F.lower, _sub("\u00ad", ""), one_spaced, _sub(f"[{QUOTES}`]", ""))


def slug(c: Column) -> Column:
    """Lower-case ASCII identifier; ``x`` if nothing is left."""
    kept = _steps(c, strip, F.lower, one_spaced, _sub("[^a-z0-9 _.-]", ""), _sub(" ", "_"), _sub("_+", "_"), _sub("^_+|_+$", ""))
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("x"))


def match_text(c: Column) -> Column:
    """The form in which evidence is looked for in a text: one_spaced() and stripped.

    Whole texts come here, and bytes are found many times faster than a
    pattern's characters.
    """
    odd = reduce(or_, [F.contains(c.cast("binary"), F.lit(b)) for b in OTHER_SPACE_BYTES])
    spaced = F.when(odd, F.regexp_replace(c, OTHER_SPACES, " ")).otherwise(F.replace(c, F.lit("\n"), F.lit(" ")))
    return _steps(spaced, _sub("  +", " "), strip)


def folded(c: Column) -> Column:
    """Case-insensitive form: lower case with sharp s spelled out."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def folded_exact(c: Column) -> Column:
    """Full Unicode case folding, in Arrow batches; ASCII comes out as lower case does."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None else x.casefold())

    return fold(c)


def relation_type(c: Column) -> Column:
    """Upper-case label of a graph edge; ``REL`` if nothing is left, ``R_`` before a digit."""
    kept = _steps(c, strip, F.upper, _sub("[^A-Z0-9_]", "_"), _sub("_+", "_"), _sub("^_+|_+$", ""))
    return F.when(kept == "", "REL").when(kept.rlike("^[0-9]"), F.concat(F.lit("R_"), kept)).otherwise(kept)


def file_name(c: Column, most: int = 120) -> Column:
    """A title as a file name of ASCII characters; ``doc`` if nothing is left."""
    kept = _steps(c, strip, one_spaced, _sub("[^A-Za-z0-9 _.-]", "_"), _sub(" ", "_"), _sub("_+", "_"))
    return F.coalesce(F.nullif(F.substring(kept, 1, most), F.lit("")), F.lit("doc"))


def file_stem(c: Column) -> Column:
    """A file's stem: letters and digits of any script, - _ . and space stay, others become _."""
    return _steps(c, _sub(r"[^\p{L}\p{N}\-_. ]", "_"), strip, lambda x: F.replace(x, F.lit("  "), F.lit(" ")))


def domain_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_")


def before_dot(c: Column) -> Column:
    """A document's id: its file name up to the first dot."""
    return F.substring_index(c, ".", 1)


def without_suffix(c: Column, *suffixes: str) -> Column:
    """A file name without step suffixes such as ``.chunks``, wherever they are."""
    for s in suffixes:
        c = F.replace(c, F.lit(s), F.lit(""))
    return c


def preview(c: Column, size: int) -> Column:
    return F.substring(strip(F.replace(c, F.lit("\n"), F.lit(" "))), 1, size)


def part(c: Column, start: Column, end: Column) -> Column:
    """Characters [start, end), counted from 0."""
    return F.substring(c, start + 1, end - start)


def last_place(c: Column, what: str) -> Column:
    """Where ``what`` occurs last, from 0; -1 if nowhere."""
    at = F.locate(what[::-1], F.reverse(c))
    return F.when(at > 0, F.length(c) - at - len(what) + 1).otherwise(-1)


def place_from(what: Column, c: Column, start: Column) -> Column:
    """Where ``what`` occurs first at or after start, from 0; -1 if nowhere."""
    return F.call_function("locate", what, c, start + 1) - 1


def utc_now() -> Column:
    """Processing time as an ISO-8601 string in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def greedy_json(c: Column, braces_only: bool = False) -> Column:
    """The text from the first opening bracket to the last one that closes it; null without one."""
    pattern = r"(?s)(\{.*\})" if braces_only else r"(?s)(\{.*\}|\[.*\])"
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
