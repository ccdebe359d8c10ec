"""Personal data in whole texts: patterns, checksums and context, in DataFrame functions only.

Regular expressions propose spans, leftmost first and without overlap within a
kind.  Validators confirm them: the parts of an address are at most 255, card
numbers pass Luhn, bank account numbers pass mod 97, phone numbers have 9 to
15 digits.  A span's score is its kind's own, raised by a passed checksum and
by context words close by.  The four base kinds are reported whenever they are
valid; the other kinds where their score reaches ``least_score`` and they
overlap no base span.

Patterns start only where a run of their characters starts (or right after the
match before), and repeat possessively, so a text of one long run costs time
in proportion to its length and no recursion.  Spans are gathered in blocks:
100,000 of them in one text take a few seconds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, folded, held, let

BEFORE, AFTER = 48, 24
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A plain test that every text with a match passes, cheaper than the pattern.
    hint: str
    score: float
    checked: float
    context: str
    #: The group that is proposed, if not the match.
    group: int = 0


#: In the order in which spans at one place are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, 0.0, "mail|contact|write to|courriel|correo"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, 0.2, "ip|address|server|host|adresse"),
    Kind("card", r"(?<![0-9])[0-9](?:[ -]?[0-9])++", "", 0.4, 0.4, "card|visa|master|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.6, 0.2, "tel|phone|call|fax|mobil|whatsapp"),
    # Narrower proposals inside what a greedy match above has run together with its neighbours.
    Kind("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4})(?![0-9])", "", 0.4, 0.4, "card|visa|master|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])", "+", 0.6, 0.2, "tel|phone|call|fax|mobil|whatsapp"),
    # The match is a start of four characters only, so that a start within the run after another one is met as well; the group goes on over what may belong to it.
    Kind("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?s:.{0,24})))[A-Z]{2}[0-9]{2}", "", 0.3, 0.5, "iban|account|bank|konto|compte|cuenta", 1),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, 0.1, r"ssn|social security|taxpayer|tax id"),
    Kind("local_phone", r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", "", 0.3, 0.1, r"tel|phone|call|fax|mobile|cell"),
)
BASE = 4

#: Characters of an account number by country; other countries' have any length.
ACCOUNTS = dict(part.split(":") for part in "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SE:24 SI:19 SK:24 SM:27 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20".split())


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _mod97(m: Column) -> Column:
    """An account number's remainder: its first four characters go last, letters count 10 to 35."""
    plain = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9..)|-00-|0000$")
    return F.lit(True)


def _account(run: Column) -> Column:
    """The account number that a run of characters starts with, null if none.

    All cuts of 15 to 34 characters at a word's end are tried by mod 97; of
    several valid ones that of the country's length is taken, or the longest.
    """
    cut = lambda n: F.call_function("regexp_extract", run, F.concat(F.lit("^(?: ?[A-Z0-9]){"), n.cast("string"), F.lit("}(?![A-Za-z0-9])")), F.lit(0))
    valid = F.filter(F.transform(F.sequence(F.lit(15), F.lit(34)), cut), lambda m: (m != "") & (_mod97(m) == 1))
    length = F.element_at(F.create_map(*[F.lit(x) for c, n in ACCOUNTS.items() for x in (c, int(n))]), F.left(run, F.lit(2)))
    best = lambda v: F.coalesce(F.get(F.filter(v, lambda m: F.length(F.regexp_replace(m, " ", "")) == length), F.lit(0)), F.get(v, F.size(v) - 1))
    return F.when(F.size(valid) > 0, let(valid, best))


#: A span: code points from 0, end exclusive; kinds are numbered as in KINDS.
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:double>"
NONE = f"array<{SPAN}>"


def _entry(no: int, start: Column, size: Column, context: Column) -> Column:
    k = KINDS[no]
    return F.struct(start.alias("start"), F.lit(no).alias("kind_no"), (start + size).alias("end"), F.lit(k.name).alias("kind"), F.least(F.lit(1.0), F.lit(k.score + k.checked) + context).alias("score"))


def _context(no: int, before: Column, after: Column) -> Column:
    near = F.concat_ws(" ", F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER)))
    return F.when(near.rlike(f"(?i)(?<![a-z])(?:{KINDS[no].context})"), 0.3).otherwise(0.0)


def _accounts(pieces: Column, found: Column, no: int) -> Column:
    """As _spans(), for runs: an account number is in a run of its own, and none starts within the one before."""
    item = lambda i, e, m: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("size"), _context(no, F.get(pieces, i), F.substring(e, F.length(m) + 1, F.length(e))).alias("context"))
    each = F.transform(found, lambda e, i: let(_account(e), lambda m: item(i, e, m)))

    def step(s: Column, e: Column) -> tuple[Column, Column, Column]:
        start = s["at"] + e["gap"]
        ok = e["size"].isNotNull() & (start >= s["until"])
        return F.struct((start + 4).alias("at"), F.when(ok, start + e["size"]).otherwise(s["until"]).alias("until")), ok, _entry(no, start, e["size"], e["context"])

    return folded(each, F.struct(F.lit(0).alias("at"), F.lit(0).alias("until")), SPAN, step)


def _spans(pieces: Column, found: Column, no: int) -> Column:
    """Valid matches as spans; pieces are the texts between all matches."""
    if KINDS[no].name == "iban":
        return _accounts(pieces, found, no)
    each = F.transform(found, lambda m, i: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("size"), _valid(KINDS[no].name, m).alias("ok"), _context(no, F.get(pieces, i), F.get(pieces, i + 1)).alias("context")))

    def step(s: Column, e: Column) -> tuple[Column, Column, Column]:
        start = s["at"] + e["gap"]
        return F.struct((start + e["size"]).alias("at")), e["ok"], _entry(no, start, e["size"], e["context"])

    return folded(each, F.struct(F.lit(0).alias("at")), SPAN, step)


def _merged(base: Column, more: Column) -> Column:
    """Spans of base, and those of more that overlap none of them, in order of start and kind.

    Two passes over all of them in order: forwards, a span goes that starts
    before the end of a base span met so far; backwards, one that ends after
    the start of the base span met last.
    """
    is_base = lambda e: e["kind_no"] < BASE
    ahead = lambda s, e: (F.struct(F.when(is_base(e), F.greatest(s["edge"], e["end"])).otherwise(s["edge"]).alias("edge")), is_base(e) | (e["start"] >= s["edge"]), e)
    back = lambda s, e: (F.struct(F.when(is_base(e), e["start"]).otherwise(s["edge"]).alias("edge")), is_base(e) | (e["end"] <= s["edge"]), e)
    both = folded(F.reverse(folded(F.array_sort(F.concat(base, more)), F.struct(F.lit(0).alias("edge")), SPAN, ahead)), F.struct(F.lit((1 << 31) - 1).alias("edge")), SPAN, back)
    return F.when(F.size(more) > 0, F.reverse(both)).otherwise(F.array_sort(base))


def _found(docs: DataFrame, text_col: str, least_score: float) -> DataFrame:
    """(row, text, spans): each row of docs as a struct, so that no name of its columns matters, its text (null: empty) and its spans."""
    x = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    empty, numbers = F.array().cast("array<string>"), range(len(KINDS))
    for no, k in enumerate(KINDS):
        hint = F.col("text").contains(k.hint) if k.hint else F.col("text").rlike("[0-9]{2}|[0-9][ -][0-9]")
        x = x.withColumn(f"m{no}", F.when(hint, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(k.group))).otherwise(empty))
    for no, k in enumerate(KINDS):
        x = x.withColumn(f"p{no}", F.when(F.size(f"m{no}") > 0, F.split("text", k.pattern, -1)).otherwise(empty))
    x = x.select("row", "text", *[held(F.col(f"{c}{no}")).alias(f"{c}{no}") for no in numbers for c in "mp"])
    some = lambda no: F.when(F.size(f"m{no}") > 0, _spans(F.col(f"p{no}"), F.col(f"m{no}"), no)).otherwise(F.array().cast(NONE))
    x = x.select("row", "text", *[some(no).alias(f"s{no}") for no in numbers])
    more = F.filter(F.concat(*[F.col(f"s{no}") for no in numbers if no >= BASE]), lambda e: e["score"] >= least_score)
    x = x.select("row", "text", F.concat(*[F.col(f"s{no}") for no in range(BASE)]).alias("base"), held(more).alias("more"))
    return x.select("row", "text", held(_merged(F.col("base"), F.col("more"))).alias("spans"))


def with_spans(docs: DataFrame, text_col: str = "text", least_score: float = 0.6, out_col: str = "pii") -> DataFrame:
    """docs with ``out_col``: spans (start, kind_no, end, kind, score) by start, then kind; code points, end exclusive.

    A null or empty text has none; a column of that name is replaced.  Other
    columns may have any names.  Repeated rows stay, no rows give none.
    """
    x = _found(docs, text_col, least_score)
    return x.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != out_col], F.col("spans").alias(out_col))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_other, max_score).

    A null or empty text has no spans.  Repeated rows stay repeated; null ids
    are kept.  An empty table gives an empty one.  Other columns are ignored.
    """
    x = with_spans(docs.select(F.col(id_col), F.col(text_col).alias("_t")), "_t")
    base = F.filter("pii", lambda e: e["kind_no"] < BASE)
    count = lambda no: F.size(F.filter("pii", lambda e: e["kind_no"] == no)).cast("long")
    return x.select(
        id_col, *[count(no).alias(f"n_{KINDS[no].name}") for no in range(BASE)], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda e: e["kind_no"] >= BASE)).cast("long").alias("n_other"), F.array_max(F.transform("pii", lambda e: e["score"])).alias("max_score"),
    )


def _cut(text: Column, spans: Column, block: int = 256) -> Column:
    """text with each span replaced by its kind in square brackets, where spans overlap by that of the first.

    A place in a text is found by counting its characters, so a block of
    neighbouring spans takes its part of the text first.
    """
    step = lambda s, e: (F.struct(F.greatest(s["at"], e["end"]).alias("at")), e["start"] >= s["at"], F.struct(s["at"].alias("lo"), e["start"].alias("hi"), e["kind"].alias("kind")))
    cuts = folded(spans, F.struct(F.lit(0).alias("at")), "struct<lo:int,hi:int,kind:string>", step)
    last = lambda part: F.get(part, F.size(part) - 1)
    piece = lambda c, x: F.concat(F.substring(c["text"], x["lo"] - c["lo"] + 1, x["hi"] - x["lo"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
    whole = lambda part: F.struct(F.get(part, F.lit(0))["lo"].alias("lo"), F.substring(text, F.get(part, F.lit(0))["lo"] + 1, last(part)["hi"] - F.get(part, F.lit(0))["lo"]).alias("text"))
    joined = F.transform(let(cuts, lambda c: blocks_of(c, block)), lambda part: let(whole(part), lambda c: F.array_join(F.transform(part, lambda x: piece(c, x)), "")))
    end = F.array_max(F.transform(spans, lambda e: e["end"]))
    return F.concat(F.array_join(joined, ""), F.substring(text, end + 1, F.length(text)))


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with every span replaced by its kind in square brackets, where spans overlap by that of the first.

    A null text stays null, an empty one empty; length_col, if docs has it,
    follows the new text.  Other columns stay, whatever their names.  Repeated
    rows stay repeated, and no rows give none.
    """
    x = _found(docs, text_col, 0.6)
    x = x.select("row", held(F.when(F.col("row")[text_col].isNull() | (F.size("spans") == 0), F.col("row")[text_col]).otherwise(_cut(F.col("text"), F.col("spans")))).alias("clean"))

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("clean")
        if c == length_col:
            return F.length("clean").cast(docs.schema[c].dataType)
        return F.col("row")[c]

    return x.select(*[column(c).alias(c) for c in docs.columns])
