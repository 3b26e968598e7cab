"""Personal data with DataFrame functions only: patterns propose, checksums confirm, context adjusts.

A pattern's matches are marked in the text, which is then split at the marks: every
second piece is a match, and the lengths before it give its place in code points.
Patterns are written with possessive repeats and a look behind the start, so that a
long run of word characters is tried once and long chains need no stack; they match
exactly what the plain patterns in ``PLAIN`` match.

Each candidate gets a score: ``CONFIRMED`` if its kind has a checksum or range test
and it passes, else ``PROPOSED``, and ``CONTEXT`` more if a word of its kind stands
within ``BEFORE`` characters before it or ``AFTER`` behind it.  Spans of the base
rules are always kept.  Bank accounts (mod-97) are added, and card numbers of 13 to
15 digits that pass Luhn and have a context word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\x01"
BEFORE, AFTER = 40, 20
PROPOSED, CONFIRMED, CONTEXT, LEAST = 0.5, 0.75, 0.25, 0.75
KINDS = ["email", "ip", "card", "phone", "iban"]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z][A-Z][0-9][0-9](\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?\b",
}
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PLAIN["phone"],
    "iban": PLAIN["iban"],
}
#: what a text must have for a pattern to be tried
HINTS = {"email": "@", "ip": None, "card": None, "phone": "+", "iban": None}
WORDS = {
    "email": "mail|contact|write", "ip": "ip|host|server|address|addr",
    "card": "card|visa|credit|karte|carte|tarjeta|payment", "phone": "phone|tel|call|mobile|fax|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta",
}
EMPTY = "cast(array() as array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def luhn(digits: Column) -> Column:
    """Luhn's test of a string of digits."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice)).cast("long")

    return _total(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), worth)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces, its first four characters moved to the end, is 1 modulo 97."""
    def step(a: Column, c: Column) -> Column:
        v = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (a * F.when(v > 9, 100).otherwise(10) + v) % 97

    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _verdict(kind: str, m: Column) -> tuple[Column, Column]:
    """(base span, confirmed) of a candidate."""
    yes, no = F.lit(True), F.lit(False)
    if kind == "email":
        return yes, no
    if kind == "ip":
        small = F.forall(F.split(m, r"\."), lambda x: _let(F.ltrim(x, F.lit("0")), lambda y: (F.length(y) <= 3) & (
            F.coalesce(y.try_cast("int"), F.lit(0)) <= 255)))
        return small, small
    if kind == "phone":
        n = F.length(F.regexp_replace(m, "[^0-9]", ""))
        return (n >= 8) & (n <= 15), no
    if kind == "card":
        digits = F.regexp_replace(m, "[^0-9]", "")
        good = F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(no)
        return good & (F.length(digits) >= 16), good
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return no, F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(no)


def _spans(kind: str, text: Column) -> Column:
    pieces = F.split(F.regexp_replace(text, f"({PATTERNS[kind]})", f"{MARK}$1{MARK}"), MARK)
    block = 256

    def of_pieces(p: Column) -> Column:
        sizes = F.transform(p.parts, lambda x: F.length(x).cast("long"))
        return _let(F.struct(p.parts.alias("parts"), sizes.alias("sizes")), with_sizes)

    def with_sizes(p: Column) -> Column:
        # lengths are added up in blocks, so that thousands of matches stay cheap
        sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(p.sizes) / block).cast("int")),
                           lambda b: _total(F.slice(p.sizes, b * block + 1, block)))
        return _let(F.struct(p.parts.alias("parts"), p.sizes.alias("sizes"), sums.alias("sums")), with_sums)

    def with_sums(p: Column) -> Column:
        def span(k: Column) -> Column:
            i = k * 2 + 1
            b = F.floor(i / block).cast("int")
            start = _total(F.slice(p.sums, F.lit(1), b)) + _total(F.slice(p.sizes, b * block + 1, i - b * block))
            near = F.concat_ws(" ", F.right(F.get(p.parts, i - 1), F.lit(BEFORE)), F.left(F.get(p.parts, i + 1), F.lit(AFTER)))
            return _let(F.struct(F.get(p.parts, i).alias("m"), start.alias("start"), F.get(p.sizes, i).alias("size"), near.alias("near")), judged)

        return F.transform(F.sequence(F.lit(0), ((F.size(p.parts) - 3) / 2).cast("int")), span)

    def judged(c: Column) -> Column:
        base, confirmed = _verdict(kind, c.m)
        score = F.when(confirmed, CONFIRMED).otherwise(PROPOSED) + F.when(
            c.near.rlike(rf"(?i)(?<![a-z])(?:{WORDS[kind]})(?![a-z])"), CONTEXT).otherwise(0.0)
        known = score if kind != "card" else F.when(base | (score > CONFIRMED), score).otherwise(0.0)
        known = F.when(confirmed, known).otherwise(0.0) if kind in ("card", "iban") else known
        return F.struct(F.lit(kind).alias("kind"), c.start.alias("start"), (c.start + c["size"]).alias("end"),
                        base.alias("base"), known.alias("score"))

    found = _let(F.struct(pieces.alias("parts")), lambda p: F.when(F.size(p.parts) > 1, of_pieces(p)).otherwise(F.expr(EMPTY)))
    kept = F.filter(found, lambda s: s.base | (s.score >= (LEAST if kind in ("card", "iban") else 9.0)))
    hint = text.contains(HINTS[kind]) if HINTS[kind] else text.rlike("[0-9]")
    return F.when(hint, kept).otherwise(F.expr(EMPTY))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) for each row: structs of kind, start, end (code points, end exclusive), base, score.

    Spans are ordered by kind as in KINDS, then start.  A missing text is empty and an
    empty text has no spans.  Rows are judged one by one, so repeated rows and ties
    don't matter.
    """
    clean = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), MARK, "\x02")
    given = docs.select(F.col(f"`{id_col}`").alias("id"), clean.alias("t"))
    each = given.select("id", *[_spans(k, F.col("t")).alias(k) for k in KINDS])
    return each.select(F.col("id").alias(id_col), F.concat(*KINDS).alias("spans"))
