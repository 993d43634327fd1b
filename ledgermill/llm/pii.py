"""Personal data by pattern, checksum and context, in Spark column expressions only.

A pattern proposes spans, a validator (octet range, Luhn, digit count, mod 97) confirms them, and words near a span raise
its score. Matches are leftmost and do not overlap within a kind. Positions count code points. They come from splitting
the text at the same pattern: the pieces between the matches and the matches alternate.

The patterns are written so that no text, however long, costs more than linear time: repetitions are possessive or bounded,
and a run that cannot start a match is not entered again at each of its characters (``(?:\\G|(?<!...))``). Starts of matches are
sums over chunks of matches, so a text of very many numbers costs little more than its length.

Defined results: null and empty texts have no span; an empty table gives an empty result. Rows are independent, so repeated
rows repeat their result. Columns besides identifier and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import slim

#: Kinds in the order of the result, base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")

#: The pattern of each kind.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
}
#: A text without this cannot hold the kind; the pattern is not tried on it.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None}
#: Words that make a kind likelier when they stand within ``NEAR`` characters before it.
CONTEXT = {
    "email": r"(?i)(?:mail|contact|kontakt|correo|courriel|write|send)",
    "ip": r"(?i)(?:\bip\b|address|host|server|adresse|login)",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|payment|pay)",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|anruf|appel|llam)",
    "iban": r"(?i)(?:iban|account|bank|konto|compte|cuenta)",
}
NEAR = 40
#: Score of a confirmed span, and what a context word adds.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.9}
CONTEXT_BONUS = 0.1

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.split(F.reverse(digits), "")

    def value(digit: Column, place: Column) -> Column:
        doubled = digit.cast("int") * (1 + place % 2)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    numbered = F.transform(F.filter(places, lambda d: d != ""), value)
    return F.aggregate(numbered, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes the check of ISO 13616: letters count from A = 10, the first four signs go last."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        number = F.when(sign.rlike("[0-9]"), sign.cast("int")).otherwise(F.ascii(sign) - 55)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.filter(F.split(moved, ""), lambda s: s != ""), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(f"^{_OCTET}(?:[.]{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


_CHUNK = 256  # steps placed in one run; lists grow by copies, so they are kept short
_PLACED = "array<struct<start:int,match:string,gap:string>>"


def _placed(steps: Column) -> Column:
    """Start of each match from the lengths of the gaps and matches before it: sums of chunks first, then inside each chunk."""
    ends = lambda at, step: at + F.length(step["gap"]) + F.length(step["match"])

    def inside(chunk: Column, begin: Column) -> Column:
        empty = F.struct(begin.alias("at"), F.array().cast(_PLACED).alias("all"))

        def place(state: Column, step: Column) -> Column:
            start = state["at"] + F.length(step["gap"])
            one = F.struct(start.alias("start"), step["match"].alias("match"), step["gap"].alias("gap"))
            return F.struct(ends(state["at"], step).alias("at"), F.concat(state["all"], F.array(one)).alias("all"))

        return F.aggregate(chunk, empty, place, lambda state: state["all"])

    def begins(chunks: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        sizes = F.transform(chunks, lambda chunk: F.aggregate(chunk, F.lit(0), ends))
        return F.aggregate(
            sizes, empty, lambda state, size: F.struct((state["at"] + size).alias("at"), F.concat(state["all"], F.array(state["at"])).alias("all")),
            lambda state: state["all"],
        )

    def whole(steps: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(steps), F.lit(_CHUNK)), lambda at: at < F.size(steps))
        chunks = F.transform(firsts, lambda at: F.slice(steps, at + 1, F.lit(_CHUNK)))
        return _bound(chunks, lambda known: F.flatten(F.zip_with(known, begins(known), inside)))

    return _bound(steps, whole)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once; an expression inside a lambda would be for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, in order of their start."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = _bound(
        found,
        lambda matches: F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match"))
        ),
    )
    confirmed = F.filter(_placed(steps), lambda s: _valid(kind, s["match"]))
    named = F.transform(
        confirmed,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["match"])).alias("end"),
            F.when(F.right(s["gap"], F.lit(NEAR)).rlike(CONTEXT[kind]), BASE_SCORE[kind] + CONTEXT_BONUS)
            .otherwise(BASE_SCORE[kind]).alias("score"),
        ),
    )
    possible = text.rlike("[0-9]") if kind != "email" else F.lit(True)
    if NEEDS[kind]:
        possible = F.contains(text, F.lit(NEEDS[kind])) & possible
    return F.when(possible, named).otherwise(F.array()).cast(_SPANS)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one array of spans (kind, start, end, score) per kind of ``KINDS``."""
    source = slim(docs, id_col, text_col)
    return source.select("doc_id", *(spans(F.col("text"), kind).alias(kind) for kind in KINDS))


def written(*arrays: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    parts = F.transform(F.concat(*arrays), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
