"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds are reported whenever their pattern and check hold: ``email``; ``ip`` (four parts of at
most 255); ``card`` (16 to 19 digits that pass Luhn); ``phone`` (``+``, 8 to 15 digits). Further
kinds need a score of ``THRESHOLD``: ``iban`` (mod-97), ``short_card`` (13 to 15 digits that pass
Luhn), ``ssn`` and ``local_phone`` (no checksum, so a context word must stand within ``CONTEXT_CHARS``
characters before or after them).

Patterns are written with possessive repeats and a lookbehind at the start of a run. They find what
the plain greedy patterns find, in one pass over the text and without recursion on long runs.

Null and empty texts have no spans. Every row is treated alone: repeated rows give equal results,
null ids and extra columns are carried along, an empty table gives an empty result. Positions count
code points from 0; the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.llm.common import full_text

CONTEXT_CHARS = 40
THRESHOLD = 0.5
CONTEXT_BOOST = 0.35

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn, from the last digit leftwards."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _digit_count(match: Column, low: int, high: int) -> Column:
    return F.length(_digits(match)).between(low, high)


def _octets(match: Column) -> Column:
    octet = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{octet}(?:\.{octet}){{3}}$")


def _mod97(match: Column) -> Column:
    """Whether an account number passes mod-97: first four signs last, letters as 10 to 35."""
    plain = F.upper(F.regexp_replace(match, "[ -]", ""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    signs = F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10).try_cast("int"))
    rest = F.aggregate(
        F.filter(signs, lambda v: v.isNotNull()),
        F.lit(0),
        lambda a, v: (F.when(v > 9, a * 100).otherwise(a * 10) + v) % 97,
    )
    return F.length(plain).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    """How one kind is found: a sign every match holds, its pattern, its check and its score."""

    name: str
    needs: str
    pattern: str
    check: object
    prior: float
    context: tuple[str, ...] = ()
    base: bool = False


KINDS = (
    Kind(
        "email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        lambda m: F.lit(True), 0.9, ("mail", "contact", "write"), True,
    ),
    Kind(
        "ip", ".", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", _octets, 0.7, ("ip", "host", "address", "server"), True,
    ),
    Kind(
        "card", "", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
        lambda m: _luhn(_digits(m)), 0.8, ("card", "visa", "credit", "payment"), True,
    ),
    Kind(
        "phone", "+", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: _digit_count(m, 8, 15), 0.7,
        ("phone", "call", "tel", "mobile"), True,
    ),
    Kind(
        "iban", "", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        _mod97, 0.8, ("iban", "account", "bank"),
    ),
    Kind(
        "short_card", "", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])",
        lambda m: _luhn(_digits(m)), 0.3, ("card", "visa", "amex", "credit", "payment"),
    ),
    Kind(
        "ssn", "-", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True), 0.3, ("ssn", "social security", "social-security"),
    ),
    Kind(
        "local_phone", "", r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        lambda m: F.lit(True), 0.3, ("phone", "call", "tel", "mobile", "fax"),
    ),
)


def _spans_of(kind: Kind, text: Column, digits: Column) -> Column:
    """Array of (kind, start, end, score) of one kind; empty where the text lacks a sign it needs.

    ``split`` by the pattern gives the text between the matches, so running lengths give positions.
    """
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        before = F.substr(text, F.greatest(F.lit(1), start + 1 - CONTEXT_CHARS), F.least(start, F.lit(CONTEXT_CHARS)))
        after = F.substr(text, end + 1, F.lit(CONTEXT_CHARS))
        near = F.lower(F.concat(before, F.lit("\n"), after))
        close = F.lit(False)
        for word in kind.context:
            close = close | near.contains(word)
        score = F.lit(kind.prior) + F.when(close, CONTEXT_BOOST).otherwise(0.0)
        keep = kind.check(pair["match"])
        if not kind.base:
            keep = keep & (score >= THRESHOLD)
        span = F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), F.least(score, F.lit(1.0)).alias("score")
        )
        return F.struct(
            F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
            end.alias("at"),
        )

    pairs = F.zip_with(matches, F.slice(between, F.lit(1), F.size(matches)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    found = F.aggregate(pairs, F.struct(empty.alias("spans"), F.lit(0).alias("at")), add, lambda s: s["spans"])
    needed = F.contains(text, F.lit(kind.needs)) if kind.needs else F.lit(True)
    if kind.name != "email":
        needed = needed & digits
    return F.when(needed, found).otherwise(empty)


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans") -> DataFrame:
    """``docs`` with an array of spans, by kind as listed in ``KINDS``, then by start."""
    text = full_text(text_col)
    marked = docs.withColumn("_pii_digits", text.rlike("[0-9]"))
    found = [_spans_of(kind, text, F.col("_pii_digits")) for kind in KINDS]
    return marked.withColumn(spans_col, F.concat(*found)).drop("_pii_digits")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*[k.name for k in KINDS if k.base]))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; other columns unchanged.

    Overlapping spans become one, named after the span that begins first (the longer one, if two
    begin together). A text without spans stays as it is, null included. ``length_col`` names a column
    that gets the new number of characters of changed texts.
    """
    spans_col = "_pii_spans"
    while spans_col in docs.columns:
        spans_col += "_"
    work = find_pii(docs, text_col, spans_col)
    text, spans = F.col(text_col), F.col(spans_col)
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))
    )

    def step(state: Column, span: Column) -> Column:
        new = span["start"] >= state["at"]
        gap = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.when(new, F.concat(state["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]")))
            .otherwise(state["out"])
            .alias("out"),
            F.greatest(state["at"], -span["back"]).alias("at"),
        )

    masked = F.aggregate(
        ordered,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)),
    )
    changed = F.size(spans) > 0
    work = work.withColumn(text_col, F.when(changed, masked).otherwise(text))
    if length_col in docs.columns:
        work = work.withColumn(length_col, F.when(changed, F.length(text).cast("long")).otherwise(F.col(length_col)))
    return work.drop(spans_col)
