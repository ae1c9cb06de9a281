"""Text helpers with the exact trimming and blank rules the parser and guards need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a payload trim removes (all up to U+0020).
TRIMMED = "".join(chr(c) for c in range(0x21))
# The white space of a blank test; no-break spaces do not count.
BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def has_odd_space(text: Column) -> Column:
    """Whether a text holds any character below the space."""
    return text.rlike(r"[\x00-\x1f]")


def trim_control(text: Column, odd_space: Column) -> Column:
    """Trim all characters up to the space; the cheap trim does where there is nothing else."""
    return F.when(odd_space, F.btrim(text, F.lit(TRIMMED))).otherwise(F.trim(text))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(F.btrim(text, F.lit(BLANK)), F.lit("")) == ""


def blank_to(text: Column, other: Column) -> Column:
    return F.when(is_blank(text), other).otherwise(text)


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | text.startswith(prefix)
    return hit


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit
