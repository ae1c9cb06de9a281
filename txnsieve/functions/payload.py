"""Columns that read and write the ``key:value|key:value`` payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnsieve.functions.text import trim_control
from txnsieve.schemas import FIELD_COLUMNS, REQUIRED_FIELDS


def payload_parts(raw: Column) -> Column:
    return F.split(F.coalesce(raw, F.lit("")), r"\|", -1)


def in_wire_order(parts: Column) -> Column:
    """Whether the parts are exactly the required fields in wire order, as producers write them."""
    named = [F.startswith(F.get(parts, F.lit(i)), F.lit(f"{n}:")) for i, n in enumerate(REQUIRED_FIELDS)]
    return reduce(lambda a, b: a & b, named, F.size(parts) == len(REQUIRED_FIELDS))


def ordered_value(parts: Column, name: str) -> Column:
    """The value of a field of a payload in wire order; null for an optional field."""
    if name not in REQUIRED_FIELDS:
        return F.lit(None).cast("string")
    part = F.get(parts, F.lit(REQUIRED_FIELDS.index(name)))
    return F.trim(F.substr(part, F.lit(len(name) + 2)))


def payload_pairs(parts: Column) -> Column:
    """Pairs of a payload, last first, so that the first match of a key is its last value.

    The key ends at the first colon; parts without a key are left out.
    """
    return F.reverse(F.filter(parts, lambda p: F.instr(p, ":") > 1))


def pair_keys(pairs: Column, odd_space: Column) -> Column:
    return F.transform(pairs, lambda p: trim_control(F.substring_index(p, ":", 1), odd_space))


def pair_values(pairs: Column, odd_space: Column) -> Column:
    return F.transform(pairs, lambda p: trim_control(F.substr(p, F.instr(p, ":") + F.lit(1)), odd_space))


def field_value(keys: Column, values: Column, name: str) -> Column:
    """The value of a field, null when the payload does not carry it."""
    return F.get(values, (F.array_position(keys, F.lit(name)) - 1).cast("int"))


def first_missing(names: dict[str, str]) -> Column:
    """The first required field, in wire order, that is null; null when none is.

    ``names`` maps columns to the name they have here.
    """
    columns = [(n, names.get(FIELD_COLUMNS[n], FIELD_COLUMNS[n])) for n in REQUIRED_FIELDS]
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(n)) for n, c in columns])


# The spellings of numbers that are no digits; any other text with an n is no number.
_WORD_NUMBERS = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity")


def parse_amount(text: Column) -> Column:
    """Amount text to double, null when it is no number."""
    wordless = ~F.contains(F.lower(text), F.lit("n"))
    return F.when(wordless | text.isin(*_WORD_NUMBERS), text.try_cast("double"))


def amount_error(text: Column) -> Column:
    return F.when(text == "", F.lit("empty String")).otherwise(
        F.concat(F.lit('For input string: "'), text, F.lit('"'))
    )


def serialize_payload(**columns: Column) -> Column:
    """The twelve-field payload; ``columns`` override the column of the same name.

    A null value travels as the text ``null``.
    """
    parts = []
    for name in REQUIRED_FIELDS:
        column = FIELD_COLUMNS[name]
        value = columns.get(column, F.col(column)).cast("string")
        parts.append(F.concat(F.lit(f"{name}:"), F.coalesce(value, F.lit("null"))))
    return F.concat_ws("|", *parts)
