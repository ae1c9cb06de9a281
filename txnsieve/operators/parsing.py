"""Payload text to typed events, with a reject branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.functions.payload import (
    amount_error,
    field_value,
    first_missing,
    in_wire_order,
    ordered_value,
    pair_keys,
    pair_values,
    parse_amount,
    payload_pairs,
    payload_parts,
)
from txnsieve.functions.text import has_odd_space
from txnsieve.schemas import FIELD_COLUMNS, OPTIONAL_FIELDS

ERROR = "error_message"
UNKNOWN_ID = "UNKNOWN"
#: Where a record stood in its source; part of the order of arrival.
PLACE = ("source_partition", "source_offset")
#: Event times that a date can be made of: the years 1970 to 9999.
LAST_MS = 253_402_300_799_999


def parse_payloads(df: DataFrame, raw: str = "value", null_text_as_null: bool = False) -> DataFrame:
    """Add the event fields and ``error_message``, null for a valid payload.

    Optional fields default to empty text. The first missing required field names the error; a
    present but empty field passes. A null field travels as the text ``null`` and stays that text,
    unless ``null_text_as_null`` is set.
    """
    # Producers write all fields in one order, which needs no search; any other payload is searched
    # by key. The generators do each step once per row: filters on the fields stop there instead of
    # repeating that work for every field they name.
    kept = [c for c in df.columns if c not in FIELD_COLUMNS.values()]
    parts, odd, ordered = F.col("_parts"), F.col("_odd"), F.col("_ordered")
    pairs = F.when(~ordered, payload_pairs(parts))
    split = F.struct(payload_parts(F.col(raw)).alias("_parts"), F.coalesce(has_odd_space(F.col(raw)), F.lit(False)).alias("_odd"))
    search = F.struct(pair_keys(pairs, odd).alias("_keys"), pair_values(pairs, odd).alias("_values"))
    fields = F.struct(
        *[
            F.when(ordered, ordered_value(parts, n))
            .otherwise(field_value(F.col("_keys"), F.col("_values"), n))
            .alias(c)
            for n, c in FIELD_COLUMNS.items()
        ]
    )
    read = (
        df.select(*kept, F.inline(F.array(split)))
        .withColumn("_ordered", ~odd & in_wire_order(parts))
        .select(*kept, "_parts", "_odd", "_ordered", F.inline(F.array(search)))
        .select(*kept, F.inline(F.array(fields)))
        .withColumnsRenamed({"amount": "_amount_text"})
    )
    checks = F.struct(
        parse_amount(F.col("_amount_text")).alias("amount"),
        first_missing({"amount": "_amount_text"}).alias("_missing"),
    )
    read = read.select("*", F.inline(F.array(checks)))
    missing, amount = F.col("_missing"), F.col("amount")
    error = F.when(
        missing.isNotNull(),
        F.concat(F.lit("Missing required field '"), missing, F.lit("' in payload: "), F.coalesce(F.col(raw), F.lit(""))),
    ).when(amount.isNull(), amount_error(F.col("_amount_text")))
    optional = [FIELD_COLUMNS[n] for n in OPTIONAL_FIELDS]

    def result(column: str) -> Column:
        if column == "amount":
            return amount
        value = F.coalesce(column, F.lit("")) if column in optional else F.col(column)
        return F.nullif(value, F.lit("null")) if null_text_as_null else value

    return read.select(*kept, *[result(c).alias(c) for c in FIELD_COLUMNS.values()], error.alias(ERROR))


def valid_events(parsed: DataFrame, raw: str = "value") -> DataFrame:
    return parsed.where(F.col(ERROR).isNull()).drop(ERROR, raw)


def rejected_records(parsed: DataFrame, raw: str = "value") -> DataFrame:
    """Records for the dead-letter topic: an unparsed payload has no id of its own."""
    return parsed.where(F.col(ERROR).isNotNull()).select(
        F.lit(UNKNOWN_ID).alias("transaction_id"),
        F.col(raw).alias("original_payload"),
        ERROR,
        *[c for c in ("event_ms", "seq", *PLACE) if c in parsed.columns],
    )


def reject_impossible_times(parsed: DataFrame, ms: str = "event_ms") -> DataFrame:
    """Marks rows without an event time, or with one that no date can be made of, as rejects."""
    possible = F.coalesce(F.col(ms).between(0, LAST_MS), F.lit(False))
    error = F.concat(F.lit("Impossible event time: "), F.coalesce(F.col(ms).cast("string"), F.lit("none")))
    return parsed.withColumn(ERROR, F.coalesce(ERROR, F.when(~possible, error)))
