from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from txnsieve.functions.payload import serialize_payload
from txnsieve.functions.text import is_blank
from txnsieve.operators.parsing import parse_payloads, rejected_records, valid_events
from txnsieve.schemas import FIELD_COLUMNS

FIELDS = {
    "transactionId": "order-77/a", "userId": "ann", "cardFingerprint": "c0ffee", "amount": "32",
    "currency": "CHF", "merchantId": "bakery", "merchantCategoryCode": "5462", "merchantRiskTier": "medium",
    "deviceFingerprint": "tablet9", "ipAddress": "198.51.100.7", "ipCountry": "CH", "billingCountry": "LI",
}


def payload(**changes: str | None) -> str:
    fields = {**FIELDS, **changes}
    return "|".join(f"{k}:{v}" for k, v in fields.items() if v is not None)


def parse(spark, *texts):
    return parse_payloads(spark.createDataFrame([(t,) for t in texts], "value string")).collect()


def test_all_fields_and_optional_defaults(spark):
    row = parse(spark, payload())[0]
    assert row.error_message is None
    assert row.amount == 32.0
    for name, text in FIELDS.items():
        if name != "amount":
            assert row[FIELD_COLUMNS[name]] == text
    assert (row.user_agent, row.created_at) == ("", "")


def test_order_of_fields_does_not_matter(spark):
    reordered = "|".join(reversed(payload().split("|")))
    first, second = parse(spark, payload(), reordered)
    assert first.asDict() | {"value": ""} == second.asDict() | {"value": ""}


@pytest.mark.parametrize(
    ("text", "amount"),
    [("149.99", 149.99), ("1e3", 1000.0), ("1d", 1.0), ("Infinity", math.inf), ("-5", -5.0)],
)
def test_numbers(spark, text, amount):
    assert parse(spark, payload(amount=text))[0].amount == amount


def test_nan_is_a_number_only_in_that_spelling(spark):
    exact, other = parse(spark, payload(amount="NaN"), payload(amount="nan"))
    assert math.isnan(exact.amount) and exact.error_message is None
    assert other.error_message == 'For input string: "nan"'


@pytest.mark.parametrize("name", list(FIELDS))
def test_missing_field_names_the_error(spark, name):
    raw = payload(**{name: None})
    row = parse(spark, raw)[0]
    assert row.error_message == f"Missing required field '{name}' in payload: {raw}"


def test_first_missing_field_wins_and_empty_text_lacks_all(spark):
    both, empty, none = parse(spark, payload(amount=None, userId=None), "", None)
    assert "'userId'" in both.error_message
    assert empty.error_message == "Missing required field 'transactionId' in payload: "
    assert none.error_message == empty.error_message


def test_bad_amounts_are_rejected(spark):
    word, blank = parse(spark, payload(amount="abc"), payload(amount=""))
    assert word.error_message == 'For input string: "abc"'
    assert blank.error_message == "empty String"


def test_trim_duplicates_colons_and_junk(spark):
    raw = "\t" + payload(userId=" a b ") + "\x00|currency:EUR|junk|:x| userAgent : Mozilla:5.0 : x "
    row = parse(spark, raw)[0]
    assert (row.transaction_id, row.user_id, row.currency) == ("order-77/a", "a b", "EUR")
    assert row.billing_country == "LI"
    assert row.user_agent == "Mozilla:5.0 : x"


def test_present_but_empty_field_passes(spark):
    row = parse(spark, payload(deviceFingerprint=""))[0]
    assert row.error_message is None and row.device_fingerprint == ""


def test_split_into_valid_and_rejected(spark):
    df = spark.createDataFrame([(payload(),), ("x",)], "value string")
    parsed = parse_payloads(df)
    assert valid_events(parsed).count() == 1
    rejected = rejected_records(parsed).collect()
    assert [(r.transaction_id, r.original_payload) for r in rejected] == [("UNKNOWN", "x")]


def test_serialize_round_trip_and_null_text(spark):
    columns = [FIELD_COLUMNS[n] for n in FIELDS]
    values = tuple(32 if n == "amount" else None if n == "ipCountry" else v for n, v in FIELDS.items())
    types = ", ".join(f"{c} {'long' if c == 'amount' else 'string'}" for c in columns)
    text = spark.createDataFrame([values], types).select(serialize_payload()).first()[0]
    assert text == payload(ipCountry="null")
    assert parse(spark, text)[0].ip_country == "null"


def test_blank(spark):
    texts = [None, "", " \t\n　", " ", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", is_blank(F.col("t")).alias("b")).orderBy("i").collect()
    assert [r.b for r in rows] == [True, True, True, False, False]


def test_null_text_can_be_read_as_null(spark):
    df = spark.createDataFrame([(payload(deviceFingerprint="null"),)], "value string")
    assert parse_payloads(df).first().device_fingerprint == "null"
    row = parse_payloads(df, null_text_as_null=True).first()
    assert row.device_fingerprint is None and row.error_message is None
