"""Explicit schemas of the stored tables and of the event stream."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload field names in wire order; the first twelve are required.
REQUIRED_FIELDS = (
    "transactionId", "userId", "cardFingerprint", "amount", "currency", "merchantId",
    "merchantCategoryCode", "merchantRiskTier", "deviceFingerprint", "ipAddress", "ipCountry",
    "billingCountry",
)
OPTIONAL_FIELDS = ("userAgent", "createdAt")

# Payload field name -> column name.
FIELD_COLUMNS = {
    "transactionId": "transaction_id",
    "userId": "user_id",
    "cardFingerprint": "card_fingerprint",
    "amount": "amount",
    "currency": "currency",
    "merchantId": "merchant_id",
    "merchantCategoryCode": "merchant_category_code",
    "merchantRiskTier": "merchant_risk_tier",
    "deviceFingerprint": "device_fingerprint",
    "ipAddress": "ip_address",
    "ipCountry": "ip_country",
    "billingCountry": "billing_country",
    "userAgent": "user_agent",
    "createdAt": "created_at",
}


def _strings(*names: str, nullable: bool = True) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), nullable) for n in names]


REQUEST = T.StructType(
    [
        *_strings("userId", "cardFingerprint"),
        # Clients send whole and fractional numbers; the stored amount is a whole number.
        T.StructField("amount", T.DecimalType(38, 18)),
        *_strings(
            "currency", "merchantId", "merchantCategoryCode", "merchantRiskTier", "deviceFingerprint",
            "ipAddress", "ipCountry", "billingCountry", "userAgent",
        ),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *_strings("transaction_id", "user_id", "card_fingerprint", nullable=False),
        T.StructField("amount", T.LongType(), False),
        *_strings("currency", "merchant_id", nullable=False),
        *_strings(
            "merchant_category_code", "merchant_risk_tier", "device_fingerprint", "ip_address",
            "ip_country", "billing_country", "user_agent",
        ),
        *_strings("status", nullable=False),
        T.StructField("created_at", T.TimestampNTZType(), False),
    ]
)

OUTBOX = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *_strings("transaction_id", "payload", "status", nullable=False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("published_at", T.TimestampType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        *_strings("name", "expression", nullable=False),
        T.StructField("score", T.IntegerType(), False),
        T.StructField("enabled", T.BooleanType(), False),
        *_strings("group_name", "match_mode"),
    ]
)

DECISIONS = T.StructType(
    [
        *_strings("transaction_id", "decision"),
        T.StructField("risk_score", T.LongType()),
        *_strings("decision_reason", "processing_stage"),
        T.StructField("decided_at", T.TimestampType()),
        T.StructField("behavioral_score", T.LongType()),
        T.StructField("rule_score", T.LongType()),
        T.StructField("enrichment_score", T.LongType()),
        *_strings("rules_version"),
    ]
)

FAILED_EVENTS = T.StructType(
    [
        *_strings("transaction_id", "original_payload", "error_message", "failure_type", "status"),
        T.StructField("retry_count", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("last_retried_at", T.TimestampType()),
        T.StructField("resolved_at", T.TimestampType()),
    ]
)

REPUTATION = T.StructType(
    [
        *_strings("prefix", "reputation"),
        T.StructField("score", T.LongType()),
        *_strings("source"),
        T.StructField("unavailable", T.BooleanType()),
    ]
)

# Record shape shared by topics: key, value, named headers, and the place in the source they came from.
TOPIC_RECORD = T.StructType(
    [
        *_strings("key", "value"),
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([*_strings("key"), T.StructField("value", T.BinaryType())])),
        ),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
